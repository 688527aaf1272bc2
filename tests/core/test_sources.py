"""Fetching that tells its failures, silver that replaces what is new, and files inspected on executors."""

from __future__ import annotations

import argparse
import http.server
import json
import threading

import pytest
import yaml
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.plans import silver
from tidemark.sources import discovery, files
from tidemark.sources.registry import load_registry

CHAIN = "[SSL: CERTIFICATE_VERIFY_FAILED] unable to get local issuer certificate"
NAMES = ["CLAVE", "ANIO", "AVANCE", "LATITUD", "LONGITUD", "TOTAL"]
RENAME = dict(zip(NAMES, ("cve_cartera", "anio", "avance_fisico", "latitud", "longitud", "monto_total_inversion"), strict=True))


def probes_of(spark, urls):
    return spark.createDataFrame([("vivo", u, 2020, q, True) for q, u in enumerate(urls, 1)], "fuente string, url string, anio int, trimestre int, existe boolean")


def test_failures_are_told_kept_and_joined_again(spark, tmp_path, capsys):
    calls: list[str] = []
    served = {"https://h/a.csv": b"A,B\n1,2\n", "https://h/chain.csv": b"A,B\n3,4\n"}

    def fetch(method, url):
        calls.append(url)
        if "chain" in url:
            raise OSError(CHAIN)
        if "down" in url:
            raise OSError("connection reset")
        if "empty" in url:
            return 200, {}, b""
        return (200, {}, served[url]) if url in served else (404, {}, b"")

    urls = ["https://h/a.csv", "https://h/chain.csv", "https://h/gone.csv", "https://h/down.csv", "https://h/empty.csv"]
    lines = [{"fuente": "vivo", "url": u, "anio": 2020, "trimestre": q, "existe": True} for q, u in enumerate(urls, 1)]
    (tmp_path / "discovery.jsonl").write_text("".join(json.dumps(r) + "\n" for r in lines))
    args = argparse.Namespace(data=str(tmp_path), all=False)
    run = lambda **k: cli.bronze(spark, args, fetch, lambda m, u: (200, {}, served[u]), 0.0, **k)
    discovery_sleep, discovery.time.sleep = discovery.time.sleep, lambda s: None
    try:
        assert run() == 1
        out = capsys.readouterr()
        assert "2 files added, 3 failed" in out.out and "HTTP 404: https://h/gone.csv" in out.err and "the file is empty" in out.err
        records = {r["url"]: r for r in files.read_manifest(spark, str(tmp_path / "manifest.jsonl")).collect()}
        assert set(records) == set(served) and records["https://h/chain.csv"]["http_status"] == 200
        calls.clear()
        assert run() == 1  # what is gone is not asked for again, the others are
        assert set(calls) == {"https://h/down.csv", "https://h/empty.csv"}
        last = {r["url"].split("/")[-1]: (r["intentos_previos"], r["ultimo_status"]) for r in discovery.last_failures(files.read_failures(spark, str(tmp_path / "fallidos.jsonl"))).collect()}
        assert last == {"gone.csv": (1, 404), "down.csv": (2, None), "empty.csv": (2, 200)}
        served |= {"https://h/down.csv": b"A\n1\n", "https://h/empty.csv": b"A\n2\n", "https://h/gone.csv": b"A\n3\n"}
        fetch_all = lambda m, u: (200, {}, served[u])
        assert cli.bronze(spark, args, fetch_all, None, 0.0) == 0
        args.all = True
        assert cli.bronze(spark, args, fetch_all, None, 0.0) == 0
        assert files.read_manifest(spark, str(tmp_path / "manifest.jsonl")).count() == 5
    finally:
        discovery.time.sleep = discovery_sleep


def test_an_incomplete_chain_without_another_client_is_a_failure(spark, tmp_path):
    def fetch(method, url):
        raise OSError(CHAIN)

    pending = discovery.to_ingest(probes_of(spark, ["https://h/x.csv"]), files.read_manifest(spark, str(_empty(tmp_path))))
    done = discovery.ingest(fetch, pending, tmp_path / "b", tmp_path / "m.jsonl", "d", discovery.RateLimiter(0.0), sleep=lambda s: None)
    assert done.added == 0 and len(done.failed) == 1 and "CERTIFICATE" in done.failed[0][1]
    done = discovery.ingest(fetch, pending, tmp_path / "b", tmp_path / "m.jsonl", "d", discovery.RateLimiter(0.0), fallback=lambda m, u: (503, {}, b""), sleep=lambda s: None)
    assert done.failed == [("https://h/x.csv", "HTTP 503")]


def _empty(folder):
    (folder / "m.jsonl").touch()
    return folder / "m.jsonl"


def test_mirror_questions_use_the_other_client_and_names_alone():
    def fetch(method, url):
        raise OSError(CHAIN)

    def other(method, url):
        if "search" in url:
            return 200, {}, json.dumps({"result": {"count": 2, "results": [{"name": "x", "notes": "obra abierta"}, {"name": "y", "title": "Obra Abierta"}]}}).encode()
        return (200, {}, json.dumps({"success": False}).encode()) if "show" in url else (200, {}, b"the OPA of works")

    asked = discovery.mirror_questions(lambda u: (None, None, "no_reconocido"), "https://m", "p", "s", "https://page", (("opa",), ("works", "other")))
    got = list(discovery.ask(fetch, asked, discovery.RateLimiter(0.0), sleep=lambda s: None, fallback=other))
    assert [(p.existe, p.error) for p in got] == [(False, "no package of this id"), (True, None), (True, None)]
    assert got[1].extra["coincidencia_real"] == "y"
    got = list(discovery.ask(fetch, asked, discovery.RateLimiter(0.0), sleep=lambda s: None))
    assert all(not p.existe and "CERTIFICATE" in p.error for p in got)


def test_the_systems_client(tmp_path):
    class Handler(http.server.BaseHTTPRequestHandler):
        def answer(self):
            if self.path == "/moved":
                self.send_response(302)
                self.send_header("Location", "/file")
                self.end_headers()
                return
            body = b"x" * 5000 if self.path == "/file" else b"no"
            self.send_response(200 if self.path == "/file" else 404)
            self.send_header("Content-Length", str(len(body)))
            self.send_header("X-Kind", "a: b")
            self.end_headers()
            if self.command == "GET":
                self.wfile.write(body)

        do_GET = do_HEAD = answer

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        status, headers, body = cli.curl_fetch("GET", f"{base}/moved")
        assert (status, headers["x-kind"], len(body)) == (200, "a: b", 5000)
        assert cli.curl_fetch("HEAD", f"{base}/file")[::2] == (200, b"")
        assert len(cli.curl_fetch("GET_RANGE", f"{base}/file")[2]) == discovery.RANGE
        assert cli.curl_fetch("GET", f"{base}/none")[0] == 404
        assert cli.curl_fetch("GET", "http://127.0.0.1:1/none", 2.0) == (None, {}, b"")
    finally:
        server.shutdown()


# --- silver -------------------------------------------------------------------------------------------


@pytest.fixture
def bronze(spark, tmp_path):
    folder = tmp_path / "bronze"
    folder.mkdir()
    (tmp_path / "r.yml").write_text(yaml.safe_dump({"esquemas": {files.header_hash(NAMES): {"columnas": RENAME}}, "snapshots_conocidos_corruptos": []}, sort_keys=False))
    registry, records = load_registry(tmp_path / "r.yml"), []

    def add(i, rows, sha=None):
        (folder / f"f{i}.csv").write_text("\n".join([",".join(NAMES), *rows]) + "\n")
        records[:] = [r for r in records if r["snapshot_id"] != f"202{i}Q1_x"]
        records.append({"snapshot_id": f"202{i}Q1_x", "sha256": sha or f"s{i}", "archivo_bronze": f"f{i}.csv", "header_hash": files.header_hash(NAMES), "encoding_detectado": "utf-8", "corte_declarado": {"anio": 2020 + i, "trimestre": 1}})
        (tmp_path / "m.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records))

    def run():
        manifest, out = files.read_manifest(spark, str(tmp_path / "m.jsonl")), str(tmp_path / "silver")
        return silver.write_silver(silver.normalise(spark, registry, manifest, str(folder), silver.written_snapshots(spark, out)), out)

    return tmp_path, add, run, registry


def row(i, total="5"):
    return f"0411211000{i},2020,1,20,-99,{total}"


def test_only_new_snapshots_are_written(spark, bronze):
    path, add, run, registry = bronze
    add(0, [row(1), row(2), row(3, "-1")])
    add(1, [row(1), "bad,2020,1,20,-99,5"])
    assert [i for i, _ in run().snapshots] == ["2020Q1_x", "2021Q1_x"]
    stamp = lambda: {str(p.relative_to(path)): p.stat().st_mtime_ns for p in (path / "silver").rglob("*.parquet")}
    before = stamp()
    assert run().snapshots == [] and stamp() == before
    add(2, [row(7)])
    assert [i for i, _ in run().snapshots] == ["2022Q1_x"]
    after = stamp()
    assert all(after[k] == v for k, v in before.items()) and {k.split("snapshot_id=")[1].split("/")[0] for k in set(after) - set(before)} == {"2022Q1_x"}
    # the same snapshot with other content is replaced, its quarantine with it
    add(1, [row(1), row(8)], "other")
    assert [i for i, _ in run().snapshots] == ["2021Q1_x"]
    schema = silver.silver_schema(registry.canonical_columns())
    rows = files.read_silver(spark, str(path / "silver"), schema, "valid")
    assert {r["snapshot_id"]: r["count"] for r in rows.groupBy("snapshot_id").count().collect()} == {"2020Q1_x": 2, "2021Q1_x": 2, "2022Q1_x": 1}
    assert [r["snapshot_id"] for r in files.read_silver(spark, str(path / "silver"), schema, "quarantine").collect()] == ["2020Q1_x"]
    audit = {r["snapshot_id"]: r for r in spark.read.schema(silver.AUDIT).parquet(str(path / "silver/audit")).collect()}
    assert {k: (r["n_rows"], r["n_valid"], r["sha256"]) for k, r in audit.items()} == {"2020Q1_x": (3, 2, "s0"), "2021Q1_x": (2, 2, "other"), "2022Q1_x": (1, 1, "s2")}
    assert audit["2020Q1_x"]["motivos"] == {"monto_total_inversion_not_negative": 1}


def test_a_broken_off_run_is_done_again(spark, bronze, monkeypatch):
    path, add, run, _ = bronze
    add(0, [row(1)])
    run()
    add(0, [row(1), row(2)], "new")
    whole = silver.audit
    monkeypatch.setattr(silver, "audit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        run()
    monkeypatch.setattr(silver, "audit", whole)
    assert [i for i, _ in run().snapshots] == ["2020Q1_x"]
    assert spark.read.schema(silver.AUDIT).parquet(str(path / "silver/audit")).first()["n_rows"] == 2


def test_what_is_written_must_agree_with_what_was_judged(bronze, monkeypatch):
    _, add, run, _ = bronze
    add(0, [row(1), row(2)])
    whole = silver.audit
    monkeypatch.setattr(silver, "audit", lambda rows, *a: whole(rows.limit(1), *a))
    with pytest.raises(silver.LostRows, match="judged 2 rows, 2 of them valid, but wrote 1 and 1"):
        run()


def test_a_file_without_rows_counts_as_done(spark, bronze):
    path, add, run, _ = bronze
    add(0, [])
    run()
    assert run().snapshots == []
    assert spark.read.schema(silver.AUDIT).parquet(str(path / "silver/audit")).first()["n_rows"] == 0


def test_dialects_equal_what_the_driver_finds(spark, tmp_path):
    heads = {"a.csv": "X;Ñ;X\n1;2;3\n".encode("latin-1"), "b.csv": "﻿A,B\n1,2\n".encode(), "c.csv": "A\tB\n1\t2\n".encode(), "d.csv": b"", "e.pdf": b"%PDF", "f.csv": "Ä|B\n1|2\n".encode()}
    for name, content in heads.items():
        (tmp_path / name).write_bytes(content)
    got = {r["name"]: r for r in files.read_dialects(spark, [str(tmp_path / n) for n in heads]).collect()}
    assert set(heads) - set(got) == {"d.csv"}  # nothing to inspect
    for name, content in heads.items():
        if not content:
            continue
        columns, encoding = files.inspect_columns(content, name[-3:])
        assert (got[name]["columns"], got[name]["encoding"], got[name]["header_hash"]) == (columns, encoding, files.header_hash(columns))
    assert [got[n]["separator"] for n in ("a.csv", "b.csv", "c.csv", "f.csv")] == [";", ",", "\t", "|"]
    given = files.read_dialects(spark, [str(tmp_path / "f.csv")], {"f.csv": "latin-1"}).first()
    assert given["encoding"] == "latin-1" and given["columns"][0] == "Ã\x84"


def test_large_files_give_their_heads_to_the_driver(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("A;B\n" + "1;2\n" * 1000)
    monkeypatch.setattr(files, "WHOLE", 100)
    r = files.read_dialects(spark, [str(tmp_path / "a.csv")]).first()
    assert (r["separator"], r["columns"]) == (";", ["A", "B"])
    assert files.names_in(spark, str(tmp_path)) == {"a.csv"} and files.names_in(spark, str(tmp_path / "none")) == set()


def test_one_aggregate_audits_and_the_write_observes(spark):
    from tidemark.operators import contract

    rules = [contract.between("x", 0, 5), contract.Rule("even", F.col("x") % 2 == 0)]
    judged = contract.judge(spark.range(10).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"), F.lit(2).alias("w")), rules)
    got = {r["g"]: (r["n_rows"], r["n_valid"], r["w"], r["motivos"]) for r in contract.audit(judged, ["g"], rules, ["w"]).collect()}
    assert got[0] == (4, 1, 8, {"x_in_range": 2, "even": 2}) and got[2] == (3, 1, 6, {"x_in_range": 1, "even": 1})
    rows, seen = contract.observed(judged, rules, ["w"])
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n_rows": 10, "n_valid": 3, "w": 20, "x_in_range": 4, "even": 5}
