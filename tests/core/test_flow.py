"""Files to package: discovery, bronze, silver, gold, publication, streaming, on small made-up files."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile
from pathlib import Path

import pyarrow.parquet as pq
import pytest
import yaml
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cleaning import clean_key, parse_number
from tidemark.operators.checks import run_checks
from tidemark.operators.feeds import version_label
from tidemark.plans.gold import PUBLISHED, build_gold, gold_checks
from tidemark.plans.silver import normalise, silver_schema, write_silver
from tidemark.publish import package
from tidemark.sources import discovery, files, xlsx
from tidemark.sources.registry import UnknownSchema, load_registry
from tidemark.streaming import bronze as stream

MODERN = ["CVE_CARTERA", "NOMBRE", "ANIO", "AVANCE", "LATITUD", "LONGITUD", "TOTAL", "MODIFICADO", "RAMO", "INICIO"]
OLD = ["CVE_PPI", "CVE_PPI", "ANIO", "LATITUD_INICIAL", "LONGITUD_INICIAL", "TOTAL"]


def sheet(rows: list[list[object]]) -> bytes:
    """A minimal spreadsheet with shared, inline and numeric cells, the last column a date."""
    texts: list[str] = []
    body = ""
    for i, row in enumerate(rows, 1):
        cells = ""
        for j, v in enumerate(row):
            ref = f"{chr(65 + j)}{i}"
            if v is None:
                continue
            if isinstance(v, str) and j % 2:
                cells += f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
            elif isinstance(v, str):
                texts.append(v)
                cells += f'<c r="{ref}" t="s"><v>{len(texts) - 1}</v></c>'
            else:
                cells += f'<c r="{ref}" s="{1 if j == len(row) - 1 else 0}"><v>{v}</v></c>'
        body += f'<row r="{i}">{cells}</row>'
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="a" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><t>{t}</t></si>" for t in texts) + "</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


@pytest.fixture(scope="module")
def site():
    """What the source serves: url -> bytes."""
    modern = lambda rows: ("\n".join([",".join(MODERN), *rows]) + "\n").encode()
    return {
        "https://h/OPA/2020/ConsolidadoOPA1erTrimestre2020.csv": modern(["'0411211000a,Uno,2020,10,20.5,-99.5,100,\"1,000.5\",4,01/03/2019", "0411211000B,Dos,2020,50,0,0,200,10,4,x", "0411211000B,Dos b,2020,50,0,0,200,5,4,mar-06", "garbage,Mal,1990,500,1,1,-1,0,9,"]),
        "https://h/OPA/2020/ConsolidadoOPA2doTrimestre2020.csv": modern(["0411211000A,Uno bis,2020,8,20.5,-99.5,100,2000,4,01/03/2019", "0411211000C,Tres,2020,99,19,-98,10,1,5,"]),
        "https://h/OPA/2020/SeguimientoOPA2doTrimestre2020.csv": modern(["0411211000A,Otro,2020,9,20.5,-99.5,100,1,4,"]),
        "https://h/OPA/2019/reporteOPA4toTrimestre.xlsx": sheet([OLD, ["0411211000A", "Viejo; ñ", 2019, 0, -99.5, 43831]]),
        "https://h/OPA/2018/proyectos_opa_01t2018.csv": ";".join(OLD).encode("latin-1") + "\n0411211000A;Año;2018;20.5;-99.5;7\n".encode("latin-1"),
        "https://h/OPA/2017/proyectos_opa_01t2017.csv": b"SOMETHING,ELSE\n1,2\n",
        "https://h/dicc.pdf": b"%PDF",
    }


@pytest.fixture(scope="module")
def world(spark, site, tmp_path_factory):
    """Discovery and ingestion of the site, with a registry for its layouts."""
    d = tmp_path_factory.mktemp("world")
    calls: list[tuple[str, str]] = []

    def fetch(method, url):
        calls.append((method, url))
        if url not in site:
            return 404, {}, b""
        if method == "HEAD" and url.endswith("xlsx"):
            return 405, {}, b""
        return 200, {"Content-Length": str(len(site[url]))}, site[url] if method == "GET" else b""

    from tidemark.functions.urls import classify_url

    urls = spark.createDataFrame([(u,) for u in [*site, "https://h/OPA/2016/none.csv"]], "url STRING").withColumn("c", classify_url(F.col("url"))).select("url", "c.anio", "c.trimestre", "c.patron")
    limiter = discovery.RateLimiter(0.0)
    found = discovery.probe_all(fetch, urls, "vivo", d / "probes.jsonl", limiter)
    probes = files.read_probes(spark, str(d / "probes.jsonl"))
    (d / "manifest.jsonl").touch()
    manifest = lambda: files.read_manifest(spark, str(d / "manifest.jsonl"))
    added = [discovery.ingest(fetch, discovery.to_ingest(probes, manifest()), d / "bronze", d / "manifest.jsonl", "2026-01-01", limiter).added for _ in range(2)]
    rename = {"CVE_CARTERA": "cve_cartera", "NOMBRE": "nombre_ppi", "ANIO": "anio", "AVANCE": "avance_fisico", "LATITUD": "latitud", "LONGITUD": "longitud", "TOTAL": "monto_total_inversion", "MODIFICADO": "modificado", "RAMO": "id_ramo", "INICIO": "fecha_inicio_cal_ff"}
    old = {"CVE_PPI": "cve_cartera", "CVE_PPI.1": "nombre_ppi", "ANIO": "anio", "LATITUD_INICIAL": "latitud", "LONGITUD_INICIAL": "longitud", "TOTAL": "monto_total_inversion"}
    layouts = {files.header_hash(MODERN): {"columnas": rename}, files.header_hash(files.distinct_names(OLD)): {"columnas": old}}
    (d / "registry.yml").write_text(yaml.safe_dump({"esquemas": layouts, "snapshots_conocidos_corruptos": []}, sort_keys=False))
    assert {m for m, u in calls if u.endswith("xlsx")} == {"HEAD", "GET_RANGE", "GET"}
    return d, found, added, probes, manifest, load_registry(d / "registry.yml")


@pytest.fixture(scope="module")
def silver(spark, world):
    d, _, _, _, manifest, registry = world
    run = normalise(spark, registry, manifest(), str(d / "bronze"))
    write_silver(run, str(d / "silver"))
    return run, files.read_silver(spark, str(d / "silver"), silver_schema(registry.canonical_columns()), "valid")


@pytest.fixture(scope="module")
def gold(spark, world, silver):
    series = spark.createDataFrame([(2020, 1, 50.0, 2018)], "anio INT, trimestre INT, inpc DOUBLE, anio_base INT")
    return build_gold(silver[1], world[4](), series)


def test_discovery_and_idempotent_ingest(world):
    _, found, added, probes, manifest, _ = world
    assert found == 7 and added == [6, 0]
    assert {r["metodo"] for r in probes.where("existe").collect()} == {"HEAD", "GET_RANGE"}
    ids = {r["snapshot_id"][:6] for r in manifest().collect()}
    assert ids == {"2020Q1", "2020Q2", "2019Q4", "2018Q1", "2017Q1"}


def test_silver_rows_quarantine_and_audit(spark, world, silver):
    run, rows = silver
    assert [f[2] for f in run.failed] == ["esquema_desconocido"]
    got = {(r["cve_cartera"], r["snapshot_id"][:6], r["nombre_ppi"]) for r in rows.collect()}
    assert ("0411211000A", "2018Q1", "Año") in got and ("0411211000A", "2019Q4", "Viejo; ñ") in got and len(got) == 8
    first = rows.where("nombre_ppi = 'Uno'").first()
    assert (first["modificado"], first["fecha_inicio_cal_ff"].isoformat(), first["id_ramo"]) == (1000.5, "2019-03-01", 4)
    assert rows.where("nombre_ppi = 'Dos'").first()["latitud"] is None
    audit = {r["snapshot_id"][:6]: r for r in spark.read.parquet(f"{world[0]}/silver/audit").where("n_rows = 4").collect()}["2020Q1"]
    assert (audit["n_valid"], audit["n_quarantined"], audit["pct_valid"], audit["fechas_no_parseadas"]) == (3, 1, 75.0, 1)
    assert audit["motivos"]["anio_in_range"] == 1 and len(audit["motivos"]) == 6


def test_unknown_layout_is_an_error(world):
    with pytest.raises(UnknownSchema):
        world[5].rename_map("nope")


def test_gold_tables(gold):
    obs = {(r["cve_cartera"], r["snapshot_id"][:6]): r for r in gold.fct_ppi_observacion.where("snapshot_id NOT LIKE '2020Q2%'").collect()}
    twice = obs["0411211000B", "2020Q1"]
    assert (twice["n_registros_agregados"], twice["modificado"], twice["modificado_real"]) == (2, 15.0, 30.0)
    delta = gold.fct_ppi_delta.where("avance_fisico_decrecio").collect()
    assert [(r["cve_cartera"], r["delta_avance_fisico"], r["bandera_renombramiento"], r["cobertura_parcial_del_universo"]) for r in delta] == [("0411211000A", -2.0, True, False)]
    life = {r["cve_cartera"]: r["estatus_terminal_inferido"] for r in gold.fct_ppi_ciclo_vida.collect()}
    assert life == {"0411211000A": "vigente_ultimo_corte_disponible", "0411211000B": "salida_no_explicada", "0411211000C": "terminado_probable"}
    assert gold.dim_ppi.where("cve_cartera = '0411211000A'").count() == 4
    assert {r["estado"] for r in gold.dim_snapshot.where("anio = 2017").collect()} == {"excluido_de_silver"}
    assert version_label(gold.dim_snapshot) == "2020T2"
    assert all(n == 0 for _, severity, n in run_checks(gold_checks(gold)) if severity == "error")


def test_package_is_deterministic_and_complete(spark, gold, tmp_path):
    seeds = {"dim_ramo": ("id_ramo LONG", [(4,)]), "dim_entidad": ("id_entidad_federativa LONG", [(1,)]), "dim_tipo_ppi": ("id_tipo_ppi LONG", [(2,), (1,)])}
    tables = {k: getattr(gold, k) for k in PUBLISHED if hasattr(gold, k)} | {k: spark.createDataFrame(rows, schema) for k, (schema, rows) in seeds.items()}
    config = {"titulo": "T", "descripcion": "D", "licencia": {"nombre": "L", "url": "u"}, "cadencia": {"valor": "Q"}, "temas": ["x"]}
    digests = []
    for run in ("a", "b"):
        p = tmp_path / run
        package.write_tables(tables, PUBLISHED, p / "tabular")
        package.write_geojson(package.features(gold.fct_ppi_observacion, gold.dim_snapshot, gold.dim_ppi), p / "geojson")
        package.write_catalogue(p, config, {}, {"n": 1}, {"m": 2})
        package.write_note(p / "NOTA.md", "T", [("A", "b")], "fin")
        digests.append(package.write_checksums(p).read_text())
    assert digests[0] == digests[1] and len(digests[0].splitlines()) == 16 + len(list((tmp_path / "a/geojson").iterdir())) + 2
    text = (tmp_path / "a/tabular/dim_tipo_ppi.csv").read_bytes()
    assert text == b"id_tipo_ppi\r\n1\r\n2\r\n"
    assert pq.read_table(tmp_path / "a/tabular/dim_tipo_ppi.parquet").to_pydict() == {"id_tipo_ppi": [1, 2]}
    points = json.loads((tmp_path / "a/geojson/ppi_consolidado.geojson").read_text())
    assert points["type"] == "FeatureCollection" and points["features"][0]["geometry"]["coordinates"] == [-99.5, 20.5]
    assert "modificado" in points["features"][0]["properties"] and any(f["properties"]["modificado"] is None for f in points["features"])
    catalogue = json.loads((tmp_path / "a/catalog.json").read_text())
    one = catalogue["dcat:dataset"][0]["dcat:distribution"][0]
    assert one["dct:checksum"]["spdx:checksumValue"] == hashlib.sha256((tmp_path / "a" / one["dcat:downloadURL"]).read_bytes()).hexdigest()


def test_publication_names_all_problems(spark, tmp_path):
    with pytest.raises(package.PublishError, match="dim_a, dim_b"):
        package.write_tables({}, {"dim_b": ("x",), "dim_a": ("x",)}, tmp_path)
    (tmp_path / "c.yml").write_text("catalogo: {titulo: t, licencia: {nombre: n}}")
    with pytest.raises(package.PublishError, match="descripcion, licencia.url, cadencia.valor, fuente_primaria.url"):
        package.load_catalogue_config(tmp_path / "c.yml")
    df = spark.createDataFrame([(1, "a")], "id INT, nombre STRING")
    with pytest.raises(package.PublishError, match="t.nombre: no description; t.other: described but not there"):
        package.write_dictionary({"t": df}, {"t": {"id": "the id", "other": "x"}}, tmp_path / "d")
    written = package.write_dictionary({"t": df}, {"t": {"id": "the | id", "nombre": "x"}}, tmp_path / "d")
    assert "the \\| id" in written[-1].read_text() and (tmp_path / "d/t.csv").read_bytes().startswith(b"columna,tipo,descripcion\r\n")
    with pytest.raises(package.PublishError):
        package.write_catalogue(tmp_path / "nothing", {}, {}, {}, {})


def test_spreadsheet_cells(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(sheet([["A", "B", "A", "F"], ["x", "y", 1.5, 43831], [None, None, None, None], ["NA", "n/a", 2, 43831.5]]))
    got = xlsx.scan_xlsx(spark, [str(tmp_path / "a.xlsx")], ["A", "B", "A.1", "F"]).collect()
    assert [tuple(r) for r in got] == [("x", "y", "1.5", "2020-01-01 00:00:00"), (None, None, "2", "2020-01-01 12:00:00")]
    assert xlsx.header_of((tmp_path / "a.xlsx").read_bytes()) == ["A", "B", "A.1", "F"]


def test_spreadsheets_as_a_source(spark, tmp_path):
    """A partition a file, sheets of several batches, a header's names or a given schema."""
    spark.dataSource.register(xlsx.XlsxSource)
    (tmp_path / "a.xlsx").write_bytes(sheet([["A", "B", "A"], *[[f"k{i}", None if i % 3 else "x", i] for i in range(25)]]))
    (tmp_path / "b.xlsx").write_bytes(sheet([["A", "B", "A"], ["last", "y", 7]]))
    df = spark.read.format("xlsx").option("batch", 10).load(str(tmp_path))
    assert df.columns == ["A", "B", "A.1"] and df.count() == 26 and df.rdd.getNumPartitions() == 2
    whole = [tuple(r) for r in xlsx.scan_xlsx(spark, [str(tmp_path / "a.xlsx"), str(tmp_path / "b.xlsx")], df.columns).collect()]
    as_iso = lambda rows: sorted(map(repr, rows))
    assert as_iso(map(tuple, df.collect())) == as_iso(whole)
    two = spark.read.format("xlsx").schema("first STRING, second STRING").load(str(tmp_path / "b*.xlsx"))
    assert [tuple(r) for r in two.collect()] == [("last", "y")]


def test_quoted_separators_in_headers_and_many_files_of_a_layout(spark, tmp_path):
    """A header with a quoted separator and line break, in files that one scan reads, each row with its snapshot."""
    names = ["CVE, CARTERA", "AN\nIO", "AVANCE", "LATITUD", "LONGITUD", "TOTAL"]
    head = '"CVE, CARTERA","AN\nIO",AVANCE,LATITUD,LONGITUD,TOTAL\n'
    (tmp_path / "bronze").mkdir()
    records = []
    for i in range(3):
        (tmp_path / f"bronze/f{i}.csv").write_text(head + f"0411211000{i},202{i},1{i},20,-99,10{i}\n")
        records.append({"snapshot_id": f"202{i}Q1_x", "archivo_bronze": f"f{i}.csv", "header_hash": files.header_hash(names), "encoding_detectado": "utf-8", "corte_declarado": {"anio": 2020 + i, "trimestre": 1}})
    (tmp_path / "m.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records))
    rename = dict(zip(names, ("cve_cartera", "anio", "avance_fisico", "latitud", "longitud", "monto_total_inversion"), strict=True))
    (tmp_path / "r.yml").write_text(yaml.safe_dump({"esquemas": {files.header_hash(names): {"columnas": rename}}, "snapshots_conocidos_corruptos": []}, sort_keys=False))
    run = normalise(spark, load_registry(tmp_path / "r.yml"), files.read_manifest(spark, str(tmp_path / "m.jsonl")), str(tmp_path / "bronze"))
    got = sorted((r["cve_cartera"], r["anio"], r["avance_fisico"], r["snapshot_id"], r["monto_total_inversion"]) for r in run.valid.collect())
    assert got == [(f"0411211000{i}", 2020.0 + i, 10.0 + i, f"202{i}Q1_x", 100.0 + i) for i in range(3)] and run.failed == []
    assert run.judged._jdf.queryExecution().optimizedPlan().toString().count("csv") == 1


def test_probes_fall_back_and_tell_lengths():
    def fetch(method, url):
        if url == "chain":
            raise OSError("[SSL: CERTIFICATE_VERIFY_FAILED] unable to get local issuer certificate")
        return (200, {}, b"") if method == "HEAD" else (206, {"Content-Range": "bytes 0-2047/99999", "Content-Length": "2048"}, b"x")

    p = discovery.probe(fetch, "vivo", "u", 2020, 1, "x", sleep=lambda s: None)
    assert (p.metodo, p.existe, p.content_length) == ("GET_RANGE", True, 99999)
    p = discovery.probe(fetch, "vivo", "chain", 2020, 1, "x", sleep=lambda s: None, fallback=lambda m, u: (200, {"content-length": "7"}, b""))
    assert (p.metodo, p.existe, p.content_length, p.error) == ("GET_RANGE+CURL", True, 7, None)
    assert not discovery.probe(fetch, "vivo", "chain", 2020, 1, "x", sleep=lambda s: None).existe


def test_mirror_and_archive_reach_bronze(spark, tmp_path):
    from tidemark.functions.urls import classify_text

    file = "https://m/OPA/2019/reporteOPA3erTrimestre.xlsx"
    shown = {"success": True, "result": {"resources": [{"url": file, "name": "n", "format": "XLSX"}, {"url": "https://m/other.csv"}]}}
    searched = {"result": {"count": 2, "results": [{"name": "obra-vieja"}, {"name": "obra-publica", "title": "Obra abierta"}]}}
    captures = [["timestamp", "original", "statuscode", "length"], ["20200101", "https://h/OPA/2018/proyectos_opa_01t2018.csv", "200", "12"]]
    content = (";".join(OLD) + "\n").encode("latin-1")

    def fetch(method, url):
        if "package_show" in url:
            return 200, {}, json.dumps(shown).encode()
        if "package_search" in url:
            return 200, {}, json.dumps(searched).encode()
        if url.startswith("https://cdx"):
            return (200, {}, json.dumps(captures).encode()) if "good" in url else (200, {}, b"<html>busy") if "blocked" in url else (200, {}, b"")
        return (200, {}, content) if url.startswith("https://web.archive.org/web/20200101id_/https://h/") else (404, {}, b"")

    limiter, still = discovery.RateLimiter(0.0), lambda s: None
    mirror = list(discovery.ask(fetch, discovery.mirror_questions(classify_text, "https://m/api", "opa", "obra", "https://page"), limiter, sleep=still))
    assert [(p.existe, p.anio, p.trimestre, p.patron) for p in mirror] == [(True, None, None, None), (True, 2019, 3, "trimestral_ordinal"), (True, None, None, "recurso_ckan"), (True, None, None, None), (False, None, None, None)]
    assert mirror[3].extra["coincidencia_real"] == "obra-publica"
    archive = list(discovery.ask(fetch, discovery.archive_questions(classify_text, "https://cdx", ["good", "blocked", "none"], {"matchType": "prefix"}), limiter, sleep=still))
    asked = [(p.existe, p.error is None, p.extra["n_capturas"]) for p in archive if p.metodo == "CDX_QUERY"]
    assert asked == [(True, True, 1), (False, False, None), (False, True, 0)]
    assert discovery.append([*mirror, *archive], tmp_path / "p.jsonl") == 6
    (tmp_path / "m.jsonl").touch()
    pending = discovery.to_ingest(files.read_probes(spark, str(tmp_path / "p.jsonl")), files.read_manifest(spark, str(tmp_path / "m.jsonl")))
    assert discovery.ingest(fetch, pending, tmp_path / "b", tmp_path / "m.jsonl", "2026-01-01", limiter).added == 1
    r = files.read_manifest(spark, str(tmp_path / "m.jsonl")).first()
    assert (r["origen"], r["wayback_timestamp"], r["snapshot_id"][:6]) == ("wayback", "20200101", "2018Q1")


def test_commands_end_to_end(spark, world, silver, tmp_path, capsys):
    """Normalised files to marts, checks, reports, figures and the package, with their exit codes."""
    import shutil

    from tidemark import cli

    d = tmp_path / "data"
    shutil.copytree(world[0], d)
    conf, seeds = tmp_path / "conf", tmp_path / "seeds"
    conf.mkdir()
    seeds.mkdir()
    (conf / "inpc.csv").write_text("anio,trimestre,inpc,anio_base\n2020,1,50.0,2018\n")
    (conf / "dcat.yml").write_text(yaml.safe_dump({"catalogo": {"titulo": "T", "descripcion": "D", "licencia": {"nombre": "L", "url": "u"}, "cadencia": {"valor": "Q"}, "fuente_primaria": {"url": "u"}, "nota": {"privacidad": "Revisado."}}}))
    (seeds / "dim_ramo_seed.csv").write_text("id_ramo,descripcion_ramo,en_catalogo_oficial\n4,Gobernación,true\n5,Relaciones,true\n9,Nueve,true\n")
    (seeds / "dim_entidad_seed.csv").write_text("id_entidad_federativa,entidad_federativa,en_catalogo_oficial\n1,A,true\n")
    (seeds / "dim_tipo_ppi_seed.csv").write_text("id_tipo_ppi,descripcion_tipo_ppi\n1,B\n")
    base = ["--data", str(d), "--registry", str(d / "registry.yml"), "--deflator", str(conf / "inpc.csv"), "--catalogue", str(conf / "dcat.yml"), "--seeds", str(seeds)]
    assert cli.main(["publish", *base]) == 1 and "run gold first" in capsys.readouterr().err
    assert cli.main(["normalize", *base]) == 1  # one layout is unknown
    assert cli.main(["gold", *base]) == 0
    assert "error observation_id_ramo_exists: 0" in capsys.readouterr().out
    assert cli.main(["inspect", *base]) == 0 and "| `ANIO` |" in (d / "esquemas.md").read_text()
    assert cli.main(["publish", *base]) == 0
    note = (d / "publish/2020T2/NOTA-TECNICA.md").read_text()
    assert note.count("\n## ") == 7 and "Revisado." in note
    assert len((d / "publish/2020T2/checksums.sha256").read_text().splitlines()) > 18
    assert cli.main(["figuras", *base]) in (0, 1) and len(list((d / "figuras").iterdir())) == 8
    (seeds / "dim_ramo_seed.csv").write_text("id_ramo,descripcion_ramo,en_catalogo_oficial\n5,Relaciones,true\n")
    assert cli.main(["gold", *base]) == 1 and "observation_id_ramo_exists" in capsys.readouterr().err


def test_archive_captures_become_probes(spark):
    captures = spark.createDataFrame([("20200101", "https://h/OPA/2019/reporteOPA4toTrimestre.xlsx")], "timestamp STRING, original STRING")
    r = discovery.archive_probes(captures).first()
    assert (r["fuente"], r["anio"], r["trimestre"], r["url"]) == ("wayback", 2019, 4, "https://web.archive.org/web/20200101id_/https://h/OPA/2019/reporteOPA4toTrimestre.xlsx")


def test_descriptions_come_from_models(tmp_path):
    (tmp_path / "s.yml").write_text("models: [{name: t, description: 'a  b', columns: [{name: x, description: y}, {name: z}]}]")
    assert package.load_descriptions(tmp_path / "s.yml") == ({"t": "a b"}, {"t": {"x": "y", "z": ""}})


def test_retry_and_limiter():
    waits: list[float] = []
    tries = iter([OSError("x"), OSError("y"), 7])

    def call():
        v = next(tries)
        if isinstance(v, OSError):
            raise v
        return v

    assert discovery.with_retry(call, 3, 1.0, waits.append) == (7, 3) and waits == [1.0, 2.0]

    def down(method, url):
        raise OSError("down")

    p = discovery.probe(down, "vivo", "u", None, None, None, attempts=2, sleep=lambda s: None)
    assert not p.existe and p.error == "OSError: down" and p.intentos == 4
    now = [0.0]
    limiter = discovery.RateLimiter(2.0, lambda: now[0], waits.append)
    limiter.wait()
    now[0] = 0.5
    limiter.wait()
    assert waits[-1] == 1.5


def test_stream_appends_each_file_once(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("cve_cartera", "anio", "avance_fisico", "latitud", "longitud", "monto_total_inversion")])
    (tmp_path / "in").mkdir()

    def clean(df):
        numbers = {c: parse_number(F.col(c)) for c in schema.names[1:]}
        return df.withColumns({"cve_cartera": clean_key(F.col("cve_cartera")), **numbers})

    def drop(name: str, *rows: str) -> None:
        (tmp_path / "in" / name).write_text("\n".join([",".join(schema.names), *rows]) + "\n")
        stream.start(stream.stream_snapshots(spark, str(tmp_path / "in"), schema), clean, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()

    drop("a.csv", "'0411211000a,2020,1,20,-100,5", "bad,2020,1,20,-100,5")
    drop("b.csv", "0411211000B,2020,1,,,5")
    assert sorted(r["cve_cartera"] for r in spark.read.parquet(str(tmp_path / "out/valid")).collect()) == ["0411211000A", "0411211000B"]
    assert spark.read.parquet(str(tmp_path / "out/quarantine")).count() == 1


def test_entry_contract(spark, sf_dir):
    import __spark_entry__ as entry

    assert len(entry.entry(spark).columns) == 22 and set(entry.oracle_sql()) <= set(entry.queries())
    assert Path(entry.__file__).name == "__spark_entry__.py"
