"""The semantic traps: places where engines silently differ, each pinned by a test."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cleaning, urls
from tidemark.operators import checks, contract, coverage, feeds, panel
from tidemark.sources import files


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,want",
    [
        ("2003-01-01 00:00:00", "2003-01-01"), ("01/12/2002", "2002-12-01"), ("mar-06", "2006-03-01"), ("dic-85", "1985-12-01"), ("Enero/2001", "2001-01-01"), (" SEPTIEMBRE/2016 ", "2016-09-01"),
        ("2003-13-01", None), ("01/13/2002", None), ("", None), (None, None), ("nan", None), ("mes-06", None), ("2003", None), ("9999999999/1/2003", None), ("ene-69", "2069-01-01"), ("ene-70", "1970-01-01"),
    ],
)
def test_months(spark, text, want):
    got = one(spark, cleaning.parse_month, text)
    assert (got.isoformat() if got else None) == want


@pytest.mark.parametrize("text,want", [("1,234.5", 1234.5), ("12d", None), ("1E5", 100000.0), (" 7 ", 7.0), ("nan", None), ("", None), (None, None), ("1.", 1.0), (".5", 0.5), ("-3", -3.0), ("0x1", None), ("1f", None)])
def test_numbers(spark, text, want):
    assert one(spark, cleaning.parse_number, text) == want


@pytest.mark.parametrize("text,want,ok", [("'0411abc0001", "0411ABC0001", True), ("''04112110001 ", "04112110001", True), ("1.2E+10", "1.2E+10", False), ("1234567", "1234567", False), (None, None, False), ("0000-000-00", "0000-000-00", False)])
def test_keys(spark, text, want, ok):
    assert one(spark, cleaning.clean_key, text) == want
    assert one(spark, lambda c: cleaning.is_key(cleaning.clean_key(c)), text) == ok


def test_null_skipping_extremes(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 10), (1, 3, 20), (1, 4, None)], "k INT, o INT, v INT")
    got = df.groupBy("k").agg(panel.first_known("v", "o").alias("a"), panel.last_known("v", "o").alias("b")).first()
    assert (got["a"], got["b"]) == (10, 20)


def test_version_zero_when_nothing_is_known_at_first(spark):
    df = spark.createDataFrame([("k", 1, "s1", None), ("k", 2, "s2", None), ("k", 3, "s3", "a"), ("k", 4, "s4", None), ("j", 1, "t1", "x")], "k STRING, o INT, snapshot_id STRING, v STRING")
    got = sorted((r["k"], r["version_ppi"], r["vigente_desde_corte"], r["vigente_hasta_corte"], r["es_version_vigente"]) for r in panel.versions(df, "k", "o", ("v",)).collect())
    assert got == [("j", 1, 1, 1, True), ("k", 0, 1, 2, False), ("k", 1, 3, 3, False), ("k", 2, 4, 4, True)]


def test_collapse_sums_and_represents(spark):
    df = spark.createDataFrame([("k", "s", 1.1, 5.0, "a"), ("k", "s", 2.2, 5.0, "b"), ("k", "s", None, None, "c"), (None, "s", 9.0, 9.0, "z")], "k STRING, s STRING, m DOUBLE, p DOUBLE, n STRING")
    got = panel.collapse_grain(df, ["k", "s"], [panel.descending("m")], ("m",), ("p",), (), ("n",)).collect()
    assert [(r["n_registros_agregados"], r["m"], r["p"], r["n"]) for r in got] == [(3, 3.3, 5.0, "b")]


def test_deflator_matches_null_quarters(spark):
    obs = spark.createDataFrame([(1, 2020, None, 10.0), (2, 2020, 1, 10.0), (3, None, None, 10.0)], "id INT, y INT, q INT, m DOUBLE")
    series = spark.createDataFrame([(2020, None, 50.0, 2018), (2020, 1, 0.0, 2018), (None, None, 1.0, 2018)], "anio INT, trimestre INT, inpc DOUBLE, anio_base INT")
    got = {r["id"]: (r["m_real"], r["anio_base_deflactor"]) for r in panel.deflate(obs, series, ("m",), "y", "q").collect()}
    assert got == {1: (20.0, 2018), 2: (None, 2018), 3: (None, None)}


def test_canonical_pick_is_total(spark):
    rows = [("b", 2020, 1, "otro", "vivo"), ("a", 2020, 1, "otro", "vivo"), ("c", 2020, 1, "concluido", "wayback"), ("d", 2020, None, "anual_generico", "vivo"), ("e", 2020, 2, "consolidado", "wayback"), ("f", 2020, 2, "consolidado", "vivo")]
    got = {r["trimestre"]: (r["snapshot_id"], r["cobertura_parcial_del_universo"], r["orden_corte"], r["indice_trimestre"]) for r in panel.canonical_snapshots(spark.createDataFrame(rows, "snapshot_id STRING, anio INT, trimestre INT, producto STRING, origen STRING")).collect()}
    assert got == {1: ("c", True, 20201, 8081), 2: ("f", False, 20202, 8082)}


def test_contract_counts_reasons_per_rule(spark):
    columns = "cve_cartera STRING, anio DOUBLE, avance_fisico DOUBLE, latitud DOUBLE, longitud DOUBLE, monto_total_inversion DOUBLE"
    rows = [("04112110001", 2020.0, 50.0, 20.0, -100.0, 1.0), (None, 2020.0, None, None, None, None), ("bad", 1999.0, 150.0, 0.5, 10.0, -1.0), ("0411211000", None, None, None, None, None)]
    judged = contract.judge(spark.createDataFrame(rows, columns), contract.snapshot_rules())
    valid, quarantine = contract.split(judged)
    assert {r["cve_cartera"] for r in valid.collect()} == {"04112110001", "0411211000"} and quarantine.count() == 2
    assert sum(r["n"] for r in contract.reason_counts(judged).collect()) == 7
    t = contract.totals(judged).first()
    assert (t["n_rows"], t["n_valid"], t["n_quarantined"], t["pct_valid"]) == (4, 2, 2, 50.0)


def test_urls(spark):
    cases = {
        "https://x/PTP/OPA/2016/proyectos_opa_03t2016.csv": (2016, 3, "trimestral_numerico"),
        "https://x/OPA/2016/Proyectos_OPA_3t.csv": (2016, 3, "trimestral_numerico"),
        "https://x/OPA/2019/reporteOPA4toTrimestre_V2.xlsx": (2019, 4, "trimestral_ordinal"),
        "https://x/OPA/2022/SeguimientoOPA1ERTrimestre2022.CSV": (2022, 1, "trimestral_nuevo"),
        "https://x/DatosAbiertos/OPA/2021/proyectos_opa.csv": (2021, None, "anual_generico"),
        "https://x/PTP/OPA/2015/Proyectos_OPA.csv": (2015, None, "anual_generico_antiguo"),
        "https://x/else.csv": (None, None, "no_reconocido"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "u STRING").withColumn("c", urls.classify_url(F.col("u")))
    assert {r["u"]: tuple(r["c"]) for r in df.collect()} == cases


def test_gate_thresholds(spark):
    for n, word in ((17, "completo"), (12, "parcial"), (3, "Pivotar")):
        matrix = coverage.quarter_grid(spark, 2016, 2021).withColumn("categoria", F.when((F.col("anio") - 2016) * 4 + F.col("trimestre") <= n, "vivo").otherwise("hueco"))
        got = coverage.recoverable(matrix, 2016, 2021).first()
        assert got["recuperables"] == n and word in got["recomendacion"]


def test_trailing_gap(spark):
    years = lambda cats: spark.createDataFrame([(2010 + i, c) for i, c in enumerate(cats)], "anio INT, categoria STRING")
    assert coverage.trailing_gap(years(["vivo", "hueco", "vivo", "hueco", "hueco"])).first()[0] == 2
    assert coverage.trailing_gap(years(["hueco", "hueco"])).first()[0] == 2
    assert coverage.trailing_gap(years(["hueco", "vivo"])).first()[0] == 0


def test_histogram_closes_the_upper_edge(spark):
    df = spark.createDataFrame([(x,) for x in (-100.0, -80.0, 300.0, 301.0, None)], "v DOUBLE")
    assert {r["bin"]: r["n"] for r in feeds.histogram(df, "v", -100, 300, 20).collect()} == {0: 1, 1: 1, 19: 1, -1: 1}


def test_latest_point_uses_text_order(spark):
    rows = [("k", "2021Q3_a", 20.0, -99.0, 8.0), ("k", "2021_anual_b", 21.0, -98.0, None), ("j", "2020Q1_c", None, -98.0, 1.0)]
    got = feeds.latest_points(spark.createDataFrame(rows, "k STRING, snapshot_id STRING, latitud DOUBLE, longitud DOUBLE, m DOUBLE"), "k", "m").collect()
    assert [(r["snapshot_id"], r["tamano"]) for r in got] == [("2021_anual_b", 31.0)]


def test_checks_report_and_raise(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None)], "k INT, v STRING")
    assert [(r["k"], r["n"]) for r in checks.unique(df, ["k"]).collect()] == [(1, 2)]
    assert checks.not_null(df, "k").count() == 2
    assert [r["v"] for r in checks.accepted_values(df, "v", ("a", "b")).collect()] == ["c"]
    assert checks.relationship(df, "k", spark.createDataFrame([(2,)], "p INT"), "p").count() == 2
    assert checks.run_checks([checks.Check("w", df, "warn")]) == [("w", "warn", 4)]
    with pytest.raises(AssertionError, match="a: 4 rows; b: 1 rows"):
        checks.run_checks([checks.Check("a", df), checks.Check("b", checks.unique(df, ["k"]))])


def test_files_heads():
    assert files.detect_encoding("año".encode("utf-8-sig")) == "utf-8-sig" and files.detect_encoding("año".encode("latin-1")) == "latin-1"
    assert files.detect_separator("a;b;c\n1;2;3\n") == ";" and files.detect_separator("abc") == ","
    assert files.distinct_names(["X", "X", "Y", "X"]) == ["X", "X.1", "Y", "X.2"]
    columns, encoding = files.inspect_columns("A;B;A\n1;2;3\n".encode(), ".csv")
    assert columns == ["A", "B", "A.1"] and encoding == "utf-8-sig"
    assert files.inspect_columns(b"PK\x03\x04broken", "xlsx") == (None, None) and files.header_hash(None) is None
    assert files.header_hash(["A", "B"]) != files.header_hash(["B", "A"])


def test_captures(spark):
    assert files.parse_captures(spark, None) is None
    assert files.parse_captures(spark, "[]").count() == 0
    got = files.parse_captures(spark, '[["timestamp","original"],["2020","http://a"],["2021","http://b"]]')
    assert [tuple(r) for r in got.orderBy("timestamp").collect()] == [("2020", "http://a"), ("2021", "http://b")]
