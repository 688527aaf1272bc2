"""Marts in the catalogue: buckets, comments and drift; the as-of merge against a join by ranges."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import panel
from tidemark.plans import marts
from tidemark.plans.queries import QUERIES, collapsed
from tidemark.session import Workspace

SILVER = "cve_cartera STRING, snapshot_id STRING, modificado DOUBLE, avance_fisico DOUBLE, nombre_ppi STRING, estatus_operacion STRING, id_ramo LONG, anio DOUBLE"
MANIFEST = "snapshot_id STRING, url STRING, origen STRING, fecha_descarga STRING, corte_declarado STRUCT<anio: INT, trimestre: INT>, header_hash STRING, sha256 STRING, bytes LONG"
DEFLATOR = "anio INT, trimestre INT, inpc DOUBLE, anio_base INT"


def exchanges(df):
    return re.findall(r"Exchange (?:hash|range|single|Single)\w*", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(2)
    cuts = [(f"{y}Q{q}_x", y, q) for y in (2020, 2021, 2022) for q in (1, 2, 3, 4)]
    silver = [(f"K{k:010d}", s, float(rng.randint(1, 99)), float(rng.randint(0, 99)), rng.choice(["a", "b", None]), rng.choice(["Vigente", None]), k % 3, float(y)) for k in range(60) for s, y, _ in cuts if rng.random() < 0.6 for _ in range(rng.choice([1, 1, 3]))]
    manifest = [(s, f"https://h/Consolidado{s}.csv", "vivo", "2026-01-01", (y, q), "h", "s", 1) for s, y, q in cuts]
    return spark.createDataFrame(silver, SILVER), spark.createDataFrame(manifest, MANIFEST), spark.createDataFrame([(2020, 1, 50.0, 2018)], DEFLATOR)


@pytest.fixture(scope="module")
def saved(spark, inputs, tmp_path_factory):
    path = tmp_path_factory.mktemp("marts")
    described = {"dim_ppi": {"cve_cartera": "The project's  key", "nombre_ppi": "It's name"}}
    gold = marts.save_gold(spark, *inputs, "panel_marts", str(path), buckets=3, described=described, about={"dim_ppi": "Versions of a 'project'"})
    yield gold, path
    spark.sql("DROP DATABASE panel_marts CASCADE")


def test_marts_equal_the_lazy_relations(spark, inputs, saved):
    from tidemark.plans.gold import build_gold

    want, got = build_gold(*inputs), marts.read_marts(spark, "panel_marts")
    for name in ("int_ppi_observaciones_canonicas", "dim_snapshot", "dim_ppi", "fct_ppi_observacion", "fct_ppi_delta", "fct_ppi_ciclo_vida"):
        a, b = getattr(want, name), getattr(got, name)
        assert a.columns == b.columns
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_tables_are_bucketed_and_staging_is_views(spark, saved):
    _, path = saved
    kinds = {t.name: (t.tableType, t.isTemporary) for t in spark.catalog.listTables("panel_marts")}
    assert {n for n, (_, temporary) in kinds.items() if temporary} >= {"stg_snapshots", "stg_opa_snapshot", "stg_deflactor_inpc"}
    for name in marts.BUCKETED:
        files = [f.name for f in (path / name).glob("part-*")]
        assert 0 < len(files) <= 3 and all(re.search(r"_0000[0-2]\.", f) for f in files)
        assert "Num Buckets" in {r["col_name"] for r in spark.sql(f"DESCRIBE FORMATTED panel_marts.{name}").collect()}


def test_what_follows_a_key_needs_no_exchange(spark, saved):
    gold = marts.read_marts(spark, "panel_marts")
    rows, cuts = gold.int_ppi_observaciones_canonicas, gold.int_snapshot_canonico
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        deltas = panel.deltas(rows, "cve_cartera", "orden_corte", "indice_trimestre", ("modificado",), "avance_fisico", "estatus_operacion", "nombre_ppi", ("anio",))
        life = panel.life_cycle(rows, cuts, "cve_cartera", "orden_corte", "indice_trimestre", "modificado", "avance_fisico", "estatus_operacion", "nombre_ppi", "anios_he", "anio", "cobertura_parcial_del_universo")
        enriched = panel.as_of(rows.select("cve_cartera", "orden_corte", "modificado"), gold.dim_ppi, "cve_cartera", "orden_corte", ("nombre_ppi",))
        for df in (deltas, panel.versions(rows, "cve_cartera", "orden_corte", ("nombre_ppi",)), enriched):
            assert exchanges(df) == []
        assert [e for e in exchanges(life) if "hash" in e] == []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_merge_deals_out_by_the_key_once(spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = collapsed(spark, sf_dir)
        plan = QUERIES["panel_asof_enrich"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and len(exchanges(rows)) == 1
        assert all("REPARTITION" in line for line in plan.splitlines() if "Exchange hash" in line)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_comments_survive_and_drift_is_found(spark, saved):
    assert marts.column_comments(spark, "panel_marts.dim_ppi")["cve_cartera"] == "The project's key"
    assert spark.table("panel_marts.dim_ppi").schema["nombre_ppi"].metadata["comment"] == "It's name"
    rows = {(r["tabla"], r["columna"]): (r["tipo"], r["descripcion"]) for r in marts.dictionary(spark, ["panel_marts.dim_ppi", "panel_marts.fct_ppi_delta"]).collect()}
    assert rows["dim_ppi", "nombre_ppi"] == ("string", "It's name") and rows["fct_ppi_delta", "anio"][1] == ""
    whole = {c: "x" for c in spark.table("panel_marts.dim_ppi").columns} | {"cve_cartera": "The project's key", "nombre_ppi": "other", "gone": "y"}
    drift = marts.comment_drift(spark, "panel_marts", {"dim_ppi": whole})
    assert "dim_ppi.gone: described but not there" in drift and "dim_ppi.nombre_ppi: the catalogue says otherwise" in drift and not any("cve_cartera" in d for d in drift)
    assert "dim_ppi.version_ppi: no description" in marts.comment_drift(spark, "panel_marts", {"dim_ppi": {"cve_cartera": "The project's key"}})


def test_all_missing_tables_are_named(spark, saved):
    assert marts.missing_tables(spark, "panel_marts", ["dim_ppi", "zeta", "alfa"]) == ["alfa", "zeta"]
    with pytest.raises(marts.MissingTables, match="dim_ppi, dim_snapshot, fct_ppi_ciclo_vida"):
        marts.read_marts(spark, "no_such_database")


def test_a_second_save_replaces_the_first(spark, inputs, tmp_path):
    silver, manifest, deflator = inputs
    for part in (silver, silver.where("cve_cartera < 'K0000000030'")):
        marts.save_gold(spark, part, manifest, deflator, "panel_again", str(tmp_path), buckets=2)
    assert spark.table("panel_again.fct_ppi_ciclo_vida").count() == 30
    spark.sql("DROP DATABASE panel_again CASCADE")


def test_as_of_equals_a_join_by_ranges(spark):
    rng = random.Random(5)
    versions, observations = [], []
    for k in range(40):
        at = rng.randint(0, 5)
        for v in range(rng.randint(0, 5)):
            until = at + rng.randint(0, 4)
            versions.append((f"k{k}", v, at, until, rng.choice(["a", "b", None]), v))
            at = until + rng.randint(1, 4)
        observations += [(f"k{k}", rng.choice([None, *range(25)]), i, "old") for i in range(12)]
    versions += [(None, 0, 0, 30, "never", 1), ("k1", 9, None, 30, "never", 1)]
    observations += [(None, i, i, "old") for i in range(20)] + [("none", 3, 1, "old")] + [("k2", 7, 1, "old")] * 3
    v = spark.createDataFrame(versions, "cve STRING, version_ppi INT, vigente_desde_corte LONG, vigente_hasta_corte LONG, nombre STRING, fase INT")
    o = spark.createDataFrame(observations, "cve STRING, orden INT, monto INT, nombre STRING")
    got = panel.as_of(o, v, "cve", "orden", ("nombre", "fase"))
    assert got.columns == ["cve", "orden", "monto", "nombre", "fase"]
    want = []
    for c, at, m, _ in observations:
        hit = next(((n, f) for k, _, a, b, n, f in versions if c is not None and k == c and at is not None and a is not None and a <= at <= b), (None, None))
        want.append((c, at, m, *hit))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert panel.as_of(o, v.limit(0), "cve", "orden", ("nombre",)).where("nombre IS NOT NULL").count() == 0
    assert panel.as_of(o.limit(0), v, "cve", "orden", ("nombre",)).count() == 0


def test_a_workspace_goes_with_its_tables(spark):
    space = Workspace(spark, "test")
    name = space.table("t")
    marts.save_table(spark.range(10).withColumn("k", F.col("id") % 3), name, f"{space.path}/t", 2, ("k",))
    assert spark.table(name).count() == 10
    space.drop()
    assert not spark.catalog.tableExists(name)
