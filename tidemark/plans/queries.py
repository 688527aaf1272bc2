"""Every operator applied to the driver's tables, each beside the SQL that says the same.

``orders`` plays the raw panel: customers are keys, quarters of the order date are snapshots, several
orders of a customer in a quarter are the repeated grain. Nulls are injected by id, since the tables hold
none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cleaning, urls
from tidemark.operators import checks, contract, coverage, feeds, panel
from tidemark.publish import package
from tidemark.session import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_if_divides(c: Column, n: int, value: Column) -> Column:
    return F.when(c % n != 0, value)


MONEY = "decimal(18,2)"


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of cleaned snapshot rows."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    year, quarter = F.year("o_orderdate"), F.quarter("o_orderdate")
    return o.select(
        F.col("o_custkey").alias("cve"), year.alias("anio"), quarter.alias("trimestre"),
        F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string")).alias("snapshot_id"),
        null_if_divides(k, 7, F.col("o_totalprice")).alias("modificado"),
        null_if_divides(k, 5, F.col("o_totalprice") - 100).alias("ejercido"),
        null_if_divides(k, 11, (k % 101).cast("double")).alias("avance"),
        null_if_divides(k, 13, F.col("o_orderstatus")).alias("estatus"),
        null_if_divides(k, 6, F.col("o_orderpriority")).alias("nombre"),
        (F.col("o_custkey") % 25).cast("int").alias("ramo"), k.alias("orden"),
    )


_RAW = """raw AS (
  SELECT o_custkey AS cve, year(o_orderdate)::INTEGER AS anio, quarter(o_orderdate)::INTEGER AS trimestre,
         year(o_orderdate) || 'Q' || quarter(o_orderdate) AS snapshot_id,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS modificado, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice - 100 END AS ejercido,
         CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey % 101)::DOUBLE END AS avance, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS estatus,
         CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END AS nombre, (o_custkey % 25)::INTEGER AS ramo, o_orderkey AS orden
  FROM orders)"""

_COLLAPSED = (
    _RAW
    + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cve, snapshot_id ORDER BY modificado DESC NULLS LAST, orden ASC NULLS LAST) AS rn FROM raw
), panel AS (
  SELECT cve, snapshot_id, count(*) AS n_registros_agregados, sum(modificado::DECIMAL(18,2))::DOUBLE AS modificado, sum(ejercido::DECIMAL(18,2))::DOUBLE AS ejercido,
         max(avance) AS avance, min(anio) AS anio, min(trimestre) AS trimestre, min(ramo) AS ramo,
         max(nombre) FILTER (WHERE rn = 1) AS nombre, max(estatus) FILTER (WHERE rn = 1) AS estatus,
         min(anio) * 10 + min(trimestre) AS orden_corte, min(anio) * 4 + min(trimestre) AS indice_trimestre, min(anio) % 3 = 0 AS parcial
  FROM ranked GROUP BY cve, snapshot_id)"""
)


def collapsed(spark: SparkSession, sf_dir: str, dealt: bool = True, parts: int | None = None) -> DataFrame:
    order = [panel.descending("modificado"), panel.ascending("orden")]
    # one exchange by the key serves the collapse and whatever compares a key's cuts afterwards; alone, the
    # collapse combines rows before its own
    raw = raw_panel(spark, sf_dir)
    if dealt:
        raw = raw.repartition(parts, "cve") if parts else raw.repartition("cve")
    rows = panel.collapse_grain(raw, ["cve", "snapshot_id"], order, ("modificado", "ejercido"), ("avance",), ("anio", "trimestre", "ramo"), ("nombre", "estatus"), MONEY)
    return rows.select(
        "*", cleaning.order_index(F.col("anio"), F.col("trimestre")).alias("orden_corte"), cleaning.linear_index(F.col("anio"), F.col("trimestre")).alias("indice_trimestre"),
        (F.col("anio") % 3 == 0).alias("parcial"),
    )


@query(f"WITH {_COLLAPSED} SELECT cve, snapshot_id, n_registros_agregados, modificado, ejercido, avance, anio, trimestre, ramo, nombre, estatus, orden_corte, indice_trimestre, parcial FROM panel")
def panel_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapsed(spark, sf_dir, dealt=False)


_SNAPSHOTS = """snapshots AS (
  SELECT DISTINCT 'S' || (o_orderkey % 9) || '_' || year(o_orderdate) || quarter(o_orderdate) AS snapshot_id, year(o_orderdate)::INTEGER AS anio,
         CASE WHEN o_orderkey % 9 <> 4 THEN quarter(o_orderdate)::INTEGER END AS trimestre,
         CASE o_orderkey % 9 WHEN 0 THEN 'otro' WHEN 1 THEN 'seguimiento' WHEN 2 THEN 'concluido' WHEN 3 THEN 'consolidado' WHEN 4 THEN 'anual_generico' ELSE 'otro' END AS producto,
         CASE o_orderkey % 2 WHEN 0 THEN 'vivo' ELSE 'wayback' END AS origen
  FROM orders)"""


def snapshots_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, y, q = F.col("o_orderkey"), F.year("o_orderdate"), F.quarter("o_orderdate")
    kind = k % 9
    return o.select(
        F.concat(F.lit("S"), kind.cast("string"), F.lit("_"), y.cast("string"), q.cast("string")).alias("snapshot_id"), y.alias("anio"), F.when(kind != 4, q).alias("trimestre"),
        F.when(kind == 1, "seguimiento").when(kind == 2, "concluido").when(kind == 3, "consolidado").when(kind == 4, "anual_generico").otherwise("otro").alias("producto"),
        F.when(k % 2 == 0, "vivo").otherwise("wayback").alias("origen"),
    ).distinct()


@query(
    f"""WITH {_SNAPSHOTS} SELECT snapshot_id, anio, trimestre, producto, anio * 10 + trimestre AS orden_corte, anio * 4 + trimestre AS indice_trimestre,
  producto <> 'consolidado' AND producto <> 'anual_generico' AS cobertura_parcial_del_universo
FROM (SELECT *, row_number() OVER (PARTITION BY anio, trimestre ORDER BY CASE producto WHEN 'consolidado' THEN 1 WHEN 'seguimiento' THEN 2 WHEN 'concluido' THEN 3 ELSE 4 END,
  CASE origen WHEN 'vivo' THEN 1 ELSE 2 END, snapshot_id) AS rn FROM snapshots WHERE trimestre IS NOT NULL) WHERE rn = 1"""
)
def panel_canonical_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.canonical_snapshots(snapshots_of(spark, sf_dir))


@query(
    """SELECT n_chars, doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY n_chars ORDER BY CASE lang WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END, doc_id) AS rn FROM documents) WHERE rn = 1"""
)
def panel_dedup_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("n_chars", "doc_id", "lang", "source")
    return panel.pick_first(d, ["n_chars"], [panel.rank_of(F.col("lang"), ("en", "es", "fr")), F.col("doc_id").asc_nulls_last()])


_DEFLATOR = """deflator(anio, trimestre, inpc, anio_base) AS (VALUES (1996, 1, 80.0::DOUBLE, 2018), (1996, 2, 82.5, 2018), (1997, NULL, 85.0, 2018), (1998, 4, 0.0, 2018), (1999, 3, 99.5, 2018))"""


@query(
    f"""WITH {_COLLAPSED}, {_DEFLATOR}, obs AS (SELECT cve, snapshot_id, CASE WHEN cve % 17 <> 0 THEN anio END AS anio_corte, CASE WHEN anio <> 1997 THEN trimestre END AS trimestre_corte, modificado, ejercido FROM panel)
SELECT obs.*, modificado * (100.0::DOUBLE / nullif(d.inpc, 0)) AS modificado_real, ejercido * (100.0::DOUBLE / nullif(d.inpc, 0)) AS ejercido_real, d.anio_base AS anio_base_deflactor
FROM obs LEFT JOIN deflator d ON d.anio = anio_corte AND (d.trimestre = trimestre_corte OR (d.trimestre IS NULL AND trimestre_corte IS NULL))"""
)
def panel_observation_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = collapsed(spark, sf_dir).select(
        "cve", "snapshot_id", F.when(F.col("cve") % 17 != 0, F.col("anio")).alias("anio_corte"), F.when(F.col("anio") != 1997, F.col("trimestre")).alias("trimestre_corte"), "modificado", "ejercido"
    )
    series = [(1996, 1, 80.0, 2018), (1996, 2, 82.5, 2018), (1997, None, 85.0, 2018), (1998, 4, 0.0, 2018), (1999, 3, 99.5, 2018)]
    return panel.deflate(obs, spark.createDataFrame(series, "anio INT, trimestre INT, inpc DOUBLE, anio_base INT"), ("modificado", "ejercido"), "anio_corte", "trimestre_corte")


_DELTA = """SELECT cve, snapshot_id, snapshot_id_anterior, anio, trimestre, parcial, orden_corte, indice_trimestre - indice_trimestre_anterior AS brecha_trimestres,
  modificado_anterior, modificado, modificado - modificado_anterior AS delta_modificado, ejercido_anterior, ejercido, ejercido - ejercido_anterior AS delta_ejercido,
  avance_anterior, avance, avance - avance_anterior AS delta_avance, avance < avance_anterior AS avance_decrecio, estatus_anterior, estatus,
  estatus IS DISTINCT FROM estatus_anterior AS cambio_estatus, nombre_anterior IS NOT NULL AND nombre IS DISTINCT FROM nombre_anterior AS bandera_renombramiento
FROM (SELECT *, lag(snapshot_id) OVER w AS snapshot_id_anterior, lag(indice_trimestre) OVER w AS indice_trimestre_anterior, lag(modificado) OVER w AS modificado_anterior,
  lag(ejercido) OVER w AS ejercido_anterior, lag(avance) OVER w AS avance_anterior, lag(estatus) OVER w AS estatus_anterior, lag(nombre) OVER w AS nombre_anterior
  FROM panel WINDOW w AS (PARTITION BY cve ORDER BY orden_corte)) WHERE indice_trimestre_anterior IS NOT NULL"""


def _deltas(rows: DataFrame) -> DataFrame:
    return panel.deltas(rows, "cve", "orden_corte", "indice_trimestre", ("modificado", "ejercido"), "avance", "estatus", "nombre", ("anio", "trimestre", "parcial"))


@query(f"WITH {_COLLAPSED} {_DELTA}")
def panel_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deltas(collapsed(spark, sf_dir))


_VERSIONS = """changes AS (
  SELECT *, CASE WHEN nombre IS DISTINCT FROM lag(nombre) OVER w OR estatus IS DISTINCT FROM lag(estatus) OVER w THEN 1 ELSE 0 END AS change FROM panel WINDOW w AS (PARTITION BY cve ORDER BY orden_corte)
), numbered AS (SELECT *, sum(change) OVER (PARTITION BY cve ORDER BY orden_corte ROWS UNBOUNDED PRECEDING) AS version_ppi FROM changes
), versions AS (
  SELECT cve, version_ppi::BIGINT AS version_ppi, min(orden_corte) AS vigente_desde_corte, max(orden_corte) AS vigente_hasta_corte, arg_min(snapshot_id, orden_corte) AS snapshot_id_inicio,
    arg_max(snapshot_id, orden_corte) AS snapshot_id_fin, arg_min(nombre, orden_corte) AS nombre, arg_min(estatus, orden_corte) AS estatus, arg_min(avance, orden_corte) AS avance,
    row_number() OVER (PARTITION BY cve ORDER BY version_ppi DESC) = 1 AS es_version_vigente
  FROM numbered GROUP BY cve, version_ppi)"""


def _versions(rows: DataFrame) -> DataFrame:
    return panel.versions(rows, "cve", "orden_corte", ("nombre", "estatus"), ("avance",))


@query(f"WITH {_COLLAPSED}, {_VERSIONS} SELECT * FROM versions")
def panel_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(collapsed(spark, sf_dir))


_LIFE = """life AS (
  SELECT v.cve, primer_corte, ultimo_corte, trimestres AS trimestres_entre_primera_y_ultima_observacion, snapshot_id_inicio, snapshot_id_fin, nombre_ppi, monto_inicial, monto_final, avance_fisico_final,
    estatus_operacion_final, duracion_planeada_anios, n_observaciones, n_anios_observado, alguna_observacion_con_cobertura_parcial,
    CASE WHEN monto_inicial > 0 THEN round((monto_final - monto_inicial) / monto_inicial * 100, 2) END AS sobrecosto_pct, round(trimestres / 4.0::DOUBLE, 2) AS duracion_observada_anios,
    CASE WHEN avance_fisico_final >= 95 THEN 'terminado_probable' WHEN ultimo_corte < f.valor THEN 'salida_no_explicada' ELSE 'vigente_ultimo_corte_disponible' END AS estatus_terminal_inferido
  FROM (SELECT cve, min(orden_corte) AS primer_corte, max(orden_corte) AS ultimo_corte, max(indice_trimestre) - min(indice_trimestre) AS trimestres, arg_min(snapshot_id, orden_corte) AS snapshot_id_inicio,
      arg_max(snapshot_id, orden_corte) AS snapshot_id_fin, arg_min(nombre, orden_corte) AS nombre_ppi, arg_min(modificado, orden_corte) AS monto_inicial, arg_max(modificado, orden_corte) AS monto_final,
      arg_max(avance, orden_corte) AS avance_fisico_final, arg_max(estatus, orden_corte) AS estatus_operacion_final, arg_min(ramo, orden_corte) AS duracion_planeada_anios, count(*) AS n_observaciones,
      count(DISTINCT anio) AS n_anios_observado, bool_or(parcial) AS alguna_observacion_con_cobertura_parcial FROM panel GROUP BY cve) v,
    (SELECT max(orden_corte) AS valor FROM panel) f)"""


def _life(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    return panel.life_cycle(rows, cuts, "cve", "orden_corte", "indice_trimestre", "modificado", "avance", "estatus", "nombre", "ramo", "anio", "parcial")


def _panel_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _life(collapsed(spark, sf_dir), raw_panel(spark, sf_dir).select(cleaning.order_index(F.col("anio"), F.col("trimestre")).alias("orden_corte")))


@query(f"WITH {_COLLAPSED}, {_LIFE} SELECT * FROM life")
def panel_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel_life(spark, sf_dir)


@query(
    f"""WITH {_COLLAPSED}, {_VERSIONS} SELECT o.cve, o.snapshot_id, o.orden_corte, o.modificado, v.nombre, v.estatus FROM panel o
LEFT JOIN versions v ON v.cve = o.cve AND o.orden_corte BETWEEN v.vigente_desde_corte AND v.vigente_hasta_corte"""
)
def panel_asof_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = collapsed(spark, sf_dir)
    return panel.as_of(rows.select("cve", "snapshot_id", "orden_corte", "modificado"), _versions(rows), "cve", "orden_corte", ("nombre", "estatus"))


# the same over the panel as a bucketed table of the catalogue: what follows a key's rows needs no exchange


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.plans.marts import save_table

    space, buckets = Workspace(spark, "mart"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    return save_table(collapsed(spark, sf_dir, parts=buckets), space.table("panel"), f"{space.path}/panel", buckets, ("cve", "orden_corte"))


@query(f"WITH {_COLLAPSED} {_DELTA}")
def mart_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deltas(_mart(spark, sf_dir))


@query(f"WITH {_COLLAPSED}, {_VERSIONS} SELECT * FROM versions")
def mart_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(_mart(spark, sf_dir))


@query(f"WITH {_COLLAPSED}, {_LIFE} SELECT * FROM life")
def mart_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _mart(spark, sf_dir)
    return _life(rows, rows)


@query(
    f"""WITH {_COLLAPSED}, {_VERSIONS} SELECT o.cve, o.snapshot_id, o.orden_corte, o.modificado, v.nombre, v.estatus FROM panel o
LEFT JOIN versions v ON v.cve = o.cve AND o.orden_corte BETWEEN v.vigente_desde_corte AND v.vigente_hasta_corte"""
)
def mart_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _mart(spark, sf_dir)
    return panel.as_of(rows.select("cve", "snapshot_id", "orden_corte", "modificado"), _versions(rows), "cve", "orden_corte", ("nombre", "estatus"))


@query(
    f"""WITH {_RAW}, counts AS (SELECT snapshot_id, count(*) AS n_observaciones, count(DISTINCT cve) AS n_ppi FROM (SELECT cve, CASE WHEN trimestre <> 2 THEN snapshot_id END AS snapshot_id FROM raw) GROUP BY snapshot_id)
SELECT s.snapshot_id, s.anio, s.trimestre, coalesce(n_observaciones, 0) AS n_observaciones, coalesce(n_ppi, 0) AS n_ppi, CASE WHEN c.snapshot_id IS NULL THEN 'excluido_de_silver' ELSE 'normalizado' END AS estado
FROM (SELECT DISTINCT snapshot_id, anio, trimestre FROM raw) s LEFT JOIN counts c USING (snapshot_id)"""
)
def snapshot_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_panel(spark, sf_dir)
    return panel.snapshot_dimension(raw.select("snapshot_id", "anio", "trimestre").distinct(), raw.withColumn("snapshot_id", F.when(F.col("trimestre") != 2, F.col("snapshot_id"))), "cve", ("snapshot_id", "anio", "trimestre"))


@query("SELECT n_nationkey::BIGINT AS id, n_name AS description, n_regionkey < 3 AS en_catalogo_oficial, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def catalog_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("description"), (F.col("n_regionkey") < 3).alias("en_catalogo_oficial"), F.col("r_name").alias("region"))
    return panel.catalogue(rows, "id", ("description", "en_catalogo_oficial", "region"))


_RULES = """judged AS (SELECT c_custkey, key, c_acctbal, c_nationkey, list_filter([CASE WHEN NOT coalesce(regexp_matches(key, '^[0-9A-Z]{10,11}$'), FALSE) THEN 'key_pattern' END,
    CASE WHEN NOT coalesce(bal BETWEEN -500 AND 9000, TRUE) THEN 'bal_in_range' END, CASE WHEN NOT coalesce(c_nationkey <= 20, TRUE) THEN 'nation_known' END], lambda x: x IS NOT NULL) AS reasons
  FROM (SELECT *, CASE WHEN c_custkey % 19 <> 0 THEN upper(CASE WHEN c_custkey % 23 = 0 THEN 'bad' ELSE 'k' || lpad(c_custkey::VARCHAR, 9, '0') END) END AS key, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS bal FROM customer))"""


def _customer_rules() -> list[contract.Rule]:
    return [contract.Rule("key_pattern", F.col("key").rlike(cleaning.KEY_PATTERN), nullable=False), contract.between("bal", -500, 9000), contract.Rule("nation_known", F.col("c_nationkey") <= 20)]


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    key = F.when(k % 23 == 0, F.lit("bad")).otherwise(F.concat(F.lit("k"), F.lpad(k.cast("string"), 9, "0")))
    c = table(spark, sf_dir, "customer").select("c_custkey", null_if_divides(k, 19, cleaning.clean_key(key)).alias("key"), "c_acctbal", "c_nationkey", null_if_divides(k, 10, F.col("c_acctbal")).alias("bal"))
    return contract.judge(c, _customer_rules())


@query(f"WITH {_RULES} SELECT c_custkey, key, c_acctbal, c_nationkey, array_to_string(reasons, ',') AS reasons FROM judged WHERE len(reasons) > 0")
def contract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.split(_judged(spark, sf_dir))[1].select("c_custkey", "key", "c_acctbal", "c_nationkey", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {_RULES} SELECT c_custkey, key, c_acctbal, c_nationkey FROM judged WHERE len(reasons) = 0")
def contract_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.split(_judged(spark, sf_dir))[0].drop("bal")


@query(f"WITH {_RULES} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM judged) GROUP BY reason")
def contract_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.reason_counts(_judged(spark, sf_dir))


@query(
    f"""WITH {_RULES} SELECT c_nationkey, count(*) AS n_rows, count(*) FILTER (WHERE len(reasons) = 0) AS n_valid, count(*) FILTER (WHERE len(reasons) > 0) AS n_quarantined,
  round(count(*) FILTER (WHERE len(reasons) = 0) * 100.0::DOUBLE / count(*), 1) AS pct_valid FROM judged GROUP BY c_nationkey"""
)
def contract_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.totals(_judged(spark, sf_dir), ["c_nationkey"])


@query(
    f"""WITH {_RULES} SELECT c_nationkey, count(*) AS n_rows, count(*) FILTER (WHERE len(reasons) = 0) AS n_valid, count(*) FILTER (WHERE len(reasons) > 0) AS n_quarantined,
  round(count(*) FILTER (WHERE len(reasons) = 0) * 100.0::DOUBLE / count(*), 1) AS pct_valid, sum(c_custkey)::BIGINT AS c_custkey,
  concat_ws(',', 'bal_in_range=' || nullif(count(*) FILTER (WHERE list_contains(reasons, 'bal_in_range')), 0), 'key_pattern=' || nullif(count(*) FILTER (WHERE list_contains(reasons, 'key_pattern')), 0),
    'nation_known=' || nullif(count(*) FILTER (WHERE list_contains(reasons, 'nation_known')), 0)) AS motivos FROM judged GROUP BY c_nationkey"""
)
def contract_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = contract.audit(_judged(spark, sf_dir), ["c_nationkey"], _customer_rules(), ["c_custkey"])
    said = F.transform(F.array_sort(F.map_entries("motivos")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return counted.withColumn("motivos", F.array_join(said, ","))


@query(
    f"""WITH {_RULES} SELECT count(*) AS n_rows, count(*) FILTER (WHERE len(reasons) = 0) AS n_valid, sum(c_custkey)::BIGINT AS c_custkey, count(*) FILTER (WHERE list_contains(reasons, 'key_pattern')) AS key_pattern,
  count(*) FILTER (WHERE list_contains(reasons, 'bal_in_range')) AS bal_in_range, count(*) FILTER (WHERE list_contains(reasons, 'nation_known')) AS nation_known FROM judged"""
)
def contract_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the write of the judged rows observes on its way."""
    rows, seen = contract.observed(_judged(spark, sf_dir), _customer_rules(), ["c_custkey"])
    space = Workspace(spark, "observed")
    rows.write.parquet(f"{space.path}/judged")
    space.drop()
    found = seen.get
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} long" for name in found))


@query(
    f"WITH {_RAW} SELECT count(*) AS n, count(*) FILTER (WHERE ejercido > modificado * (1 + 0.05::DOUBLE)) AS n_over FROM (SELECT modificado * (0.4::DOUBLE + avance / 200) AS modificado, ejercido FROM raw) WHERE modificado IS NOT NULL AND ejercido IS NOT NULL"
)
def contract_overspent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_panel(spark, sf_dir).select((F.col("modificado") * (F.lit(0.4) + F.col("avance") / 200)).alias("modificado"), "ejercido")
    return contract.overspent_share(rows, "ejercido", "modificado")


@query(
    """SELECT c_custkey, upper(ltrim(trim(raw), '''')) AS key, coalesce(regexp_matches(upper(ltrim(trim(raw), '''')), '^[0-9A-Z]{10,11}$'), FALSE) AS is_key
FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '''' || lower(c_mktsegment) || c_custkey WHEN 1 THEN '  ' || 'k' || lpad(c_custkey::VARCHAR, 9, '0') || ' ' WHEN 2 THEN '''''ab' || lpad(c_custkey::VARCHAR, 9, '0')
  WHEN 3 THEN NULL ELSE c_custkey::VARCHAR || 'E+10' END AS raw FROM customer)"""
)
def clean_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    padded = F.lpad(k.cast("string"), 9, "0")
    raw = (
        F.when(k % 5 == 0, F.concat(F.lit("'"), F.lower("c_mktsegment"), k.cast("string")))
        .when(k % 5 == 1, F.concat(F.lit("  k"), padded, F.lit(" ")))
        .when(k % 5 == 2, F.concat(F.lit("''ab"), padded))
        .when(k % 5 == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(k.cast("string"), F.lit("E+10")))
    )
    key = cleaning.clean_key(raw)
    return table(spark, sf_dir, "customer").select("c_custkey", key.alias("key"), cleaning.is_key(key).alias("is_key"))


@query(
    """SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN o_totalprice WHEN 1 THEN round(o_totalprice)::BIGINT::DOUBLE WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL
  WHEN 5 THEN (o_orderkey % 100)::DOUBLE * 1e3 WHEN 6 THEN -o_orderkey::DOUBLE ELSE NULL END AS number FROM orders"""
)
def clean_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    text = (
        F.when(k % 8 == 0, F.concat(F.lit(" "), F.format_number("o_totalprice", 2)))
        .when(k % 8 == 1, F.format_number(F.round(price), 0))
        .when(k % 8 == 2, F.concat(k.cast("string"), F.lit("d")))
        .when(k % 8 == 3, F.lit("nan"))
        .when(k % 8 == 4, F.lit("s/d"))
        .when(k % 8 == 5, F.concat((k % 100).cast("string"), F.lit("E3")))
        .when(k % 8 == 6, F.concat(F.lit("-"), k.cast("string")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", cleaning.parse_number(text).alias("number"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 4 THEN date_trunc('month', o_orderdate)::DATE END AS mes FROM orders"""
)
def parse_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    name = lambda i: F.get(F.array(*[F.lit(m[i]) for m in cleaning.MONTHS]), F.month(d) - 1)
    text = (
        F.when(k % 6 == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(k % 6 == 1, F.concat(F.lit(" 01/"), F.month(d).cast("string"), F.lit("/"), F.year(d).cast("string")))
        .when(k % 6 == 2, F.concat(name(0), F.lit("-"), F.date_format(d, "yy")))
        .when(k % 6 == 3, F.concat(F.initcap(name(1)), F.lit("/"), F.year(d).cast("string")))
        .when(k % 6 == 4, F.concat(F.lit("1/13/"), F.year(d).cast("string")))
        .otherwise(F.lit("pendiente"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", cleaning.parse_month(text).alias("mes"))


@query("SELECT vec_id, CASE WHEN label <> 0 THEN label::DOUBLE END AS latitud, CASE WHEN isnan(x) THEN NULL ELSE x END AS valor FROM (SELECT vec_id, label, CASE WHEN vec_id % 4 = 0 THEN 'nan'::DOUBLE ELSE vec_id / 2.0::DOUBLE END AS x FROM embeddings)")
def sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.when(F.col("vec_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("vec_id") / F.lit(2.0))
    return table(spark, sf_dir, "embeddings").select("vec_id", cleaning.zero_to_null(F.col("label").cast("double")).alias("latitud"), cleaning.nan_to_null(x).alias("valor"))


_URLS = """SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'https://x/PTP/OPA/2016/proyectos_opa_0' || (page_id % 4 + 1) || 't2016.csv' WHEN 1 THEN 'https://x/OPA/2016/Proyectos_OPA_' || (page_id % 4 + 1) || 't.xlsx'
  WHEN 2 THEN 'https://x/OPA/2019/reporteOPA3erTrimestre_V2.xlsx' WHEN 3 THEN 'https://x/DatosAbiertos/OPA/2022/ConsolidadoOPA4toTrimestre2022.CSV?d=1' WHEN 4 THEN 'https://x/DatosAbiertos/OPA/2021/proyectos_opa.csv'
  WHEN 5 THEN 'https://x/PTP/OPA/2015/Proyectos_OPA.csv' WHEN 6 THEN 'https://x/OPA/2020/ConcluidosOPA1erTrimestre2020.csv' ELSE url END AS url FROM pages"""


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    q = (k % 4 + 1).cast("string")
    made = (
        F.when(k % 8 == 0, F.concat(F.lit("https://x/PTP/OPA/2016/proyectos_opa_0"), q, F.lit("t2016.csv")))
        .when(k % 8 == 1, F.concat(F.lit("https://x/OPA/2016/Proyectos_OPA_"), q, F.lit("t.xlsx")))
        .when(k % 8 == 2, "https://x/OPA/2019/reporteOPA3erTrimestre_V2.xlsx")
        .when(k % 8 == 3, "https://x/DatosAbiertos/OPA/2022/ConsolidadoOPA4toTrimestre2022.CSV?d=1")
        .when(k % 8 == 4, "https://x/DatosAbiertos/OPA/2021/proyectos_opa.csv")
        .when(k % 8 == 5, "https://x/PTP/OPA/2015/Proyectos_OPA.csv")
        .when(k % 8 == 6, "https://x/OPA/2020/ConcluidosOPA1erTrimestre2020.csv")
        .otherwise(F.col("url"))
    )
    return table(spark, sf_dir, "pages").select("page_id", made.alias("url"))


@query(
    f"""SELECT page_id, CASE page_id % 8 WHEN 0 THEN 2016 WHEN 1 THEN 2016 WHEN 2 THEN 2019 WHEN 3 THEN 2022 WHEN 4 THEN 2021 WHEN 5 THEN 2015 WHEN 6 THEN 2020 END AS anio,
  CASE page_id % 8 WHEN 0 THEN (page_id % 4 + 1)::INTEGER WHEN 1 THEN (page_id % 4 + 1)::INTEGER WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 6 THEN 1 END AS trimestre,
  CASE page_id % 8 WHEN 0 THEN 'trimestral_numerico' WHEN 1 THEN 'trimestral_numerico' WHEN 2 THEN 'trimestral_ordinal' WHEN 3 THEN 'trimestral_nuevo' WHEN 4 THEN 'anual_generico' WHEN 5 THEN 'anual_generico_antiguo' WHEN 6 THEN 'trimestral_nuevo' ELSE 'no_reconocido' END AS patron,
  CASE WHEN url ILIKE '%Consolidado%' THEN 'consolidado' WHEN url ILIKE '%Concluido%' THEN 'concluido' WHEN page_id % 8 IN (4, 5, 7) THEN 'anual_generico' ELSE 'otro' END AS producto,
  CASE WHEN page_id % 8 IN (1, 2) THEN 'xlsx' WHEN page_id % 8 < 7 THEN 'csv' END AS ext
FROM ({_URLS})"""
)
def classify_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _urls(spark, sf_dir).withColumn("c", urls.classify_url(F.col("url")))
    return rows.select("page_id", "c.anio", "c.trimestre", "c.patron", urls.product(F.col("url"), F.col("c.trimestre")).alias("producto"), urls.extension(F.col("url")).alias("ext"))


@query("SELECT doc_id, sha256(lang || ',' || source) AS header_hash, sha256(text) AS content_hash FROM documents")
def header_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.array_join(F.array("lang", "source"), ",")
    return table(spark, sf_dir, "documents").select("doc_id", cleaning.sha256_hex(joined).alias("header_hash"), cleaning.sha256_hex(F.col("text")).alias("content_hash"))


@query(
    """SELECT doc_id, CASE WHEN anio IS NULL THEN 'aux_archivo_' || lang || '_1_' || s WHEN trimestre IS NULL THEN anio || '_anual_' || s ELSE anio || 'Q' || trimestre || '_' || s END AS snapshot_id,
  CASE WHEN anio IS NULL THEN 'opa_aux_archivo_' || lang || '_1_' || s WHEN trimestre IS NULL THEN 'opa_' || anio || '_anual_' || s ELSE 'opa_' || anio || '_' || trimestre || '_' || s END || '.csv' AS archivo
FROM (SELECT doc_id, lang, substr(sha256(text), 1, 8) AS s, CASE WHEN doc_id % 5 <> 0 THEN 2010 + doc_id % 10 END AS anio, CASE WHEN doc_id % 3 <> 0 THEN doc_id % 4 + 1 END AS trimestre FROM documents)"""
)
def snapshot_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    year, quarter = null_if_divides(k, 5, (k % 10 + 2010).cast("int")), null_if_divides(k, 3, (k % 4 + 1).cast("int"))
    sha, url = cleaning.sha256_hex(F.col("text")), F.concat(F.lit("https://h/p/Archivo-"), F.upper("lang"), F.lit(".1.csv?v=2"))
    return table(spark, sf_dir, "documents").select("doc_id", cleaning.snapshot_id(year, quarter, sha, url).alias("snapshot_id"), cleaning.bronze_name(year, quarter, sha, F.lit(".CSV"), url).alias("archivo"))


@query("SELECT c_custkey AS id, c_acctbal AS saldo, c_mktsegment AS segmento, NULL::VARCHAR AS nombre FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.files import union_by_name as unite

    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("saldo"), F.col("c_mktsegment").alias("segmento"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("nombre"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("saldo"))
    return unite([c, s])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"WITH {_RAW} SELECT cve, snapshot_id, orden FROM raw WHERE modificado IS NULL")
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_null(raw_panel(spark, sf_dir), "modificado").select("cve", "snapshot_id", "orden")


@query(f"WITH {_RAW} SELECT estatus, count(*) AS n FROM raw WHERE estatus NOT IN ('O', 'F') GROUP BY estatus")
def check_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.accepted_values(raw_panel(spark, sf_dir), "estatus", ("O", "F"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def check_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.relationship(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query(f"WITH {_COLLAPSED}, delta AS ({_DELTA}) SELECT cve, snapshot_id, avance, avance_anterior FROM delta WHERE avance < avance_anterior AND NOT (avance_decrecio AND cve % 2 = 0)")
def check_progress_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _deltas(collapsed(spark, sf_dir)).withColumn("bandera", F.col("avance_decrecio") & (F.col("cve") % 2 == 0))
    return checks.unflagged_fall(rows, "avance", "avance_anterior", "bandera").select("cve", "snapshot_id", "avance", "avance_anterior")


_COUNTS = """counts AS (SELECT event_type AS ramo, (dayofyear(ts) - 1)::INTEGER AS dia, ((dayofyear(ts) - 1) % 4 + 1)::INTEGER AS trimestre, (dayofyear(ts) % 11 = 0) AS parcial, count(DISTINCT CASE WHEN dayofyear(ts) % 3 <> 0 OR event_id % 40 = 0 THEN user_id END) AS n_ppi
  FROM events GROUP BY ALL)"""


@query(
    f"""WITH {_COUNTS} SELECT ramo, dia, n AS n_ppi_anterior, n_ppi, round((n_ppi - n) / n::DOUBLE * 100, 1) AS pct_cambio
FROM (SELECT *, lag(n_ppi) OVER w AS n, lag(trimestre) OVER w AS q, lag(parcial) OVER w AS p FROM counts WINDOW w AS (PARTITION BY ramo ORDER BY dia))
WHERE n >= 5 AND NOT parcial AND NOT p AND NOT (trimestre = 1 AND q = 4) AND (n_ppi - n) / n::DOUBLE <= -0.70"""
)
def check_count_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.dayofyear("ts")
    # every third day most events lose their user, so that counts fall; no row is left out
    user = F.when((d % 3 != 0) | (F.col("event_id") % 40 == 0), F.col("user_id"))
    counts = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("ramo"), (d - 1).alias("dia"), ((d - 1) % 4 + 1).alias("trimestre"), (d % 11 == 0).alias("parcial")).agg(F.countDistinct(user).alias("n_ppi"))
    return checks.unstable_counts(counts, "ramo", "dia", "trimestre", "n_ppi", "parcial")


_PROBES = """probes AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'wayback' WHEN 1 THEN 'vivo' WHEN 2 THEN 'espejo' ELSE 'otra' END AS fuente, year(o_orderdate)::INTEGER AS anio,
    CASE WHEN o_orderkey % 5 <> 0 THEN quarter(o_orderdate)::INTEGER END AS trimestre, CASE WHEN o_orderkey % 5 <> 0 THEN 'trimestral_nuevo' ELSE 'anual_generico' END AS patron,
    year(o_orderdate) < 2000 AND (o_orderkey % 701 = 0 OR (year(o_orderdate) = 1997 AND quarter(o_orderdate) = 2)) AS existe FROM orders)"""
_CELLS = """seen AS (SELECT anio, trimestre, min(CASE fuente WHEN 'vivo' THEN 0 WHEN 'espejo' THEN 1 WHEN 'wayback' THEN 2 END) AS r FROM probes WHERE existe AND trimestre IS NOT NULL AND patron NOT IN ('anual_generico', 'anual_generico_antiguo') GROUP BY ALL
), matrix AS (SELECT g.anio, g.trimestre, CASE r WHEN 0 THEN 'vivo' WHEN 1 THEN 'espejo' WHEN 2 THEN 'wayback' ELSE 'hueco' END AS categoria
  FROM (SELECT a::INTEGER AS anio, q::INTEGER AS trimestre FROM range(1995, 2003) t(a), range(1, 5) u(q)) g LEFT JOIN seen USING (anio, trimestre))"""


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, y, q = F.col("o_orderkey"), F.year("o_orderdate"), F.quarter("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.when(k % 4 == 0, "wayback").when(k % 4 == 1, "vivo").when(k % 4 == 2, "espejo").otherwise("otra").alias("fuente"), y.alias("anio"), F.when(k % 5 != 0, q).alias("trimestre"),
        F.when(k % 5 != 0, "trimestral_nuevo").otherwise("anual_generico").alias("patron"), ((y < 2000) & ((k % 701 == 0) | ((y == 1997) & (q == 2)))).alias("existe"),
    )


@query(f"WITH {_PROBES}, {_CELLS} SELECT * FROM matrix")
def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.coverage_matrix(_probes(spark, sf_dir), 1995, 2002)


@query(
    f"""WITH {_PROBES}, {_CELLS}, r AS (SELECT count(*) FILTER (WHERE anio BETWEEN 1995 AND 2000 AND categoria <> 'hueco') AS recuperables FROM matrix)
SELECT recuperables, 24::BIGINT AS total, recuperables / 24.0::DOUBLE * 100 AS porcentaje, CASE WHEN recuperables / 24.0 * 100 >= 70 THEN 'Panel trimestral completo, alcance original.'
  WHEN recuperables / 24.0 * 100 >= 50 THEN 'Panel trimestral parcial, huecos documentados en el reporte de calidad.'
  ELSE 'Pivotar a panel anual (Tomo VIII del PEF + OPA anual) y usar SRFT para la capa subnacional georreferenciada.' END AS recomendacion FROM r"""
)
def coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.recoverable(coverage.coverage_matrix(_probes(spark, sf_dir), 1995, 2002), 1995, 2000)


_YEARLY = """yearly AS (SELECT y.anio, CASE r WHEN 0 THEN 'vivo' WHEN 1 THEN 'espejo' WHEN 2 THEN 'wayback' ELSE 'hueco' END AS categoria FROM (SELECT a::INTEGER AS anio FROM range(1995, 2003) t(a)) y
  LEFT JOIN (SELECT anio, min(CASE fuente WHEN 'vivo' THEN 0 WHEN 'espejo' THEN 1 WHEN 'wayback' THEN 2 END) AS r FROM probes WHERE existe AND patron IN ('anual_generico', 'anual_generico_antiguo') GROUP BY anio) USING (anio))"""


@query(f"WITH {_PROBES}, {_YEARLY} SELECT * FROM yearly")
def coverage_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.yearly_coverage(_probes(spark, sf_dir), 1995, 2002)


@query(f"WITH {_PROBES}, {_YEARLY} SELECT coalesce(max(anio) - max(anio) FILTER (WHERE categoria <> 'hueco'), count(*))::BIGINT AS racha_final FROM yearly")
def coverage_trailing_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.trailing_gap(coverage.yearly_coverage(_probes(spark, sf_dir), 1995, 2002))


@query(f"WITH {_PROBES}, {_CELLS} SELECT DISTINCT anio FROM matrix WHERE categoria <> 'hueco'")
def coverage_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.covered_years(coverage.coverage_matrix(_probes(spark, sf_dir), 1995, 2002))


@query(
    f"""WITH {_SNAPSHOTS}, canon AS (SELECT anio, trimestre, producto <> 'consolidado' AND producto <> 'anual_generico' AS parcial FROM (SELECT *, row_number() OVER (PARTITION BY anio, trimestre ORDER BY
    CASE producto WHEN 'consolidado' THEN 1 WHEN 'seguimiento' THEN 2 WHEN 'concluido' THEN 3 ELSE 4 END, CASE origen WHEN 'vivo' THEN 1 ELSE 2 END, snapshot_id) AS rn FROM snapshots WHERE trimestre IS NOT NULL) WHERE rn = 1
), decl AS (SELECT anio, trimestre, bool_or(origen = 'vivo') AS vivo, bool_or(anio % 4 = 1) AS corrupto FROM snapshots WHERE trimestre IS NOT NULL GROUP BY ALL
), datos AS (SELECT DISTINCT anio, trimestre FROM snapshots WHERE trimestre IS NOT NULL AND (anio + trimestre) % 3 <> 0 AND anio < 2000
), grid AS (SELECT a::INTEGER AS anio, q::INTEGER AS trimestre FROM (SELECT unnest(range((SELECT min(anio) FROM decl), (SELECT max(anio) FROM decl) + 1)) AS a), range(1, 5) u(q))
SELECT g.anio, g.trimestre, CASE WHEN g.anio * 10 + g.trimestre > f.fin THEN 'futuro' WHEN d.anio IS NOT NULL THEN CASE WHEN vivo THEN 'vivo' ELSE 'wayback' END WHEN corrupto THEN 'corrupto' ELSE 'hueco' END AS categoria,
  d.anio IS NOT NULL AND coalesce(c.parcial, FALSE) AND NOT g.anio * 10 + g.trimestre > f.fin AS parcial
FROM grid g LEFT JOIN decl USING (anio, trimestre) LEFT JOIN canon c USING (anio, trimestre) LEFT JOIN datos d USING (anio, trimestre), (SELECT max(anio * 10 + trimestre) AS fin FROM datos) f"""
)
def coverage_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snapshots_of(spark, sf_dir)
    state = s.select("snapshot_id", F.when(F.col("anio") % 4 == 1, "excluido_de_silver").otherwise("normalizado").alias("estado")).distinct()
    data = s.where(F.col("trimestre").isNotNull() & ((F.col("anio") + F.col("trimestre")) % 3 != 0) & (F.col("anio") < 2000))
    return coverage.coverage_feed(s, state, panel.canonical_snapshots(s), data)


_UNIVERSE = """universe AS (SELECT g.anio, g.trimestre, n_ppi FROM (SELECT a::INTEGER AS anio, q::INTEGER AS trimestre FROM range(1994, 2003) t(a), range(1, 5) u(q)) g
  LEFT JOIN (SELECT anio, CASE WHEN NOT (anio = 1997 AND trimestre = 3) THEN trimestre END AS trimestre, count(DISTINCT cve) AS n_ppi FROM raw GROUP BY ALL) USING (anio, trimestre))"""


def _universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_panel(spark, sf_dir).withColumn("trimestre", F.when(~((F.col("anio") == 1997) & (F.col("trimestre") == 3)), F.col("trimestre")))
    return feeds.universe(raw, coverage.quarter_grid(spark, 1994, 2002), "cve")


@query(f"WITH {_RAW}, {_UNIVERSE} SELECT * FROM universe")
def universe_by_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _universe(spark, sf_dir)


_DROPS = "drops AS (SELECT b.anio, a.n_ppi AS n_q4, b.n_ppi AS n_q1, round((b.n_ppi - a.n_ppi) / a.n_ppi::DOUBLE * 100, 1) AS pct FROM universe b JOIN universe a ON a.anio + 1 = b.anio AND a.trimestre = 4 WHERE b.trimestre = 1 AND a.n_ppi IS NOT NULL AND b.n_ppi IS NOT NULL)"


@query(f"WITH {_RAW}, {_UNIVERSE}, {_DROPS} SELECT * FROM drops")
def seasonal_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.seasonal_drops(_universe(spark, sf_dir))


@query(f"WITH {_RAW}, {_UNIVERSE}, {_DROPS} SELECT min(pct) AS min_pct, max(pct) AS max_pct FROM drops")
def seasonal_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.seasonal_range(feeds.seasonal_drops(_universe(spark, sf_dir)))


@query(
    """WITH li AS (SELECT p_brand, year(l_shipdate)::INTEGER AS anio, l_extendedprice FROM lineitem JOIN part ON l_partkey = p_partkey),
top AS (SELECT p_brand FROM li GROUP BY p_brand ORDER BY sum(l_extendedprice::DECIMAL(18,2)) DESC, p_brand LIMIT 7)
SELECT anio, CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand ELSE 'Otros' END AS p_brand, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS l_extendedprice FROM li GROUP BY 1, 2"""
)
def top_n_with_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    rows = li.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).select("p_brand", F.year("l_shipdate").alias("anio"), "l_extendedprice")
    return feeds.top_with_rest(rows, "p_brand", "l_extendedprice", 7, ("anio",), kind=MONEY)


@query(
    f"""WITH {_COLLAPSED}, placed AS (SELECT cve, snapshot_id, modificado, (cve % 18 + 14.5)::DOUBLE AS latitud, CASE WHEN cve % 9 <> 0 THEN -(cve % 30)::DOUBLE - 88 END AS longitud FROM panel),
last AS (SELECT cve, snapshot_id, modificado, latitud, longitud FROM (SELECT *, row_number() OVER (PARTITION BY cve ORDER BY snapshot_id DESC) AS rn FROM placed WHERE longitud IS NOT NULL) WHERE rn = 1)
SELECT cve, snapshot_id, modificado, latitud, longitud, round(cbrt(greatest(coalesce(modificado, 1), 1)) / (SELECT max(cbrt(greatest(coalesce(modificado, 1), 1))) FROM last) * 28 + 3, 6) AS tamano FROM last"""
)
def latest_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("cve")
    placed = collapsed(spark, sf_dir).select("cve", "snapshot_id", "modificado", (k % 18 + F.lit(14.5)).cast("double").alias("latitud"), F.when(k % 9 != 0, -(k % 30).cast("double") - 88).alias("longitud"))
    return feeds.latest_points(placed, "cve", "modificado").withColumn("tamano", F.round("tamano", 6))


@query(f"WITH {_COLLAPSED}, {_LIFE} SELECT estatus_terminal_inferido, count(*) AS n FROM life GROUP BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.status_counts(_panel_life(spark, sf_dir), "estatus_terminal_inferido")


@query(
    f"""WITH {_COLLAPSED}, {_LIFE} SELECT (CASE WHEN sobrecosto_pct BETWEEN -100 AND 300 THEN least(floor((sobrecosto_pct + 100) / 20), 19) ELSE -1 END)::BIGINT AS bin, count(*) AS n FROM life WHERE sobrecosto_pct IS NOT NULL GROUP BY 1"""
)
def histogram_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.histogram(_panel_life(spark, sf_dir), "sobrecosto_pct", -100.0, 300.0, 20.0)


@query(
    """SELECT count(*) AS n_snapshots, max(source) AS ultima_descarga, sum(n_chars)::BIGINT AS bytes, min(anio) AS anio_min, max(anio) AS anio_max, (SELECT string_agg(lang || '=' || n, ',' ORDER BY lang || '=' || n) FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)) AS por_origen
FROM (SELECT *, 2010 + doc_id % 10 AS anio FROM documents)"""
)
def provenance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.provenance(table(spark, sf_dir, "documents"), F.col("doc_id") % 10 + 2010, "lang", "source", "n_chars")


@query(
    """SELECT count(*) AS n, count(DISTINCT p_name) AS n_claves, min(p_name) AS menor, max(p_name) AS mayor, round(avg(regexp_matches(p_name, '1$')::INTEGER), 6) AS cumple, bool_and(regexp_matches(p_name, '1$')) AS todas FROM part"""
)
def key_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.key_profile(table(spark, sf_dir, "part"), "p_name", "1$")


@query(
    f"""WITH {_SNAPSHOTS}, p AS (SELECT anio + (coalesce(trimestre, 1) - 1) / 4.0::DOUBLE AS pos, snapshot_id FROM snapshots)
SELECT (SELECT snapshot_id FROM p ORDER BY pos, snapshot_id LIMIT 1) AS oldest, (SELECT snapshot_id FROM p ORDER BY pos DESC, snapshot_id DESC LIMIT 1) AS newest, (SELECT snapshot_id FROM p ORDER BY abs(pos - 1998.5), snapshot_id LIMIT 1) AS middle"""
)
def sample_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snapshots_of(spark, sf_dir)
    position = F.col("anio") + (F.coalesce("trimestre", F.lit(1)) - 1) / F.lit(4.0)
    return feeds.nearest_to(s, position, 1998.5, ["snapshot_id"]).select(*[F.col(f"{c}.snapshot_id").alias(c) for c in ("oldest", "newest", "middle")])


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier ORDER BY s_nationkey NULLS LAST, s_suppkey")
def stable_export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return package.stable_order(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), ["s_nationkey", "s_suppkey"])


@query(
    f"""WITH {_COLLAPSED}, {_VERSIONS} SELECT CASE WHEN o.cve % 7 <> 0 THEN o.anio::VARCHAR ELSE 'sin_anio' END AS grupo, o.cve AS cve_cartera, o.snapshot_id,
  '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[-99.5,' || (14 + o.cve % 18) || '.5]}},"properties":{{"cve_cartera":' || o.cve || ',"nombre_ppi":' || coalesce('"' || v.nombre || '"', 'null') || ',"trimestre_corte":' || o.trimestre || '}}}}' AS feature
FROM panel o LEFT JOIN versions v ON v.cve = o.cve AND o.orden_corte BETWEEN v.vigente_desde_corte AND v.vigente_hasta_corte WHERE o.cve % 9 <> 0"""
)
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = collapsed(spark, sf_dir), F.col("cve")
    obs = p.select(
        k.alias("cve_cartera"), "snapshot_id", F.when(k % 7 != 0, F.col("anio").cast("double")).alias("anio_corte"), F.col("trimestre").alias("trimestre_corte"),
        (k % 18 + F.lit(14.5)).cast("double").alias("latitud"), F.when(k % 9 != 0, F.lit(-99.5)).alias("longitud"),
    )
    versions = _versions(p).withColumnsRenamed({"cve": "cve_cartera", "nombre": "nombre_ppi"})
    return package.features(obs, p.select("snapshot_id", "anio", "trimestre").distinct(), versions, ("cve_cartera", "nombre_ppi", "trimestre_corte"))


_GRID = """hosts AS (SELECT DISTINCT regexp_extract(url, '^https?://[^/]+/') AS b FROM pages WHERE regexp_matches(url, '^https?://[^/]+/')
), y AS (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1))::INTEGER AS a FROM orders
), cells AS (
  SELECT 'OPA/' || a || '/p_0' || q || 't.csv' AS u, a, q::INTEGER AS q, 'trimestral_numerico' AS p FROM y, range(1, 5) t(q)
  UNION ALL SELECT 'OPA/' || a || '/r' || o || 'T_V' || v || '.xlsx', a, n, 'trimestral_ordinal' FROM y, (VALUES ('1er', 1), ('2do', 2), ('3er', 3), ('4to', 4)) o(o, n), range(1, 3) w(v)
  UNION ALL SELECT 'DatosAbiertos/' || a || '.csv', a, NULL, 'anual_generico' FROM y UNION ALL SELECT 'raro.csv', 2017, 2, 'caso_especial' UNION ALL SELECT 'dicc.xlsx', NULL, NULL, 'auxiliar')"""


@query(f"WITH {_GRID} SELECT b || u AS url, a AS anio, q AS trimestre, p AS patron FROM hosts, cells")
def url_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid on every host that serves a page, over the years that orders span."""
    host = F.regexp_extract("url", "^https?://[^/]+/", 0)
    years = table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    grid = urls.UrlGrid(
        "", tuple(years), ("OPA/{anio}/p_0{n}t.csv", "OPA/{anio}/r{ord}T_V{v}.xlsx", "DatosAbiertos/{anio}.csv"), versions=(1, 2),
        special=(("raro.csv", 2017, 2),), auxiliary=("dicc.xlsx",),
    )
    return urls.candidates_on(table(spark, sf_dir, "pages").select(host.alias("base")).where("base != ''"), grid)


# --- files and relations: the readers, the staging and the marts over the same tables --------------------


@query(
    """SELECT o_orderkey, 'K' || lpad(o_custkey::VARCHAR, 9, '0') AS cve_cartera, year(o_orderdate)::DOUBLE AS anio, CASE WHEN o_orderkey % 9 <> 0 THEN (14 + o_orderkey % 18)::DOUBLE + 0.5 END AS latitud,
  o_totalprice AS modificado, CASE WHEN o_orderkey % 7 <> 0 THEN date_trunc('month', o_orderdate)::DATE END AS fecha_inicio_cal_ff, (o_custkey % 25)::BIGINT AS id_ramo, o_orderstatus AS "OTRA",
  NULL::DOUBLE AS avance_fisico, NULL::DOUBLE AS longitud, NULL::DOUBLE AS monto_total_inversion, (o_orderkey % 7 = 0)::INTEGER AS "_unparsed", 'S1' AS snapshot_id FROM orders"""
)
def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.plans.silver import clean_rows

    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    raw = table(spark, sf_dir, "orders").select(
        k, F.concat(F.lit(" 'k"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("CLAVE"), F.year(d).cast("string").alias("ANIO"),
        F.when(k % 9 == 0, "0").otherwise(F.concat((k % 18 + 14).cast("string"), F.lit(".5"))).alias("LAT"), F.format_number("o_totalprice", 2).alias("TOTAL"),
        F.when(k % 7 == 0, "pendiente").otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss")).alias("INICIO"), (F.col("o_custkey") % 25).cast("string").alias("RAMO"), F.col("o_orderstatus").alias("OTRA"),
    )
    rename = {"CLAVE": "cve_cartera", "ANIO": "anio", "LAT": "latitud", "TOTAL": "modificado", "INICIO": "fecha_inicio_cal_ff", "RAMO": "id_ramo"}
    return clean_rows(raw, rename, F.lit("S1"))


@query(
    """WITH m AS (SELECT 'S' || (o_orderkey % 500) AS snapshot_id, 'https://h/' || CASE o_orderkey % 4 WHEN 0 THEN 'consolidado' WHEN 1 THEN 'SeguimientoOPA' WHEN 2 THEN 'concluidos' ELSE 'x' END || o_orderkey || '.csv' AS url,
    CASE o_orderkey % 3 WHEN 0 THEN 'vivo' WHEN 1 THEN 'espejo' ELSE 'wayback' END AS origen, o_orderdate::DATE AS fecha_descarga, CASE WHEN o_orderkey % 11 <> 0 THEN year(o_orderdate)::INTEGER END AS anio,
    CASE WHEN o_orderkey % 5 <> 0 THEN quarter(o_orderdate)::INTEGER END AS trimestre, 'h' || o_orderkey % 5 AS header_hash, 's' || o_orderkey AS sha256, o_custkey::BIGINT AS bytes FROM orders)
SELECT snapshot_id, url, origen, fecha_descarga, anio, trimestre, header_hash, sha256, bytes, CASE WHEN url ILIKE '%consolidado%' THEN 'consolidado' WHEN url ILIKE '%seguimiento%' THEN 'seguimiento'
  WHEN url ILIKE '%concluido%' THEN 'concluido' WHEN trimestre IS NULL THEN 'anual_generico' ELSE 'otro' END AS producto
FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_id ORDER BY CASE origen WHEN 'vivo' THEN 1 WHEN 'espejo' THEN 2 ELSE 3 END, url) AS rn FROM m WHERE anio IS NOT NULL) WHERE rn = 1"""
)
def staged_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.plans.gold import stage_snapshots

    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    name = F.when(k % 4 == 0, "consolidado").when(k % 4 == 1, "SeguimientoOPA").when(k % 4 == 2, "concluidos").otherwise("x")
    cut = F.struct(null_if_divides(k, 11, F.year(d)).alias("anio"), null_if_divides(k, 5, F.quarter(d)).alias("trimestre"))
    manifest = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), (k % 500).cast("string")).alias("snapshot_id"), F.concat(F.lit("https://h/"), name, k.cast("string"), F.lit(".csv")).alias("url"),
        F.when(k % 3 == 0, "vivo").when(k % 3 == 1, "espejo").otherwise("wayback").alias("origen"), F.date_format(d, "yyyy-MM-dd").alias("fecha_descarga"), cut.alias("corte_declarado"),
        F.concat(F.lit("h"), (k % 5).cast("string")).alias("header_hash"), F.concat(F.lit("s"), k.cast("string")).alias("sha256"), F.col("o_custkey").cast("long").alias("bytes"),
    )
    return stage_snapshots(manifest)


_MARTS = (
    _RAW
    + """, manifest AS (SELECT DISTINCT snapshot_id, anio, trimestre, 'https://h/' || CASE WHEN anio % 3 = 0 THEN 'Seguimiento' ELSE 'Consolidado' END || snapshot_id AS url FROM raw
), silver AS (SELECT 'K' || cve AS cve_cartera, CASE WHEN trimestre <> 2 THEN snapshot_id END AS snapshot_id, modificado, avance AS avance_fisico, nombre AS nombre_ppi, estatus AS estatus_operacion, ramo::BIGINT AS id_ramo FROM raw)"""
)


def _marts(spark: SparkSession, sf_dir: str):
    from tidemark.plans.gold import build_gold

    raw = raw_panel(spark, sf_dir)
    product = F.when(F.col("anio") % 3 == 0, "Seguimiento").otherwise("Consolidado")
    manifest = raw.select("snapshot_id", "anio", "trimestre").distinct().select(
        "snapshot_id", F.concat(F.lit("https://h/"), product, F.col("snapshot_id")).alias("url"), F.lit("vivo").alias("origen"), F.lit("2026-01-01").alias("fecha_descarga"),
        F.struct("anio", "trimestre").alias("corte_declarado"), F.lit("h").alias("header_hash"), F.lit("s").alias("sha256"), F.lit(1).cast("long").alias("bytes"),
    )
    silver = raw.select(
        F.concat(F.lit("K"), F.col("cve").cast("string")).alias("cve_cartera"), F.when(F.col("trimestre") != 2, F.col("snapshot_id")).alias("snapshot_id"), "modificado", F.col("avance").alias("avance_fisico"), F.col("nombre").alias("nombre_ppi"),
        F.col("estatus").alias("estatus_operacion"), F.col("ramo").cast("long").alias("id_ramo"), F.col("anio").cast("double").alias("anio"),
    )
    return build_gold(silver, manifest, spark.createDataFrame([], "anio INT, trimestre INT, inpc DOUBLE, anio_base INT"))


@query(
    f"""WITH {_MARTS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY cve_cartera, snapshot_id ORDER BY modificado DESC NULLS LAST, nombre_ppi NULLS LAST, estatus_operacion NULLS FIRST) AS rn FROM silver)
SELECT cve_cartera, snapshot_id, n_registros_agregados, r.modificado, avance_fisico, nombre_ppi, estatus_operacion, id_ramo, anio, trimestre, anio * 10 + trimestre AS orden_corte, anio * 4 + trimestre AS indice_trimestre, anio % 3 = 0 AS cobertura_parcial_del_universo
FROM (SELECT cve_cartera, snapshot_id, count(*) AS n_registros_agregados, sum(modificado::DECIMAL(28,6))::DOUBLE AS modificado, max(avance_fisico) AS avance_fisico, max(nombre_ppi) FILTER (WHERE rn = 1) AS nombre_ppi,
  max(estatus_operacion) FILTER (WHERE rn = 1) AS estatus_operacion, min(id_ramo) AS id_ramo FROM ranked GROUP BY ALL) r JOIN manifest USING (snapshot_id)"""
)
def gold_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ("cve_cartera", "snapshot_id", "n_registros_agregados", "modificado", "avance_fisico", "nombre_ppi", "estatus_operacion", "id_ramo", "anio", "trimestre", "orden_corte", "indice_trimestre", "cobertura_parcial_del_universo")
    return _marts(spark, sf_dir).int_ppi_observaciones_canonicas.select(*own)


@query(
    f"""WITH {_MARTS} SELECT m.snapshot_id, anio, trimestre, 'vivo' AS origen, DATE '2026-01-01' AS fecha_descarga, url, 's' AS sha256, 1::BIGINT AS bytes, coalesce(n, 0) AS n_observaciones, coalesce(k, 0) AS n_ppi,
  CASE WHEN n IS NULL THEN 'excluido_de_silver' ELSE 'normalizado' END AS estado FROM manifest m LEFT JOIN (SELECT snapshot_id, count(*) AS n, count(DISTINCT cve_cartera) AS k FROM silver GROUP BY 1) USING (snapshot_id)"""
)
def gold_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marts(spark, sf_dir).dim_snapshot


@query(
    """SELECT s_suppkey::VARCHAR AS "S_KEY", s_name || ', "x"' || chr(10) || 'y' AS "S NAME", CASE WHEN s_suppkey % 3 <> 0 THEN s_nationkey::VARCHAR END AS "S.1" FROM supplier"""
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows written as CSV and scanned again under their layout; ``NA`` comes back as null."""
    from tidemark.sources.files import scan_csv

    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        k.cast("string").alias("a"), F.concat("s_name", F.lit(', "x"\ny')).alias("b"), F.when(k % 3 == 0, "NA").otherwise(F.col("s_nationkey").cast("string")).alias("c")
    )
    path = Workspace(spark, "round").path
    rows.write.option("header", True).option("sep", ";").option("escape", '"').option("quoteAll", True).csv(path)
    return scan_csv(spark, path, ["S_KEY", "S NAME", "S.1"], ";")


@query("SELECT p_partkey, p_name, NULL::DOUBLE AS falta FROM part")
def read_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.files import read_silver

    return read_silver(spark, f"{sf_dir}/part.parquet", T.StructType([T.StructField("falta", T.DoubleType()), *[f for f in table(spark, sf_dir, "part").schema if f.name in ("p_partkey", "p_name")]]))


_CLASSIFIED = f"""SELECT page_id, url, CASE page_id % 8 WHEN 0 THEN 2016 WHEN 1 THEN 2016 WHEN 2 THEN 2019 WHEN 3 THEN 2022 WHEN 4 THEN 2021 WHEN 5 THEN 2015 WHEN 6 THEN 2020 END AS anio,
  CASE page_id % 8 WHEN 0 THEN (page_id % 4 + 1)::INTEGER WHEN 1 THEN (page_id % 4 + 1)::INTEGER WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 6 THEN 1 END AS trimestre,
  CASE page_id % 8 WHEN 0 THEN 'trimestral_numerico' WHEN 1 THEN 'trimestral_numerico' WHEN 2 THEN 'trimestral_ordinal' WHEN 3 THEN 'trimestral_nuevo' WHEN 4 THEN 'anual_generico' WHEN 5 THEN 'anual_generico_antiguo' WHEN 6 THEN 'trimestral_nuevo' ELSE 'no_reconocido' END AS patron,
  CASE WHEN page_id % 8 IN (1, 2) THEN 'xlsx' WHEN page_id % 8 < 7 THEN 'csv' END AS ext FROM ({_URLS})"""


@query(
    f"""SELECT 'wayback' AS fuente, 'https://web.archive.org/web/2020' || lpad(page_id::VARCHAR, 10, '0') || 'id_/' || url AS url, anio, trimestre, patron, TRUE AS existe, '2020' || lpad(page_id::VARCHAR, 10, '0') AS wayback_timestamp FROM ({_CLASSIFIED})"""
)
def archive_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.discovery import archive_probes

    stamp = F.concat(F.lit("2020"), F.lpad(F.col("page_id").cast("string"), 10, "0"))
    return archive_probes(_urls(spark, sf_dir).select(stamp.alias("timestamp"), F.col("url").alias("original")))


@query(
    f"""SELECT 'vivo' AS fuente, url || '?p=' || page_id AS url, anio, trimestre, TRUE AS existe, NULL::VARCHAR AS wayback_timestamp, ext FROM ({_CLASSIFIED})
WHERE page_id % 5 <> 0 AND ext IS NOT NULL AND page_id % 3 <> 0"""
)
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.discovery import to_ingest

    k = F.col("page_id")
    rows = _urls(spark, sf_dir).withColumn("c", urls.classify_url(F.col("url"))).select(k, F.concat("url", F.lit("?p="), k.cast("string")).alias("url"), "c.anio", "c.trimestre")
    probes = rows.select(F.lit("vivo").alias("fuente"), "url", "anio", "trimestre", (k % 5 != 0).alias("existe"))
    return to_ingest(probes, rows.where(k % 3 == 0).select("url", F.struct("anio", "trimestre").alias("corte_declarado")))


@query(f"WITH {_RAW} SELECT anio || 'T' || trimestre AS version FROM raw ORDER BY raw.anio DESC, raw.trimestre DESC LIMIT 1")
def version_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.feeds import version_label

    return spark.createDataFrame([(version_label(raw_panel(spark, sf_dir).select("anio", "trimestre")),)], "version STRING")


@query(
    """SELECT doc_id || '.csv' AS name, CASE WHEN doc_id % 2 = 0 THEN 'latin-1' ELSE 'utf-8-sig' END AS encoding, CASE doc_id % 4 WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN chr(9) ELSE '|' END AS separator,
  'CLAVE AÑO LARGO' AS columns, 3 AS n_columnas, sha256('CLAVE,AÑO,LARGO') AS header_hash FROM documents"""
)
def inspect_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heads of files made from the documents' columns, in two encodings and four separators, inspected on executors."""
    from tidemark.sources.files import dialects

    k = F.col("doc_id")
    sep = F.when(k % 4 == 0, ",").when(k % 4 == 1, ";").when(k % 4 == 2, "\t").otherwise("|")
    line = lambda *cells: F.concat_ws("", cells[0], sep, cells[1], sep, cells[2], F.lit("\n"))
    head = F.concat(line(F.lit("CLAVE"), F.lit("AÑO"), F.lit("LARGO")), *[line(k + i, F.lit(2010 + i), F.col("n_chars")) for i in range(3)])
    content = F.when(k % 2 == 0, F.encode(head, "ISO-8859-1")).otherwise(F.encode(head, "UTF-8"))
    found = dialects(table(spark, sf_dir, "documents").select(F.concat(k.cast("string"), F.lit(".csv")).alias("name"), content.alias("content"), F.lit(None).cast("string").alias("encoding")))
    return found.select("name", "encoding", "separator", F.array_join("columns", " ").alias("columns"), F.col("n_columns").alias("n_columnas"), "header_hash")


@query(
    """SELECT p_partkey, list_reduce(regexp_split_to_array(trim(regexp_replace(p_name || ' ' || p_brand || '  ' || p_name || ' ' || p_partkey || ' de ' || p_brand, '\\s+', ' ', 'g')), ' '),
  lambda a, w: CASE WHEN length(string_split(a, '<br>')[-1]) + 1 + length(w) <= 24 THEN a || ' ' || w ELSE a || '<br>' || w END) AS etiqueta FROM part"""
)
def wrap_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat("p_name", F.lit(" "), "p_brand", F.lit("  "), "p_name", F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" de "), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", cleaning.wrap(label, 24).alias("etiqueta"))


@query(
    """SELECT c_custkey, c_custkey::BIGINT AS snapshots_normalizados, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey::BIGINT END AS snapshots_omitidos_corruptos, 0::BIGINT AS snapshots_esquema_desconocido, 7::BIGINT AS snapshots_error_lectura,
  c_custkey::BIGINT * 1000 AS filas_totales, c_custkey::BIGINT * 900 AS filas_validas, c_custkey::BIGINT * 100 AS filas_en_cuarentena, CASE WHEN c_custkey % 3 <> 0 THEN 90.5::DOUBLE END AS pct_filas_validas FROM customer"""
)
def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality reports written for every customer, and read again; some lack a line or a share."""
    from tidemark.sources.report import SUMMARY, parse_summaries

    k = F.col("c_custkey")
    commas = lambda n: F.format_number(n.cast("long"), 0)
    bold = lambda n: F.concat(F.lit("**"), n.cast("string"), F.lit("**"))
    values = [bold(k), bold(F.col("c_nationkey")), bold(F.lit(0)), bold(F.lit(7)), commas(k * 1000), F.concat(commas(k * 900), F.when(k % 3 == 0, "").otherwise(" (90.5%)")), commas(k * 100)]
    lines = [F.concat(F.lit(f"- {name}" + (" (no se escriben): " if f == "filas_en_cuarentena" else ": ")), v) for (f, name), v in zip(SUMMARY.items(), values, strict=True)]
    lines[1] = F.when(k % 5 != 0, lines[1])
    text = F.concat_ws("\n", F.lit("# Calidad"), F.lit("## Resumen"), *lines, F.lit("## Detalle"), F.col("c_name"))
    return parse_summaries(table(spark, sf_dir, "customer").select("c_custkey", text.alias("value")))


# --- round trips: what the writers leave, read again by the readers ---------------------------------------


@query(
    """SELECT 'vivo' AS fuente, 'https://h/' || o_orderkey AS url, 200 AS status, floor(o_totalprice)::BIGINT AS content_length, year(o_orderdate)::INTEGER AS anio, CASE WHEN o_orderkey % 5 <> 0 THEN quarter(o_orderdate)::INTEGER END AS trimestre,
  o_orderkey % 3 = 0 AS existe, CASE WHEN o_orderkey % 4 = 0 THEN '2020' || o_orderkey END AS sello, CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 1 END AS n_extra FROM orders"""
)
def probe_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe records as JSON lines; fields beyond the fixed ones come back in the map of extras."""
    from tidemark.sources.files import read_probes

    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    path = f"{Workspace(spark, 'probes').path}/lines"
    table(spark, sf_dir, "orders").select(
        F.lit("vivo").alias("fuente"), F.concat(F.lit("https://h/"), k.cast("string")).alias("url"), F.lit(200).alias("status"), F.col("o_totalprice").cast("long").alias("content_length"),
        F.year(d).alias("anio"), null_if_divides(k, 5, F.quarter(d)).alias("trimestre"), (k % 3 == 0).alias("existe"), F.when(k % 4 == 0, F.concat(F.lit("2020"), k.cast("string"))).alias("wayback_timestamp"),
        F.col("o_orderstatus").alias("otro"),
    ).write.json(path)
    rows = read_probes(spark, path)
    return rows.select("fuente", "url", "status", "content_length", "anio", "trimestre", "existe", F.try_element_at("extra", F.lit("wayback_timestamp")).alias("sello"), F.size("extra").alias("n_extra"))


_LETTERS = """letters AS (SELECT 'https://h/' || o_custkey AS url, CASE o_orderkey % 3 WHEN 0 THEN 404 WHEN 1 THEN 503 END AS status, o_orderstatus AS error,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::INTEGER AS intento FROM orders)"""


def _letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    k = F.col("o_orderkey")
    turn = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    status = F.when(k % 3 == 0, 404).when(k % 3 == 1, 503)
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("https://h/"), F.col("o_custkey").cast("string")).alias("url"), status.alias("status"), F.col("o_orderstatus").alias("error"), turn.alias("intento"))


@query(f"WITH {_LETTERS} SELECT url, max(intento) AS intentos_previos, arg_max(coalesce(status, -1), intento) AS ultimo_status, arg_max(error, intento) AS ultimo_error FROM letters GROUP BY url")
def failed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.discovery import last_failures

    return last_failures(_letters(spark, sf_dir)).withColumn("ultimo_status", F.coalesce("ultimo_status", F.lit(-1)))


@query(
    f"""WITH {_LETTERS}, last AS (SELECT url, max(intento) AS n, arg_max(coalesce(status, -1), intento) AS status FROM letters GROUP BY url)
SELECT c_custkey, 'https://h/' || c_custkey AS url, coalesce(n, 0) AS intentos_previos FROM customer LEFT JOIN last ON url = 'https://h/' || c_custkey WHERE coalesce(status, 0) <> 404 AND c_custkey % 7 <> 0"""
)
def files_to_try_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are neither in the manifest nor known to be gone, with their failures so far."""
    from tidemark.sources.discovery import to_ingest

    k = F.col("c_custkey")
    url = F.concat(F.lit("https://h/"), k.cast("string"))
    files = table(spark, sf_dir, "customer").select(k, url.alias("url"))
    probes = files.select(k, F.concat("url", F.lit(".csv")).alias("url"), F.lit("vivo").alias("fuente"), F.lit(None).cast("int").alias("anio"), F.lit(None).cast("int").alias("trimestre"), F.lit(True).alias("existe"))
    done = probes.where(k % 7 == 0).select("url", F.struct("anio", "trimestre").alias("corte_declarado"))
    failures = _letters(spark, sf_dir).withColumn("url", F.concat("url", F.lit(".csv")))
    return to_ingest(probes, done, failures).select("c_custkey", F.regexp_replace("url", "[.]csv$", "").alias("url"), "intentos_previos")


_SILVER = """judged AS (SELECT 'K' || lpad(o_orderkey::VARCHAR, 9, '0') AS cve_cartera, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS snapshot_id, year(o_orderdate)::DOUBLE + 15 AS anio,
    (o_orderkey % 103)::DOUBLE AS avance_fisico, o_totalprice - 1000 * (o_orderkey % 40) AS monto FROM orders
), told AS (SELECT *, avance_fisico <= 100 AS a, monto >= 0 AS m FROM judged)"""


def _written_silver(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Orders as judged rows, written by snapshot; the folder and the judged rows."""
    from tidemark.plans.silver import SilverRun, write_silver

    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("K"), F.lpad(k.cast("string"), 9, "0")).alias("cve_cartera"), F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")).alias("snapshot_id"), (F.year(d) + 15).cast("double").alias("anio"),
        (k % 103).cast("double").alias("avance_fisico"), F.lit(None).cast("double").alias("latitud"), F.lit(None).cast("double").alias("longitud"), (F.col("o_totalprice") - 1000 * (k % 40)).alias("monto_total_inversion"), F.lit(0).alias("_unparsed"),
    )
    judged = contract.judge(rows, contract.snapshot_rules())
    path = Workspace(spark, "silver").path
    snapshots = [(r["snapshot_id"], "s") for r in rows.select("snapshot_id").distinct().collect()]  # a catalogue's size
    write_silver(SilverRun(judged, [], snapshots), path)
    return path, judged


@query(f"WITH {_SILVER} SELECT cve_cartera, snapshot_id, anio, avance_fisico, monto AS monto_total_inversion FROM told WHERE a AND m")
def silver_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.files import read_silver

    path, judged = _written_silver(spark, sf_dir)
    schema = T.StructType([f for f in judged.schema if f.name in ("cve_cartera", "snapshot_id", "anio", "avance_fisico", "monto_total_inversion")])
    return read_silver(spark, path, schema, "valid")


@query(
    f"""WITH {_SILVER} SELECT snapshot_id, 's' AS sha256, count(*) AS n_rows, count(*) FILTER (WHERE a AND m) AS n_valid, count(*) FILTER (WHERE NOT (a AND m)) AS n_quarantined,
  round(count(*) FILTER (WHERE a AND m) * 100.0::DOUBLE / count(*), 1) AS pct_valid, 0::BIGINT AS fechas_no_parseadas, coalesce(nullif(count(*) FILTER (WHERE NOT a), 0), 0) AS avance, coalesce(nullif(count(*) FILTER (WHERE NOT m), 0), 0) AS monto FROM told GROUP BY snapshot_id"""
)
def silver_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.plans.silver import AUDIT

    path, _ = _written_silver(spark, sf_dir)
    found = lambda rule: F.coalesce(F.try_element_at("motivos", F.lit(rule)), F.lit(0))
    rows = spark.read.schema(AUDIT).parquet(f"{path}/audit")
    return rows.select(*[c for c in rows.columns if c != "motivos"], found("avance_fisico_in_range").alias("avance"), found("monto_total_inversion_not_negative").alias("monto"))


@query("""SELECT s_suppkey || ',"' || s_name || ' ""x"", y",' || CASE WHEN s_suppkey % 3 <> 0 THEN s_nationkey::VARCHAR ELSE '' END || ',' || CASE WHEN s_suppkey % 2 = 0 THEN 'True' ELSE 'False' END AS linea FROM supplier""")
def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as the package writes them: quotes doubled, nulls empty."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(k, F.concat("s_name", F.lit(' "x", y')).alias("s_name"), F.when(k % 3 != 0, F.col("s_nationkey")).alias("s_nationkey"), (k % 2 == 0).alias("par"))
    return package._csv_lines(package.stable_order(rows, ["s_suppkey"])).select(F.regexp_replace("value", "\\r$", "").alias("linea"))


@query("SELECT DISTINCT 'https://h/' || o_custkey AS url, year(o_orderdate)::INTEGER AS anio, CASE WHEN o_orderkey % 5 <> 0 THEN quarter(o_orderdate)::INTEGER END AS trimestre FROM orders")
def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest records made from orders, streamed in two runs: a snapshot counts once, in whichever file it comes."""
    from tidemark.streaming.bronze import start_records

    k, d, path = F.col("o_orderkey"), F.col("o_orderdate"), Workspace(spark, "records").path
    cut = F.struct(F.year(d).alias("anio"), null_if_divides(k, 5, F.quarter(d)).alias("trimestre"))
    rows = table(spark, sf_dir, "orders").select(k, F.concat(F.lit("https://h/"), F.col("o_custkey").cast("string")).alias("url"), cut.alias("corte_declarado"))
    for half in (k % 2 == 0, k % 2 == 1):
        rows.where(half).select("url", "corte_declarado").write.mode("append").json(f"{path}/in")
        start_records(spark, f"{path}/in", f"{path}/out", f"{path}/check").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("url", "corte_declarado.anio", "corte_declarado.trimestre")
