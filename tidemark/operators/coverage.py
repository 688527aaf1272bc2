"""Coverage of the calendar: which quarters a panel holds, from where, and whether that is enough."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.urls import YEARLY

#: Origins by priority; a cell without any is a gap.
PRIORITY = ("vivo", "espejo", "wayback")
GAP = "hueco"

# The gate's answers, by the least percentage of quarters that can be recovered.
GATE = (
    (70.0, "Panel trimestral completo, alcance original."),
    (50.0, "Panel trimestral parcial, huecos documentados en el reporte de calidad."),
    (0.0, "Pivotar a panel anual (Tomo VIII del PEF + OPA anual) y usar SRFT para la capa subnacional georreferenciada."),
)


def quarter_grid(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Every quarter of the years from ``first`` to ``last``."""
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("anio"))
    return years.select("anio", F.explode(F.array(*[F.lit(q) for q in (1, 2, 3, 4)])).alias("trimestre"))


def _best(priority: Sequence[str]):
    ranks = F.create_map(*[F.lit(v) for i, p in enumerate(priority) for v in (p, i)])
    return F.min(F.try_element_at(ranks, F.col("fuente")))


def _name(rank, priority: Sequence[str]):
    return F.coalesce(F.get(F.array(*[F.lit(p) for p in priority]), rank), F.lit(GAP))


def coverage_matrix(probes: DataFrame, first: int, last: int, priority: Sequence[str] = PRIORITY) -> DataFrame:
    """(anio, trimestre, categoria) of the whole grid: the best origin that exists, else a gap.

    ``probes``: fuente, anio, trimestre, patron, existe. Layouts without a quarter do not count here.
    """
    seen = probes.where(F.col("anio").isNotNull() & F.col("trimestre").isNotNull() & F.col("existe") & ~F.col("patron").isin(*YEARLY))
    best = seen.groupBy("anio", "trimestre").agg(_best(priority).alias("_r"))
    return quarter_grid(probes.sparkSession, first, last).join(best, ["anio", "trimestre"], "left").select("anio", "trimestre", _name(F.col("_r"), priority).alias("categoria"))


def yearly_coverage(probes: DataFrame, first: int, last: int, priority: Sequence[str] = PRIORITY) -> DataFrame:
    """(anio, categoria) by layouts that name a year only."""
    seen = probes.where(F.col("anio").isNotNull() & F.col("existe") & F.col("patron").isin(*YEARLY))
    best = seen.groupBy("anio").agg(_best(priority).alias("_r"))
    years = quarter_grid(probes.sparkSession, first, last).select("anio").distinct()
    return years.join(best, "anio", "left").select("anio", _name(F.col("_r"), priority).alias("categoria"))


def recoverable(matrix: DataFrame, first: int, last: int) -> DataFrame:
    """One row: quarters of the years that can be recovered, all of them, the percentage, and the gate's answer."""
    total = (last - first + 1) * 4
    n = matrix.where(F.col("anio").between(first, last) & (F.col("categoria") != GAP)).agg(F.count(F.lit(1)).alias("recuperables"))
    pct = F.col("recuperables") / F.lit(float(total)) * 100 if total > 0 else F.lit(0.0)
    answer = F.when(F.lit(False), "")
    for least, text in GATE:
        answer = answer.when(F.col("porcentaje") >= least, text)
    return n.select("recuperables", F.lit(total).cast("long").alias("total"), pct.alias("porcentaje")).withColumn("recomendacion", answer)


def trailing_gap(yearly: DataFrame) -> DataFrame:
    """One row: how many years at the end of the range are gaps."""
    last = F.max(F.when(F.col("categoria") != GAP, F.col("anio")))
    return yearly.agg(F.coalesce(F.max("anio") - last, F.count(F.lit(1))).cast("long").alias("racha_final"))


def covered_years(matrix: DataFrame) -> DataFrame:
    """Years with at least one quarter that is no gap."""
    return matrix.where(F.col("categoria") != GAP).select("anio").distinct()


def coverage_feed(snapshots: DataFrame, dim_snapshot: DataFrame, canonical: DataFrame, with_data: DataFrame) -> DataFrame:
    """(anio, trimestre, categoria, parcial) of every quarter between the first and last declared year.

    With data a quarter is ``vivo`` or ``wayback``; without, ``corrupto`` if a declared snapshot never
    reached the clean layer, else ``hueco``; after the last quarter with data, ``futuro``. ``parcial`` is a
    dimension of its own. The grid's bounds are one row, broadcast.
    """
    state = dim_snapshot.select(F.col("snapshot_id").alias("_id"), "estado")
    declared = (
        snapshots.where(F.col("trimestre").isNotNull())
        .join(state, F.col("snapshot_id") == F.col("_id"), "left")
        .groupBy("anio", "trimestre")
        .agg(F.bool_or(F.col("origen") == "vivo").alias("vivo"), F.bool_or(F.coalesce("estado", F.lit("")) == "excluido_de_silver").alias("corrupto"))
        .join(canonical.select("anio", "trimestre", F.col("cobertura_parcial_del_universo").alias("parcial")), ["anio", "trimestre"], "left")
    )
    data = with_data.select("anio", "trimestre").distinct().withColumn("datos", F.lit(True))
    bounds = declared.agg(F.min("anio").alias("a"), F.max("anio").alias("b"))
    years = bounds.where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("anio"))
    grid = years.select("anio", F.explode(F.array(*[F.lit(q) for q in (1, 2, 3, 4)])).alias("trimestre"))
    end = data.agg(F.max(F.col("anio") * 10 + F.col("trimestre")).alias("_end"))
    cells = grid.join(declared, ["anio", "trimestre"], "left").join(data, ["anio", "trimestre"], "left").crossJoin(F.broadcast(end))
    future = F.col("anio") * 10 + F.col("trimestre") > F.col("_end")
    has = F.coalesce("datos", F.lit(False))
    category = (
        F.when(future, "futuro")
        .when(has, F.when(F.coalesce("vivo", F.lit(False)), "vivo").otherwise("wayback"))
        .when(F.coalesce("corrupto", F.lit(False)), "corrupto")
        .otherwise(GAP)
    )
    return cells.select("anio", "trimestre", category.alias("categoria"), (has & F.coalesce("parcial", F.lit(False)) & ~F.coalesce(future, F.lit(False))).alias("parcial"))
