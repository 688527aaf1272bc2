"""Data behind the figures: small frames, aggregated before anything is drawn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleaning import point_size
from tidemark.operators.panel import exact_sum, pick_first


def universe(panel: DataFrame, grid: DataFrame, key: str) -> DataFrame:
    """Distinct keys per quarter on the whole grid; null where the panel has a gap."""
    n = panel.groupBy("anio", "trimestre").agg(F.countDistinct(key).alias("n_ppi"))
    return grid.select("anio", "trimestre").join(n, ["anio", "trimestre"], "left")


def seasonal_drops(counts: DataFrame) -> DataFrame:
    """First quarters beside the fourth before them: anio, n_q4, n_q1 and the change in percent."""
    known = counts.where(F.col("n_ppi").isNotNull())
    q4 = known.where("trimestre = 4").select((F.col("anio") + 1).alias("anio"), F.col("n_ppi").alias("n_q4"))
    both = known.where("trimestre = 1").select("anio", F.col("n_ppi").alias("n_q1")).join(q4, "anio")
    return both.select("anio", "n_q4", "n_q1", F.round((F.col("n_q1") - F.col("n_q4")) / F.col("n_q4").cast("double") * 100, 1).alias("pct"))


def seasonal_range(drops: DataFrame) -> DataFrame:
    return drops.agg(F.min("pct").alias("min_pct"), F.max("pct").alias("max_pct"))


def top_with_rest(df: DataFrame, group: str, amount: str, n: int, by: Sequence[str] = (), rest: str = "Otros", kind: str = "decimal(28,6)") -> DataFrame:
    """Sums of the ``n`` largest groups by name, all others under ``rest``.

    The top list is a TakeOrderedAndProject of at most ``n`` rows, so it is broadcast.
    """
    top = df.groupBy(group).agg(exact_sum(amount, kind).alias("_t")).orderBy(F.col("_t").desc_nulls_last(), F.col(group).asc_nulls_last()).limit(n)
    named = df.join(F.broadcast(top.select(F.col(group).alias("_g"))), F.col(group) == F.col("_g"), "left")
    label = F.when(F.col("_g").isNotNull(), F.col(group)).otherwise(rest)
    return named.select(*by, label.alias(group), amount).groupBy(*by, group).agg(exact_sum(amount, kind).alias(amount))


def latest_points(observations: DataFrame, key: str, amount: str) -> DataFrame:
    """Each key's latest observation with a position, with its marker size.

    Latest by the snapshot id as text. The largest size is an aggregate of one row, broadcast, rather than
    a window over everything.
    """
    placed = observations.where(F.col("latitud").isNotNull() & F.col("longitud").isNotNull())
    last = pick_first(placed, [key], [F.col("snapshot_id").desc_nulls_last()])
    root = last.agg(F.max(F.cbrt(F.greatest(F.coalesce(F.col(amount), F.lit(1.0)), F.lit(1.0)))).alias("_m"))
    return last.crossJoin(F.broadcast(root)).select(*observations.columns, point_size(F.col(amount), F.col("_m")).alias("tamano"))


def status_counts(life: DataFrame, status: str) -> DataFrame:
    return life.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: str, low: float, high: float, width: float) -> DataFrame:
    """(bin, n) of the values in [low, high], the upper edge in the last bin, and the rest under bin -1."""
    inside = F.col(column).between(low, high)
    last = int((high - low) / width) - 1
    bin_ = F.when(inside, F.least(F.floor((F.col(column) - low) / width), F.lit(last))).otherwise(-1).cast("long")
    return df.where(F.col(column).isNotNull()).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def provenance(manifest: DataFrame, year: Column, origin: str, day: str, size: str) -> DataFrame:
    """One row: snapshots, by origin, last download, bytes, and the span of years."""
    by_origin = manifest.groupBy(origin).agg(F.count(F.lit(1)).alias("n"))
    names = by_origin.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.col(origin), F.col("n").cast("string")))), ",").alias("por_origen"))
    rest = manifest.agg(F.count(F.lit(1)).alias("n_snapshots"), F.max(day).alias("ultima_descarga"), F.sum(size).alias("bytes"), F.min(year).alias("anio_min"), F.max(year).alias("anio_max"))
    return rest.crossJoin(F.broadcast(names))


def nearest_to(df: DataFrame, position: Column, target: float, columns: Sequence[str]) -> DataFrame:
    """One row: the first, last and the nearest to ``target`` of a set of files, as structs."""
    row = F.struct(*columns)
    return df.agg(F.min(F.struct(position.alias("p"), row.alias("r")))["r"].alias("oldest"), F.max(F.struct(position.alias("p"), row.alias("r")))["r"].alias("newest"), F.min(F.struct(F.abs(position - target).alias("d"), row.alias("r")))["r"].alias("middle"))


def key_profile(df: DataFrame, key: str, pattern: str) -> DataFrame:
    """One row: rows, distinct keys, least and greatest key, share and totality of keys that fit a pattern."""
    fits = F.col(key).rlike(pattern)
    return df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("n_claves"), F.min(key).alias("menor"), F.max(key).alias("mayor"),
        F.round(F.avg(fits.cast("double")), 6).alias("cumple"), F.bool_and(fits).alias("todas"),
    )


def version_label(snapshots: DataFrame) -> str:
    """``2024T3`` of the newest quarter; the newest year without one, ``sin_version`` without either."""
    newest = snapshots.where("trimestre IS NOT NULL").orderBy(F.col("anio").desc(), F.col("trimestre").desc()).limit(1).first()
    if newest:
        return f"{newest['anio']}T{newest['trimestre']}"
    year = snapshots.agg(F.max("anio")).first()[0]
    return str(year) if year else "sin_version"
