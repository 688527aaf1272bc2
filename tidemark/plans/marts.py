"""Marts as tables of the catalogue: bucketed and sorted by the panel's key, with comments, and views of what they are made of.

What compares, versions or follows a key's rows reads its buckets and needs no exchange by the key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.gold import Gold, build_gold

KEY = "cve_cartera"
#: Relations that stay views, and the columns by which the buckets of the others are sorted.
VIEWS = ("stg_snapshots",)
BUCKETED = {
    "int_ppi_observaciones_dedup": (KEY, "snapshot_id"), "int_ppi_observaciones_canonicas": (KEY, "orden_corte"), "dim_ppi": (KEY, "version_ppi"),
    "fct_ppi_observacion": (KEY, "snapshot_id"), "fct_ppi_delta": (KEY, "orden_corte"), "fct_ppi_ciclo_vida": (KEY,),
}


class MissingTables(RuntimeError):
    """Tables that the catalogue lacks, all named together."""


@contextmanager
def bucketed_scans(spark: SparkSession) -> Iterator[None]:
    """Reads buckets as partitions even where no operator asks for it, so what is written keeps to its buckets."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def save_table(df: DataFrame, table: str, path: str, buckets: int = 0, order: Sequence[str] = (), comments: Mapping[str, str] | None = None, about: str = "") -> DataFrame:
    """``df`` as an external table below ``path``, replaced if it exists; with ``buckets``, by the first column of ``order``.

    Rows that are dealt out by that column into as many partitions make one file a bucket; of a frame that is
    not, each task writes a file for each bucket that it has rows of. ``comments`` go to the columns they name.
    """
    spark = df.sparkSession
    for name, text in (comments or {}).items():
        if name in df.columns and text.strip():
            df = df.withMetadata(name, {**df.schema[name].metadata, "comment": " ".join(text.split())})
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    if buckets:
        writer = writer.bucketBy(buckets, order[0]).sortBy(*order)
    with bucketed_scans(spark):
        writer.saveAsTable(table)
    if about:
        quoted = about.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {table} IS '{quoted}'")
    return spark.table(table)


def save_gold(
    spark: SparkSession, silver: DataFrame, manifest: DataFrame, deflator: DataFrame, database: str, path: str, buckets: int | None = None,
    described: Mapping[str, Mapping[str, str]] | None = None, about: Mapping[str, str] | None = None,
) -> Gold:
    """Every relation in the catalogue: inputs and staging as views of the session, all others as tables of ``database``.

    The key's rows are dealt out once, into as many partitions as buckets; every table made from a bucketed
    one is written bucket by bucket, without another exchange.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    silver.createOrReplaceTempView("stg_opa_snapshot")
    deflator.createOrReplaceTempView("stg_deflactor_inpc")

    def kept(df: DataFrame, name: str) -> DataFrame:
        if name in VIEWS:
            df.createOrReplaceTempView(name)
            return spark.table(name)
        order = BUCKETED.get(name, ())
        return save_table(df, f"{database}.{name}", f"{path}/{name}", buckets if order else 0, order, (described or {}).get(name), (about or {}).get(name, ""))

    return build_gold(silver, manifest, deflator, kept, buckets)


def missing_tables(spark: SparkSession, database: str, names: Iterable[str]) -> list[str]:
    """Those of the names that are neither a table of the database nor a view of the session."""
    there = {t.name for t in spark.catalog.listTables(database)} if spark.catalog.databaseExists(database) else set()
    return sorted(set(names) - there)


def read_marts(spark: SparkSession, database: str) -> Gold:
    """The relations that ``save_gold`` made."""
    names = [f.name for f in fields(Gold)]
    if missing := missing_tables(spark, database, names):
        raise MissingTables(f"{database} lacks: {', '.join(missing)}")
    return Gold(*[spark.table(n if n in VIEWS else f"{database}.{n}") for n in names])


def column_comments(spark: SparkSession, table: str) -> dict[str, str]:
    """The comment of each column of a table, empty where it has none."""
    return {c.name: c.description or "" for c in spark.catalog.listColumns(table)}


def dictionary(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """(tabla, columna, tipo, descripcion) of the named tables, read back from the catalogue."""
    rows = [(t.rpartition(".")[2], c.name, c.dataType, c.description or "") for t in tables for c in spark.catalog.listColumns(t)]
    return spark.createDataFrame(rows, "tabla string, columna string, tipo string, descripcion string").orderBy("tabla", "columna")


def comment_drift(spark: SparkSession, database: str, described: Mapping[str, Mapping[str, str]]) -> list[str]:
    """What descriptions and catalogue disagree on: columns without a comment or with another one, and descriptions of no column."""
    out = []
    for name, wanted in sorted(described.items()):
        found = column_comments(spark, f"{database}.{name}")
        out += [f"{name}.{c}: no description" for c in found if not wanted.get(c, "").strip()]
        out += [f"{name}.{c}: described but not there" for c in wanted if c not in found]
        out += [f"{name}.{c}: the catalogue says otherwise" for c, text in wanted.items() if c in found and text.strip() and " ".join(text.split()) != found[c]]
    return out
