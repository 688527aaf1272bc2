"""New snapshot files as a stream: each micro-batch is cleaned, judged and appended once.

An addition to the batch flow for sources that deliver files continuously; same columns, same contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.contract import judge, snapshot_rules, split
from tidemark.sources.files import MANIFEST


def stream_snapshots(spark: SparkSession, folder: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """CSV files as they arrive, all text, with the file's name in ``_file``."""
    rows = spark.readStream.schema(schema).option("header", True).option("sep", separator).option("multiLine", True).option("escape", '"').csv(folder)
    return rows.withColumn("_file", F.col("_metadata.file_name"))


def append_once(valid_path: str, quarantine_path: str, clean: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch writer whose output folders carry the batch number, so a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        valid, quarantine = split(judge(clean(batch), snapshot_rules()))
        valid.write.mode("overwrite").parquet(f"{valid_path}/batch={number}")
        quarantine.write.mode("overwrite").parquet(f"{quarantine_path}/batch={number}")

    return write


def start(stream: DataFrame, clean: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Processes everything available, then stops; run again, it takes up where it left."""
    writer = append_once(f"{out}/valid", f"{out}/quarantine", clean)
    return stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_records(records: DataFrame) -> DataFrame:
    """Manifest records as they arrive, of each (url, anio, trimestre) the first alone, nulls being equal.

    The keys seen are the query's state, kept in its checkpoint: a restarted query knows them, and a record
    that comes again, in whatever file, is dropped. The state grows by a key for each snapshot of a source.
    """
    cut = {"_anio": F.col("corte_declarado.anio"), "_trimestre": F.col("corte_declarado.trimestre")}
    return records.withColumns(cut).dropDuplicates(["url", *cut]).drop(*cut)


def start_records(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the records of the JSON-lines files that have come to ``folder``, each snapshot once, then stops."""
    records = first_records(spark.readStream.schema(MANIFEST).json(folder))
    return records.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
