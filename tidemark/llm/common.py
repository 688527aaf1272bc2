"""What several operators share: scratch tables, gapless numbering, group streaming, byte hashing."""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.session import checkpoint_root

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


#: Files for each core of a scratch table of narrow rows, and rows of an Arrow batch, whose texts may be long.
FILES_A_CORE, BATCH_ROWS = 8, 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the rows of the session's Arrow batches: a worker holds a batch of texts several times over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


class Scratch:
    """Parquet tables in the shared checkpoint folder, used to cut lineage.

    A lost executor costs a re-read, never a recomputation of what came before. ``drop`` frees a table
    whose readers are done; what is left goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        small_batches(spark)
        self.spark, self.root = spark, f"{checkpoint_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
        atexit.register(self._sweep)

    def table(self, df: DataFrame, name: str, few: bool = False) -> DataFrame:
        """``df``, written and read again; with ``few``, for narrow rows, into a few files for each core."""
        path = f"{self.root}/{name}"
        if few:
            df = df.coalesce(max(FILES_A_CORE * self.spark.sparkContext.defaultParallelism, 32))
        df.write.parquet(path)
        # a written column is nullable, whatever the frame said
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
            path.getFileSystem(conf).delete(path, True)
        # shuffle files go once the driver has collected the plans that made them
        gc.collect()
        jvm.System.gc()

    def _sweep(self) -> None:
        try:
            self.drop("")
        except Exception:  # the session is gone already; the folder's owner purges it
            pass


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once: a lambda that names it would evaluate it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null gives an empty array."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[ \t-\r]+|[ \t-\r]+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))


#: Digests up to which a filter is made, 16 bits for each: 64 MB at most to broadcast.
FILTERED = 1 << 24


def members(table: DataFrame, key: str) -> tuple[DataFrame, int] | None:
    """A filter of the values of a binary column: bitmaps by bucket, and its size in bits.

    None where ``table``, counted here, has too many rows; then nothing is filtered out, and a join that
    follows gives the same rows.
    """
    n = table.count()
    if n > FILTERED:
        return None
    bits = max(1 << 15, 1 << (16 * n).bit_length())
    at = F.pmod(F.xxhash64(key, F.lit(3)), F.lit(bits))
    marks = table.select(F.shiftright(at, 15).cast("int").alias("_bucket"), (at.bitwiseAND(F.lit(32767))).alias("_bit"))
    return marks.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_marks")), bits


def holds(rows: DataFrame, key: str, found: tuple[DataFrame, int] | None) -> DataFrame:
    """``rows`` with ``_held``: false where ``key`` is null or surely not among the filter's values."""
    if found is None:
        return rows.withColumn("_held", F.col(key).isNotNull())
    marks, bits = found
    at = F.pmod(F.xxhash64(key, F.lit(3)), F.lit(bits))
    placed = rows.withColumn("_at", F.when(F.col(key).isNotNull(), at)).withColumn("_b", F.shiftright("_at", 15).cast("int"))
    joined = placed.join(F.broadcast(marks), F.col("_b") == F.col("_bucket"), "left")
    byte = F.conv(F.hex(F.expr("substring(_marks, cast(shiftright(_at & 32767, 3) AS int) + 1, 1)")), 16, 10).cast("int")
    joined = joined.withColumn("_byte", F.when(F.col("_marks").isNotNull(), byte).otherwise(F.lit(0)))
    return joined.withColumn("_held", F.coalesce(F.expr("shiftright(_byte, cast(_at & 7 AS int)) & 1") == 1, F.lit(False))).drop("_at", "_b", "_bucket", "_marks", "_byte")


def gapless_index(df: DataFrame, group: str, digest: Column, order: list[Column], out: str, blocks: int = 1024) -> DataFrame:
    """``out``: 0, 1, 2, ... inside each value of ``group``, without one task per group.

    Rows are ranked inside (group, block), a block being ``digest``, a hash as a long, modulo ``blocks``; a running sum over the at most
    ``groups x blocks`` block counts gives each block its offset. That table is bounded by those two
    parameters, so it is broadcast; nothing else moves but the rows of one block.
    """
    df = df.withColumn("_block", F.pmod(digest, F.lit(blocks)).cast("int"))
    offsets = (
        df.groupBy(group, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.sum("_n").over(Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)))
        .select(F.col(group).alias("_g"), F.col("_block").alias("_b"), F.coalesce("_offset", F.lit(0)).cast("long").alias("_offset"))
    )
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(group, "_block").orderBy(*order)).cast("long") - 1)
    joined = ranked.join(F.broadcast(offsets), (F.col(group) == F.col("_g")) & (F.col("_block") == F.col("_b")))
    return joined.withColumn(out, F.col("_rank") + F.col("_offset")).drop("_g", "_b", "_block", "_rank", "_offset")


def stream_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of equal ``keys`` in sorted batches, each as one frame, whatever the batch borders."""
    held: list[pd.DataFrame] = []
    last: tuple | None = None
    for pdf in batches:
        if not len(pdf):
            continue
        cols = [pdf[k].to_numpy() for k in keys]
        change = np.zeros(len(pdf), bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), len(pdf)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in cols)
            if key != last and held:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(pdf.iloc[a:b])
            last = key
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


# --- byte hashing -----------------------------------------------------------------------------------

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64's multipliers
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, in place on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 1024), _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS[:n]


_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in BLANKS]] = True


def word_hashes(data: bytes, separator: np.ndarray = _BLANK, prefixes: tuple[int, ...] = ()) -> np.ndarray:
    """64-bit hash of each maximal run of non-separator bytes, in order.

    With ``prefixes``, one more column for each: the hash of the word's first so many bytes, 0 for a word
    that does not go on beyond them.
    """
    b = np.frombuffer(data, np.uint8)
    sep = separator[b]
    inside = np.flatnonzero(~sep)
    if not len(inside):
        return np.empty((0, 1 + len(prefixes)) if prefixes else 0, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], inside[1:] != inside[:-1] + 1]))
    lengths = np.diff(first, append=len(inside))
    offset = np.arange(len(inside)) - np.repeat(first, lengths)
    values = (b[inside].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()) + 1)[offset]
    whole = mix64(np.add.reduceat(values, first) + lengths.astype(np.uint64))
    if not prefixes:
        return whole
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    columns = [whole]
    for k in prefixes:
        longer = lengths > k
        own = total[np.where(longer, first + k, first)] - total[first]
        columns.append(np.where(longer, mix64(own ^ np.uint64(k << 56)), np.uint64(0)))
    return np.stack(columns, axis=1)


def bounded_batches(pdf: pd.DataFrame, column: str, most: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Slices of a batch whose texts hold about ``most`` characters; one long text is its own slice."""
    size = pdf[column].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy(np.int64)
    group = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(pdf)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield pdf.iloc[a:b]


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of an id's decimal text modulo ``divisor``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor)).cast("int")


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """Up to ``most`` rows, chosen by a hash of ``key``; all of them if there are no more.

    Only for fitting a model: one narrow count, then a filter, so no task and no shuffle sees more. The
    filter aims a tenth below the bound, so the same rows come every time; the limit is for keys that
    many rows share.
    """
    n = rows.count()
    if n > most:
        cut = int(0.9 * most / n * (1 << 30))
        rows = rows.where(F.pmod(F.xxhash64(F.col(key), F.lit(77)), F.lit(1 << 30)) < cut)
    return rows.limit(most)
