"""Optimal length buckets: boundaries by dynamic programming over the global length histogram.

Every document of a bucket is padded to the bucket's boundary, so a batch of a token budget holds a
fixed number of rows and batches can be numbered without any sequential pass over the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import gapless_index

#: Lengths below 2 * FINE are histogram bins of their own; above, each doubling has FINE bins.
FINE = 512


def length_bin(n: Column) -> Column:
    """Bin of a length, increasing with it; at most FINE * 64 bins whatever the corpus."""
    shift = F.greatest(F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int") - F.lit(FINE.bit_length() - 1), F.lit(0))
    return shift.cast("long") * F.lit(FINE) + F.floor(n.cast("double") / F.pow(F.lit(2.0), shift.cast("double"))).cast("long")


def optimal_boundaries(longest: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` runs of bins with the least padding in all.

    ``longest``, ``counts``, ``totals``: per bin, in order, the longest length, the documents and their
    summed length. A run costs documents times its longest length less the summed length. Exact over these
    bins; ties go to fewer buckets, then to the lower boundary.
    """
    n = len(longest)
    if not n:
        return []
    top = longest.astype(np.float64)
    c = np.concatenate([[0.0], np.cumsum(counts, dtype=np.float64)])
    s = np.concatenate([[0.0], np.cumsum(totals, dtype=np.float64)])
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    back: list[np.ndarray] = []
    for _ in range(min(buckets, n)):
        now, frm = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + (c[j] - c[:j]) * top[j - 1] - (s[j] - s[:j])
            frm[j] = int(np.argmin(cost))
            now[j] = cost[frm[j]]
        back.append(frm)
        if len(back) > 1 and now[n] >= best[n]:
            back.pop()
            break
        best = now
    cuts, j = [], n
    for frm in reversed(back):
        cuts.append(int(longest[j - 1]))
        j = int(frm[j])
        if not j:
            break
    return cuts[::-1]


def pack(documents: DataFrame, buckets: int = 16, budget: int = 65536, length: Column | None = None) -> DataFrame:
    """Every document with its length bucket and token-budget batch.

    ``length`` counts a row's tokens; by default the bytes of ``text`` in UTF-8, the tokens of a byte-level
    model. The driver reads one histogram row per non-empty bin, at most FINE * 64 whatever the corpus;
    boundaries are optimal among the longest lengths of these bins. A bucket's batch holds
    ``max(1, budget // boundary)`` rows, so only a text longer than the whole budget exceeds it, alone in
    its batch. Batches follow a hash of the row inside the bucket, so a batch is no run of one source; only
    a bucket's last batch is not full.

    Returned: doc_id, n_tokens, bucket, boundary, slot (gapless in the bucket), batch (gapless in the
    bucket), padding. Null or empty texts have length 0 and share the lowest bucket; repeated rows keep a
    slot each; an empty table gives an empty result; other columns are ignored.
    """
    n = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long") if length is None else length.cast("long")
    rows = documents.select("doc_id", n.alias("n_tokens"), F.xxhash64("doc_id", "text").alias("_h"))
    bins = (
        rows.groupBy(length_bin(F.col("n_tokens")).alias("bin"))
        .agg(F.max("n_tokens").alias("longest"), F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("total"))
        .collect()
    )
    bins.sort(key=lambda r: r["bin"])
    bounds = optimal_boundaries(*(np.array([r[k] for r in bins], np.int64) for k in ("longest", "n", "total")), buckets) or [0]
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    bucket = F.size(F.filter(table, lambda b: b < F.col("n_tokens")))
    placed = rows.withColumn("bucket", bucket).withColumn("boundary", F.get(table, F.col("bucket")))
    # blocks follow the whole row, so one id, or none, on many texts is no hot block
    slots = gapless_index(placed, "bucket", F.col("_h"), [F.col("doc_id").asc_nulls_last(), F.col("n_tokens")], "slot", blocks=4096)
    per_batch = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.col("boundary"), F.lit(1))))
    return slots.select(
        "doc_id", "n_tokens", "bucket", "boundary", "slot",
        F.floor(F.col("slot") / per_batch).cast("long").alias("batch"),
        (F.col("boundary") - F.col("n_tokens")).alias("padding"),
    )
