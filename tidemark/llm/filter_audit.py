"""Filter interaction audit: what five filters remove, alone and together, in each of their 120 orders.

A document's outcome under every order depends on one number alone, the mask of the filters it fails. So the
documents are counted once, by part and mask; each part's histogram of 32 masks, and those of its good and
its toxic documents, are rows of an incidence matrix, and its products with integer 32 x 600 matrices (120
orders of five steps) are the counts of the report. No order is ever run over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, small_batches, word_array

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
#: Least words; least distinct words and most capitals, in hundredths; characters that fail a text.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, r"[#$%&*|]"
#: Parts whose rows are made together: 600 rows each.
PARTS_A_BATCH = 50

ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: The filter of each column of the matrices, and its bit.
STEP_FILTER = np.array([FILTERS.index(f) for order in ORDERS for f in order])
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = "part STRING, filter_order STRING, step INT, " + ", ".join(f"{c} LONG" for c in COUNTS)


def outcome_matrices() -> dict[str, np.ndarray]:
    """32 x 600 matrices of 0 and 1: what becomes of a mask at each step of each order."""
    masks = np.arange(MASKS)[:, None]
    own = (1 << STEP_FILTER)[None, :]
    before = np.array([sum(1 << FILTERS.index(f) for f in order[:k]) for order in ORDERS for k in range(len(FILTERS))])[None, :]
    gone, fails = masks & before != 0, masks & own != 0
    found = {"kept": ~gone & ~fails, "removed": ~gone & fails, "redundant": gone & fails, "unique_fails": np.broadcast_to(masks == own, gone.shape)}
    return {name: m.astype(np.int64) for name, m in found.items()}


def text_failures(text: Column) -> Column:
    """The mask of the four filters that look at a text alone, bit 0 for A; a null text is empty."""
    text = F.coalesce(text, F.lit(""))

    def mask(words: Column) -> Column:
        n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
        return (n < LEAST_WORDS).cast("int") + F.when(100 * distinct < LEAST_DISTINCT * n, 2).otherwise(0)

    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return let(word_array(text), mask) + F.when(100 * capitals > MOST_CAPITALS * F.char_length(text), 4).otherwise(0) + F.when(text.rlike(SYMBOLS), 8).otherwise(0)


def mask_histogram(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters they fail, and how many are labelled so.

    Texts are compared by their SHA-256. Rows that agree in text, id and part are counted before anything is
    joined; the least id of a text comes from an aggregate, and a row is told from a copy by (text, id), so
    neither copies of one text nor rows without an id meet in one task.
    """
    rows = docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("doc_id"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"), text_failures(F.col("text")).alias("mask"),
    ).groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("_least")).where("_least IS NOT NULL").select(F.col("digest").alias("_digest"), "_least")
    marks = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("_good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("_toxic"))
        .where("_good OR _toxic")
        .withColumn("_spread", F.lit(0))
    )
    # rows without an id match no label; a hash of their text keeps them from meeting in one task
    spread = rows.withColumn("_s", F.when(F.col("doc_id").isNull(), F.hash("digest")).otherwise(0))
    marked = spread.join(marks, (F.col("doc_id") == F.col("_id")) & (F.col("_s") == F.col("_spread")), "left")
    joined = marked.join(first, (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_least")), "left")
    copy = F.col("doc_id").isNotNull() & F.col("_least").isNull()
    return (
        joined.groupBy("part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))
        .agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(f"_{c}"), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])
    )


def _products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    outcome = outcome_matrices()
    same = (STEP_FILTER[:, None] == np.arange(len(FILTERS))[None, :]).astype(np.int64)
    orders, steps = np.repeat(ORDERS, len(FILTERS)), np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
    for pdf in batches:
        for a in range(0, len(pdf), PARTS_A_BATCH):
            own = pdf.iloc[a : a + PARTS_A_BATCH]
            # rows of the incidence matrix: all, good and toxic documents of each part
            stack = np.zeros((3, len(own), MASKS), np.int64)
            for i, cells in enumerate(own["cells"]):
                for cell in cells:
                    stack[:, i, cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
            everyone, good, toxic = stack
            counts = {name: everyone @ m for name, m in outcome.items()}
            counts |= {"good_lost": good @ outcome["removed"], "toxic_lost": toxic @ outcome["removed"]}
            counts["shapley"] = (counts["removed"] @ same)[:, STEP_FILTER]
            shape = {"part": np.repeat(own["part"].to_numpy(), len(STEP_FILTER)), "filter_order": np.tile(orders, len(own)), "step": np.tile(steps, len(own))}
            yield pd.DataFrame(shape | {c: counts[c].ravel() for c in COUNTS})


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (the source), order of the five filters and step: what is kept, removed and lost there.

    A: under 200 words; B: under half of the words distinct; C: more than 2 % capitals; D: a symbol; E: the
    text of a document with a smaller id, in any part. ``shapley`` is the filter's removed documents summed
    over all orders. Null texts are empty; a null source is the empty part. A row without an id is no copy and
    has no label; it can't be the smaller id either. Rows that repeat id and text are each counted, none of
    them a copy of the other. A document counts as good or toxic if any of its label rows says so. Parts
    without failures have their zeros; an empty table gives no rows, an empty label table no losses. Other
    columns are not looked at.
    """
    small_batches(docs.sparkSession)
    cells = F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")  # 32 at most
    return mask_histogram(docs, labels).groupBy("part").agg(cells).mapInPandas(_products, AUDIT)
