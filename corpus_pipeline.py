"""A corpus, cleaned and packed: language, quality, near copies, repeated passages, length buckets.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; ``run`` writes each one's result to the
shared checkpoint folder and reads it again, so a lost executor never costs more than one stage. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import langid
from tidemark.llm.common import Scratch
from tidemark.llm.jaccard_join import one_of_each_group
from tidemark.llm.packing import pack
from tidemark.llm.quality import without_rejected
from tidemark.llm.repeats import without_repeats

#: Least calibrated probability of the predicted language.
MIN_LANGUAGE_SCORE = 0.4
#: Bytes of a passage that may occur once only: fifty words of four letters and a space.
REPEATED_BYTES = 250


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those whose language stays in doubt, go.

    Null, empty and letterless texts go. Rows that repeat an id, or have none, are judged each by its own text;
    very long texts are judged whole. Without a single labelled text all documents go, none being in a known
    language. An empty table stays empty, and no other column is looked at.
    """
    return langid.in_known_language(docs, MIN_LANGUAGE_SCORE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go.

    Null and short texts go, as they have fewer words than the rules ask for. Rows that repeat an id, or have
    none, are judged each by its own text, copies alike. A null language is a stratum of its own. An empty
    label table leaves the base rules alone; an empty table stays empty.
    """
    return without_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, a row of the group's least id.

    Texts without words, null ones included, are nobody's copies and all stay. Rows that repeat an id are told
    apart by their texts; of equal rows one stays. A row without an id stays only if its group has no other.
    An empty table stays empty.
    """
    return one_of_each_group(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of REPEATED_BYTES and more that occur more than once are cut from the texts.

    No row goes: a text that is all repeats becomes empty, a null one stays null, shorter ones stay as they
    are. Rows that repeat an id count as documents of their own. An empty table stays empty.
    """
    return without_repeats(docs, REPEATED_BYTES)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches; every row, null and empty texts included, is in one batch."""
    return pack(docs)


STAGES = [
    ("language ID", language),
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("packing", packing),
]

#: SQL cannot express the trained and similarity stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"{k}-{name.replace(' ', '-')}")
    return docs
