"""The pipeline's stages: what each keeps and changes, odd rows, and the whole run."""

from __future__ import annotations

import bisect
import collections
import itertools
import random

import pytest

import corpus_pipeline
from tests.llm.test_operators import WORD, labels, none, odd, repeated  # noqa: F401
from tidemark.llm import langid, quality
from tidemark.llm.components import local_roots
from tidemark.llm.packing import pack


@pytest.fixture(scope="module")
def labelled_dir(tmp_path_factory, spark, odd, labels):  # noqa: F811
    d = tmp_path_factory.mktemp("sf")
    odd.write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    return str(d)


def test_stages_keep_columns_and_take_odd_and_empty_tables(spark, odd, none, labelled_dir):  # noqa: F811
    for frame in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, labelled_dir)
            assert out.columns == frame.columns
            assert out.count() <= frame.count()


def test_language_stage_drops_letterless_texts(spark, odd, labelled_dir):  # noqa: F811
    ids = {r["doc_id"] for r in corpus_pipeline.language(spark, odd, labelled_dir).collect()}
    assert not ids & {4, 5, 6} and {1, 2, 3} <= ids


def test_quality_stage_drops_short_and_repetitive_texts(spark, odd, labelled_dir):  # noqa: F811
    ids = collections.Counter(r["doc_id"] for r in corpus_pipeline.quality(spark, odd, labelled_dir).collect())
    assert not {7, 9, 10, 12} & set(ids) and ids[2] == 2 and ids[13] == 1


def shingles(text: str) -> frozenset:
    w = WORD.findall(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def one_of_each(docs: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The documents of least id of the groups that Jaccard similarities of 0.8 make, by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    left, right = [], []
    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if 5 * common >= 4 * (len(x) + len(sets[j]) - common) > 0:
                left.append(j)
                right.append(i)
    return [d for i, (d, r) in enumerate(zip(docs, local_roots(len(docs), left, right), strict=True)) if i == r]


def least_padding(lengths: list[int], buckets: int) -> int:
    """The least padding of at most so many length buckets, by trying every boundary."""
    sizes = sorted(lengths)
    values = sorted(set(sizes))
    upto = [bisect.bisect_right(sizes, v) for v in values]
    total = [0, *itertools.accumulate(sizes)]
    best = [v * n - total[n] for v, n in zip(values, upto, strict=True)]
    for _ in range(buckets - 1):
        best = [min([v * n - total[n], *(best[i] + v * (n - upto[i]) - (total[n] - total[upto[i]]) for i in range(j))]) for j, (v, n) in enumerate(zip(values, upto, strict=True))]
    return best[-1]


def test_run_equals_brute_force(spark):
    """The whole pipeline against row-by-row code, stage by stage, on the smallest tables."""
    d = "/root/testdata/sf0.001"
    docs, marks = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = langid.train(docs)
    kept = []
    for r in sorted(docs.select("doc_id", "text").collect()):
        lang, score = model.predict(r["text"])
        if lang != langid.UNDETERMINED and score >= corpus_pipeline.MIN_LANGUAGE_SCORE:
            kept.append((r["doc_id"], r["text"]))
    # so few labels certify no cutoff: only the base rules are left
    known = spark.createDataFrame(kept, "doc_id LONG, text STRING").join(docs.select("doc_id", "lang"), "doc_id")
    judged = quality.quality_rules(known, marks)
    assert judged.where("NOT kept AND NOT base_failed").count() == 0
    kept = [(i, t) for i, t in kept if len(w := WORD.findall(t)) >= 20 and 100 * repeated(w) <= 30 * len(w)]
    kept = one_of_each(kept)
    width = corpus_pipeline.REPEATED_BYTES
    count = collections.Counter(b[i : i + width] for _, t in kept for b in [t.encode()] for i in range(len(b) - width + 1))
    want = {}
    for i, t in kept:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if count[b[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        want[i] = len(bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore").encode())
    got = corpus_pipeline.run(spark, d).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and len(got) == len(want)
    lengths = list(want.values())
    bounds = sorted({r["boundary"] for r in got})
    assert all(r["boundary"] == next(b for b in bounds if b >= r["n_tokens"]) for r in got)
    least, padding = least_padding(lengths, 16), sum(r["padding"] for r in got)
    # bins are exact below 1024 and coarse above, where a bin's lengths differ by less than one in 512
    assert least <= padding <= least + sum(n for n in lengths if n >= 1024) / 512


def test_packing_is_optimal_where_bins_are_exact(spark):
    rng = random.Random(3)
    lengths = [rng.choice((rng.randrange(40), rng.randrange(300, 320), rng.randrange(1000))) for _ in range(400)]
    df = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(lengths)], "doc_id LONG, text STRING")
    for buckets in (1, 3, 8):
        assert sum(r["padding"] for r in pack(df, buckets).collect()) == least_padding(lengths, buckets)


def test_run_takes_odd_tables(spark, labelled_dir):
    assert corpus_pipeline.run(spark, labelled_dir).columns[0] == "doc_id"
