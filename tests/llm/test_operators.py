"""Each operator against brute force, and its defined results for odd input."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, embedding_dedup, html_text, jaccard_join, langid, packing, quality, repeats, sharding, suffix_sort, toxicity
from tidemark.llm.components import connected_components, local_roots
from tidemark.llm.common import Scratch, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score STRING, shard STRING, kept STRING, cid STRING, stratum STRING, node STRING, digest STRING"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(4)
    base = words(rng, 300)
    near = base[:]
    near[150] = "changed"
    long = " ".join(words(rng, 60_000))
    texts = [
        (1, " ".join(base), "en"), (2, " ".join(base), "en"), (2, " ".join(base), "en"), (3, " ".join(near), None), (4, None, "en"), (5, "", "de"), (6, " \t\n", None),
        (None, "one two three", "en"), (7, "one two three", None), (8, long, "en"), (9, "x" * 30_000, "fr"), (10, "ab " * 9000, "es"), (None, None, None),
        (11, "line\nline\nline\n" + " ".join(words(rng, 40)), "en"), (12, "\U0001f600 ñandú   naïve", "es"), (13, " ".join(words(rng, 100)), "de"),
    ]
    rows = [(i, t, lang, None, None, "s", "s", None, "c", "x", "n", "d") for i, t, lang in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(1, 14)] + [(None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id LONG, quality INT, toxic INT")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# --- sharding -----------------------------------------------------------------------------------------


def jump(key: int, n: int) -> int:
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_sharding_follows_jump_hash(odd, shards):
    got = sharding.shard_documents(odd, shards).collect()
    assert len(got) == odd.count()
    for r in got:
        key = int(hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:16], 16)
        assert (r["shard"], r["grown_shard"]) == (jump(key, shards), jump(key, shards + 1))
        assert r["grown_shard"] in (r["shard"], shards)
    for _, own in itertools.groupby(sorted(got, key=lambda r: (r["shard"], r["slot"])), key=lambda r: r["shard"]):
        assert [r["slot"] for r in own] == list(range(len([r for r in got if r["shard"] == _])))


def test_sharding_sizes_and_crc(odd):
    texts = collections.Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in odd.collect())
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.shard_documents(odd).collect()) == texts


def test_sharding_rejects_no_shards(odd):
    with pytest.raises(ValueError):
        sharding.shard_documents(odd, 0)


# --- quality ------------------------------------------------------------------------------------------


def repeated(w: list[str]) -> int:
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    return len({j for own in at.values() if len(own) > 1 for i in own for j in range(i, i + 8)})


def test_quality_counts(odd, labels):
    texts = collections.defaultdict(list)
    for r in odd.collect():
        texts[r["doc_id"]].append(r["text"] or "")
    got = quality.quality_rules(odd, labels).collect()
    assert len(got) == odd.count()
    for r in got:
        own = [(len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), repeated(w)) for t in texts[r["doc_id"]] for w in [WORD.findall(t)]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_repeat_words"]) in own
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert {r["doc_id"]: r["n_dup_lines"] for r in got}[11] == 2


@pytest.mark.parametrize("seed", range(3))
def test_repeated_words_of_random_texts(spark, seed):
    rng = random.Random(seed)
    texts = [[rng.choice("ab") for _ in range(rng.randint(0, 60))] for _ in range(60)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id LONG, text STRING")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.measures(df, "doc_id").collect()}
    assert got == {i: repeated(t) for i, t in enumerate(texts)}


def test_binomial_tail_is_exact(spark):
    from math import comb

    cases = [(k, n) for n in (10, 100, 500) for k in (0, 1, 3, 5)]
    df = spark.createDataFrame(cases, "k LONG, n LONG")
    for r in df.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).collect():
        exact = sum(comb(r["n"], i) * 0.02**i * 0.98 ** (r["n"] - i) for i in range(r["k"] + 1)) if r["k"] < r["n"] * 0.02 else 1.0
        assert r["p"] == pytest.approx(exact, rel=1e-9)


def test_cutoffs_reject_bad_and_keep_good(spark):
    rng = random.Random(1)
    docs, marks = [], []
    for i in range(2000):
        bad = i % 4 == 0
        text = " ".join(w + ("$$$" if bad else "") for w in words(rng, 40))
        docs.append((i, text, "en"))
        marks.append((i, 0 if bad else 1))
    got = quality.quality_rules(spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING"), spark.createDataFrame(marks, "doc_id LONG, quality INT"))
    assert {r["doc_id"] for r in got.where("kept").collect()} == {i for i, q in marks if q}
    few = spark.createDataFrame(marks[:100], "doc_id LONG, quality INT")  # too few to prove anything
    assert quality.quality_rules(spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING"), few).where("not kept").count() == 0


def test_a_stratum_s_rejections_stay_within_the_risk(spark):
    """Cutoffs of all measures together, judged on the half of the labels that chose none."""
    rng = random.Random(17)
    docs, marks = [], []
    for i in range(6000):
        good = i % 3 > 0
        w = words(rng, 40)
        if not good or rng.random() < 0.003:  # a few good texts look bad, each in one way
            kind = rng.randrange(3) if good else 0
            w = [x + "##" for x in w] if kind == 0 else [x.upper() for x in w] if kind == 1 else [x * 5 for x in w]
        docs.append((i, " ".join(w), ("en", "de")[i % 2]))
        marks.append((i, int(good)))
    df = spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING")
    labelled = spark.createDataFrame(marks, "doc_id LONG, quality INT")
    judged = quality.quality_rules(df.withColumn("stratum2", F.col("lang")), labelled, carry=("lang",)).withColumnRenamed("lang", "stratum")
    found = quality.audit_rejections(judged, labelled).collect()
    assert {r["stratum"] for r in found} == {"en", "de"}
    for r in found:
        assert r["n_good"] > 500 and r["good_out"] <= quality.RISK * r["n_good"] and r["p_value"] > quality.DELTA
    bad = judged.join(labelled.where("quality = 0"), "doc_id")
    assert bad.where("NOT kept").count() > 0.9 * bad.count()
    spoiled = quality.audit_rejections(judged.withColumn("kept", F.lit(False)), labelled).collect()
    assert all(r["p_value"] < 1e-6 for r in spoiled)


# --- packing ------------------------------------------------------------------------------------------


def test_boundaries_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(40):
        size = np.unique(rng.integers(1, 60, 8))
        n = rng.integers(1, 9, len(size))
        for k in (1, 2, 3, 9):
            cost = lambda b: sum((b[np.searchsorted(b, x)] - x) * c for x, c in zip(size, n, strict=True))  # noqa: B023, E731
            best = min(cost(sorted({*x, size[-1]})) for r in range(min(k, len(size))) for x in itertools.combinations(size, r))
            got = packing.optimal_boundaries(size, n, size * n, k)
            assert cost(got) == best and len(got) <= k


def test_packing_holds_every_row_within_budget(odd):
    got = packing.pack(odd, buckets=4, budget=10_000).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r["doc_id"] for r in odd.collect())
    batches = collections.defaultdict(list)
    for r in got:
        assert r["padding"] == r["boundary"] - r["n_tokens"] >= 0
        batches[r["bucket"], r["batch"]].append(r)
    for own in batches.values():
        assert len(own) == 1 or len(own) * own[0]["boundary"] <= 10_000
    for b in {r["bucket"] for r in got}:
        assert sorted(r["slot"] for r in got if r["bucket"] == b) == list(range(sum(r["bucket"] == b for r in got)))
        assert sorted({r["batch"] for r in got if r["bucket"] == b}) == list(range(len({r["batch"] for r in got if r["bucket"] == b})))


# --- near-duplicates ----------------------------------------------------------------------------------


def shingles(text: str | None) -> frozenset:
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)) if w)


def brute_join(rows: list[tuple]) -> list[tuple]:
    """(doc_id, class_id, n_links) of each row."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    link = [[j for j in range(n) if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(ids) if ids else None, len(link[i])))
    return sorted(out, key=str)


def test_join_of_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.jaccard_join(odd).collect()), key=str)
    assert got == brute_join(rows)


@pytest.mark.parametrize("node,block", [(1024, 512), (8, 6)])
def test_join_of_groups_with_small_and_large_blocks(spark, monkeypatch, node, block):
    monkeypatch.setattr(jaccard_join, "NODE", node)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(9)
    rows, at = [], 0
    for size in (1, 2, 5, 30):
        base = words(rng, 120)
        for _ in range(size):
            own = base[:]
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(["zz", "yy", "xx"])
            rows.append((at, " ".join(own)))
            at += 1
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(4)
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.jaccard_join(df).collect()), key=str)
    assert got == brute_join(rows)


def test_a_node_dealt_out_as_pairs_of_blocks_gives_the_same_components():
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64)) for _ in range(3)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) > 0.03], rng.integers(0, 1 << 63, 3, dtype=np.uint64)])) for b in base for _ in range(12)]
    sig = jaccard_join.signatures(sets)
    low = ((sig * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    labels_ = np.zeros((len(sets), 32), np.uint8)  # one node: all share the whole label
    want = [12 * (i // 12) for i in range(36)]
    assert jaccard_join.node_links(labels_, low).tolist() == want
    block, left, right = rng.integers(0, 4, len(sets)), [], []
    for i, j in itertools.combinations_with_replacement(range(4), 2):
        own = np.flatnonzero((block == i) | (block == j))
        side = None if i == j else np.where(block[own] == i, 1, 2)
        got = jaccard_join.node_links(labels_[own], low[own], side)
        left, right = [*left, *own], [*right, *own[got]]
    assert local_roots(len(sets), left, right) == want


def crowd(m: int, copies: list[tuple[int, int, int]]) -> np.ndarray:
    """Hash bytes of m unlike members; (a, b, n) makes b agree with a in n of 128."""
    low = np.random.default_rng(6).integers(0, 256, (m, 128)).astype(np.uint8)
    for a, b, n in copies:
        low[b] = np.where(np.arange(128) < n, low[a], low[a] + 1)
    return low


def test_every_pair_of_a_large_node_is_compared():
    low = crowd(3000, [(700, 2900, 100), (2900, 5, 100), (10, 11, 80), (20, 2000, 79)])
    low[100:300] = low[100]  # copies, and one that resembles only the last of them
    low[299, :28] += 1
    low[2500] = np.where(np.arange(128) < 90, low[299], low[100] + 2)
    want = np.arange(3000)
    want[[700, 2900]], want[11], want[100:300], want[2500] = 5, 10, 100, 100
    assert (low[2500] == low[100]).sum() < 80 and jaccard_join.node_components(low).tolist() == want.tolist()
    side = 1 + np.arange(3000) % 2
    got = jaccard_join.node_components(low, side)
    assert got[2900] == got[5] == got[700] == 5 and got[2500] == got[299] == 100 and got[2000] == 2000


def test_a_near_copy_does_not_end_the_search_for_others():
    low = crowd(4, [(0, 1, 126), (0, 2, 101), (2, 3, 126)])
    labels_ = np.zeros((4, 32), np.uint8)
    labels_[2:, 24:] = 1  # each pair shares a whole label, all four the prefix of the last level
    assert jaccard_join.LEVELS == (8, 7, 6)
    assert jaccard_join.node_links(labels_, low).tolist() == [0, 0, 0, 0]
    labels_[2:, 20:] = 1  # or only the shortest one, which none of them is searched with any more
    assert jaccard_join.node_links(labels_, low).tolist() == [0, 0, 2, 2]
    assert jaccard_join.node_links(labels_, low, levels=(jaccard_join.SHORTEST,)).tolist() == [0, 0, 0, 0]


def test_levels_shorten_until_the_target_recall():
    found = lambda d: 1 - (1 - 0.8**d) ** jaccard_join.TREES
    assert found(jaccard_join.LEVELS[-1]) >= jaccard_join.TARGET > found(jaccard_join.LEVELS[-1] + 1)


def test_levels_in_turn_give_what_the_last_one_gives():
    rng = np.random.default_rng(8)
    for _ in range(20):
        m = 60
        low = crowd(m, [(int(a), int(b), int(n)) for a, b, n in zip(rng.integers(0, m, 40), rng.integers(0, m, 40), rng.integers(60, 128, 40), strict=True) if a != b])
        labels_ = np.zeros((m, 32), np.uint8)
        labels_[:, 24:] = rng.integers(0, 2, (m, 8))
        labels_ = labels_[np.lexsort(labels_.T[::-1])]
        assert jaccard_join.node_links(labels_, low).tolist() == jaccard_join.node_components(low).tolist()


def test_only_open_members_ask():
    low = crowd(200, [(3, 150, 100), (4, 151, 100), (5, 152, 100)])
    open_ = np.zeros(200, bool)
    open_[[3, 151]] = True
    got = jaccard_join.node_components(low, open_=open_)
    assert got[150] == 3 and got[151] == 4 and got[152] == 152


@pytest.mark.parametrize("m", [70, 800])
@pytest.mark.parametrize("levels,shared", [((5,), 20), ((8, 7, 6), 24)])
def test_members_of_a_hot_node_meet_whatever_their_children(spark, monkeypatch, m, levels, shared):
    monkeypatch.setattr(jaccard_join, "NODE", 16)
    rng = np.random.default_rng(7)
    pairs = [(i, m - 1 - i, 100) for i in range(1, 9)]
    low = crowd(m, pairs)
    label = rng.integers(0, 256, (m, 16, 32)).astype(np.uint8)
    label[:, 0, :shared] = 7  # one node in one trie, children all different
    rows = [(b"%016d" % i, low[i].tobytes(), label[i].tobytes(), i < m // 2) for i in range(m)]
    edges = jaccard_join._candidates(spark.createDataFrame(rows, "cid binary, low binary, label binary, open boolean"), Scratch(spark, "hot"), levels, "hot")
    assert {tuple(sorted((int(r["a"]), int(r["b"])))) for r in edges.collect()} == {(a, b) for a, b, _ in pairs}


def test_the_forest_finds_pairs_at_the_threshold(spark):
    """Pairs of similarity 0.80 to 0.83 without any other partner: at least the target recall of them is found."""
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(700):
        common = np.unique(rng.integers(0, 1 << 63, 330, dtype=np.uint64))
        own = int(len(common) * rng.uniform(0.1, 0.125))
        sets += [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, own, dtype=np.uint64)])) for _ in range(2)]
    sig = jaccard_join.signatures(sets)
    low = ((sig * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    rows = [(b"%016d" % i, low[i].tobytes(), sig[i].astype(">u4").tobytes()) for i in range(len(sets))]
    edges = jaccard_join._forest(spark.createDataFrame(rows, "cid binary, low binary, label binary").repartition(4), Scratch(spark, "forest"))
    found = {tuple(sorted((int(r["a"]), int(r["b"])))) for r in edges.collect()}
    assert sum((2 * i, 2 * i + 1) in found for i in range(700)) >= 0.99 * 700


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    for share in (0.5, 0.8, 0.95):
        k = int(len(base) * 2 * share / (1 + share))
        a, b = base, np.concatenate([base[:k], rng.integers(0, 1 << 63, len(base) - k, dtype=np.uint64)])
        s = jaccard_join.signatures([a, np.unique(b)])
        assert abs((s[0] == s[1]).mean() - share) < 0.15


def test_one_of_each_group(odd):
    kept = collections.Counter(r["doc_id"] for r in jaccard_join.one_of_each_group(odd).collect())
    assert kept[1] == 1 and kept[2] == 0 and kept[3] == 0 and kept[7] == 1 and kept[8] == 1


def test_one_of_each_group_judges_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(12)
    a, b, c, d, e = (" ".join(words(rng, 80)) for _ in range(5))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, d), (None, d + " more"), (None, e), (None, None), (None, None), (4, " "), (4, ""), (5, e + " end")]
    got = rows_of(jaccard_join.one_of_each_group(spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)))
    nameless = [t for i, t in got if i is None and t is not None]
    assert nameless in ([d], [d + " more"])
    want = [(1, a), (2, b), (3, c), (None, nameless[0]), (None, None), (None, None), (4, " "), (4, ""), (5, e + " end")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_verified_links_equal_set_arithmetic():
    rng = np.random.default_rng(2)
    for _ in range(30):
        base = np.unique(rng.integers(0, 1000, 60).astype(np.uint64))
        sets = [np.unique(np.concatenate([base[rng.random(len(base)) > 0.1], rng.integers(0, 1000, 4).astype(np.uint64)])) for _ in range(6)]
        got = jaccard_join.verified_links(sets, np.arange(6), np.arange(6))
        for i, j in itertools.product(range(6), repeat=2):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            assert got[i, j] == (5 * len(a & b) >= 4 * len(a | b))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(30)] + [(5, None)]
    got = dict(rows_of(connected_components(spark.createDataFrame(edges, "x INT, y INT"), Scratch(spark, "t"), "c")))
    parent = {}

    def find(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for a, b in edges:
        if b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    want = {v: find(v) for v in parent if any(find(v) == find(u) for u in parent if u != v)}
    assert got == want


def test_components_of_hubs(spark, tmp_path):
    """Stars whose centres have far more edges than a task should join, and chains through them."""
    rng = random.Random(6)
    edges = [(0, i) for i in range(1, 1500)] + [(5000, i) for i in range(4000, 4900)] + [(1499, 4000), (9000, 9001)] + [(i, i + 1) for i in range(9100, 9140)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a LONG, b LONG"), Scratch(spark, "hubs"), "hubs").collect()}
    assert {got[i] for i in [*range(1500), *range(4000, 4900), 5000]} == {0}
    assert got[9001] == 9000 and {got[i] for i in range(9100, 9141)} == {9100}


@pytest.mark.parametrize("hub", [False, True])
def test_components_come_from_small_plans(spark, monkeypatch, hub):
    """The driver holds a plan's exchanges and broadcasts at once, so no plan may hold a whole round's."""
    plans, write = [], Scratch.table

    def table(self, df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, *args, **kwargs)

    monkeypatch.setattr(Scratch, "table", table)
    edges = [(i, i + 1) for i in range(40) if i % 8] + [(100, i) for i in range(101, 500 if hub else 120)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a LONG, b LONG"), Scratch(spark, "plans"), "plans").collect()}
    nodes = sorted({v for e in edges for v in e})
    at = {v: i for i, v in enumerate(nodes)}
    assert got == {v: nodes[r] for v, r in zip(nodes, local_roots(len(nodes), [at[a] for a, _ in edges], [at[b] for _, b in edges]), strict=True)}
    # BroadcastExchange counts as an exchange too
    assert max(p.count("Exchange ") for p in plans) <= 8 and max(p.count("BroadcastExchange ") for p in plans) <= 3


# --- repeated passages --------------------------------------------------------------------------------


def digests(result) -> list[tuple]:
    """The contract's columns, after a look at the text that is left."""
    rows = result.collect()
    assert all(hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"] for r in rows if r["text"].isascii())
    return sorted([tuple(r)[:5] for r in rows], key=str)


def brute_repeats(rows: list[tuple], width: int = 400) -> list[tuple]:
    data = [(t or "").encode() for _, t in rows]
    count = collections.Counter(b[i : i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for (doc_id, _), b in zip(rows, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if count[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_contexts_do_not_depend_on_segments(monkeypatch):
    rng = random.Random(2)
    texts = [("".join(rng.choice("abc ") for _ in range(n))).encode() for n in (0, 399, 400, 401, 5000)] + [b"ab" * 3000, b"x" * 900]

    def anchors() -> list[dict[int, int]]:
        out = [{} for _ in texts]
        for owners, bases, parts in repeats._segments(texts):
            for part, anchor, first, windows, times, off in repeats.contexts(parts):
                body = texts[owners[part]][first + bases[part] :]
                assert repeats.gram_hashes(np.frombuffer(body[off : off + repeats.GRAM], np.uint8)).view(np.int64)[0] == anchor
                for i in range(windows * times):
                    at = first + bases[part] + i
                    assert at not in out[owners[part]]
                    out[owners[part]][at] = anchor
        return out

    whole = anchors()
    assert [len(w) for w in whole] == [max(0, len(t) - 399) for t in texts]
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    assert anchors() == whole
    for t, w in zip(texts, whole, strict=True):  # equal windows have equal anchors
        by_window = {}
        for at, anchor in w.items():
            assert by_window.setdefault(t[at : at + 400], anchor) == anchor


def test_shards_spool_to_disk(monkeypatch):
    rng = random.Random(3)
    shared = bytes(rng.randrange(97, 123) for _ in range(450))
    bodies = [shared, shared[20:] + b"tail" * 5, bytes(rng.randrange(97, 123) for _ in range(420)), b"once" * 110]
    want = [[(20, 51)], [(0, 31)], None]
    for room in (1 << 20, 16):
        monkeypatch.setattr(repeats, "SPOOL", room)
        shard = repeats.ShardText()
        for i, b in enumerate(bodies):
            shard.add((i, b"k"), b, False)
            shard.add((i, b"k"), b, False)  # a repeated row
        found = dict(shard.repeats())
        assert [found.get((i, b"k")) for i in range(3)] == want
        assert found[3, b"k"] == [(0, len(bodies[3]) - 399)]


def test_repeats_against_brute_force(spark):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared, other = text(600), text(420)
    rows = [
        (1, text(300) + shared + text(200)), (2, shared), (3, text(50) + shared[100:520]), (4, other + text(10) + other), (5, text(399)), (5, text(399)), (6, None), (7, ""),
        (8, "ab" * 700), (9, "x" * 401), (10, "x" * 400), (11, text(900)), (None, shared[:450] + other[:401]), (12, "y" * 400), (13, "z" * 399 + "z"), (14, shared), (14, shared),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id LONG, text STRING, digest STRING").repartition(3)
    assert digests(repeats.remove_repeats(df)) == brute_repeats(rows)
    texts = {r["doc_id"]: r["text"] for r in repeats.without_repeats(df).collect()}
    assert texts[2] == "" and texts[11] == dict(rows)[11] and repeats.without_repeats(df).columns == df.columns


def test_a_shard_larger_than_its_bounds_goes_through_queues_on_disk(monkeypatch):
    """What a task of ``remove_repeats`` does with a shard beyond its bounds: queues spill, and every repeated window is found."""
    rng = random.Random(15)
    lines = ["".join(rng.choices("abcdefghij ", k=rng.randint(300, 700))) for _ in range(1500)]
    bodies = [" ".join(rng.choices(lines, k=4)).encode() for _ in range(1700)]
    opened, path = [], suffix_sort.Space.path
    monkeypatch.setattr(repeats, "Space", lambda: suffix_sort.Space(queue_bytes=1 << 20, array_bytes=1 << 24))  # less than a shard needs
    monkeypatch.setattr(suffix_sort.Space, "path", lambda self: (opened.append(1), path(self))[1])
    shard = repeats.ShardText()
    for i, body in enumerate(bodies):
        shard.add((i,), body, False)
    assert sum(map(len, bodies)) > 3 << 20
    got = dict(shard.repeats())
    assert len(opened) > 20
    windows = collections.Counter(hashlib.md5(b[i : i + 400]).digest() for b in bodies for i in range(len(b) - 399))
    for i, body in enumerate(bodies):
        again = [windows[hashlib.md5(body[j : j + 400]).digest()] > 1 for j in range(len(body) - 399)]
        found = [False] * len(again)
        for begin, end in got.get((i,), []):
            found[begin:end] = [True] * (end - begin)
        assert found == again


def test_repeats_of_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 50_000]
    assert digests(repeats.remove_repeats(odd.where("doc_id IS NULL OR doc_id != 8"))) == brute_repeats(rows)


@pytest.mark.parametrize(("width", "hot"), [(44, 1), (200, 8000)])
def test_hot_anchors_are_split_without_parting_equal_windows(spark, monkeypatch, width, hot):
    """A passage in many documents, each with its own surroundings, and shards far too small for its anchors."""
    rng = random.Random(width)
    text = lambda n: "".join(rng.choice("abcde ") for _ in range(n))
    passage, longer = text(width + 30), text(3 * width)
    rows = [(i, text(rng.randrange(80)) + (passage if i % 3 else longer[: width + i] + "|") + text(rng.randrange(300))) for i in range(60)]
    rows += [(60, passage), (61, passage), (62, passage[: width - 1]), (63, rows[4][1]), (64, longer + longer)]
    monkeypatch.setattr(repeats, "HOT", hot)
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    assert digests(repeats.remove_repeats(df, width)) == brute_repeats(rows, width)


def test_no_filter_gives_the_same_rows(spark, monkeypatch):
    from tidemark.llm import common

    rng = random.Random(5)
    shared = "".join(rng.choice("abc ") for _ in range(500))
    rows = [(i, ("".join(rng.choice("abc ") for _ in range(300)) + shared * (i % 2))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    want = brute_repeats(rows)
    assert digests(repeats.remove_repeats(df)) == want
    monkeypatch.setattr(common, "FILTERED", -1)
    assert digests(repeats.remove_repeats(df)) == want


def brute_suffixes(s: list[int]) -> tuple[list[int], list[int]]:
    order = sorted(range(len(s)), key=lambda i: s[i:])
    common = [0]
    for a, b in itertools.pairwise(order):
        k = 0
        while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        common.append(k)
    return order, common


#: Memory for queues, for arrays, elements at a time, and names up to which recursion ends: plenty, next to none, and no end in memory.
SPACES = [(1 << 20, 1 << 20), (64, 64, 5, 2), (1 << 20, 1 << 20, 1 << 20, 0), (64, 64, 1 << 20, 1 << 20)]


@pytest.mark.parametrize("space", SPACES)
def test_suffixes_and_common_prefixes(space):
    rng = np.random.default_rng(0)
    for trial in range(150):
        n, k = int(rng.integers(0, 200)), int(rng.integers(1, 6))
        t = rng.integers(1, 1 + k, n)
        if trial % 4 == 0:
            t = np.tile(t[:9], n)[:n]
        elif trial % 4 == 1:
            t = np.concatenate([t, t, t[: n // 2]])
        elif trial % 4 == 2:
            t = np.repeat(t, rng.integers(1, 6, n))
        t = np.concatenate([t, [0]]).astype(np.uint16)
        order, common = brute_suffixes(t.tolist())
        with suffix_sort.Space(*space) as held:
            got, shared = suffix_sort.suffix_array(t, held, 5000 if trial % 5 == 0 else 300)
            assert got.tolist() == order and shared.tolist() == common
            found = suffix_sort.repeated_windows(got, shared, 4, held).tolist()
            got, shared = suffix_sort.suffix_array(t, held, 300, 7)
            assert shared.tolist() == [min(c, 7) for c in common]
        s = t.tolist()
        count = collections.Counter(tuple(s[i : i + 4]) for i in range(len(s) - 3))
        assert found == [count[tuple(s[i : i + 4])] > 1 for i in range(len(s))]


def test_a_shard_many_times_its_memory_goes_through_disk(tmp_path, monkeypatch):
    """Queues of 8 kB, arrays of 16 kB and 4096 elements at a time, over a text of 300,000: the result is the same."""
    rng = np.random.default_rng(3)
    part = rng.integers(1, 30, 60_000)
    t = np.concatenate([part, rng.integers(1, 30, 120_000), part, rng.integers(1, 4, 60_000), [0]]).astype(np.uint16)
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    with suffix_sort.Space() as plenty:
        want, want_common = suffix_sort.suffix_array(t, plenty, 258, 400)
        want_found = suffix_sort.repeated_windows(want, want_common, 400, plenty)
        assert not plenty.files
    with suffix_sort.Space(8 << 10, 16 << 10, 4096, 2000) as space:
        got, common = suffix_sort.suffix_array(t, space, 258, 400)
        assert isinstance(got, np.memmap) and space.files > 50
        assert (common == want_common).all()
        found = suffix_sort.repeated_windows(got, common, 400, space)
    assert (found == want_found).all() and found[:59_600].all() and not found[60_000:170_000].any()
    assert not list(tmp_path.iterdir())


# --- embeddings ---------------------------------------------------------------------------------------


def vectors(seed: int, n: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 and rows:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(0, 0.02, 16)
        else:
            v = rng.normal(0, 1, 16)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 2)))
    return rows


def brute_vectors(rows: list[tuple]) -> list[tuple]:
    ok = [lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if o else None for (_, v, _), o in zip(rows, ok, strict=True)]
    n = len(rows)
    link = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], len(link[i]), min(rows[j][0] for j in seen)))
    return sorted(out)


@pytest.mark.parametrize("cell,block", [(4096, 8192), (40, 30)])
def test_vectors_against_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors(1, 400)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id LONG, embedding ARRAY<FLOAT>, label INT, cid STRING").repartition(3)
    got = embedding_dedup.near_duplicates(df)
    found, there = embedding_dedup.audit_recall(df, got, divisor=1)
    assert found >= 0.95 * there
    want = dict((v, n) for v, n, _ in brute_vectors(rows))
    assert all(r["n_links"] <= want[r["vec_id"]] for r in got.collect())


def test_search_finds_links_and_more_effort_no_fewer():
    rows = vectors(3, 600)
    x = embedding_dedup._unit(np.array([v for _, v, _ in rows]))
    want = {(int(i), int(j)) for i, j in np.argwhere(np.triu(x @ x.T >= 0.98, 1))}
    for effort in (1, 2):
        got = set(zip(*(v.tolist() for v in embedding_dedup.cell_pairs(x, effort)), strict=True))
        assert got <= want and len(got) >= 0.97 * len(want)


def test_audit_widens_a_search_that_finds_too_little(spark, monkeypatch):
    rows = vectors(2, 120)
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, label INT")
    real = embedding_dedup._links
    for enough, steps in ((2, [1, 2]), (99, [1, 2, 4, "exact"])):
        seen = []

        def poor(placed, effort, exact=False, enough=enough, seen=seen):
            seen.append("exact" if exact else effort)
            return real(placed, effort, exact) if exact or effort >= enough else real(placed, effort).where("false")

        monkeypatch.setattr(embedding_dedup, "_links", poor)
        got = embedding_dedup.near_duplicates(df)
        rows_got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect())
        assert seen == steps
        assert rows_got == brute_vectors(rows) if "exact" in steps else sum(r[1] for r in rows_got) > 0


def test_audit_draws_more_where_links_are_rare(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 1, 16).tolist(), 0) for i in range(600)]
    rows += [(600 + i, rows[i][1][:15] + [rows[i][1][15] + 0.01], 0) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>, label INT")
    monkeypatch.setattr(embedding_dedup, "AUDIT", 16)
    classes = df.select(F.unhex(F.md5(F.col("vec_id").cast("string"))).alias("cid"), F.lit(0).cast("long").alias("group"), "embedding", F.lit(1).cast("long").alias("copies"))
    drawn, want = embedding_dedup._audit(classes, None)
    assert len(drawn) > 500 and sum(want) >= 4


def test_many_vectors_with_a_dense_cluster(spark, monkeypatch):
    """Over 10,000 vectors of four labels, links planted in each, and a cluster in which all are linked."""
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, (9000, 24))
    near = x[:900] + rng.normal(0, 0.03, (900, 24))
    dense = rng.normal(0, 1, 24) + rng.normal(0, 0.02, (400, 24))
    x = np.concatenate([x, near, dense]).astype(np.float32)
    label = np.concatenate([np.arange(9000) % 4, np.arange(900) % 4, np.zeros(400, int)])
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label, strict=True))], "vec_id LONG, embedding ARRAY<FLOAT>, label INT")
    monkeypatch.setattr(embedding_dedup, "CELL", 512)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    unit = embedding_dedup._unit(x)
    there = found = 0
    for c in range(4):
        own = np.flatnonzero(label == c)
        want = (unit[own] @ unit[own].T >= 0.98).sum(axis=1) - 1
        n = np.array([got[int(i)]["n_links"] for i in own])
        assert (n <= want).all()
        there, found = there + want.sum(), found + n.sum()
    assert there > 400 * 399 and found >= 0.95 * there
    assert len({got[i]["component_id"] for i in range(9900, 10300)}) == 1


def test_bits_hold_pairs_and_components():
    rng = np.random.default_rng(1)
    for n in (2, 7, 8, 9, 130):
        pairs = rng.integers(0, n, (n // 2, 2))
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        bits = np.zeros((n, -(-n // 8)), np.uint8)
        for i, j in np.concatenate([pairs, pairs[:, ::-1]]).tolist():
            bits[i, j >> 3] |= 1 << (j & 7)
        got = {(int(i), int(j)) for a, b in embedding_dedup.pairs_of(bits) for i, j in zip(a, b, strict=True)}
        assert got == {tuple(p) for p in np.concatenate([pairs, pairs[:, ::-1]]).tolist()}
        assert embedding_dedup.roots_of(bits).tolist() == local_roots(n, pairs[:, 0], pairs[:, 1])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 0), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], None), (6, None, 0), (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (11, [1.0, 0.0, 0.0], 0), (12, [], 0), (13, [0.0, 1.0], 0), (13, [0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, label INT")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == brute_vectors(rows)
    assert embedding_dedup.near_duplicates(df.where("vec_id > 100")).count() == 0


# --- tokens -------------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, odd, sf_dir):
    tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    docs = odd.select("doc_id", "text").union(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    want = collections.Counter()
    for r in docs.collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert collections.Counter(rows_of(bpe.bpe_digests(docs, path, tokenizers.PATTERN))) == want


def test_bpe_of_hard_spellings():
    tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.read_ranks(tokenizers.path("byte_bpe_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    replay = bpe.Replay(ranks, tokenizers.PATTERN)
    rng = random.Random(0)
    texts = ["", "a  b\n\n c", "don't we'll\x1c\x1d x", " \t\n", "aaaaaaa " * 50, "日本語 テキスト", "　　x", "a\x85b", "'s 's''", "x" * 3000, "²³ ½ Ⅷ", "a​b"]
    texts += ["".join(rng.choice("aab \n'é中1.") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    for t, ids in zip(texts, replay.encode_all(texts), strict=True):
        assert ids.tolist() == encoding.encode_ordinary(t)
        assert replay.decode(ids) == t.encode() and replay.spell(ids).decode() == " ".join(map(str, ids.tolist()))


# --- classifiers --------------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.98 * got.count()


def test_language_of_odd_rows(odd):
    got = langid.identify_languages(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0.0 for i in (4, 5, 6))
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 3 == 1) for r in got)


def test_language_without_any_label(odd):
    got = langid.identify_languages(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in got.collect()} == {"und"}


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 64])
def test_ngrams_of_segments_equal_those_of_the_whole(monkeypatch, segment):
    rng = random.Random(segment)
    texts = ["Ein längerer Text, 123 mit Wörtern!  Und noch einer. " * 20, "  ..x", "ΟΔΟΣ ΟΔΟΣ. İstanbul", "".join(rng.choice("ab .,\U0001f600ß") for _ in range(3000))]
    whole = [langid.ngram_counts(t) for t in texts]
    monkeypatch.setattr(langid, "SEGMENT", segment)
    assert all((w == langid.ngram_counts(t)).all() for w, t in zip(whole, texts, strict=True)) and langid.ngram_counts("12 .") is None


def spelled_ngrams(text: str) -> collections.Counter:
    """Character n-grams one by one, as hashed buckets."""
    plain = re.sub(r"\x00+", " ", "".join(c if c.isalpha() else "\x00" for c in text.lower()))
    out = collections.Counter()
    for n in (1, 2, 3):
        for i in range(len(plain) - n + 1):
            h = n
            for c in plain[i : i + n]:
                h = (((h ^ ord(c)) * 0x01000193) + 0x9E3779B9 * n) % 2**32
            h ^= h >> 15
            out[(h * 0x2C1B3C6D) % 2**32 >> 16] += 1
    return out


def test_language_scores_equal_those_computed_n_gram_by_n_gram(spark):
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) < 3000").orderBy("doc_id").limit(200).collect() if r["text"]]
    model = langid.fit([r["text"] for r in docs[50:]], [r["lang"] for r in docs[50:]])
    for r in docs[:50]:
        counts = spelled_ngrams(r["text"])
        x = {b: math.log1p(n) * model.idf[b] for b, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        z = [(sum(v / norm * model.weights[b][k] for b, v in x.items()) + model.bias[k]) / model.temperature for k in range(len(model.languages))]
        p = [math.exp(v - max(z)) for v in z]
        best = max(range(len(p)), key=p.__getitem__)
        lang, score = model.predict(r["text"])
        assert lang == model.languages[best] and abs(score - p[best] / sum(p)) < 1e-6


def test_toxicity_of_held_out_documents(spark):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(docs, marks).join(marks, "doc_id").where("held_out").toPandas()
    hit = ((got.predicted == 1) & (got.toxic == 1)).sum()
    assert hit >= 0.85 * (got.toxic == 1).sum() and hit >= 0.85 * (got.predicted == 1).sum()


def test_toxicity_of_odd_rows(odd, labels):
    got = toxicity.score_toxicity(odd, labels).collect()
    assert len(got) == odd.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (4, 5)}) == 1
    assert toxicity.score_toxicity(odd, labels.where("doc_id > 99")).count() == odd.count()


def test_toxicity_logits_equal_those_computed_window_by_window(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) BETWEEN 1 AND 900").orderBy("doc_id").limit(90).collect()
    model = toxicity.fit([r["text"] for r in docs[50:]], [i % 2 for i in range(len(docs) - 50)], epochs=3)
    for text in ["", "...", *[r["text"] for r in docs[:50]]]:
        words_ = [model.embedding[rows].sum(axis=0) for rows in toxicity.word_rows(text)] or [np.zeros(toxicity.WIDTH)]
        logit = model.bias
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best = -math.inf
                for i in range(len(words_)):
                    answer = sum(float(words_[i + j] @ model.filters[k][j][:, f]) for j in range(width) if i + j < len(words_))
                    best = max(best, answer + float(model.shifts[k][f]))
                logit += max(best, 0.0) * float(model.top[k * toxicity.FILTERS + f])
        assert abs(model.logit(toxicity.word_rows(text)) - logit) < 1e-3


def test_toxicity_segments_lose_nothing(monkeypatch):
    model = toxicity.fit(["a bad word here", "a good word here"] * 10, [1, 0] * 10, epochs=2)
    rows = toxicity.word_rows("some good words and a bad word here " * 30)
    whole = model.pooled(rows)
    monkeypatch.setattr(toxicity, "SEGMENT", 7)
    assert np.allclose(whole, model.pooled(rows), atol=1e-5)


# --- pages --------------------------------------------------------------------------------------------


def test_blocks_decode_and_collapse():
    page = "<html><head><title>T</title></head><body><p>A&amp;B&nbsp; <b>c\n\td</b> &eacute;<p>x < y<br>z<!-- no --><script>var a='<p>';</script></body>"
    assert [b.text for b in html_text.leaf_blocks(page)] == ["A&B c d é", "x < y z"]


def test_pages_of_unseen_layouts():
    wrong = total = 0
    for page, labels_ in html_text.labelled_pages(150, seed=99):
        blocks = html_text.leaf_blocks(page)
        field = html_text.trained_field()
        wrong += sum(a != b for a, b in zip(field.decode(field.scores(blocks)), labels_, strict=True))
        total += len(labels_)
    assert wrong <= 0.01 * total


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    for _ in range(50):
        field = html_text.BlockField({}, np.zeros((0, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        scores = rng.normal(size=(6, 2))
        value = lambda y: field.start[y[0]] + sum(scores[i, a] for i, a in enumerate(y)) + sum(field.step[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=6), key=value)
        assert field.decode(scores) == list(best)


def test_pages_odd(spark):
    main = "<article><h1>Head line</h1><p>One two three four five six seven.</p><p>" + "word " * 50_000 + "end.</p></article>"
    rows = [(1, "u", f"<nav><a href=x>Menu</a></nav>{main}<footer>&copy; foot</footer>", "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<<<>>>", "x"), (4, "u", "<div class=ad>buy", "x"), (1, "u", "<nav><a href=x>Menu</a></nav>", "x")]
    df = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, text STRING")
    got = html_text.extract_text(df).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert max(r["n_chars"] for r in got) > 250_000 and next(r for r in got if r["page_id"] == 2)["text"] == ""
    assert html_text.extract_text(df.where("page_id > 99")).count() == 0


def test_real_pages_give_their_article(spark):
    import html as entities

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    field = html_text.trained_field()
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = " ".join(entities.unescape(re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert field.extract(r["html"]) == want


# --- all ----------------------------------------------------------------------------------------------


def test_empty_tables(none, labels):
    tokenizers = pytest.importorskip("public_tokenizers")
    assert sharding.shard_documents(none).count() == 0
    assert quality.quality_rules(none, labels).count() == 0
    assert packing.pack(none).count() == 0
    assert jaccard_join.jaccard_join(none).count() == 0
    assert repeats.remove_repeats(none).count() == 0
    assert langid.identify_languages(none).count() == 0
    assert toxicity.score_toxicity(none, labels).count() == 0
    assert bpe.bpe_digests(none, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN).count() == 0


def test_word_hashes_tell_words_apart():
    h = word_hashes(b"a b a  ab ba\tab")
    assert h[0] == h[2] and h[3] == h[5] and len(set(h.tolist())) == 4 and len(word_hashes(b" \n")) == 0
