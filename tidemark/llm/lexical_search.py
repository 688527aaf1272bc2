"""Ranked lexical search: exact top documents of each item over a clustered index of reordered documents.

Documents are put in order by recursive graph bisection, which swaps documents between two halves as long as
that lowers the cost of coding the gaps of their terms' lists. The upper levels of the recursion are fitted on
a bounded sample and all documents are routed through them; below, blocks of bounded size are bisected in full,
down to clusters of similar documents. A cluster keeps the highest impact of each of its terms, so the scores
in it are bounded without looking at its documents. Each item first visits the few clusters of the highest
bounds, which gives it a floor; then clusters are visited by bound and left alone once it is below the floor.
The order decides how much is visited, never what is found: ties are settled by doc_id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import Scratch, bounded_sample, mix64, small_batches, stream_groups, word_hashes

TOP = 10
#: Distinct terms, and items, that are answered together; more are answered in blocks.
BLOCK_TERMS, BLOCK_ITEMS = 1 << 20, 4096
#: Terms of a document that the bisection looks at, those of least hash, and the classes they are dealt into.
SKETCH, FEATURES = 128, 4096
#: Passes of swaps at a level, and the share of documents below which another is not worth it.
SWEEPS, FEW_SWAPS = 8, 0.002
#: A term is a run of letters and digits of ASCII and of all other characters, whose bytes have the high bit.
_GAP = np.zeros(256, bool)
_GAP[:128] = [not chr(b).isalnum() for b in range(128)]
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Shape:
    """Documents, and postings, of a block that is bisected in one task and of a cluster; the sample that the
    upper levels are fitted on, and the most of these levels, below which leaves are salted; the clusters that
    an item visits for its first floor. None of them changes a result."""

    block: int = 2048
    block_postings: int = 1 << 22
    cluster: int = 64
    cluster_postings: int = 1 << 20
    sample: int = 16384
    levels: int = 8
    first: int = 4


POSTINGS = "doc_id STRING, n LONG, terms ARRAY<INT>, tfs ARRAY<INT>, sketch ARRAY<INT>"
CLUSTERS = "leaf INT, salt INT, cluster INT, doc_ids ARRAY<STRING>, terms ARRAY<INT>, highest ARRAY<INT>, starts ARRAY<INT>, members ARRAY<INT>, impacts ARRAY<INT>"
FOUND = "qid INT, doc_id LONG, score LONG"


def term_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of each term of a text, in order, A to Z lower-cased."""
    return word_hashes((text or "").encode().translate(_LOWER), _GAP)


@dataclass
class Items:
    """Items answered together: a sorted vocabulary of term hashes, and each item's distinct terms in it."""

    ids: list
    vocabulary: np.ndarray
    terms: np.ndarray
    times: np.ndarray
    starts: np.ndarray


def item_blocks(benchmark: DataFrame, terms: int = BLOCK_TERMS, items: int = BLOCK_ITEMS) -> Iterator[Items]:
    """The items in blocks of bounded size; one longer than a block is a block of its own. Items without a term find nothing."""

    def block(held: list[tuple]) -> Items:
        vocabulary = np.unique(np.concatenate([h for _, h, _ in held]))
        sizes = [len(h) for _, h, _ in held]
        at = np.searchsorted(vocabulary, np.concatenate([h for _, h, _ in held])).astype(np.int32)
        return Items([i for i, _, _ in held], vocabulary, at, np.concatenate([n for _, _, n in held]), np.cumsum([0, *sizes]))

    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        hashes, times = np.unique(term_hashes(row["text"]), return_counts=True)
        if not len(hashes):
            continue
        if held and (size + len(hashes) > terms or len(held) == items):
            yield block(held)
            held, size = [], 0
        held.append((row["item_id"], hashes, times.astype(np.int64)))
        size += len(hashes)
    if held:
        yield block(held)


# --- the order of documents ------------------------------------------------------------------------------


def _cost(degree: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bits to code the gaps of a list of so many documents among ``size``."""
    return degree * np.log2((size + 1) / (degree + 1))


def _rank_in(group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Position of each element among those of its group, where ``order`` sorts all by group first."""
    sorted_group = group[order]
    first = np.concatenate([[True], sorted_group[1:] != sorted_group[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order)) - start
    return rank


def bisect_graph(owner: np.ndarray, feature: np.ndarray, n: int, levels: int, seen: Callable | None = None) -> np.ndarray:
    """Leaf of each of ``n`` documents after ``levels`` bisections; leaves in order are the documents' order.

    ``owner`` and ``feature`` are the edges of the graph. All nodes of a level are bisected at once: documents
    are ranked by what their move would save, and the best of both halves swap places while a pair saves
    anything. ``seen`` is told each level's degrees, sizes, nodes and sides.
    """
    node = np.zeros(n, np.int64)
    for level in range(levels):
        nodes = 1 << level
        size = np.bincount(node, minlength=nodes)
        side = (_rank_in(node, np.argsort(node, kind="stable")) >= (size[node] + 1) // 2).astype(np.int64)
        for _ in range(SWEEPS):
            half = node * 2 + side
            key = half[owner] * FEATURES + feature
            degree = np.bincount(key, minlength=2 * nodes * FEATURES).reshape(nodes, 2, FEATURES).astype(np.float64)
            sizes = np.bincount(half, minlength=2 * nodes).reshape(nodes, 2, 1)
            other, others = degree[:, ::-1], sizes[:, ::-1]
            saved = _cost(degree, sizes) + _cost(other, others) - _cost(np.maximum(degree - 1, 0), sizes) - _cost(other + 1, others)
            gain = np.bincount(owner, weights=saved.ravel()[key], minlength=n)
            order = np.lexsort((-gain, half))
            rank = _rank_in(half, order)
            # the documents of one rank in the two halves of a node are next to each other
            pairs = np.lexsort((side, rank, node))
            a, b = pairs[:-1], pairs[1:]
            swap = (node[a] == node[b]) & (rank[a] == rank[b]) & (gain[a] + gain[b] > 0)
            side[a[swap]], side[b[swap]] = 1, 0
            if swap.sum() <= FEW_SWAPS * n:
                break
        if seen is not None:
            half = node * 2 + side
            degree = np.bincount(half[owner] * FEATURES + feature, minlength=2 * nodes * FEATURES).reshape(nodes, 2, FEATURES)
            seen(level, degree.astype(np.float64), np.bincount(half, minlength=2 * nodes).reshape(nodes, 2), node, side)
        node = node * 2 + side
    return node


def _edges(sketches: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(s) for s in sketches]
    return np.repeat(np.arange(len(sketches)), sizes), np.concatenate(sketches).astype(np.int64) if sketches else np.empty(0, np.int64)


def fit_routes(sketches: list[np.ndarray], levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level and node, what a feature speaks for the left half, and the sum above which a document goes there.

    A document joins the half where its terms cost less; the threshold is the median of the sample, so halves
    are as even as the sample is.
    """
    owner, feature = _edges(sketches)
    routes: list[tuple[np.ndarray, np.ndarray]] = []

    def seen(level: int, degree: np.ndarray, sizes: np.ndarray, node: np.ndarray, side: np.ndarray) -> None:
        added = _cost(degree + 1, sizes[:, :, None]) - _cost(degree, sizes[:, :, None])
        speaks = (added[:, 1] - added[:, 0]).astype(np.float32)
        total = np.bincount(owner, weights=speaks.ravel()[node[owner] * FEATURES + feature], minlength=len(node))
        at = [np.median(total[node == k]) if (node == k).any() else 0.0 for k in range(1 << level)]
        routes.append((speaks, np.array(at)))

    bisect_graph(owner, feature, len(sketches), levels, seen)
    return routes


def route(sketches: list[np.ndarray], routes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The leaf of each document below the fitted levels."""
    owner, feature = _edges(sketches)
    node = np.zeros(len(sketches), np.int64)
    for speaks, at in routes:
        total = np.bincount(owner, weights=speaks.ravel()[node[owner] * FEATURES + feature], minlength=len(node))
        node = node * 2 + (total <= at[node])
    return node


# --- the index --------------------------------------------------------------------------------------------


def _postings(vocabulary: Broadcast) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = vocabulary.value
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                hashes = term_hashes(text)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                terms, tfs = np.unique(at[known[at] == hashes], return_counts=True)
                least = np.argsort(mix64(terms.astype(np.uint64) + np.uint64(1)), kind="stable")[:SKETCH]
                rows.append((len(hashes), terms.astype(np.int32), tfs.astype(np.int32), np.unique(terms[least] % FEATURES).astype(np.int32)))
            out = pd.DataFrame(rows, columns=["n", "terms", "tfs", "sketch"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out[out["n"] > 0]

    return run


def _leaf_of(routes: Broadcast):
    @F.pandas_udf("int")
    def leaf(sketch: pd.Series) -> pd.Series:
        return pd.Series(route(list(sketch), routes.value).astype(np.int32))

    return leaf


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _clusters(total: int, length: int, shape: Shape) -> Callable:
    """Bisects each block down to clusters and lays out their postings by term."""

    def lay_out(own: pd.DataFrame, cluster: int) -> dict:
        sizes = own["terms"].map(len).to_numpy()
        member = np.repeat(np.arange(len(own), dtype=np.int32), sizes)
        terms, tfs = np.concatenate(own["terms"].to_list()), np.concatenate(own["tfs"].to_list()).astype(np.int64)
        m = 25 + np.array([75 * n * total // length for n in own["n"].tolist()], np.int64)
        order = np.argsort(terms, kind="stable")
        impacts = impact(tfs, m[member])[order].astype(np.int32)
        distinct, starts = np.unique(terms[order], return_index=True)
        highest = np.maximum.reduceat(impacts, starts) if len(starts) else impacts
        return {
            "leaf": own["leaf"].iloc[0], "salt": own["salt"].iloc[0], "cluster": cluster, "doc_ids": own["doc_id"].to_list(), "terms": distinct, "highest": highest,
            "starts": np.append(starts, len(terms)).astype(np.int32), "members": member[order], "impacts": impacts,
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in stream_groups(batches, ["leaf", "salt"]):
            levels = max(0, math.ceil(math.log2(len(block) / shape.cluster)))
            leaf = bisect_graph(*_edges(block["sketch"].to_list()), len(block), levels)
            block = block.iloc[np.argsort(leaf, kind="stable")]
            postings = np.cumsum(block["terms"].map(len).to_numpy())
            part = np.stack([np.sort(leaf), postings // shape.cluster_postings])
            cuts = [0, *(np.flatnonzero((part[:, 1:] != part[:, :-1]).any(axis=0)) + 1).tolist(), len(block)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                yield pd.DataFrame([lay_out(block.iloc[a:b], k)])

    return run


@dataclass
class Index:
    """Clusters of reordered documents, and the weight of each term of the vocabulary."""

    clusters: DataFrame
    weights: np.ndarray


def build_index(docs: DataFrame, vocabulary: np.ndarray, scratch: Scratch, name: str = "index", shape: Shape = Shape()) -> Index | None:
    """The clustered index of all documents over the terms of a vocabulary; None if no document has a term.

    Counts are of all documents and terms. Documents without a term of the vocabulary count, but are in no cluster.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = scratch.table(docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(_postings(shared), POSTINGS), f"{name}-postings")
    total, length = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not total:
        return None
    frequency = np.zeros(len(vocabulary), np.int64)
    counts = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toPandas()
    frequency[counts["term"].to_numpy()] = counts["df"].to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)

    held = rows.where(F.size("terms") > 0)
    levels = min(shape.levels, max(0, math.ceil(math.log2(total / shape.block))))
    if levels:
        sample = bounded_sample(held.select("doc_id", "sketch"), "doc_id", shape.sample).toPandas()
        routes = spark.sparkContext.broadcast(fit_routes(sample["sketch"].to_list(), levels))
        held = held.withColumn("leaf", _leaf_of(routes)("sketch"))
    else:
        held = held.withColumn("leaf", F.lit(0))
    # a leaf of more documents or postings than a block is dealt into several
    sizes = held.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("terms")).alias("postings")).collect()
    salts = {r["leaf"]: max(math.ceil(r["n"] / shape.block), math.ceil(r["postings"] / shape.block_postings)) for r in sizes}
    many = F.element_at(F.array(*[F.lit(salts.get(k, 1)) for k in range(1 << levels)]), F.col("leaf") + 1)
    dealt = held.withColumn("salt", F.pmod(F.monotonically_increasing_id(), many).cast("int"))
    blocks = dealt.repartition("leaf", "salt").sortWithinPartitions("leaf", "salt")
    clusters = scratch.table(blocks.mapInPandas(_clusters(total, length, shape), CLUSTERS), name)
    scratch.drop(f"{name}-postings")
    return Index(clusters, weights)


# --- the search -------------------------------------------------------------------------------------------


class _Asked:
    """Items as flat arrays: bounds and scores of a cluster for all of them or for one."""

    def __init__(self, items: Items, weights: np.ndarray) -> None:
        self.items, self.weight = items, items.times * weights[items.terms]
        self.at = np.full(len(items.vocabulary), -1, np.int64)
        self.starts = items.starts

    def bounds(self, terms: np.ndarray, highest: np.ndarray) -> np.ndarray:
        """No document of the cluster scores more."""
        top = np.zeros(len(self.at), np.int64)
        top[terms] = highest
        return np.add.reduceat(top[self.items.terms] * self.weight, self.starts[:-1])

    def enter(self, row) -> None:
        self.at[row.terms] = np.arange(len(row.terms))

    def leave(self, row) -> None:
        self.at[row.terms] = -1

    def scores(self, row, item: int) -> np.ndarray:
        """Of each document of the cluster that was entered."""
        own = slice(self.starts[item], self.starts[item + 1])
        at, weight = self.at[self.items.terms[own]], self.weight[own]
        at, weight = at[at >= 0], weight[at >= 0]
        begin, sizes = row.starts[at], row.starts[at + 1] - row.starts[at]
        places = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        out = np.zeros(len(row.doc_ids), np.int64)
        np.add.at(out, row.members[places], row.impacts[places] * np.repeat(weight, sizes))
        return out


class _Best:
    """The best documents of each item that a task has seen, all that tie with the last included."""

    def __init__(self, n: int, floor: np.ndarray, top: int) -> None:
        self.found: list[list[tuple[int, int | None]]] = [[] for _ in range(n)]
        self.floor, self.top = floor.copy(), top

    def add(self, item: int, ids: list, scores: np.ndarray) -> None:
        good = np.flatnonzero(scores >= max(self.floor[item], 1))
        if not len(good):
            return
        # the least ids first among equals, a null one last; more than ``top`` are never needed
        own = self.found[item] + [(int(scores[k]), ids[k]) for k in good]
        own.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        self.found[item] = own[: self.top]
        if len(own) >= self.top:
            self.floor[item] = max(self.floor[item], own[self.top - 1][0])

    def rows(self) -> pd.DataFrame:
        flat = [(q, i, s) for q, own in enumerate(self.found) for s, i in own]
        out = pd.DataFrame(flat, columns=["qid", "doc_id", "score"])
        return out.astype({"qid": "int32", "doc_id": "Int64", "score": "int64"})


def _highest_bounds(asked: Broadcast, most: int) -> Callable:
    """The few clusters of the highest bounds for each item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query = _Asked(*asked.value)
        best: list[list[tuple]] = [[] for _ in query.items.ids]
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                bounds = query.bounds(row.terms, row.highest)
                for q in np.flatnonzero(bounds > 0):
                    if len(best[q]) < most or bounds[q] > best[q][-1][0]:
                        best[q] = sorted([*best[q], (int(bounds[q]), int(row.leaf), int(row.salt), int(row.cluster))], reverse=True)[:most]
        yield pd.DataFrame([(q, *x) for q, own in enumerate(best) for x in own], columns=["qid", "bound", "leaf", "salt", "cluster"], dtype=np.int64)

    return run


def _visit(asked: Broadcast, floor: np.ndarray, top: int) -> Callable:
    """Scores the clusters of a batch by descending bound, item by item, and stops an item where the bound is below its floor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query = _Asked(*asked.value)
        best = _Best(len(query.items.ids), floor, top)
        for pdf in batches:
            rows = list(pdf.itertuples(index=False))
            bounds = np.stack([query.bounds(r.terms, r.highest) for r in rows])
            # clusters are entered by their highest bound over what any item still needs
            order = np.argsort(-np.max(bounds - np.maximum(best.floor, 1), axis=1), kind="stable")
            for k in order.tolist():
                asking = np.flatnonzero(bounds[k] >= np.maximum(best.floor, 1))
                if not len(asking):
                    continue
                row = rows[k]
                query.enter(row)
                ids = [None if i is None else int(i) for i in row.doc_ids]
                for q in asking[np.argsort(-bounds[k][asking])].tolist():
                    best.add(q, ids, query.scores(row, q))
                query.leave(row)
        yield best.rows()

    return run


def _top(found: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def _answer(spark: SparkSession, index: Index, items: Items, top: int, first: int) -> DataFrame:
    asked = spark.sparkContext.broadcast((items, index.weights))
    bounds = index.clusters.select("leaf", "salt", "cluster", "terms", "highest").mapInPandas(_highest_bounds(asked, first), "qid INT, bound LONG, leaf INT, salt INT, cluster INT")
    nearest = Window.partitionBy("qid").orderBy(F.desc("bound"), "leaf", "salt", "cluster")
    # a few clusters for each of a block's items
    chosen = bounds.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= first).select("leaf", "salt", "cluster").distinct()
    visited = index.clusters.join(F.broadcast(chosen), ["leaf", "salt", "cluster"], "left_semi")
    floor = np.zeros(len(items.ids), np.int64)
    for r in _top(visited.mapInPandas(_visit(asked, floor, top), FOUND), top).where(F.col("rank") == top).collect():
        floor[r["qid"]] = r["score"]
    return _top(index.clusters.mapInPandas(_visit(asked, floor, top), FOUND), top)


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, shape: Shape = Shape()) -> DataFrame:
    """The ``top`` documents of each item by score, equal scores by ascending doc_id: item_id, rank, doc_id, score.

    Items and documents whose text is null, empty or without a term find nothing and are not found; such
    documents count in no statistic. Rows that repeat an id are documents, or items, of their own; a null
    doc_id comes after all others of its score. Very long texts are read whole, and an item's terms count as
    often as they occur. Empty tables give no rows; other columns are not looked at. Terms are told apart by a
    64-bit hash; the documents' terms that no item asks for are counted, not kept.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = benchmark.schema["item_id"].dataType
    scratch = Scratch(spark, "search")
    out = None
    for k, items in enumerate(item_blocks(benchmark)):
        index = build_index(docs, items.vocabulary, scratch, f"index-{k}", shape)
        if index is None:
            break
        names = spark.createDataFrame(list(enumerate(items.ids)), T.StructType([T.StructField("qid", T.IntegerType()), T.StructField("item_id", kind)]))
        found = _answer(spark, index, items, top, shape.first).join(F.broadcast(names), "qid").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
        return spark.createDataFrame([], schema)
    return out
