"""Embedding near-duplicates: a robust-pruned flat graph, searched greedily and expanded over the range.

Vectors meet only within a label. A label is cut into overlapping cells around centroids; a cell's task cuts
it again into overlapping cluster shards, builds each shard's neighbour lists, unites them, prunes them
robustly (a neighbour stays only if no nearer neighbour lies closer to it), and searches the united graph
from the shards' medoids for every member: a beam first walks towards it, then everything within range of
it is expanded until nothing new appears. Every pair found is verified in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch
from tidemark.llm.components import connected_components

#: Least cosine of a link, and how far below it the search still expands.
COSINE, SLACK = 0.98, 0.01
#: Vectors per cell and per shard, centroids in all at most, cells and shards that a vector joins.
CELL, SHARD, CENTROIDS, OVERLAP = 4096, 1024, 4096, 3
#: Candidates and neighbours of a node, the prune's slack, and the beam's width.
CANDIDATES, DEGREE, ALPHA, BEAM = 48, 24, 1.15, 40
#: Members of a cell beyond which it is dealt out as pairs of blocks.
BLOCK = 8192
#: Vectors per centroid among which centroids are found.
SAMPLE = 16
#: Queries of an audit at first and at most, the links it wants to see, the recall that it must find, and how
#: often the search may be widened for it before labels that lose links are compared exactly.
AUDIT, MOST_AUDIT, SEEN, RECALL, WIDENED = 256, 4096, 200, 0.95, 2


def usable(vector: Column) -> Column:
    """A vector that can be similar to another: no null, only finite components, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of lists of one length, without nulls, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def centroids_of(x: np.ndarray, k: int, rounds: int = 6, seed: int = 1) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([np.argmax(x[a : a + 2048] @ c.T, axis=1) for a in range(0, len(x), 2048)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(size > 0, total / np.maximum(size, 1e-12), c)
    return c


def _nearest(x: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    sims = x @ c.T
    k = min(k, sims.shape[1])
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(sims, top, axis=1), axis=1), axis=1)


def robust_prune(x: np.ndarray, node: np.ndarray, cand: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """Of each node's candidates, nearest first, those that no kept one is alpha times nearer to; -1 fills up.

    ``cand``: (nodes, L) indices, -1 for none, without repetitions.
    """
    safe = np.maximum(cand, 0)
    vectors = x[safe]
    distance = np.sqrt(np.maximum(2 - 2 * np.einsum("nld,nd->nl", vectors, x[node]), 0))
    distance[(cand < 0) | (cand == node[:, None])] = np.inf
    order = np.argsort(distance, axis=1, kind="stable")
    cand, distance = np.take_along_axis(cand, order, axis=1), np.take_along_axis(distance, order, axis=1)
    vectors = np.take_along_axis(vectors, order[:, :, None], axis=1)
    between = np.sqrt(np.maximum(2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1)), 0))
    alive = np.isfinite(distance)
    out = np.full((len(node), degree), -1, np.int64)
    rows = np.arange(len(node))
    for k in range(degree):
        pick = np.argmax(alive, axis=1)
        has = alive[rows, pick]
        if not has.any():
            break
        out[has, k] = cand[has, pick[has]]
        alive &= ~(has[:, None] & (alpha * between[rows, pick] <= distance))
        alive[rows, pick] = False
    return out


@dataclass
class Graph:
    neighbours: np.ndarray
    medoids: np.ndarray


def build_graph(x: np.ndarray, shard: int = SHARD, seed: int = 2, effort: int = 1) -> Graph:
    """United, pruned neighbour lists of overlapping cluster shards of unit vectors, and the shards' medoids.

    ``effort`` multiplies the candidates and neighbours of a node.
    """
    n = len(x)
    x = x.astype(np.float32)
    shards = max(1, -(-n // shard))
    rng = np.random.default_rng(seed)
    centres = centroids_of(x[rng.choice(n, min(n, shards * SAMPLE * 4), replace=False)], shards).astype(np.float32)
    member = _nearest(x, centres, OVERLAP)
    lists: list[list[np.ndarray]] = []
    owners: list[np.ndarray] = []
    medoids = []
    for s in range(len(centres)):
        own = np.flatnonzero((member == s).any(axis=1))
        if not len(own):
            continue
        medoids.append(own[int(np.argmax(x[own] @ centres[s]))])
        k = min(CANDIDATES * effort, len(own) - 1)
        if k < 1:
            continue
        for a in range(0, len(own), 1024):
            sims = x[own[a : a + 1024]] @ x[own].T
            sims[np.arange(len(sims)), np.arange(a, a + len(sims))] = -2
            lists.append(own[np.argpartition(-sims, k - 1, axis=1)[:, :k]])
            owners.append(own[a : a + 1024])
    if not lists:
        return Graph(np.full((n, 1), -1, np.int64), np.array(medoids or [0]))
    src = np.concatenate([np.repeat(o, p.shape[1]) for o, p in zip(owners, lists, strict=True)])
    dst = np.concatenate([p.ravel() for p in lists])
    once = _prune_all(x, src, dst, n, DEGREE * effort)
    a, b = np.nonzero(once >= 0)
    b = once[a, b]
    far = rng.integers(0, n, (n, 2))  # a few long edges keep every part in reach
    src = np.concatenate([a, b])
    dst = np.concatenate([b, a])
    both = _prune_all(x, src, dst, n, DEGREE * effort)
    # a node that no list kept after the prune is hung on its nearest neighbour, so all can be reached
    orphan = np.flatnonzero((np.bincount(both[both >= 0], minlength=n) == 0) & (both[:, 0] >= 0))
    host = both[orphan, 0]
    order = np.argsort(host, kind="stable")
    orphan, host = orphan[order], host[order]
    slot = np.arange(len(host)) - np.searchsorted(host, host)
    hung = np.full((n, int(slot.max()) + 1 if len(slot) else 0), -1, np.int64)
    hung[host, slot] = orphan
    return Graph(np.concatenate([both, far, hung], axis=1), np.unique(medoids))


def _prune_all(x: np.ndarray, src: np.ndarray, dst: np.ndarray, n: int, degree: int) -> np.ndarray:
    """The pruned list of every node, of the union of all edges given."""
    code = np.unique(src * n + dst)
    src, dst = code // n, code % n
    count = np.bincount(src, minlength=n)
    begin = np.cumsum(count) - count
    out = np.full((n, degree), -1, np.int64)
    order = np.argsort(count, kind="stable")  # nodes of like degree are pruned together
    a = 0
    while a < n:
        b = min(a + 256, n)
        wide = int(count[order[b - 1]])
        while b - a > 1 and (b - a) * wide * wide > 4_000_000:
            b = a + (b - a) // 2
            wide = int(count[order[b - 1]])
        own = order[a:b]
        if wide:
            slot = np.arange(wide)
            cand = np.where(slot < count[own][:, None], dst[np.minimum(begin[own][:, None] + slot, len(dst) - 1)], -1)
            out[own] = robust_prune(x, own, cand, degree)
        a = b
    return out


def search(x: np.ndarray, graph: Graph, queries: np.ndarray, cosine: float = COSINE, beam: int = BEAM) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, other) with a cosine of at least ``cosine`` that the graph search finds, a block of queries at a time.

    Queries are members, so each enters at the medoids and at its own node. All of a block walk in step. The beam keeps the ``beam`` most similar nodes seen and expands the
    best not yet expanded; when none is left, all nodes in range are expanded, over and over.
    """
    n, width = graph.neighbours.shape
    small = x.astype(np.float32)
    block = max(1, min(256, 4_000_000 // max(n, 1)))
    for at in range(0, len(queries), block):
        q = queries[at : at + block]
        m, row = len(q), np.arange(len(q))
        seen = np.zeros((m, n), bool)
        start = np.concatenate([np.repeat(graph.medoids[None, :], m, axis=0), q[:, None]], axis=1)
        seen[row[:, None], start] = True
        sims = np.einsum("mkd,md->mk", small[start], small[q])
        nodes, done = start, np.zeros(start.shape, bool)
        near_q, near_n = [], []

        def keep(qi: np.ndarray, ni: np.ndarray, s: np.ndarray, to_q=near_q, to_n=near_n) -> tuple[np.ndarray, np.ndarray]:
            close = s >= cosine - SLACK
            to_q.append(qi[close])
            to_n.append(ni[close])
            return qi[close], ni[close]

        keep(np.repeat(row, start.shape[1]), start.ravel(), sims.ravel())
        active = row
        while len(active):
            open_ = np.where(done[active], -np.inf, sims[active])
            best = np.argmax(open_, axis=1)
            active = active[np.isfinite(open_[np.arange(len(active)), best])]
            if not len(active):
                break
            open_ = np.where(done[active], -np.inf, sims[active])
            best = np.argmax(open_, axis=1)
            done[active, best] = True
            nb = graph.neighbours[nodes[active, best]]
            fresh = (nb >= 0) & ~seen[active[:, None], np.maximum(nb, 0)]
            s = np.einsum("mkd,md->mk", small[np.maximum(nb, 0)], small[q[active]])
            s[~fresh] = -np.inf
            i, j = np.nonzero(fresh)
            seen[active[i], nb[i, j]] = True
            keep(active[i], nb[i, j], s[i, j])
            all_s, all_n = np.full((m, sims.shape[1] + width), -np.inf, np.float32), np.zeros((m, sims.shape[1] + width), np.int64)
            all_d = np.ones(all_s.shape, bool)
            all_s[:, : sims.shape[1]], all_n[:, : sims.shape[1]], all_d[:, : sims.shape[1]] = sims, nodes, done
            all_s[active, sims.shape[1] :], all_n[active, sims.shape[1] :], all_d[active, sims.shape[1] :] = s, np.maximum(nb, 0), ~fresh
            top = np.argpartition(-all_s, min(beam, all_s.shape[1]) - 1, axis=1)[:, :beam]
            sims, nodes, done = (np.take_along_axis(v, top, axis=1) for v in (all_s, all_n, all_d))
            done |= ~np.isfinite(sims)
        front_q, front_n = np.concatenate(near_q), np.concatenate(near_n)
        while len(front_q):
            grown_q, grown_n = [], []
            for a in range(0, len(front_q), 100_000):
                nb = graph.neighbours[front_n[a : a + 100_000]]
                fq = np.repeat(front_q[a : a + 100_000], width)
                nb = nb.ravel()
                ok = nb >= 0
                fq, nb = fq[ok], nb[ok]
                ok = ~seen[fq, nb]
                fq, nb = fq[ok], nb[ok]
                if not len(fq):
                    continue
                code = np.unique(fq * n + nb)
                fq, nb = code // n, code % n
                seen[fq, nb] = True
                g = keep(fq, nb, np.einsum("id,id->i", small[q[fq]], small[nb]))
                grown_q.append(g[0])
                grown_n.append(g[1])
            front_q, front_n = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (grown_q, grown_n))
        a, b = q[np.concatenate(near_q)], np.concatenate(near_n)
        ok = a != b
        a, b = a[ok], b[ok]
        exact = np.zeros(len(a), bool)
        for s in range(0, len(a), 200_000):
            exact[s : s + 200_000] = np.einsum("id,id->i", x[a[s : s + 200_000]], x[b[s : s + 200_000]]) >= cosine
        yield a[exact], b[exact]


def all_pairs(x: np.ndarray, cosine: float = COSINE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs like those of ``search``, by comparing every two."""
    block = max(1, min(256, 4_000_000 // max(len(x), 1)))
    for at in range(0, len(x), block):
        a, b = np.nonzero(x[at : at + block] @ x.T >= cosine)
        other = a + at != b
        yield a[other] + at, b[other]


def found_bits(x: np.ndarray, effort: int = 1, exact: bool = False) -> np.ndarray:
    """A bit for each two members of a cell, set if either found the other: n * n / 8 bytes, however dense."""
    n = len(x)
    bits = np.zeros((n, -(-n // 8)), np.uint8)
    if n < 2:
        return bits
    for a, b in all_pairs(x) if exact else search(x, build_graph(x, effort=effort), np.arange(n), beam=BEAM * effort):
        for i, j in ((a, b), (b, a)):
            np.bitwise_or.at(bits, (i, j >> 3), (1 << (j & 7)).astype(np.uint8))
    return bits


def pairs_of(bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs set in ``bits``, both ways round, some rows at a time."""
    n = len(bits)
    block = max(1, 4_000_000 // max(n, 1))
    for at in range(0, n, block):
        a, b = np.nonzero(np.unpackbits(bits[at : at + block], axis=1, count=n, bitorder="little"))
        yield a + at, b


def cell_pairs(x: np.ndarray, effort: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """All found pairs of a cell, each once, as indices left < right; for small cells."""
    a, b = (np.concatenate(v) for v in zip((np.empty(0, np.int64),) * 2, *pairs_of(found_bits(x, effort)), strict=True))
    return a[a < b], b[a < b]


def roots_of(bits: np.ndarray) -> np.ndarray:
    """Least member of each member's component: unseen members are reached row by row, each row read once."""
    n = len(bits)
    root = np.full(n, -1, np.int64)
    for i in range(n):
        if root[i] >= 0:
            continue
        root[i], front = i, [i]
        while front:
            near = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bits[front[:512]], axis=0), count=n, bitorder="little"))
            new = near[root[near] < 0]
            root[new] = i
            front = front[512:] + new.tolist()
    return root


def _cells(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Classes with ``cells``: the ascending numbers of the cells that each joins, and ``cell``, one a row."""
    spark = classes.sparkSession
    sizes = classes.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    target = max(CELL, -(-total // CENTROIDS))
    # a vector joins OVERLAP cells, so a label that fills no more of them is one cell; CENTROIDS rows at most
    large = {r["group"]: r["n"] for r in sizes.where(F.col("n") > target * OVERLAP).collect()}
    centres: dict = {}
    if large:
        share = {g: min(1.0, SAMPLE * -(-n // target) / n) for g, n in large.items()}
        cut = F.create_map(*[F.lit(v) for g, s in share.items() for v in (g, int(s * (1 << 30)))])
        drawn = classes.where(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) < F.coalesce(F.try_element_at(cut, F.col("group")), F.lit(0)))
        wanted = {g: -(-n // target) for g, n in large.items()}

        def centroids(key: tuple, rows: pa.Table) -> pa.Table:
            x = _unit(_matrix(rows["embedding"]))
            c = centroids_of(x, wanted[key[0].as_py()]).astype(np.float32)
            return pa.table({"group": pa.array([key[0].as_py()] * len(c), pa.int64()), "centroid": pa.array(list(c), pa.list_(pa.float32()))})

        # a label's bounded sample is clustered in one task; CENTROIDS vectors come back in all, about
        for r in drawn.where(F.col("group").isin(list(large))).select("group", "embedding").groupBy("group").applyInArrow(centroids, "group long, centroid array<float>").collect():
            centres.setdefault(r["group"], []).append(r["centroid"])
        centres = {g: np.array(c, np.float32) for g, c in centres.items()}
    shared = spark.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            group = batch.column(1).to_numpy()
            cells: list[list[int]] = [[int(g)] for g in group]
            for g in set(np.unique(group).tolist()) & known.keys():
                own = np.flatnonzero(group == g)
                near = _nearest(_unit(_matrix(batch.column(2).take(pa.array(own)))).astype(np.float32), known[g], OVERLAP)
                for i, cs in zip(own.tolist(), near.tolist(), strict=True):
                    cells[i] = sorted((int(g) + 1 + c * 0x9E3779B97F4A7C15) % (1 << 63) for c in cs)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int64()))], names=["cid", "group", "embedding", "copies", "cells"])

    kind = classes.schema["embedding"].dataType.simpleString()
    placed = classes.select("cid", "group", "embedding", "copies").mapInArrow(run, f"cid binary, group long, embedding {kind}, copies long, cells array<long>")
    return scratch.table(placed, "placed").withColumn("cell", F.explode("cells"))


def _links(placed: DataFrame, effort: int, exact: bool = False) -> DataFrame:
    """(cid, root, links) per cell and block pair; with ``exact``, of all pairs of a cell."""
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("g"))
    own = F.pmod(F.xxhash64("cid"), F.col("g")).cast("int")
    rows = (
        placed.join(sizes, "cell")
        .withColumn("own", own)
        .select("cell", "own", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("j"), "cid", "embedding", "copies", "cells")
        .select("cell", F.least("own", "j").alias("bi"), F.greatest("own", "j").alias("bj"), "own", "cid", "embedding", "copies", "cells")
    )

    def judge(held: list[tuple]) -> pa.RecordBatch:
        cell, bi, bj = held[0][:3]
        unique = list({r[4]: r for r in held}.values())
        bits = found_bits(_unit(np.array([r[5] for r in unique], np.float64)), effort, exact)
        block = np.array([r[3] for r in unique])
        cells = np.full((len(unique), OVERLAP), -1, np.int64)
        for i, r in enumerate(unique):
            cells[i, : len(r[7])] = r[7]
        copies = np.array([r[6] for r in unique], np.int64)
        links = np.zeros(len(unique), np.int64)
        for a, b in pairs_of(bits):
            # a pair that shares several cells counts in the least of them; in a pair of blocks, across them
            common = np.full(len(a), np.iinfo(np.int64).max)
            for i in range(OVERLAP):
                same = (cells[a] == cells[b][:, i : i + 1]).any(axis=1) & (cells[b][:, i] >= 0)
                common = np.where(same, np.minimum(common, cells[b][:, i]), common)
            mine = (common == cell) & ((bi == bj) | (block[a] != block[b]))
            np.add.at(links, a[mine], copies[b[mine]])
        roots = roots_of(bits)
        size = np.bincount(roots, minlength=len(unique))
        out = [(unique[i][4], unique[roots[i]][4], int(links[i])) for i in range(len(unique)) if size[roots[i]] > 1]
        columns = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.binary(), pa.int64()), strict=True)], names=["cid", "root", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:3] != held[0][:3]:
                    yield judge(held)
                    held = []
                held.append(row)
        if held:
            yield judge(held)

    dealt = rows.repartition("cell", "bi", "bj").sortWithinPartitions("cell", "bi", "bj", "cid")
    return dealt.mapInArrow(run, "cid binary, root binary, links long")


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """Every vector with n_links, component_id and kept.

    ``embeddings``: vec_id, embedding, label; other columns are ignored. Vectors of one label and dimension
    are linked if their cosine is at least 0.98; null labels, null or zero vectors and such with null or
    non-finite components link with nothing. ``component_id`` is the least vec_id that links lead to, itself
    included. Equal vectors of a label are one class throughout, so copies cost one node; repeated rows are
    copies. An empty table gives an empty result. The search is approximate: an audit compares AUDIT queries, or
    more up to MOST_AUDIT until they have SEEN links, with all rows; the search must find RECALL of their links,
    else it is widened, and after that the labels that lose links are compared exactly, in blocks. No link
    below the cosine is ever returned.
    """
    scratch = Scratch(embeddings.sparkSession, "embeddings")
    h = [F.lpad(F.hex(F.xxhash64(F.lit(k), "label", "embedding")), 16, "0") for k in (1, 2)]
    named = embeddings.select("vec_id", "label", "embedding").withColumn(
        "cid", F.when(usable(F.col("embedding")) & F.col("label").isNotNull(), F.unhex(F.concat(*h)))
    )
    group = F.shiftrightunsigned(F.xxhash64("label", F.size("embedding")), 1)
    classes = scratch.table(
        named.where(F.col("cid").isNotNull()).groupBy("cid").agg(
            F.any_value(group).alias("group"), F.any_value("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("rep")
        ),
        "classes",
    )
    placed = _cells(classes, scratch)
    drawn, want = _audit(classes, scratch)
    for widened in range(WIDENED + 1):
        found = scratch.table(_links(placed, 1 << widened), f"links-{widened}")
        links = found.groupBy("cid").agg(F.sum("links").alias("links"))
        got = _found(drawn, links)
        if sum(min(g, w) for g, w in zip(got, want, strict=True)) >= RECALL * sum(want):
            break
    else:
        # what the graphs still miss is compared in blocks: exact, and quadratic in the labels concerned alone
        short = sorted({r["group"] for r, g, w in zip(drawn, got, want, strict=True) if g < w})
        again = classes.where(F.col("group").isin(short)).select("cid", "group", "embedding", "copies", F.array("group").alias("cells"), F.col("group").alias("cell"))
        others = found.join(classes.where(F.col("group").isin(short)).select("cid"), "cid", "left_anti")
        found = scratch.table(others.union(_links(again, 1, exact=True)), "links-exact")
        links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    scratch.drop("placed")
    roots = connected_components(found.select("cid", "root"), scratch, "components")
    reps = roots.join(classes.select(F.col("cid").alias("node"), "rep"), "node")
    least = reps.groupBy("root").agg(F.min("rep").alias("least"))
    component = reps.join(least, "root").select(F.col("node").alias("cid"), "least")
    known = classes.select("cid", "rep", "copies").join(links, "cid", "left").join(component, "cid", "left").select(
        F.col("cid").alias("_cid"), F.coalesce("least", "rep").alias("_component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("_links")
    )
    joined = named.select("vec_id", "cid").join(scratch.table(known, "known"), F.col("cid") == F.col("_cid"))
    # unusable vectors meet no join: as one null key they would meet in one task
    alone = named.where(F.col("cid").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return joined.select("vec_id", F.col("_links").cast("long").alias("n_links"), F.col("_component").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("_component")).alias("kept")).union(alone)


def _brute_counts(rows: DataFrame, vectors: list, labels: list, weight: str | None = None) -> dict[int, int]:
    """For each query, the rows of its label with a cosine of at least COSINE, itself included.

    ``rows``: embedding, label and the weight; all of them meet the few queries, which are broadcast. Tasks
    return one count per query.
    """
    shared = rows.sparkSession.sparkContext.broadcast((vectors, np.array(labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, labels = shared.value
        total = np.zeros(len(vectors), np.int64)
        size = np.array([len(v) for v in vectors])
        for batch in batches:
            own = batch.column(0).to_pylist()
            own_size, own_label, own_weight = np.array([len(v) for v in own]), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for d in set(own_size.tolist()) & set(size.tolist()):
                i, j = np.flatnonzero(size == d), np.flatnonzero(own_size == d)
                near = _unit(np.array([vectors[k] for k in i])) @ _unit(np.array([own[k] for k in j])).T >= COSINE
                total[i] += (near & (labels[i][:, None] == own_label[j][None, :])) @ own_weight[j]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vectors))), pa.array(total)], names=["i", "n"])

    w = F.col(weight) if weight else F.lit(1).cast("long")
    counts = rows.select("embedding", "label", w.alias("w")).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    return {r["i"]: r["n"] for r in counts.collect()}


def _audit(classes: DataFrame, scratch: Scratch) -> tuple[list, list[int]]:
    """Queries and the links that each has with all other classes, by brute force.

    More queries are drawn until they have SEEN links or are MOST_AUDIT, so that links that are rare show.
    """
    n, size = classes.count(), AUDIT
    while True:
        cut = int(min(1.0, 0.9 * size / max(n, 1)) * (1 << 30))
        drawn = classes.where(F.pmod(F.xxhash64(F.col("cid"), F.lit(5)), F.lit(1 << 30)) < cut).limit(size).select("cid", "group", "embedding", "copies").collect()
        if not drawn:
            return [], []
        counts = _brute_counts(classes.select("embedding", F.col("group").alias("label"), "copies"), [r["embedding"] for r in drawn], [r["group"] for r in drawn], "copies")
        want = [counts.get(i, r["copies"]) - r["copies"] for i, r in enumerate(drawn)]
        if sum(want) >= SEEN or size >= min(MOST_AUDIT, n):
            return drawn, want
        size *= 4


def _found(drawn: list, links: DataFrame) -> list[int]:
    """The links found of each query."""
    if not drawn:
        return []
    queries = links.sparkSession.createDataFrame([(bytes(r["cid"]),) for r in drawn], "cid binary")
    got = {bytes(r["cid"]): r["links"] for r in links.join(F.broadcast(queries), "cid", "left_semi").collect()}  # MOST_AUDIT rows at most
    return [got.get(bytes(r["cid"]), 0) for r in drawn]


def audit_recall(embeddings: DataFrame, result: DataFrame, divisor: int = 100, block: int = 512) -> tuple[int, int]:
    """Links found and links there are, of the vectors whose id is divisible by ``divisor``.

    Those queries meet all rows, ``block`` of them at a time; only counts per query come back.
    """
    ok = embeddings.where(usable(F.col("embedding")) & F.col("label").isNotNull())
    queries = ok.where(F.col("vec_id") % divisor == 0).select("vec_id", "label", "embedding").collect()
    got = {r["vec_id"]: r["n_links"] for r in result.where(F.col("vec_id") % divisor == 0).collect()}
    there = found = 0
    for a in range(0, len(queries), block):
        part = queries[a : a + block]
        counts = _brute_counts(ok, [r["embedding"] for r in part], [r["label"] for r in part])
        for i, r in enumerate(part):
            want = counts.get(i, 1) - 1  # itself
            there, found = there + want, found + min(got[r["vec_id"]], want)
    return found, there
