"""N-gram Jaccard join: a MinHash LSH forest proposes, exact verification decides.

1. Every text becomes the set of its 5-word shingles; equal sets are one class from here on.
2. A class has a label of DEPTH min-hashes in each of TREES prefix tries. Classes whose labels share a
   prefix meet in one task, sorted by label; there prefixes are shortened from the whole label on, level by
   level, and at each level what shares a prefix and is not connected yet is compared, by all min-hashes. A
   class stops at the prefix length that finds TARGET of its partners at a similarity of 0.8, however near the
   partners are that it has; one that has none by then is searched once more with prefixes of SHORTEST.
3. Pairs whose min-hashes agree like those of similar sets connect their classes; connected classes form
   clusters, and inside a cluster every pair is verified exactly on the shingles. So a pair missed by the
   forest is still found if any path of similar texts joins it.

Large trie nodes and large clusters are dealt out as pairs of blocks; no step emits a row per pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, holds, members, mix64, word_hashes
from tidemark.llm.components import connected_components, local_roots

#: Words in a shingle, and the similarity as a fraction: links have intersection / union >= 4 / 5.
SHINGLE, SIMILAR = 5, (4, 5)
TREES, DEPTH, SHORTEST = 16, 8, 5
HASHES = TREES * DEPTH
#: Share of the partners of a similarity of 0.8 that a class's last prefix length must find in some trie.
TARGET = 0.99
#: Equal hash bytes of 128 that make a candidate: five deviations below what a similarity of 0.8 gives.
AGREE = 80
#: Members of a trie node, and of a cluster, that one task compares at a time.
NODE, BLOCK = 1024, 512
#: Large trie nodes up to which their table is broadcast, 3 MB; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 200_000

#: Prefix lengths that all classes are searched with, longest first: 8, 7 and 6, the first to reach TARGET.
LEVELS = tuple(d for d in range(DEPTH, SHORTEST, -1) if 1 - (1 - (SIMILAR[0] / SIMILAR[1]) ** (d + 1)) ** TREES < TARGET)

_rng = np.random.default_rng(20240607)
_MULTIPLY = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    A text of one to four words is a single shingle of all its words; one without words has none.
    """
    h = word_hashes((text or "").encode("utf-8", "replace"))
    if not len(h):
        return h
    n = max(len(h) - SHINGLE + 1, 1)
    out = np.full(n, min(len(h), SHINGLE), np.uint64)
    for k in range(min(SHINGLE, len(h))):
        out = (out ^ h[k : k + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
    return np.unique(mix64(out))


def set_id(shingles: np.ndarray) -> bytes:
    """128-bit digest of a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(sets: list[np.ndarray], piece: int = 1 << 16) -> np.ndarray:
    """HASHES min-hashes of each set, as uint32; sets must not be empty."""
    out = np.empty((len(sets), HASHES), np.uint32)
    a = 0
    while a < len(sets):
        b, n = a, 0
        while b < len(sets) and (b == a or n + len(sets[b]) <= piece):
            n += len(sets[b])
            b += 1
        x = (np.concatenate(sets[a:b]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *[len(s) for s in sets[a : b - 1]]])
        v = np.empty_like(x)
        for j in range(HASHES):
            np.bitwise_xor(x, _XOR[j], out=v)
            np.multiply(v, _MULTIPLY[j], out=v)
            v ^= v >> np.uint32(16)
            out[a:b, j] = np.minimum.reduceat(v, starts)
        a = b
    return out


def _digest() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _named(column: str) -> Column:
    """An id as a key that is never null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _sketch(documents: DataFrame, digest: Column) -> DataFrame:
    """doc_id, digest, cid (the class), label (the tries' labels) and low (a byte per hash); no class without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, texts = batch.columns
            for at in range(0, len(batch), 256):
                sets = [shingle_set(t) for t in texts.slice(at, 256).to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = signatures([sets[i] for i in full]) if full else np.empty((0, HASHES), np.uint32)
                low = ((sig * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
                cid, label, byte = ([None] * len(sets) for _ in range(3))
                for k, i in enumerate(full):
                    cid[i], label[i], byte[i] = set_id(sets[i]), sig[k].astype(">u4").tobytes(), low[k].tobytes()
                yield pa.RecordBatch.from_arrays([ids.slice(at, 256), digests.slice(at, 256), pa.array(cid, pa.binary()), pa.array(label, pa.binary()), pa.array(byte, pa.binary())], names=["doc_id", "digest", "cid", "label", "low"])

    rows = documents.select("doc_id", digest.alias("digest"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, digest binary, cid binary, label binary, low binary")


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """A binary column whose values all have ``width`` bytes as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _alike(low: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether AGREE or more hash bytes of each of ``x`` and each of ``y`` (indices into low) are equal."""
    lanes = (low[x][:, None, :] == low[y][None, :, :]).view(np.uint64).sum(axis=2)  # eight sums of 16 bits at most
    return (lanes * np.uint64(0x0101010101010101)) >> np.uint64(56) >= AGREE


def node_components(low: np.ndarray, side: np.ndarray | None = None, root: np.ndarray | None = None, open_: np.ndarray | None = None) -> np.ndarray:
    """Least member of each member's component under the links of all pairs whose min-hashes agree.

    With ``side``, only pairs of different sides are compared; with ``open_``, only those of an open member.
    ``root``: components known before. A pair is skipped only if links found before connect it, so a group of
    near copies costs about one comparison a member.
    """
    m = len(low)
    root = np.arange(m) if root is None else root
    open_, alive = np.ones(m, bool) if open_ is None else open_.copy(), np.ones(m, bool)
    while True:
        rest, pool = np.flatnonzero(open_), np.flatnonzero(alive)
        if not len(rest) or len(pool) < 2 or (side is not None and (side[pool] == side[pool[0]]).all()):
            return root
        count = np.bincount(root[rest], minlength=m)
        top = int(count.argmax())
        own, other = (rest[root[rest] == top], pool[root[pool] != top]) if count[top] >= 32 else (rest, pool)
        if side is not None:
            own, other = own[side[own] == side[own[0]]], other[side[other] != side[own[0]]]
        if len(other):
            own = own[:64]
        open_[own] = alive[own] = False
        for at in range(0, len(other), 2048):
            part = other[at : at + 2048]
            for i, ok in zip(own, _alike(low, own, part), strict=True):
                met = np.unique(root[np.append(part[ok], i)])
                if len(met) > 1:
                    moved = np.arange(m)
                    moved[met] = met[0]
                    root = moved[root]


def node_links(labels: np.ndarray, low: np.ndarray, side: np.ndarray | None = None, open_: np.ndarray | None = None, levels: tuple[int, ...] = LEVELS) -> np.ndarray:
    """Component of each member of one trie node: its least member that links lead to.

    ``labels``: (m, bytes) big-endian hashes as bytes, sorted. Prefixes are shortened level by level; at each,
    the members of a prefix are compared as far as links do not connect them yet. No member is left out for
    having a partner already.
    """
    m = len(labels)
    root = np.arange(m)
    for depth in levels:
        prefix = labels[:, : 4 * depth]
        change = np.flatnonzero((prefix[1:] != prefix[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), m], strict=True):
            if b - a < 2 or (root[a:b] == root[a]).all():
                continue
            _, first, at = np.unique(root[a:b], return_index=True, return_inverse=True)
            before = first[at]
            after = node_components(low[a:b], None if side is None else side[a:b], before, None if open_ is None else open_[a:b])
            joined = np.flatnonzero(after != before)
            if len(joined):
                # whole components move, members outside this prefix included
                merged = np.array(local_roots(m, root[a + joined], root[a + after[joined]]))
                root = merged[root]
    return root


def _candidates(classes: DataFrame, scratch: Scratch, levels: tuple[int, ...], name: str) -> DataFrame:
    """Edges (a, b) that connect the classes of a trie node that look similar.

    ``classes``: cid, label, low, and open, which says whose partners are sought. Nodes of one member, and
    those of no open one, are known from a count of narrow rows; what the filter of all others rejects is not
    shuffled with its hashes.
    """
    step, width, shortest = 4 * DEPTH, 4 * levels[0], 4 * levels[-1]
    tries = classes.select("cid", "low", "label", "open", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        "cid", "low", "open", F.xxhash64("tree", F.expr(f"substring(label, tree * {step} + 1, {shortest})")).alias("node"), F.expr(f"substring(label, tree * {step} + 1, {width})").alias("own")
    )
    nodes = tries.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.bool_or("open").alias("asked")).where("n > 1 AND asked").select("node", "n")
    nodes = scratch.table(nodes, f"{name}-nodes", few=True)
    hot = nodes.where(F.col("n") > NODE)
    n_hot = hot.count()
    tries = holds(tries, "node", members(nodes, "node")).where("_held").drop("_held").withColumn("side", F.lit(0).cast("byte"))
    if n_hot:
        # a large node is dealt out as pairs of blocks, so every two of its members meet in one task
        side = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
        g = F.coalesce(F.ceil(F.col("n") / F.lit(NODE)), F.lit(1).cast("long"))
        rows = tries.join(side, "node", "left").select("cid", "low", "open", "own", "node", g.alias("g"), F.pmod(F.xxhash64("cid"), g).alias("block"))
        rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("j"))
        pair = F.xxhash64("node", F.least("block", "j"), F.greatest("block", "j"))
        tries = rows.select(
            "cid", "low", "open", "own", F.when(F.col("g") == 1, F.col("node")).otherwise(pair).alias("node"),
            F.when(F.col("block") == F.col("j"), 0).when(F.col("block") < F.col("j"), 1).otherwise(2).cast("byte").alias("side"),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links(node: np.ndarray, cid: np.ndarray, own: np.ndarray, low: np.ndarray, side: np.ndarray, open_: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(node[1:] != node[:-1]) + 1
            begin, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(node)]])
            two = begin[end - begin == 2]
            hit = two[(low[two] == low[two + 1]).sum(axis=1) >= AGREE]
            a, b = [cid[hit]], [cid[hit + 1]]
            many = np.flatnonzero(end - begin > 2)
            for s, t in zip(begin[many].tolist(), end[many].tolist(), strict=True):
                roots = node_links(own[s:t], low[s:t], side[s:t] if side[s:t].all() else None, open_[s:t], levels)
                moved = np.flatnonzero(roots != np.arange(t - s))
                a.append(cid[s + moved])
                b.append(cid[s + roots[moved]])
            return pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in np.concatenate(v)], pa.binary()) for v in (a, b)], names=["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            node = batch.column(0).to_numpy()
            part = (node, _fixed(batch.column(1), 16), _fixed(batch.column(2), width), _fixed(batch.column(3), HASHES), batch.column(4).to_numpy(), batch.column(5).to_numpy(zero_copy_only=False))
            last = int(np.searchsorted(node != node[-1], False)) if node[0] == node[-1] else int(np.flatnonzero(node != node[-1])[-1]) + 1
            if last and held:  # the run that was open ends in this batch
                held.append(tuple(p[:last] for p in part))
                yield links(*(np.concatenate(p) for p in zip(*held, strict=True)))
                held = []
            elif last:
                yield links(*(p[:last] for p in part))
            if held and held[-1][0][-1] != node[-1]:
                yield links(*(np.concatenate(p) for p in zip(*held, strict=True)))
                held = []
            held.append(tuple(p[last:] for p in part))
        if held:
            yield links(*(np.concatenate(p) for p in zip(*held, strict=True)))

    dealt = tries.select("node", "cid", "own", "low", "side", "open").repartition("node").sortWithinPartitions("node", "own", "cid")
    return dealt.mapInArrow(run, "a binary, b binary")


def _forest(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Candidate edges of all classes: by prefixes down to the target recall, and shorter ones for those without a partner."""
    near = scratch.table(_candidates(classes.withColumn("open", F.lit(True)), scratch, LEVELS, "near"), "near")
    scratch.drop("near-nodes")
    met = near.select(F.explode(F.array("a", "b")).alias("_met")).distinct()
    asked = classes.join(met, F.col("cid") == F.col("_met"), "left").select("cid", "label", "low", F.col("_met").isNull().alias("open"))
    far = scratch.table(_candidates(scratch.table(asked, "asked"), scratch, (SHORTEST,), "far"), "far")
    scratch.drop("far-nodes", "asked")
    return near.union(far)


def verified_links(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether each member of ``first`` and each of ``second`` (indices into sets) are similar, exactly."""
    if len(first) == 1 and len(second) == 1:
        common = len(np.intersect1d(sets[first[0]], sets[second[0]], assume_unique=True))
        inter = np.array([[common]])
    else:
        members = np.unique(np.concatenate([first, second]))
        flat = np.concatenate([sets[i] for i in members])
        owner = np.repeat(np.arange(len(members)), [len(sets[i]) for i in members])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        new = np.concatenate([[True], flat[1:] != flat[:-1]])
        column = np.cumsum(new) - 1
        shared = np.bincount(column)[column] > 1  # what one member alone holds is in no intersection
        column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
        at = {m: k for k, m in enumerate(members.tolist())}
        f, s = np.array([at[i] for i in first.tolist()]), np.array([at[i] for i in second.tolist()])
        inter = np.zeros((len(first), len(second)), np.int64)
        n, wide = (int(column[-1]) + 1 if len(column) else 0), max(256, 4_000_000 // len(members))
        for a in range(0, n, wide):
            i, j = np.searchsorted(column, [a, a + wide])
            x = np.zeros((len(members), min(wide, n - a)), np.float32)
            x[owner[i:j], column[i:j] - a] = 1.0
            inter += np.rint(x[f] @ x[s].T).astype(np.int64)
    size = np.array([len(x) for x in sets])
    union = size[first][:, None] + size[second][None, :] - inter
    return inter * SIMILAR[1] >= union * SIMILAR[0]


def _verify(documents: DataFrame, classes: DataFrame, clusters: DataFrame, scratch: Scratch) -> DataFrame:
    """(cid, root, links, whole): links of a class found in a block pair and its least linked class there."""
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    found = clusters.join(sizes, "root").join(classes.select(F.col("cid").alias("node"), "rep", "copies"), "node")
    found = scratch.table(found.select(F.col("node").alias("cid"), "root", "rep", "copies", F.ceil(F.col("n") / BLOCK).cast("int").alias("g"), _named("rep").alias("named")), "members", few=True)
    own = F.pmod(F.xxhash64("cid"), F.col("g")).cast("int")
    # hardly any text but the members' gets past the filter, so those alone are shuffled
    texts = holds(documents.select(F.col("doc_id").alias("_id"), "text", _named("doc_id").alias("_named")), "_named", members(found, "named"))
    rows = (
        texts.where("_held").drop("_held", "_named")
        .join(found.drop("named").hint("merge"), F.col("_id").eqNullSafe(F.col("rep")))
        .withColumn("own", own)
        .select("root", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("j"), "own", "g", "cid", "copies", "text")
        .select("root", F.least("own", "j").alias("bi"), F.greatest("own", "j").alias("bj"), "own", "g", "cid", "copies", "text")
    )

    def judge(rows: list[tuple]) -> list[tuple[bytes, bytes, int, bool]]:
        _, bi, bj = rows[0][:3]
        seen: dict[bytes, tuple] = {}
        for r in rows:
            if r[5] not in seen:
                s = shingle_set(r[7])
                if set_id(s) == r[5]:  # another text under a repeated id is not this class
                    seen[r[5]] = (s, r[3], r[6], r[4])
        cids = sorted(seen)
        sets = [seen[c][0] for c in cids]
        block = np.array([seen[c][1] for c in cids])
        copies = np.array([seen[c][2] for c in cids])
        if len(cids) < 2:
            return []
        first, second = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
        if not len(first) or not len(second):
            return []
        links = np.zeros(len(cids), np.int64)
        left, right = [], []
        if len(cids) == 2 and bi == bj:
            if verified_links(sets, first[:1], second[1:])[0, 0]:
                links += copies[::-1]
                left, right = [0], [1]
        else:
            ok = verified_links(sets, first, second)
            if bi == bj:
                np.fill_diagonal(ok, False)
                links[first] += ok @ copies[second]
            else:
                links[first] += ok @ copies[second]
                links[second] += copies[first] @ ok
            x, y = np.nonzero(ok)
            left, right = first[x], second[y]
        roots = local_roots(len(cids), left, right)
        whole = rows[0][4] == 1
        return [(cids[i], cids[roots[i]], int(links[i]), whole) for i in range(len(cids)) if links[i]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:3] != held[0][:3]:
                    out += judge(held)
                    held = []
                held.append(row)
            if out:
                yield _links_batch(out)
        if held and (out := judge(held)):
            yield _links_batch(out)

    # a group's key decides the task; its rows are contiguous there
    dealt = rows.repartition("root", "bi", "bj").sortWithinPartitions("root", "bi", "bj", "cid")
    return dealt.mapInArrow(run, "cid binary, root binary, links long, whole boolean")


def _links_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["cid", "root", "links", "whole"])


def _grouped(documents: DataFrame, digest: Column, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The sketches, and of each class its class_id, n_links, first row and whether it stays for its group.

    The first row is the one of least id and, of that, least digest; one class of each group stays.
    """
    sketched = scratch.table(_sketch(documents, digest), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")).alias("first")
    classes = sketched.where(F.col("cid").isNotNull()).groupBy("cid").agg(first, F.count(F.lit(1)).alias("copies"), F.any_value("label").alias("label"), F.any_value("low").alias("low"))
    classes = classes.select("cid", F.col("first.doc_id").alias("rep"), F.col("first.digest").alias("digest"), "copies", "label", "low")
    classes = scratch.table(classes, "classes")
    clusters = scratch.table(connected_components(_forest(classes, scratch), scratch, "clusters"), "clusters", few=True)
    scratch.drop("near", "far")
    found = scratch.table(_verify(documents, classes, clusters, scratch), "links")
    scratch.drop("clusters", "members")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    split = connected_components(found.where(~F.col("whole")).select("cid", "root"), scratch, "split")
    roots = found.where("whole").select(F.col("cid").alias("node"), "root").union(split)
    named = roots.join(classes.select(F.col("cid").alias("node"), "rep"), "node")
    least = named.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("nameless"), "rep", "node")).alias("least"))
    linked = named.join(least, "root").select(F.col("node").alias("cid"), F.col("least.rep").alias("least"), (F.col("node") == F.col("least.node")).alias("stays")).join(links, "cid", "left")
    known = classes.select("cid", "rep", "digest", "copies").join(linked, "cid", "left").select(
        F.col("cid").alias("_cid"), F.coalesce("least", "rep").alias("class_id"), "rep", F.col("digest").alias("_digest"), F.coalesce("stays", F.lit(True)).alias("stays"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    known = scratch.table(known, "known")
    scratch.drop("links", "classes")
    return sketched, known


def jaccard_join(documents: DataFrame) -> DataFrame:
    """Every document with class_id, n_links and kept.

    ``documents``: doc_id, text; other columns are ignored. Two documents are linked if the Jaccard
    similarity of their sets of 5-word shingles is at least 0.8; ``n_links`` counts a document's partners,
    copies included. ``class_id`` is the least doc_id that links lead to, itself included; ``kept`` marks
    the document of that id. Words are maximal runs of anything but space, tab, and line, vertical or form
    breaks, compared as they are. A text of one to four words is one shingle; a null, empty or blank text
    links with nothing and is its own class. Repeated rows are copies of each other. A null id counts as a
    document but names a class only if no other id can. An empty table gives an empty result.
    """
    scratch = Scratch(documents.sparkSession, "jaccard")
    sketched, known = _grouped(documents, F.lit(None).cast("binary"), scratch)
    joined = sketched.select("doc_id", "cid").join(known, F.col("cid") == F.col("_cid"))
    # texts without words meet no join: as one null key they would meet in one task
    alone = sketched.where(F.col("cid").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"))
    return joined.select("doc_id", "class_id", F.col("n_links").cast("long").alias("n_links"), F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")).union(alone)


def one_of_each_group(documents: DataFrame) -> DataFrame:
    """The documents less all but one row of each group of near-duplicates, a row of the group's least id.

    A row is told by its id and its text's digest, so rows that share an id, or have none, are judged each for
    itself. Of equal rows of a group one stays; texts without words are no one's copies and all stay.
    """
    scratch = Scratch(documents.sparkSession, "jaccard-keep")
    sketched, known = _grouped(documents, _digest(), scratch)
    first = F.col("stays") & F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("digest") == F.col("_digest"))
    rows = sketched.select("doc_id", "digest", "cid").join(known, F.col("cid") == F.col("_cid")).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_text"), first.alias("first"))
    # the rows that go are fewer than those that stay
    marked = rows.groupBy("_id", "_text").agg(F.bool_or("first").alias("first"), F.count(F.lit(1)).alias("n")).where("NOT first OR n > 1")
    marked = scratch.table(marked, "marked", few=True)
    twice = not marked.where("first").isEmpty()
    told = holds(documents.withColumn("_key", _digest()), "_key", members(marked, "_text"))
    rest = told.where("NOT _held").select(documents.columns)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_text"))
    doubtful = told.where("_held").drop("_held")
    kept = rest.union(doubtful.join(marked.select("_id", "_text").hint("merge"), same, "left_anti").select(documents.columns))
    if not twice:
        return kept
    once = doubtful.join(marked.where("first").select("_id", "_text").hint("merge"), same, "left_semi").dropDuplicates(["doc_id", "_key"])
    return kept.union(once.select(documents.columns))
