"""Exact repeated passages of ``width`` bytes, removed by suffix and common-prefix arrays.

Sorting the suffixes of a whole corpus in one place is out of the question, so equal strings are brought
together first. Every window of ``width`` bytes has an anchor, the GRAM-byte string of least hash inside it;
equal windows have equal anchors. Neighbouring windows with one anchor form a context. Anchors seen once need
no further look. The contexts of the others are dealt to shards by anchor, so all occurrences of a string that
repeats are in one shard, where the suffix array decides. A context that occurs several times enters its
shard twice: further copies decide nothing.

An anchor with more contexts than a shard should hold is split by content: its windows are halved by their
distance from it, and those of a half are dealt out by all the bytes that every one of them must hold. Halves
are halved again until they are small or single windows, of which equal ones are one row. So no shard grows
with the number of documents that share a passage, and no two equal windows are parted.

All steps are keyed by content (digests of texts, anchors, contexts), so copies of a text cost one row.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, holds, members, mix64
from tidemark.llm.suffix_sort import Space, repeated_windows, suffix_array

#: Bytes of a repeated string, bytes of an anchor, bytes of text handled at a time.
WIDTH, GRAM, SEGMENT = 400, 32, 1 << 19
#: Target bytes of a shard, and the bytes of one anchor's contexts beyond which they are split.
SHARD, HOT = 2 << 20, 4 << 20
#: Bytes of a shard's contexts that a task holds in memory before they go to a file of its own.
SPOOL = 32 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling."""
    h = mix64(b.astype(np.uint64) + np.uint64(1))
    size, base = 1, int(_STEP)
    while size < GRAM:
        h = h[:-size] * np.uint64(base) + h[size:]
        base = base * base % (1 << 64)
        size *= 2
    return mix64(h)


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from the running minima of blocks of that size."""
    n = len(v) - width + 1
    blocks = -(-len(v) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(v)] = v
    grid = padded.reshape(blocks, width)
    forth = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], forth[width - 1 : width - 1 + n])


def contexts(parts: list[np.ndarray], width: int = WIDTH) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(part, anchor, first window, windows, repetitions, anchor's distance from the first window) of the contexts of several byte strings.

    Equal contexts that follow each other at a stride of their length, as in a text of one repeated word,
    come as one with repetitions. Windows never span parts.
    """
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes) - sizes
    data = np.concatenate(parts) if parts else np.empty(0, np.uint8)
    if len(data) < width:
        return
    h = gram_hashes(data)
    bits = np.uint64(max(int(len(data)).bit_length(), 1))
    least = _sliding_least((h >> bits << bits) | np.arange(len(h), dtype=np.uint64), width - GRAM + 1)
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), sizes)[: len(anchor)]
    fits = np.arange(len(anchor)) + width <= (begins + sizes)[owner]
    start = np.flatnonzero(fits)
    if not len(start):
        return
    own = anchor[start]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)])
    at = np.flatnonzero(new)
    first, count = start[at], np.diff(at, append=len(start))
    off = (own[at] - first).tolist()
    key, part = h[own[at]].view(np.int64), owner[start[at]]
    # stretches of equal anchors at a stride of their window count are candidates for one row
    chained = (key[1:] == key[:-1]) & (part[1:] == part[:-1]) & (count[1:] == count[:-1]) & (first[1:] == first[:-1] + count[:-1])
    raw = data.tobytes() if chained.any() else b""
    i, n = 0, len(at)
    chained = np.append(chained, False).tolist()
    first_, count_, key_, part_ = first.tolist(), count.tolist(), key.tolist(), part.tolist()
    begins_ = begins.tolist()
    while i < n:
        j, f, c = i, first_[i], count_[i]
        if chained[i]:
            body = raw[f : f + c + width - 1]
            while chained[j] and raw[first_[j + 1] : first_[j + 1] + c + width - 1] == body:
                j += 1
        yield part_[i], key_[i], f - begins_[part_[i]], c, j - i + 1, off[i]
        i = j + 1


def _anchors(texts: DataFrame, width: int) -> DataFrame:
    """Per document: digest of the text and its contexts; documents below ``width`` bytes have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for at in range(0, len(batch), 128):
                texts = [(t or "").encode("utf-8", "replace") for t in column.slice(at, 128).to_pylist()]
                found: list[list[dict]] = [[] for _ in texts]
                for owners, bases, parts in _segments(texts, width):
                    for part, anchor, first, windows, times, off in contexts(parts, width):
                        i, first = owners[part], first + bases[part]
                        body = texts[i][first : first + windows + width - 1]
                        found[i].append({"anchor": anchor, "context": hashlib.blake2b(body, digest_size=16).digest(), "first": first, "windows": windows, "times": times, "off": off})
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 128), pa.array([hashlib.sha256(t).digest()[:16] for t in texts], pa.binary()), pa.array(found, _FOUND)], names=["doc_id", "digest", "found"]
                )

    rows = texts.select("doc_id", "text").where(F.octet_length("text") >= width)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, digest binary, found array<struct<anchor: long, context: binary, first: long, windows: int, times: int, off: int>>")


_FOUND = pa.list_(pa.struct([("anchor", pa.int64()), ("context", pa.binary()), ("first", pa.int64()), ("windows", pa.int32()), ("times", pa.int32()), ("off", pa.int32())]))
_RUNS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def _segments(texts: list[bytes], width: int = WIDTH) -> Iterator[tuple[list[int], list[int], list[np.ndarray]]]:
    """Texts gathered, and long ones cut, to about SEGMENT bytes: owners, offsets and byte strings.

    A long text's pieces overlap by width - 1 bytes, so each window lies in exactly one.
    """
    owners: list[int] = []
    bases: list[int] = []
    parts: list[np.ndarray] = []
    total = 0
    for i, t in enumerate(texts):
        b = np.frombuffer(t, np.uint8)
        for base in range(0, max(len(b) - width + 1, 0), SEGMENT):
            piece = b[base : base + SEGMENT + width - 1]
            if parts and total + len(piece) > SEGMENT:
                yield owners, bases, parts
                owners, bases, parts, total = [], [], [], 0
            owners.append(i)
            bases.append(base)
            parts.append(piece)
            total += len(piece)
    if parts:
        yield owners, bases, parts


class ShardText:
    """A shard's contexts, in memory or beyond SPOOL in a file, and their suffix array.

    A context that occurs more than once is written twice, so that the suffix array finds it repeated.
    Contexts are joined by a symbol that no text holds.
    """

    def __init__(self, width: int = WIDTH) -> None:
        self.width = width
        self.spool = tempfile.SpooledTemporaryFile(max_size=SPOOL)
        self.names: list[tuple] = []
        self.lengths: list[int] = []
        self.again: list[bool] = []

    def add(self, name: tuple, body: bytes, again: bool) -> None:
        """Contexts come sorted by name; one that came before is left out."""
        if self.names and self.names[-1] == name:
            return
        self.spool.write(body)
        self.names.append(name)
        self.lengths.append(len(body))
        self.again.append(again)

    def repeats(self) -> Iterator[tuple[tuple, list[tuple[int, int]]]]:
        """Per context, the runs [begin, end) of windows that begin elsewhere in the shard too, if any."""
        with self.spool, Space() as space:
            text = space.array(sum((n + 1) * (1 + twice) for n, twice in zip(self.lengths, self.again, strict=True)) + 1, np.uint16)
            self.spool.seek(0)
            k = 0
            for n, twice in zip(self.lengths, self.again, strict=True):
                body = np.frombuffer(self.spool.read(n), np.uint8)
                for _ in range(1 + twice):
                    text[k : k + n] = body
                    text[k : k + n] += 1
                    text[k + n] = 257  # above every byte
                    k += n + 1
            text[k] = 0
            suffixes, common = suffix_array(text, space, 258, self.width)
            repeated = repeated_windows(suffixes, common, self.width, space)
            del text, suffixes, common
            k = 0
            for name, n, twice in zip(self.names, self.lengths, self.again, strict=True):
                own = np.concatenate([[False], repeated[k : k + n - self.width + 1], [False]])
                k += (n + 1) * (1 + twice)
                edge = np.flatnonzero(own[1:] != own[:-1]).tolist()
                if edge:
                    yield name, list(zip(edge[::2], edge[1::2], strict=True))


def _decide(rows: DataFrame, key: str, width: int) -> DataFrame:
    """(key, context, runs) from rows (shard, key, context, body, again), by one suffix array a shard.

    A task takes as many shards as fit a partition, one after the other.
    """
    dealt = rows.select("shard", key, "context", "body", "again").repartition("shard").sortWithinPartitions("shard", key, "context")
    kind = dealt.schema[key].dataType.simpleString()

    def judge(shard: ShardText) -> Iterator[pa.RecordBatch]:
        hit = [(k, context, [{"begin": a, "end": b} for a, b in runs]) for (k, context), runs in shard.repeats()]
        for at in range(0, len(hit), 4096):
            columns = zip(*hit[at : at + 4096], strict=True)
            kinds = (pa.int64() if kind == "bigint" else pa.binary(), pa.binary(), _RUNS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[key, "context", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, ShardText(width)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != number:
                    if number is not None:
                        yield from judge(shard)
                    number, shard = row[0], ShardText(width)
                shard.add((row[1], row[2]), row[3], row[4])
        if number is not None:
            yield from judge(shard)

    return dealt.mapInArrow(run, f"{key} {kind}, context binary, runs array<struct<begin: int, end: int>>")


def _shard(key: str, volume: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(max(1, -(-volume // SHARD)))).cast("int")


def _bytes(again: str, width: int) -> Column:
    """Bytes that a context takes in its shard."""
    return (F.col("windows") + width) * F.when(F.col(again), 2).otherwise(1)


def _split(hot: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    """(anchor, context, runs) of the contexts of hot anchors: rows (anchor, context, off, windows, again, body).

    Level by level, a key's windows are halved by their distance from the anchor. A half's key is what all
    its windows hold, so equal windows stay together; what remains hot is halved again. Of a level's equal
    parts one goes on, and a narrow table leads from it to where it was found.
    """
    now = hot.select(
        "anchor", F.unhex(F.lpad(F.hex("anchor"), 16, "0")).alias("key"), "context", "off", "windows", "again", "body",
        F.lit(GRAM - width).alias("low"), F.lit(0).alias("high"),
    )
    level, decided = 0, []
    while True:
        level += 1
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        near = F.greatest(F.lit(0), F.least(F.col("windows"), F.col("middle") + F.col("off") + 1))
        halves = F.array(
            F.struct(F.lit(0).alias("shift"), F.col("near").alias("windows"), F.col("low").alias("low"), F.col("middle").alias("high")),
            F.struct(F.col("near").alias("shift"), (F.col("windows") - F.col("near")).alias("windows"), (F.col("middle") + 1).alias("low"), F.col("high").alias("high")),
        )
        each = (
            now.withColumn("middle", middle).withColumn("near", near)
            .select("anchor", F.col("key").alias("of_key"), F.col("context").alias("of_context"), "off", "again", "body", F.explode(halves).alias("h"))
            .where("h.windows > 0")
            .select("anchor", "of_key", "of_context", "again", "h.*", F.col("off"), "body")
        )
        held = F.substring(F.col("body"), F.col("off") + F.col("high") + 1, F.col("low") + width - F.col("high"))
        part = F.substring(F.col("body"), F.col("shift") + 1, F.col("windows") + (width - 1))
        each = each.select(
            "anchor", "of_key", "of_context", "again", "shift", "windows", "low", "high", (F.col("off") - F.col("shift")).alias("off"),
            F.unhex(F.md5(F.concat(F.concat_ws(",", "low", "high", F.lit("")).cast("binary"), held))).alias("key"), part.alias("body"),
        ).withColumn("context", F.unhex(F.md5("body")))
        each = scratch.table(each, f"halves-{level}")
        scratch.table(each.select("key", "context", "of_key", "of_context", "shift", "anchor"), f"where-{level}")
        found = each.groupBy("key", "context").agg(
            *[F.any_value(c).alias(c) for c in ("anchor", "off", "windows", "low", "high", "body")], (F.sum(F.when(F.col("again"), 2).otherwise(1)) > 1).alias("again")
        )
        found = scratch.table(found, f"parts-{level}")
        scratch.drop(f"halves-{level}", f"again-{level - 1}")
        load = found.groupBy("key").agg(F.sum(F.when(F.col("again"), 2).otherwise(1)).alias("n"), F.sum(_bytes("again", width)).alias("bytes"), F.max("high").alias("h"), F.max("low").alias("l"))
        load = scratch.table(load.where("n > 1").select("key", "bytes", ((F.col("bytes") > HOT) & (F.col("l") < F.col("h"))).alias("hot")), f"load-{level}")
        kept = found.join(load.select(F.col("key").alias("_key"), "hot"), F.col("key") == F.col("_key")).drop("_key")
        volume = load.where("NOT hot").agg(F.sum("bytes")).first()[0] or 0
        decided.append(scratch.table(_decide(kept.where("NOT hot").withColumn("shard", _shard("key", volume)), "key", width), f"part-runs-{level}"))
        if load.where("hot").isEmpty():
            break
        now = scratch.table(kept.where("hot").drop("hot"), f"again-{level}")
        scratch.drop(f"parts-{level}", f"load-{level}")
    runs = None
    for k in range(level, 0, -1):
        own = decided[k - 1] if runs is None else decided[k - 1].union(runs)
        where = scratch.spark.read.parquet(f"{scratch.root}/where-{k}")
        moved = where.join(own, ["key", "context"]).select("anchor", "of_key", "of_context", F.transform("runs", lambda r: F.struct((r["begin"] + F.col("shift")).cast("int").alias("begin"), (r["end"] + F.col("shift")).cast("int").alias("end"))).alias("runs"))
        merged = moved.groupBy("of_key", "of_context").agg(F.any_value("anchor").alias("anchor"), F.flatten(F.collect_list("runs")).alias("runs"))
        merged = scratch.table(merged.withColumnsRenamed({"of_key": "key", "of_context": "context"}), f"up-{k}")
        runs = merged.select("key", "context", "runs")
    return merged.select("anchor", "context", "runs")


def cut(data: bytes, hits: list[dict], width: int = WIDTH) -> tuple[bytes, int, int]:
    """The bytes that no repeated window covers, how many go, and in how many runs."""
    edge = np.zeros(len(data) + 1, np.int32)
    for hit in hits:
        # repetitions stand at a stride of the context's windows, so their runs may touch
        at = hit["first"] + hit["windows"] * np.arange(hit["times"])
        for r in hit["runs"]:
            np.add.at(edge, at + r["begin"], 1)
            np.add.at(edge, at + r["end"] - 1 + width, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def _cut_rows(rows: DataFrame, width: int) -> DataFrame:
    """(row, text, n_removed, n_spans, kept_sha256) from rows (row, text, hits).

    Removal may cut a character, whose remaining bytes then go from the text; the digest is of all bytes kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                b = batch.slice(at, 128)
                out: list[tuple] = []
                for text, hits in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    kept, removed, spans = cut((text or "").encode("utf-8", "replace"), hits or [], width)
                    out.append((kept.decode("utf-8", "ignore") if hits else text, removed, spans, hashlib.sha256(kept).hexdigest()))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=["row", "text", "n_removed", "n_spans", "kept_sha256"])

    fields = [T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    return rows.select("row", "text", "hits").mapInArrow(run, T.StructType([rows.schema["row"], *fields]))


def _digest() -> Column:
    return F.substring(F.unhex(F.sha2("text", 256)), 1, 16)


def _bodies(documents: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The wanted contexts with their bytes, read from their texts.

    ``wanted``: digest, rep and a list of contexts. Only the rows of representatives match, and of other
    texts hardly one gets past the filter, so those alone are shuffled; both sides, at any size, as lists of
    contexts grow with the texts.
    """
    texts = documents.select(F.col("doc_id").alias("_id"), "text").where(F.octet_length("text") >= width).withColumn("_digest", _digest())
    texts = holds(texts, "_digest", members(wanted, "digest")).where("_held").drop("_held")
    joined = texts.join(wanted.hint("merge"), (F.col("_digest") == F.col("digest")) & F.col("_id").eqNullSafe(F.col("rep")))
    each = joined.select("text", F.explode("wanted").alias("w"))
    return each.select("w.*", F.substring(F.col("text").cast("binary"), F.col("w.first").cast("int") + 1, F.col("w.windows") + (width - 1)).alias("body"))


def find_repeats(documents: DataFrame, scratch: Scratch, width: int = WIDTH) -> DataFrame:
    """(digest, hits) of the texts that lose bytes: the runs of repeated windows in their contexts."""
    found = _anchors(documents, width).groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("found").alias("found"))
    texts = scratch.table(found.where(F.size("found") > 0), "texts")
    each = texts.select("digest", "rep", "copies", F.explode("found").alias("c")).select("digest", "rep", (F.col("copies") * F.col("c.times")).cast("long").alias("n"), "c.*")
    shared = each.groupBy("anchor").agg(F.sum("n").alias("t")).where(F.col("t") > 1).select(F.col("anchor").alias("_a"))
    suspects = scratch.table(each.join(shared, F.col("anchor") == F.col("_a")).drop("_a"), "suspects")
    scratch.drop("texts")
    one = suspects.groupBy("anchor", "context").agg(F.sum("n").alias("n"), F.min(F.struct("digest", "rep", "first", "windows", "off")).alias("at"))
    one = scratch.table(one.select("anchor", "context", (F.col("n") > 1).alias("again"), "at.*"), "contexts")
    load = one.groupBy("anchor").agg(F.sum(_bytes("again", width)).alias("bytes"))
    hot = scratch.table(load.where(F.col("bytes") > HOT), "hot-anchors", few=True)
    total, heat = one.agg(F.sum(_bytes("again", width))).first()[0] or 0, hot.agg(F.sum("bytes")).first()[0] or 0

    def bodies(contexts: DataFrame, name: str) -> DataFrame:
        listed = contexts.groupBy("digest", "rep").agg(F.collect_list(F.struct("anchor", "context", "first", "windows", "off", "again")).alias("wanted"))
        return _bodies(documents, scratch.table(listed, name), width)

    hot_anchors = hot.select(F.col("anchor").alias("_a"))
    cold = one.join(hot_anchors, F.col("anchor") == F.col("_a"), "left_anti") if heat else one
    decided = scratch.table(_decide(bodies(cold, "wanted").withColumn("shard", _shard("anchor", total - heat)), "anchor", width), "decided")
    if heat:
        held = bodies(one.join(hot_anchors, F.col("anchor") == F.col("_a"), "left_semi"), "wanted-hot")
        decided = decided.union(_split(scratch.table(held, "hot-bodies"), scratch, width))
    scratch.drop("wanted")
    hits = suspects.join(decided, ["anchor", "context"]).groupBy("digest").agg(F.collect_list(F.struct("first", "windows", "times", "runs")).alias("hits"))
    hits = scratch.table(hits, "hits")
    scratch.drop("suspects", "contexts", "decided")
    return hits


def _stripped(documents: DataFrame, others: list[str], width: int) -> tuple[DataFrame, DataFrame]:
    """Rows (row, text, n_removed, n_spans, kept_sha256) that may lose bytes, and the rows (row, text) that do not."""
    scratch = Scratch(documents.sparkSession, "repeats")
    hits = find_repeats(documents, scratch, width)
    row = F.struct(*[F.col(c) for c in others]).alias("row")
    keyed = holds(documents.select(row, "text", _digest().alias("_d")), "_d", members(hits, "digest"))
    touched = keyed.where("_held").join(hits.hint("merge"), F.col("_d") == F.col("digest"), "left").select("row", "text", "hits")
    return _cut_rows(touched, width), keyed.where("NOT _held").select("row", "text")


def remove_repeats(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every document with n_bytes, n_removed, n_spans, kept_sha256 and the text that is left.

    ``documents``: doc_id, text; other columns are ignored. A byte goes if a string of ``width`` bytes that
    covers it begins anywhere else in the table too, in the same document included; strings are judged on the
    input, so overlapping ones all count, and none spans documents. Null texts count as empty. Shorter texts
    keep everything. Repeated rows are documents of their own, so equal texts of ``width`` bytes and more
    lose everything. A cut may leave part of a character; n_removed and kept_sha256 count bytes, ``text``
    leaves such a part out. An empty table gives an empty result.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    touched, rest = _stripped(rows, ["doc_id", "n_bytes"], width)
    rest = rest.select("row", "text", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    return touched.union(rest).select("row.doc_id", "row.n_bytes", "n_removed", "n_spans", "kept_sha256", "text")


def without_repeats(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, all columns in place, with ``text`` less its repeated passages and ``n_chars`` to match.

    Null and empty texts, and rows that repeat an id or have none, are taken as by ``remove_repeats``; a null
    text stays null. An empty table gives an empty result.
    """
    others = [c for c in documents.columns if c != "text"]
    touched, rest = _stripped(documents, others, width)
    size = F.when(F.col("row.n_chars").isNotNull(), F.length("text").cast("long")) if "n_chars" in others else None
    rows = touched.select("row", "text").union(rest)
    return rows.select(*["text" if c == "text" else (size if c == "n_chars" else F.col(f"row.{c}")).alias(c) for c in documents.columns])
