"""Byte-level BPE by corpus-level merge replay.

The distinct spellings of a batch are laid end to end and all of them are merged together: an inverted
index leads from a merge's rank to the positions where its pair stands, the lowest rank present is applied
at all its positions at once, and only the pairs that touch a merged position are looked up again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import small_batches

#: White space as Unicode defines it (Python's own class also holds four control characters).
_WS = "\t-\r \x85\xa0  -     　"
#: A text in units: a word with at most one space before it, or white space. No match of the tokenizer's
#: pattern crosses a unit's border, so a unit's ids depend on its spelling alone.
UNIT = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: Spellings remembered between batches, and characters handled together; both bound memory only.
REMEMBERED, CHUNK = 400_000, 16_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Replay:
    """Encodes by the ranks of a byte-level vocabulary and decodes again."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # every way to spell a token as two tokens is a pair that merges into it
        pairs = [(ranks[t[:i]] * self.size + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs.sort()
        self.pair_key = np.array([p[0] for p in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.pair_rank = np.array([p[1] for p in pairs] + [-1], np.int64)
        by_id = [b""] * self.size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.token_length = np.array([len(t) for t in by_id], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)
        digits = [b"%d " % i for i in range(self.size)]
        self.digit_length = np.array([len(d) for d in digits], np.int64)
        self.digit_start = np.cumsum(self.digit_length) - self.digit_length
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self._forget()

    def _forget(self) -> None:
        #: Number of each known spelling; its ids are flat[start:start + length].
        self.known: dict[str, int] = {}
        self.flat, self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], -1)

    def _replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and the piece's byte position of each."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(data)
        token = self.byte_id[data]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = np.cumsum([len(p) for p in pieces])
        after[ends - 1] = -1
        before[ends - np.array([len(p) for p in pieces])] = -1
        rank = np.full(n, -1, np.int64)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self._rank(token[inner], token[inner + 1])
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enter(positions: np.ndarray) -> None:
            r = rank[positions]
            held = r >= 0
            positions, r = positions[held], r[held]
            order = np.argsort(r, kind="stable")
            positions, r = positions[order], r[order]
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            firsts = r[np.concatenate([[0], cuts])].tolist() if len(r) else []
            for k, part in zip(firsts, np.split(positions, cuts), strict=False):
                if k in index:
                    index[k].append(part)
                else:
                    index[k] = [part]
                    heapq.heappush(queue, k)

        enter(inner)
        while queue:
            r = heapq.heappop(queue)
            parts = index.pop(r)
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            at = at[rank[at] == r]
            if len(parts) > 1:
                at = _sorted_set(at)
            if not len(at):
                continue
            if len(at) > 1:  # of overlapping pairs the leftmost merges, then every second one
                clash = after[at[:-1]] == at[1:]
                if clash.any():
                    run = np.arange(len(at))
                    start = np.where(np.concatenate([[True], ~clash]), run, 0)
                    at = at[(run - np.maximum.accumulate(start)) % 2 == 0]
            gone = after[at]
            beyond = after[gone]
            token[at] = r
            alive[gone] = False
            rank[gone] = -1
            after[at] = beyond
            linked = beyond >= 0
            before[beyond[linked]] = at[linked]
            left = before[at]
            touched = _sorted_set(np.concatenate([at, left[left >= 0]]))
            right = after[touched]
            has = right >= 0
            rank[touched[~has]] = -1
            touched, right = touched[has], right[has]
            rank[touched] = self._rank(token[touched], token[right])
            enter(touched)
        return token[alive], np.flatnonzero(alive)

    def learn(self, units: set[str]) -> None:
        """Adds the ids of new spellings, all replayed together."""
        spelled, pieces, lengths = list(units), [], []
        for u in spelled:
            if u.isalpha() or (u[0] == " " and u[1:].isalpha()):
                own = [u.encode("utf-8", "replace")]
            else:
                own = [p.encode("utf-8", "replace") for p in self.pattern.findall(u)]
            pieces += own
            lengths.append(sum(map(len, own)))
        if not pieces:
            return
        ids, at = self._replay(pieces)
        cuts = np.searchsorted(at, np.cumsum(lengths))
        own = np.diff(cuts, prepend=0)
        self.known.update(zip(spelled, range(len(self.start), len(self.start) + len(spelled)), strict=True))
        self.start = np.concatenate([self.start, cuts - own + len(self.flat)])
        self.length = np.concatenate([self.length, own])
        self.flat = np.concatenate([self.flat, ids])

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        if len(self.known) > REMEMBERED:
            self._forget()
        new: set[str] = set()
        for t in texts:
            new.update(UNIT.findall(t))
        new.difference_update(self.known.keys())
        self.learn(new)
        del new
        find = self.known.__getitem__
        for t in texts:
            units = np.array(list(map(find, UNIT.findall(t))), np.int64)
            yield _ragged(self.flat, self.start[units], self.length[units])

    def spell(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by spaces."""
        return _ragged(self.digits, self.digit_start[ids], self.digit_length[ids]).tobytes()[:-1]

    def decode(self, ids: np.ndarray) -> bytes:
        return _ragged(self.blob, self.token_start[ids], self.token_length[ids]).tobytes()


def _sorted_set(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) > 1 else values


def _ragged(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """values[start[i]:start[i] + length[i]] for every i, end to end."""
    ends = np.cumsum(length)
    return values[np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]


_REPLAYS: dict[tuple, Replay] = {}


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    a = total = 0
    for i, s in enumerate(sizes):
        if i > a and total + s > most:
            yield a, i
            a, total = i, 0
        total += s
    if len(sizes) > a:
        yield a, len(sizes)


def bpe_digests(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Token count, digest of the ids and digest of the decoded bytes of every whole text.

    ``documents``: doc_id, text; other columns are ignored. A null or empty text has no ids, so both
    digests are of the empty string. Repeated rows give repeated results; an empty table an empty one. The
    vocabulary is read on the driver and broadcast, its size being the file's. There is no shuffle: each
    task replays merges over its own distinct spellings, a bounded number of characters at a time, and a
    lost task is simply run again.
    """
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast((ranks_path, read_ranks(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, ranks = shared.value
        if (path, pattern) not in _REPLAYS:
            _REPLAYS[path, pattern] = Replay(ranks, pattern)
        replay = _REPLAYS[path, pattern]

        def encoded(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            texts = [t or "" for b in held for t in b.column(1).to_pylist()]
            counts, ids_sha, decoded_sha = [], [], []
            for a, b in _slices([len(t) for t in texts], CHUNK):
                for ids in replay.encode_all(texts[a:b]):
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(replay.spell(ids)).hexdigest())
                    decoded_sha.append(hashlib.sha256(replay.decode(ids)).hexdigest())
            own = pa.chunked_array([b.column(0) for b in held]).combine_chunks()
            return pa.RecordBatch.from_arrays([own, pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        held: list[pa.RecordBatch] = []
        for batch in batches:  # replayed together, whatever the session's batches are
            held.append(batch)
            if sum(b.nbytes for b in held) >= CHUNK:
                yield encoded(held)
                held = []
        if held:
            yield encoded(held)

    schema = T.StructType([documents.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return documents.select("doc_id", "text").mapInArrow(run, schema)
