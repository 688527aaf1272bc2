"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader (FTRL-proximal) under an elastic-net penalty, whose l1 part
keeps most weights at exactly zero, then calibrated by one temperature on documents kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_sample, id_remainder, small_batches

#: Rows a model is fitted on at most, and the longest text among them; prediction has no such bound.
TRAINING_ROWS, TRAINING_CHARS = 3000, 50_000
#: Hashed features, n-gram lengths, and the characters of a text handled at a time.
BUCKETS, ORDERS, SEGMENT = 1 << 16, (1, 2, 3), 2_000_000
UNDETERMINED = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter, for all of Unicode."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed character n-grams of a whole text; None if it has no letter.

    Letters are lower-cased, every run of other characters counts as one space. Long texts are counted in
    segments: each takes over the last two characters kept before it, and whether a letter came last.
    """
    counts, seen = np.zeros(BUCKETS, np.int64), False
    text, before, letter_last = text.lower(), np.empty(0, np.uint32), True
    for at in range(0, len(text), SEGMENT):
        c = np.frombuffer(text[at : at + SEGMENT].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[c]
        seen = seen or bool(letter.any())
        kept = np.where(letter, c, np.uint32(32))[letter | np.concatenate([[letter_last], letter[:-1]])]
        letter_last, c, found = bool(letter[-1]), np.concatenate([before, kept]), []
        for n in ORDERS:
            h = np.full(max(len(c) - n + 1, 0), n, np.uint32)
            for k in range(n):
                h = (h ^ c[k : k + len(h)]) * np.uint32(0x01000193) + np.uint32(0x9E3779B9 * n % (1 << 32))
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            found.append((h >> np.uint32(16))[max(0, len(before) - n + 1) :])
        counts += np.bincount(np.concatenate(found), minlength=BUCKETS)
        before = c[-2:]
    return counts if seen else None


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf[at]
        return x / max(float(np.sqrt(x @ x)), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text) if text else None
        if counts is None or not self.languages:
            return UNDETERMINED, 0.0
        at = np.flatnonzero(counts)
        p = _softmax((self.features(at, counts[at]) @ self.weights[at] + self.bias) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(texts: list[str], langs: list[str], epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, seed: int = 7) -> LanguageModel:
    """FTRL-proximal over shuffled documents, then the temperature of least log loss on every fifth one."""
    rows = []
    for t, lang in zip(texts, langs, strict=True):
        if t and (c := ngram_counts(t)) is not None:
            at = np.flatnonzero(c)
            rows.append((at.astype(np.int32), c[at].astype(np.int32), lang))
    languages = sorted({r[2] for r in rows})
    if not rows:
        return LanguageModel([], np.ones(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0))
    label = np.array([languages.index(r[2]) for r in rows])
    df = np.zeros(BUCKETS)
    for at, _, _ in rows:
        df[at] += 1
    model = LanguageModel(languages, np.log((1 + len(label)) / (1 + df)) + 1.0, np.zeros((BUCKETS, len(languages))), np.zeros(len(languages)))
    order = np.random.default_rng(seed).permutation(len(label))
    aside = set(order[::5].tolist()) if len(label) >= 50 else set()
    features = [(at, model.features(at, c).astype(np.float32)) for at, c, _ in rows]
    del rows
    z, n = np.zeros((BUCKETS + 1, len(languages))), np.zeros((BUCKETS + 1, len(languages)))

    def weights(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for i in order:
            if i in aside:
                continue
            at, x = np.append(features[i][0], BUCKETS), np.append(features[i][1], 1.0)
            w = weights(at)
            g = _softmax(x @ w)
            g[label[i]] -= 1.0
            g = x[:, None] * g
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / alpha * w
            n[at] = new
    w = weights(np.arange(BUCKETS + 1))
    model.weights, model.bias = w[:-1], w[-1]
    if aside:
        held = np.array(sorted(aside))
        logits = np.array([features[i][1] @ model.weights[features[i][0]] + model.bias for i in held])
        grid = np.geomspace(0.2, 5.0, 60)
        loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), label[held]], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def train(documents: DataFrame) -> LanguageModel:
    """A model of ``text`` and non-null ``lang`` of documents outside the held-out third."""
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (id_remainder(F.col("doc_id"), 3) != 1))
    sample = bounded_sample(rows.where(F.length("text") <= TRAINING_CHARS).select("doc_id", "lang", "text"), "doc_id", TRAINING_ROWS).toArrow()
    order = np.argsort([str(d) for d in sample["doc_id"].to_pylist()], kind="stable")  # rows arrive in any order
    texts, langs = sample["text"].to_pylist(), sample["lang"].to_pylist()
    return fit([texts[i] for i in order], [langs[i] for i in order])


def predict(documents: DataFrame, model: LanguageModel, *keep: str) -> DataFrame:
    """``keep`` columns with held_out, lang_pred and score for every whole text, in one pass, no shuffle."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(t) for t in batch.column(len(keep) + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*keep, "held_out", "lang_pred", "score"],
            )

    rows = documents.select(*keep, (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def in_known_language(documents: DataFrame, least: float) -> DataFrame:
    """The documents, all columns in place, whose predicted language has a score of at least ``least``.

    Each text goes to Python once and comes back once if its row stays. A null, empty or letterless text goes;
    equal texts are judged alike, whatever their ids.
    """
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(train(documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = (model.predict(t) for t in part.column(1).to_pylist())
                yield part.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in found], pa.bool_()))

    others = F.struct(*[c for c in documents.columns if c != "text"]).alias("row")
    rows = documents.select(others, "text")
    return rows.mapInArrow(run, rows.schema).select(*["text" if c == "text" else F.col(f"row.{c}").alias(c) for c in documents.columns])


def identify_languages(documents: DataFrame) -> DataFrame:
    """Every document with held_out, lang_pred and score.

    ``documents``: doc_id, text, lang; other columns are ignored, and lang serves training alone. A null,
    empty or letterless text is ``und`` with score 0; so is every text if no labelled one exists. Repeated
    rows are predicted alike; an empty table gives an empty result.
    """
    return predict(documents, train(documents), "doc_id")
