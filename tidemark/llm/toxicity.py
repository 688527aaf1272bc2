"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words and their beginnings are hashed into an embedding table, whose rows add up to a word's vector, filters of several widths slide over the whole text, max pooling
keeps each filter's best answer and a logistic layer reads these. The decision threshold is calibrated by
language, which is guessed from the text's own function words, so a score depends on the text alone, and on
all labelled documents outside the fitting sample and the held-out fifth.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, id_remainder, small_batches, word_hashes

#: Rows of each class the weights are fitted on at most, and the longest text among them.
TRAINING_ROWS, TRAINING_CHARS = 2000, 50_000
#: Histogram bins of a logit's unit, and the labels of each class that a language needs for its own threshold.
BINS, LEAST = 100, 10
#: A word's beginnings of so many bytes have embeddings too, if it goes on beyond them.
PREFIXES = (4, 5, 6, 7, 8)
#: Embedding rows (0 pads), their width, filter widths, filters of each width, words handled at a time.
ROWS, WIDTH, WIDTHS, FILTERS, SEGMENT = 1 << 15, 16, (1, 2, 3), 16, 100_000
PAD = max(WIDTHS) - 1

# Common function words by which a text's language is guessed for its threshold.
FUNCTION_WORDS = {
    "de": "der die das und nicht ist den von mit ein im sich auch",
    "en": "the of and to is that for with was this are be",
    "es": "el los las que por con una del para como se su",
    "fr": "le les des est et que une dans pour du au sur",
}

#: Bytes that separate words: every ASCII byte but letters. Bytes of other characters belong to words.
_SEPARATOR = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def word_rows(text: str) -> np.ndarray:
    """Embedding rows of the lower-cased words of a whole text: a row per word, its columns add up."""
    h = word_hashes(text.lower().encode("utf-8", "replace"), _SEPARATOR, PREFIXES)
    return np.where(h == 0, 0, (h % np.uint64(ROWS - 1)).astype(np.int32) + 1).astype(np.int32)


def _padded(rows: np.ndarray) -> np.ndarray:
    """Rows with padding behind them; a text without words becomes one word of padding alone."""
    return np.concatenate([rows, np.zeros((PAD + (not len(rows)), 1 + len(PREFIXES)), np.int32)])


_GROUPS = {lang: np.unique(word_rows(words)[:, 0]) for lang, words in FUNCTION_WORDS.items()}


def language_group(rows: np.ndarray) -> str:
    """The language whose function words are most frequent; '' without any."""
    counts = {lang: int(np.isin(rows[:, 0], own).sum()) for lang, own in _GROUPS.items()}
    best = max(counts, key=lambda k: (counts[k], k))
    return best if counts[best] else ""


@dataclass
class ToxicityModel:
    embedding: np.ndarray
    filters: list[np.ndarray]  # (width, WIDTH, FILTERS) each
    shifts: list[np.ndarray]
    top: np.ndarray
    bias: float = 0.0

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Each filter's largest answer over a whole text, in segments that overlap by PAD words."""
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, np.float32)
        rows = _padded(rows)
        for at in range(0, max(len(rows) - PAD, 1), SEGMENT):
            x = self.embedding[rows[at : at + SEGMENT + PAD]].sum(axis=1)
            n = max(len(x) - PAD, 1)
            for k, w in enumerate(self.filters):
                out = sum(x[i : i + n] @ w[i] for i in range(len(w)))
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                best[part] = np.maximum(best[part], out.max(axis=0) + self.shifts[k])
        return np.maximum(best, 0.0)

    def logit(self, rows: np.ndarray) -> float:
        return float(self.pooled(rows) @ self.top + self.bias)


def best_threshold(counts: dict[int, tuple[int, int]]) -> float:
    """The cut of largest F1 through a histogram, bin -> (clean, toxic); midway to the next bin below."""
    bins = np.array(sorted(counts, reverse=True))
    clean, toxic = (np.array([counts[b][c] for b in bins.tolist()], np.float64) for c in (0, 1))
    hit = np.cumsum(toxic)
    best = int(np.argmax(2 * hit / (np.cumsum(clean + toxic) + toxic.sum())))
    below = bins[best + 1] + 1 if best + 1 < len(bins) else bins[best] - BINS
    return float((bins[best] + below) / 2 / BINS)


def thresholds(histogram: list[tuple[str, int, int, int]]) -> dict[str | None, float]:
    """Threshold of each language group with LEAST labels of both classes, and under None that of all others.

    ``histogram``: (group, toxic, bin, documents).
    """
    by: dict[str | None, dict[int, tuple[int, int]]] = {None: {}}
    for group, toxic, b, n in histogram:
        for g in (group, None):
            clean, bad = by.setdefault(g, {}).get(b, (0, 0))
            by[g][b] = (clean + n * (not toxic), bad + n * bool(toxic))
    out = {}
    for g, counts in by.items():
        total = np.array(list(counts.values()) or [(0, 0)]).sum(axis=0)
        if total.min() >= (1 if g is None else LEAST):
            out[g] = best_threshold(counts)
    return out


def fit(texts: list[str], labels: list[int], epochs: int = 12, batch: int = 32, rate: float = 0.08, seed: int = 11) -> ToxicityModel:
    """Adagrad on the log loss.

    Words of fewer than three training documents stay at the zero embedding. One embedding column starts
    at the words' smoothed log odds, so few labels suffice to point the filters at telling words.
    """
    rng = np.random.default_rng(seed)
    docs = [word_rows(t) for t in texts]
    y = np.array(labels, np.float32)
    used = rng.permutation(len(docs))
    df = np.zeros((2, ROWS))
    for i in used:
        df[int(y[i]), np.unique(docs[i])] += 1
    size = np.array([[max((y[used] == 0).sum(), 1)], [max((y[used] == 1).sum(), 1)]])
    rate_by = (df + 0.5) / (size + 1)
    known = df.sum(axis=0) >= min(3, len(used))
    e = rng.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32)
    e[:, 0] = np.clip(np.log(rate_by[1] / rate_by[0]), -4, 4) / 4
    e[~known] = 0.0
    e[0] = 0.0
    filters = [rng.normal(0, 0.3, (w, WIDTH, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w in filters:
        w[:, 0, : FILTERS // 2] = np.abs(w[:, 0, : FILTERS // 2]) + 0.5
    model = ToxicityModel(e, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32))
    if not len(used) or not 0 < y[used].sum() < len(used):
        model.top[:] = 0.0
        model.bias = -5.0 if not y.sum() else 5.0
        return model
    g_e, g_top, g_bias = np.full(ROWS, 1e-6, np.float32), np.full(model.top.shape, 1e-6, np.float32), 1e-6
    g_w, g_s = [np.full(w.shape, 1e-6, np.float32) for w in filters], [np.full(FILTERS, 1e-6, np.float32) for _ in WIDTHS]
    balance = np.where(y == 1, 0.5 / max(y[used].mean(), 1e-3), 0.5 / max(1 - y[used].mean(), 1e-3))
    for _ in range(epochs):
        turn = rng.permutation(used)
        for a in range(0, len(turn), batch):
            ids = turn[a : a + batch]
            rows = np.concatenate([_padded(docs[i]) for i in ids])
            size = np.array([max(len(docs[i]), 1) + PAD for i in ids])
            ends = np.cumsum(size)
            begins = ends - size
            x = e[rows].sum(axis=1)
            pooled, where = np.empty((len(ids), len(WIDTHS) * FILTERS), np.float32), np.empty((len(ids), len(WIDTHS) * FILTERS), np.int64)
            n = len(rows) - PAD
            for k, w in enumerate(filters):
                out = sum(x[i : i + n] @ w[i] for i in range(len(w)))
                for d, (b, stop) in enumerate(zip(begins, ends, strict=True)):
                    own = out[b : stop - PAD]
                    at = own.argmax(axis=0)
                    where[d, k * FILTERS : (k + 1) * FILTERS] = at + b
                    pooled[d, k * FILTERS : (k + 1) * FILTERS] = own[at, np.arange(FILTERS)]
                pooled[:, k * FILTERS : (k + 1) * FILTERS] += model.shifts[k]
            active = pooled > 0
            h = np.where(active, pooled, 0.0)
            z = h @ model.top + model.bias
            dz = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[ids]) * balance[ids] / len(ids)).astype(np.float32)
            d_top = h.T @ dz + 1e-4 * model.top
            dh = np.where(active, dz[:, None] * model.top, 0.0).astype(np.float32)
            touched, moves = [], []
            for k, w in enumerate(filters):
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                dk, at = dh[:, part], where[:, part]
                for i in range(len(w)):
                    r = np.minimum(at + i, len(rows) - 1)
                    dw = np.einsum("bfd,bf->df", x[r], dk) + 1e-4 * w[i]
                    touched.append(rows[r].ravel())
                    moves.append(np.repeat((dk[:, :, None] * w[i].T[None]).reshape(-1, WIDTH), rows.shape[1], axis=0))
                    g_w[k][i] += dw * dw
                    w[i] -= rate * dw / np.sqrt(g_w[k][i])
                ds = dk.sum(axis=0)
                g_s[k] += ds * ds
                model.shifts[k] -= rate * ds / np.sqrt(g_s[k])
            at, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            de = np.zeros((len(at), WIDTH), np.float32)
            np.add.at(de, inverse, np.concatenate(moves))
            de[~known[at] | (at == 0)] = 0.0
            g_e[at] += (de * de).sum(axis=1)
            e[at] -= rate * de / np.sqrt(g_e[at])[:, None]
            g_top += d_top * d_top
            model.top -= rate * d_top / np.sqrt(g_top)
            g_bias += float(dz.sum()) ** 2
            model.bias -= rate * float(dz.sum()) / g_bias**0.5
    return model


def _usable(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of the labels outside the held-out fifth."""
    own = F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), 5) != 0)
    return labels.where(own).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _fitted(cuts: dict[int, int]) -> Column:
    """Whether a labelled document's weights are fitted on it; all others serve the thresholds."""
    cut = F.coalesce(*[F.when(F.col("toxic") == c, F.lit(cut)) for c, cut in cuts.items()], F.lit(0))
    drawn = lambda seed, n: F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(n))
    return (drawn(77, 1 << 30) < cut) & (drawn(78, 5) != 0)


def train(documents: DataFrame, labels: DataFrame) -> tuple[ToxicityModel, dict[int, int]]:
    """A model of ``text`` and ``toxic`` of at most TRAINING_ROWS labelled documents a class, and the draw's cuts."""
    usable = _usable(labels)
    sizes = {int(r["toxic"]): r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    cuts = {c: int(min(1.0, 0.9 * TRAINING_ROWS / n if n > TRAINING_ROWS else 1.0) * (1 << 30)) for c, n in sizes.items()}
    texts, own = [], []
    for toxic in sorted(sizes):
        ids = usable.where((F.col("toxic") == toxic) & _fitted(cuts)).select("doc_id").limit(TRAINING_ROWS)
        found = (
            documents.where(F.col("text").isNotNull() & (F.length("text") <= TRAINING_CHARS))
            .select("doc_id", "text")
            .join(F.broadcast(ids), "doc_id")  # TRAINING_ROWS ids at most
            .limit(2 * TRAINING_ROWS)
            .toArrow()
        )
        rows = sorted(zip(found["doc_id"].to_pylist(), found["text"].to_pylist(), strict=True))
        texts += [t for _, t in rows]
        own += [toxic] * len(rows)
    return fit(texts, own), cuts


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with held_out, score and predicted.

    ``documents``: doc_id, text; ``labels``: doc_id, toxic; other columns are ignored. A null or empty text
    is scored as a text without words; an id labelled twice counts as toxic if either label says so; with
    no label of one class every score is that of the other. Repeated rows are scored alike; an empty table
    gives an empty result. One pass over the texts gives each a logit and the language group that its words
    suggest, in a narrow scratch table; the thresholds come from a histogram of the logits of all labelled
    documents on which no weight was fitted, held-out ones excepted.
    """
    small_batches(documents.sparkSession)
    model, cuts = train(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = [word_rows(t or "") for t in batch.column(2).to_pylist()]
            logit = np.array([model.logit(r) for r in rows], np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.clip(logit, -30, 30)), pa.array([language_group(r) for r in rows], pa.string())], names=["doc_id", "held_out", "logit", "group"])

    rows = documents.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("logit", T.DoubleType()), T.StructField("group", T.StringType())])
    scored = Scratch(documents.sparkSession, "toxicity").table(rows.mapInArrow(run, schema), "logits")
    apart = scored.join(_usable(labels).where(~_fitted(cuts)), "doc_id")
    bins = apart.groupBy("group", "toxic", F.floor(F.col("logit") * BINS).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    at = thresholds([(r["group"], int(r["toxic"]), r["bin"], r["n"]) for r in bins.collect()])  # 60 * BINS bins a group and class at most
    cut = F.coalesce(*[F.when(F.col("group") == g, F.lit(t)) for g, t in at.items() if g is not None], F.lit(at.get(None, 0.0)))
    score = 1 / (1 + F.exp(cut - F.col("logit")))
    return scored.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
