"""Quality rules with risk-controlled cutoffs, in DataFrame expressions only.

Four measures of a text are compared with cutoffs. A cutoff is not chosen by hand: labelled documents
held out for the purpose are counted per stratum (language), and a cutoff may be used there only if an
exact binomial test shows that it rejects at most its share of ``risk``, which is divided by the number of
measures, of the good documents. So all cutoffs of a stratum together reject at most a fraction ``risk`` of
them. The tests' level is divided by their number (Bonferroni), so this holds in all strata at once with
probability ``1 - delta``. A stratum with too few good documents proves nothing and so rejects nothing. The
other half of the labels takes no part in the choice and serves ``audit_rejections``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import Scratch, holds, let, members, word_array

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Words in a repeated window; a text of fewer words, or of more repeated ones, fails outright.
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: Candidate cutoffs per measure, all tested; a document is rejected above the cutoff.
CUTOFFS: dict[str, tuple[float, ...]] = {
    "symbol_ratio": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5, 2.0),
    "upper_ratio": (0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5),
    "dup_line_ratio": (0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "mean_word_chars": (8.0, 9.0, 10.0, 12.0, 15.0, 20.0),
}
#: Most false rejections that all measures together may cause in a stratum, as a share of its good documents
#: that pass the base rules, and the chance that any stratum's bound fails.
RISK, DELTA = 0.04, 0.05


def repeated_words(words: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur twice or more in the array, first ones included.

    Hashes of the windows are compared first; equal hashes lead to the windows themselves, so hashing
    never decides. All of it is one row's arrays: nothing is exploded or shuffled.
    """

    def combine(h: Column, step: int) -> Column:
        return let(h, lambda a: F.transform(F.slice(a, 1, F.greatest(F.size(a) - step, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(a, i + step))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = combine(combine(combine(hashes, 1), 2), 4)

    def neighbours(rows: Column, field: str) -> Column:
        """Rows that agree in ``field`` with the row before or after, of sorted rows."""
        return let(
            rows,
            lambda a: F.filter(
                a,
                lambda x, i: ((i > 0) & (F.get(a, i - 1)[field] == x[field])) | F.coalesce(F.get(a, i + 1)[field] == x[field], F.lit(False)),
            ),
        )

    def exact(h: Column) -> Column:
        suspects = neighbours(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("k"), i.alias("p")))), "k")
        spelled = F.array_sort(F.transform(suspects, lambda s: F.struct(F.array_join(F.slice(words, s["p"] + 1, WINDOW), " ").alias("k"), s["p"].alias("p"))))
        starts = F.array_sort(F.transform(neighbours(spelled, "k"), lambda s: s["p"]))
        return let(starts, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0).cast("long"), lambda acc, x: acc + x))

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(exact(h)))


def measures(documents: DataFrame, *keep: str) -> DataFrame:
    """The contract's counts and the rules' measures of each whole text, beside the ``keep`` columns.

    A null text has no words. Lines are split at ``\\n`` alone and compared whole.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    rows = documents.select(*keep, text.alias("_text"), word_array(F.col("text")).alias("_w"), lines.alias("_lines"))
    counts = rows.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_w") < WINDOW, F.lit(0).cast("long")).otherwise(let(F.col("_w"), repeated_words)).alias("n_repeat_words"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return counts.select(
        "*",
        ((F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))).alias("base_failed"),
        ratio("n_symbols", "n_words").alias("symbol_ratio"),
        ratio("n_upper", "word_chars").alias("upper_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("word_chars", "n_words").alias("mean_word_chars"),
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) exactly, by the terms' recurrence in logarithms; for k < n * p, else 1."""
    odds = math.log(p) - math.log1p(-p)
    start = F.struct((n.cast("double") * F.lit(math.log1p(-p))).alias("t"), F.lit(0.0).alias("s"))

    def add(a: Column, i: Column) -> Column:
        return F.struct((a["t"] + F.log((n - i).cast("double") / (i + 1).cast("double")) + F.lit(odds)).alias("t"), (a["s"] + F.exp(a["t"])).alias("s"))

    total = F.aggregate(F.sequence(F.lit(0).cast("long"), k), start, add, lambda a: a["s"])
    return F.when(k.cast("double") < n.cast("double") * F.lit(p), F.least(total, F.lit(1.0))).otherwise(F.lit(1.0))


def calibrate(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row (stratum, rule, cutoff) for each rule that may be used in a stratum, at ``risk`` / number of rules.

    ``labelled``: stratum, quality (0 or 1) and the measures of documents that passed the base rules; rows
    with another label or none are ignored. Of the certified cutoffs the one with the most bad less good
    documents rejected wins, of equal ones the loosest; one that rejects no more bad than good is not used.
    The table has at most (languages x rules) rows.
    """
    tall = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(float(cut)).alias("cutoff"), (F.col(rule) > F.lit(float(cut))).alias("out")) for rule, cuts in CUTOFFS.items() for cut in cuts])
    counted = (
        labelled.where(F.col("quality").isin(0, 1))
        .select("stratum", "quality", F.explode(tall).alias("r"))
        .groupBy("stratum", F.col("r.rule").alias("rule"), F.col("r.cutoff").alias("cutoff"))
        .agg(
            F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("n_good"),
            F.sum(F.when((F.col("quality") == 1) & F.col("r.out"), 1).otherwise(0)).alias("good_out"),
            F.sum(F.when((F.col("quality") == 0) & F.col("r.out"), 1).otherwise(0)).alias("bad_out"),
        )
    )
    tests = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    best = Window.partitionBy("stratum", "rule").orderBy((F.col("bad_out") - F.col("good_out")).desc(), F.col("cutoff").desc())
    return (
        counted.withColumn("n_tests", tests)
        .withColumn("p_value", binomial_tail(F.col("good_out"), F.col("n_good"), risk / len(CUTOFFS)))
        .where((F.col("p_value") <= F.lit(delta) / F.col("n_tests")) & (F.col("bad_out") > F.col("good_out")))
        .withColumn("_r", F.row_number().over(best))
        .where("_r = 1")
        .select("stratum", "rule", "cutoff", "n_good", "good_out", "bad_out", "p_value")
    )


def _half(labels: DataFrame, remainder: int) -> DataFrame:
    """doc_id and quality of the half of the labels whose crc32 of the id has this remainder."""
    own = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == remainder) & F.col("quality").isNotNull()
    return labels.where(own).groupBy("doc_id").agg(F.min("quality").alias("quality"))


def audit_rejections(judged: DataFrame, labels: DataFrame, risk: float = RISK) -> DataFrame:
    """Per stratum, on the half of the labels that chose no cutoff: good documents, those rejected, and a p-value.

    ``judged``: doc_id, stratum, base_failed, kept. ``p_value`` is the chance of as many rejections or more
    if a fraction ``risk`` of the good documents that pass the base rules were rejected; a small one speaks
    against the bound.
    """
    rows = judged.where(~F.col("base_failed")).join(_half(labels, 1).where("quality = 1"), "doc_id")
    counted = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), F.sum(F.when(F.col("kept"), 0).otherwise(1)).alias("good_out"))
    # as many or more out of n is n - k or fewer of the kept, which a fraction 1 - risk would be
    return counted.withColumn("p_value", F.when(F.col("good_out") == 0, F.lit(1.0)).otherwise(binomial_tail(F.col("n_good") - F.col("good_out"), F.col("n_good"), 1 - risk)))


def quality_rules(documents: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every document's counts, ``base_failed`` and ``kept``, after the ``carry`` columns.

    ``documents``: doc_id, text, lang; ``labels``: doc_id, quality. Other columns are ignored. Strata are
    the languages, null being one of its own. Calibration uses the labelled documents whose crc32 of the
    id is even and leaves the odd half for audits; all of that half, no sample. An id labelled twice counts
    with its lower label. Documents are measured once into a narrow scratch table, from which both passes
    read. Null or empty texts have no words and fail the base rules; repeated rows are judged alike; an
    empty table gives an empty result, an empty label table leaves only the base rules.
    """
    scratch = Scratch(documents.sparkSession, "quality")
    rows = documents.select("doc_id", "text", F.coalesce(F.col("lang"), F.lit("")).alias("stratum"), *carry)
    measured = scratch.table(measures(rows, "doc_id", "stratum", *carry), "measures")
    held = _half(labels, 0)
    chosen = calibrate(measured.where(~F.col("base_failed")).join(held, "doc_id"), risk, delta)
    # one row per language with a map rule -> cutoff, bounded by the number of languages
    cuts = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))
    cuts = scratch.table(cuts, "cutoffs", few=True)
    judged = measured.join(F.broadcast(cuts), "stratum", "left")
    over = F.lit(False)
    for rule in CUTOFFS:
        over = over | F.coalesce(F.col(rule) > F.try_element_at(F.col("cuts"), F.lit(rule)), F.lit(False))
    return judged.select(
        *carry, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~over).alias("kept"), "symbol_ratio", "upper_ratio", "dup_line_ratio", "mean_word_chars",
    )


def without_rejected(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents less the rows that the rules reject, all columns in place.

    A row is told by its id and its text's digest, so rows that share an id are judged each for itself. Rows
    that a filter of the rejected digests surely does not hold stay without being shuffled.
    """
    digest = lambda: F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    rows = documents.select("doc_id", "text", "lang", digest().alias("_digest"))
    judged = quality_rules(rows, labels, carry=("_digest",))
    scratch = Scratch(documents.sparkSession, "quality-rejected")
    rejected = scratch.table(judged.where("NOT kept").select(F.col("doc_id").alias("_id"), "_digest").distinct(), "rejected", few=True)
    told = holds(documents.withColumn("_key", digest()), "_key", members(rejected, "_digest"))
    doubtful = told.where("_held").join(rejected.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_digest")), "left_anti")
    return told.where("NOT _held").select(documents.columns).union(doubtful.select(documents.columns))
