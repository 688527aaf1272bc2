"""Row contracts: named rules, quarantine of the rows that break any, and counts by reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.cleaning import KEY_PATTERN


@dataclass(frozen=True)
class Rule:
    """A row passes where ``holds`` is true or, if ``nullable``, null."""

    name: str
    holds: Column
    nullable: bool = True

    def broken(self) -> Column:
        return F.coalesce(~self.holds, F.lit(not self.nullable))


def between(column: str, low: float, high: float) -> Rule:
    return Rule(f"{column}_in_range", F.col(column).between(low, high))


def snapshot_rules() -> list[Rule]:
    """The contract of a cleaned snapshot row; only the key may not be null."""
    return [
        Rule("cve_cartera_pattern", F.col("cve_cartera").rlike(KEY_PATTERN), nullable=False),
        between("anio", 2008, 2030),
        between("avance_fisico", 0, 100),
        between("latitud", 14.5, 32.8),
        between("longitud", -118.5, -86.7),
        Rule("monto_total_inversion_not_negative", F.col("monto_total_inversion") >= 0),
    ]


def judge(df: DataFrame, rules: Sequence[Rule], reasons: str = "reasons") -> DataFrame:
    """The rows with an array of the names of the rules that each breaks."""
    names = F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules])
    return df.withColumn(reasons, F.filter(names, lambda x: x.isNotNull()))


def split(judged: DataFrame, reasons: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """Valid rows, and quarantined rows with their reasons."""
    return judged.where(F.size(reasons) == 0).drop(reasons), judged.where(F.size(reasons) > 0)


def reason_counts(judged: DataFrame, by: Sequence[str] = (), reasons: str = "reasons") -> DataFrame:
    """Breaches by rule; a row that breaks two rules counts under both."""
    return judged.select(*by, F.explode(reasons).alias("reason")).groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n"))


def totals(judged: DataFrame, by: Sequence[str] = (), reasons: str = "reasons") -> DataFrame:
    """Rows in, valid and quarantined, and the valid share in percent."""
    valid = F.sum(F.when(F.size(reasons) == 0, 1).otherwise(0))
    rows = judged.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(valid, F.lit(0)).alias("n_valid"))
    share = F.round(F.try_divide(F.col("n_valid") * F.lit(100.0), F.col("n_rows")), 1)
    return rows.select(*by, "n_rows", "n_valid", (F.col("n_rows") - F.col("n_valid")).alias("n_quarantined"), share.alias("pct_valid"))


def _metrics(rules: Sequence[Rule], also: Sequence[str], reasons: str) -> list[Column]:
    """Rows, valid rows, sums of further columns and breaches of each rule; a rule's count is named after it."""
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    return [
        F.count(F.lit(1)).alias("n_rows"), count(F.size(reasons) == 0).alias("n_valid"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in also], *[count(F.array_contains(reasons, r.name)).alias(r.name) for r in rules],
    ]


def audit(judged: DataFrame, by: Sequence[str], rules: Sequence[Rule], also: Sequence[str] = (), reasons: str = "reasons") -> DataFrame:
    """Totals, sums of ``also`` and breaches by rule (a map, ``motivos``, of the rules broken) in one aggregate."""
    rows = judged.groupBy(*by).agg(*_metrics(rules, also, reasons))
    broken = F.map_filter(F.map_from_arrays(F.array(*[F.lit(r.name) for r in rules]), F.array(*[F.col(r.name) for r in rules])), lambda k, n: n > 0)
    share = F.round(F.try_divide(F.col("n_valid") * F.lit(100.0), F.col("n_rows")), 1)
    return rows.select(*by, "n_rows", "n_valid", (F.col("n_rows") - F.col("n_valid")).alias("n_quarantined"), share.alias("pct_valid"), *also, broken.alias("motivos"))


def observed(judged: DataFrame, rules: Sequence[Rule], also: Sequence[str] = (), reasons: str = "reasons") -> tuple[DataFrame, Observation]:
    """The rows, and their totals and breaches as metrics of the action that is run on them first: no pass of their own."""
    seen = Observation()
    return judged.observe(seen, *_metrics(rules, also, reasons)), seen


def overspent_share(df: DataFrame, spent: str, planned: str, tolerance: float = 0.05) -> DataFrame:
    """A metric, not a rule: how many rows spend more than planned beyond a tolerance."""
    known = df.where(F.col(spent).isNotNull() & F.col(planned).isNotNull())
    over = F.col(spent) > F.col(planned) * F.lit(1 + tolerance)
    return known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(over, 1).otherwise(0)), F.lit(0)).alias("n_over"))
