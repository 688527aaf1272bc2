"""Declarative data-quality checks. Each returns the rows that fail; none failing means an empty frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, nulls left out if alone, with their number."""
    rows = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Values outside the accepted ones, with their number; null is accepted."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent; null needs none."""
    keys = parent.select(F.col(parent_column).alias("_p"))
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_p"), "left_anti").select(column)


def unflagged_fall(df: DataFrame, level: str, before: str, flag: str) -> DataFrame:
    """Rows whose level fell without their flag saying so."""
    return df.where((F.col(level) < F.col(before)) & ~F.col(flag))


def unstable_counts(counts: DataFrame, group: str, order: str, quarter: str, count: str, partial: str, drop: float = -0.70, least: int = 5) -> DataFrame:
    """Groups whose count fell by ``drop`` or more since their previous cut.

    Small groups, cuts that cover part of the universe on either side, and the step from a fourth to a
    first quarter are left out.
    """
    w = Window.partitionBy(group).orderBy(F.col(order).asc_nulls_last())
    rows = counts.select("*", F.lag(count).over(w).alias("_n"), F.lag(quarter).over(w).alias("_q"), F.lag(partial).over(w).alias("_p"))
    change = (F.col(count) - F.col("_n")) / F.col("_n").cast("double")
    kept = rows.where(F.col("_n").isNotNull() & (F.col("_n") >= least) & ~F.col(partial) & ~F.col("_p") & ~((F.col(quarter) == 1) & (F.col("_q") == 4)) & (change <= drop))
    return kept.select(group, order, F.col("_n").alias(f"{count}_anterior"), count, F.round(change * 100, 1).alias("pct_cambio"))


@dataclass(frozen=True)
class Check:
    """A named check; ``warn`` ones are reported and never stop anything."""

    name: str
    failures: DataFrame
    severity: str = "error"


def run_checks(checks: Sequence[Check]) -> list[tuple[str, str, int]]:
    """(name, severity, failing rows) of every check; raises after all ran if one of severity error fails."""
    found = [(c.name, c.severity, c.failures.count()) for c in checks]
    failed = [f"{name}: {n} rows" for name, severity, n in found if n and severity == "error"]
    if failed:
        raise AssertionError("data-quality checks failed: " + "; ".join(failed))
    return found
