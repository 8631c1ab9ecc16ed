"""The result of every destructive operator: what is kept, what is rejected and why, and counts of both."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Split(NamedTuple):
    """``tagged`` holds all rows with their reason (null: kept), so that both sides can be used in one pass."""

    kept: DataFrame
    rejected: DataFrame
    stats: DataFrame
    tagged: DataFrame
    reason: str = "removal_reason"


def by_reason(tagged: DataFrame, reason: str = "removal_reason") -> Split:
    """Split a frame by its reason column: null is kept. Both sides and the counts share one lineage.

    Who uses more than one of them writes ``tagged`` first (``plans.pipeline`` does), or aggregates it."""
    stats = tagged.groupBy(F.coalesce(F.col(reason), F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("records"))
    return Split(tagged.where(F.col(reason).isNull()).drop(reason), tagged.where(F.col(reason).isNotNull()), stats, tagged, reason)


def first_rule(*rules: tuple[Column, str | Column]) -> Column:
    """Reason of the first rule that holds, null if none does."""
    out = F.when(F.lit(False), F.lit(""))
    for holds, reason in rules:
        out = out.when(F.coalesce(holds, F.lit(False)), F.lit(reason) if isinstance(reason, str) else reason)
    return out


def removal_summary(rejected: DataFrame, table: str, total: int | Column, reason: str = "removal_reason") -> DataFrame:
    """table, removal_reason, count and percentage of the table's rows."""
    counted = rejected.groupBy(reason).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.lit(table).alias("table"), F.col(reason).alias("removal_reason"), "count", (100.0 * F.col("count") / total).alias("percentage"))
