"""Filters that split: invalid concepts, temporal order, low frequency, and the cascade of the cleaning stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.scalars import blank, invalid_concept
from wardline.operators.dedup import ranked
from wardline.operators.split import Split, by_reason, first_rule
from wardline.registry import MAX_NULL_PERCENT, MIN_FREQUENCY, TableSpec


def reject_invalid(df: DataFrame, column: str) -> Split:
    """Rows whose concept (or date of death) is blank or 0 go; without the column nothing does."""
    bad = invalid_concept(F.col(column)) if column in df.columns else F.lit(False)
    return by_reason(df.withColumn("removal_reason", first_rule((bad, "invalid_concept"))))


def temporal_issue(start: Column, end: Column) -> Column:
    """Both there, and the end before the start. ISO text compares as time."""
    return ~blank(start) & ~blank(end) & (end < start)


def reject_temporal(df: DataFrame, start: str, end: str, position: str | None = None) -> Split:
    tagged = df.withColumn("temporal_issue_reason", first_rule((temporal_issue(F.col(start), F.col(end)), "end_before_start")))
    split = by_reason(tagged, "temporal_issue_reason")
    extra = split.rejected.withColumn("start_datetime", F.col(start)).withColumn("end_datetime", F.col(end)).withColumn("original_row_number", F.col(position) if position else F.lit(None).cast("long"))
    return split._replace(rejected=extra)


def frequency(df: DataFrame, concept: str) -> DataFrame:
    """concept, freq of concepts that are not blank; counts are combined before they move."""
    return df.where(~blank(F.col(concept))).groupBy(concept).agg(F.count(F.lit(1)).alias("freq"))


def reject_rare(df: DataFrame, concept: str, least: int = MIN_FREQUENCY) -> Split:
    """Rows of concepts met ``least`` times or less go; blank concepts stay, and 0 switches the filter off.

    Counts join back as a dimension, so that a concept with a third of all rows is split, not gathered."""
    if least <= 0:
        return by_reason(df.withColumn("removal_reason", F.lit(None).cast("string")))
    met = df.join(frequency(df, concept), concept, "left")
    reason = F.format_string("low_frequency_concept (%s=%s, freq=%d)", F.lit(concept), F.col(concept).cast("string"), F.col("freq"))
    tagged = met.withColumn("removal_reason", F.when(F.col("freq") <= least, reason)).drop("freq")
    return by_reason(tagged.select(*df.columns, "removal_reason"))


def null_profile(df: DataFrame, is_null=None) -> DataFrame:
    """column_name, total, missing, missing_percentage of every column, in one pass."""
    test = is_null or (lambda c: c.isNull())
    counted = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(test(F.col(c))).alias(f"_{i}") for i, c in enumerate(df.columns)])
    cols = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("missing")) for i, c in enumerate(df.columns)])
    rows = counted.select("_total", F.explode(cols).alias("x"))
    share = F.when(F.col("_total") > 0, 100.0 * F.col("x.missing") / F.col("_total")).otherwise(F.lit(0.0))
    return rows.select("x.column_name", F.col("_total").alias("total"), "x.missing", share.alias("missing_percentage"))


def prune_columns(df: DataFrame, most: float = MAX_NULL_PERCENT, is_null=None) -> tuple[DataFrame, DataFrame]:
    """The frame without columns that are null in more than ``most`` percent of rows, and the profile that decides."""
    profile = null_profile(df, is_null).withColumn("removed", F.col("missing_percentage") > most)
    return df.drop(*columns_to_prune(profile, most)), profile


def cascade(df: DataFrame, spec: TableSpec, order: Sequence[Column]) -> DataFrame:
    """Adds removal_reason: duplicate (over all rows), then invalid concept, then temporal order; first hit wins."""
    rows = ranked(df, spec.keys, order)
    rules = [(F.col("_rank") > 1, "duplicate")]
    if spec.validity and spec.validity in df.columns:
        rules.append((invalid_concept(F.col(spec.validity)), "invalid_concept"))
    if spec.start and spec.end and {spec.start, spec.end} <= set(df.columns):
        rules.append((temporal_issue(F.col(spec.start), F.col(spec.end)), "temporal_issue"))
    return rows.withColumn("removal_reason", first_rule(*rules)).drop("_rank", "_size")


def columns_to_prune(profile: DataFrame, most: float = MAX_NULL_PERCENT) -> list[str]:
    """Columns that a profile (column_name, missing_percentage) finds null in more than ``most`` percent of rows."""
    return [r.column_name for r in profile.where(F.col("missing_percentage") > most).select("column_name").collect()]  # one row a column


def clean_table(df: DataFrame, spec: TableSpec, order: Sequence[Column], most_null: float = MAX_NULL_PERCENT, profile: DataFrame | None = None) -> Split:
    """The cleaning stage: cascade, then null-heavy columns are dropped from what is kept (rejects keep all).

    ``profile`` is that of the profiling stage; without it the table is profiled here."""
    split = by_reason(cascade(df, spec, order))
    gone = columns_to_prune(null_profile(df) if profile is None else profile, most_null)
    return split._replace(kept=split.kept.drop(*gone))
