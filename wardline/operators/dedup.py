"""Keep-first deduplication with an audit of every duplicate group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.split import Split, by_reason


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], prefer: Column | None = None) -> DataFrame:
    """Adds _rank (1 is kept) and _size of each key's group. Null keys are equal; a key column that is missing is left out.

    ``order`` is a total order, the position in the source; ``prefer`` (true first) goes before it."""
    own = [F.col(k) for k in keys if k in df.columns] or [F.lit(0)]
    by = ([prefer.desc()] if prefer is not None else []) + list(order)
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*own).orderBy(*by))).withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy(*own)))


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column], prefer: Column | None = None) -> Split:
    tagged = ranked(df, keys, order, prefer).withColumn("removal_reason", F.when(F.col("_rank") > 1, F.lit("duplicate")))
    return by_reason(tagged.drop("_rank", "_size"))


def numbered(df: DataFrame, position: Column, keys: Sequence[Column], blocks: int = 4096) -> DataFrame:
    """Adds _number, 1-based by position: rows are ranked within blocks of positions, and blocks by one row each."""
    top = df.agg(F.max(position).alias("top")).first().top
    width = (top or 0) // blocks + 1
    marked = df.withColumn("_block", F.coalesce(F.floor(position / width).cast("long"), F.pmod(F.xxhash64(*keys), F.lit(blocks))))
    sizes = marked.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))  # at most 2 * blocks rows
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_block").orderBy(position.asc_nulls_last(), *keys)
    return marked.withColumn("_in", F.row_number().over(inside)).join(F.broadcast(sizes), "_block").withColumn("_number", F.col("_before") + F.col("_in")).drop("_block", "_in", "_before")


def audit(df: DataFrame, keys: Sequence[str], order: Sequence[Column], position: str | None = None, table: str = "T", prefer: Column | None = None) -> DataFrame:
    """All rows of groups with more than one: their columns, duplicate_status, duplicate_group_id, original_row_number.

    Groups are numbered by their first duplicate; without a position the numbers are unique, in no order."""
    rows = ranked(df, keys, order, prefer).where("_size > 1")
    own = [k for k in keys if k in df.columns]
    at = F.col(position) if position else F.lit(None).cast("long")
    rows = rows.withColumn("duplicate_status", F.when(F.col("_rank") == 1, F.lit("kept")).otherwise(F.lit("removed"))).withColumn("original_row_number", at)
    named = [F.col(f"_k{i}") for i in range(len(own))]
    groups = rows.where("_rank = 2").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(own)], "original_row_number")
    groups = numbered(groups, F.col("original_row_number"), named).withColumn("duplicate_group_id", F.format_string(f"{table}_%d", "_number")).drop("original_row_number", "_number")
    met = rows.join(groups, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(own)])
    return met.drop("_rank", "_size", *[f"_k{i}" for i in range(len(own))])
