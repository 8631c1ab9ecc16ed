"""Episodes: visits of one person and concept that follow each other within a gap become one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.scalars import elapsed
from wardline.registry import MERGE_MINUTES


def episode_ids(df: DataFrame, person: str, concept: str, start: str, end: str, ident: str, minutes: float = MERGE_MINUTES, running: bool = False) -> DataFrame:
    """Adds episode_index (0-based within person and concept) and episode_id.

    A row opens an episode when it is the first, when its start or the end before it is null, or when its start is more
    than ``minutes`` after the end of the row before it; with ``running``, after the latest end so far. Rows with a null
    concept each stand alone."""
    by = Window.partitionBy(person, concept).orderBy(F.col(start).asc_nulls_last(), F.col(ident))
    before = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1)) if running else F.lag(end).over(by)
    late = elapsed(F.col("_before"), F.col(start), "minutes") > minutes
    opens = F.col(concept).isNull() | F.col(start).isNull() | F.col("_before").isNull() | late
    marked = df.withColumn("_before", before).withColumn("_open", F.when(opens, 1).otherwise(0))
    index = F.sum("_open").over(by.rowsBetween(Window.unboundedPreceding, 0)) - 1
    rows = marked.withColumn("episode_index", index.cast("long")).drop("_before", "_open")
    return rows.withColumn("episode_id", F.concat_ws("_", F.col(person).cast("string"), F.coalesce(F.col(concept).cast("string"), F.lit("")), F.col("episode_index").cast("string")))


def merge(df: DataFrame, person: str, concept: str, start: str, end: str, ident: str, minutes: float = MERGE_MINUTES, running: bool = False) -> DataFrame:
    """One row per episode: columns of its first row, the earliest start and latest end, the ids in order, their number.

    Merged rows (merge_flag Y) also have merged and original times and the duration in hours; others have none there."""
    rows = episode_ids(df, person, concept, start, end, ident, minutes, running)
    order = F.struct(F.col(start).isNull().alias("n"), F.col(start).alias("s"), F.col(ident).alias("i"))
    base = [F.min_by(F.struct(*df.columns), order).alias("_row")]
    grouped = rows.groupBy(person, concept, "episode_index", "episode_id").agg(*base, F.min(start).alias("_start"), F.max(end).alias("_end"), F.count(F.lit(1)).alias("visits_merged_count"), F.array_sort(F.collect_list(order)).alias("_ids"))
    many = F.col("visits_merged_count") > 1
    only = lambda c: F.when(many, c)
    cols = [(only(F.col("_start")) if c == start else only(F.col("_end")) if c == end else F.lit(None)) for c in df.columns]
    out = [F.when(many & F.lit(c in (start, end)), new).otherwise(F.col(f"_row.{c}")).alias(c) for c, new in zip(df.columns, cols, strict=True)]
    return grouped.select(
        *out, F.when(many, "Y").otherwise("N").alias("merge_flag"), "episode_id", F.to_json(F.transform("_ids", lambda x: x["i"])).alias("original_visit_ids"), "visits_merged_count",
        only(F.col("_start")).alias("merged_start_datetime"), only(F.col("_end")).alias("merged_end_datetime"), only(elapsed(F.col("_start"), F.col("_end"), "hours")).alias("merged_duration_hours"),
        only(F.col(f"_row.{start}")).alias(f"original_{start}"), only(F.col(f"_row.{end}")).alias(f"original_{end}"),
    )


def merge_map(df: DataFrame, person: str, concept: str, start: str, end: str, ident: str, minutes: float = MERGE_MINUTES, table: str = "VISIT_OCCURRENCE") -> DataFrame:
    """One row per visit of a merged episode: its id and the episode's."""
    rows = episode_ids(df, person, concept, start, end, ident, minutes)
    size = F.count(F.lit(1)).over(Window.partitionBy(person, concept, "episode_index"))
    kept = rows.withColumn("_n", size).where("_n > 1")
    return kept.select(F.col(ident).alias("original_visit_id"), F.col("episode_id").alias("merged_episode_id"), F.col(person).alias("person_id"), F.col(concept).alias("concept_id"), F.lit(table).alias("table_type"))


def validate_merge(before: DataFrame, merged: DataFrame, ident: str) -> DataFrame:
    """ids_in, ids_out, lost, added: an episode set is sound when no id is lost, added or doubled."""
    inside = before.select(F.col(ident).cast("long").alias("id"))
    outside = merged.select(F.explode(F.from_json("original_visit_ids", "array<bigint>")).alias("id"))
    tagged = inside.select("id", F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(outside.select("id", F.lit(0), F.lit(1)))
    by_id = tagged.groupBy("id").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return by_id.agg(F.sum("a").alias("ids_in"), F.sum("b").alias("ids_out"), F.count_if(F.col("a") > F.col("b")).alias("lost"), F.count_if(F.col("b") > F.col("a")).alias("added"))
