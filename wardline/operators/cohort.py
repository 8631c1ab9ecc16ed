"""Cohorts: index times by concept, what came before them, demographics, and the summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.scalars import elapsed, labelled
from wardline.registry import GENDER, RACE


def index_times(df: DataFrame, person: str, concept: str, start: str, end: str, concepts: Sequence) -> DataFrame:
    """Earliest start and latest end of each person's rows of the index concepts."""
    rows = df.where(F.col(concept).isin(*concepts) & F.col(person).isNotNull())
    return rows.groupBy(person).agg(F.min(start).alias(f"{start}_earliest"), F.max(end).alias(f"{end}_latest"))


def events(tables: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """person, time of several tables, given as (frame, person column, time column)."""
    rows = [df.select(F.col(p).alias("person"), F.col(t).alias("time")) for df, p, t in tables]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out.where(F.col("time").isNotNull())


def before_index(index: DataFrame, pooled: DataFrame, person: str, time: str) -> DataFrame:
    """Each indexed person's events up to and at the index time: count, earliest, latest, days spanned (0 if none)."""
    own = index.select(F.col(person).alias("_p"), F.col(time).alias("_t"))
    met = pooled.join(own, (F.col("person") == F.col("_p")) & (F.col("time") <= F.col("_t")))
    counted = met.groupBy("_p").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("earliest"), F.max("time").alias("latest"))
    rows = own.join(counted, "_p", "left")
    days = F.when(F.col("n").isNotNull(), elapsed(F.col("earliest"), F.col("latest"), "days") + 1).otherwise(F.lit(0).cast("long"))
    return rows.select(F.col("_p").alias(person), F.col("_t").alias(time), F.coalesce("n", F.lit(0).cast("long")).alias("count_before_icu"), "earliest", "latest", days.alias("days_of_data_before_icu"))


def cohort_statistics(index: DataFrame, pooled: DataFrame, persons: DataFrame, deaths: DataFrame, person: str, time: str) -> DataFrame:
    """One row per indexed person: events before the index, age at it, labels and whether a death is recorded."""
    first = persons.groupBy(person).agg(F.min_by(F.struct("gender_concept_id", "race_concept_id", "year_of_birth"), F.struct("gender_concept_id", "race_concept_id", "year_of_birth")).alias("_d"))
    died = deaths.select(person).distinct().withColumn("_died", F.lit(True))
    rows = before_index(index, pooled, person, time).join(first, person, "left").join(died, person, "left")
    return rows.select(
        F.col(person).alias("patient_id"), "count_before_icu", "days_of_data_before_icu", (F.year(time) - F.col("_d.year_of_birth")).alias("age_at_icu_admission"),
        labelled(F.col("_d.gender_concept_id"), GENDER).alias("gender"), labelled(F.col("_d.race_concept_id"), RACE).alias("race"), F.coalesce("_died", F.lit(False)).alias("has_death_record"),
    )


def cohort_summary(stats: DataFrame) -> DataFrame:
    n = F.col("count_before_icu")
    return stats.agg(F.count(F.lit(1)).alias("patients"), F.avg(n).alias("mean_records"), F.max(n).alias("max_records"), F.min(n).alias("min_records"), F.avg("days_of_data_before_icu").alias("mean_days"), F.count_if("has_death_record").alias("deaths"), F.avg("age_at_icu_admission").alias("mean_age"))


def extract(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of the given persons. The id side is broadcast where its statistics allow, else both sides shuffle."""
    return df.join(ids.select(key).distinct(), key, "left_semi")
