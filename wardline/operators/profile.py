"""Profiles: counts, nulls, distinct ids, value counts, ranges and the completeness matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.quality import null_profile


def id_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_id")]


def time_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "date" in c or "time" in c]


def kind_of(dtype: str) -> str:
    """numeric or string."""
    return "numeric" if dtype.split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal") else "string"


def distinct_ids(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, distinct_count of each column; the columns go through one shuffle of (column, value) pairs."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    rows = df.select(F.explode(pairs).alias("x")).select("x.*").where("v IS NOT NULL").distinct()
    return rows.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, least, most (as text) of each column."""
    agg = df.agg(*[f(c).cast("string").alias(f"{i}_{f.__name__}") for i, c in enumerate(columns) for f in (F.min, F.max)])
    cols = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{i}_min").alias("least"), F.col(f"{i}_max").alias("most")) for i, c in enumerate(columns)])
    return agg.select(F.explode(cols).alias("x")).select("x.*")


def column_samples(df: DataFrame, columns: Sequence[str], n: int = 10, most: int = 1000) -> DataFrame:
    """column_name, unique_values (at most ``most``, approximate) and the n least values as a sample that any order of rows gives."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    rows = df.select(F.explode(pairs).alias("x")).select("x.*").where("v IS NOT NULL").distinct()
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("column_name").orderBy("v")))
    return ranked.groupBy("column_name").agg(F.least(F.count(F.lit(1)), F.lit(most)).alias("unique_values"), F.array_sort(F.collect_list(F.when(F.col("_r") <= n, F.col("v")))).alias("sample_values"))


def table_profile(df: DataFrame) -> DataFrame:
    """column_name, total, missing, missing_percentage, and the distinct count of id columns."""
    profile, ids = null_profile(df), id_columns(df)
    if not ids:
        return profile.withColumn("distinct_count", F.lit(None).cast("long"))
    return profile.join(distinct_ids(df, ids), "column_name", "left")


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, records."""
    rows = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records") for name, df in tables.items()]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionAll(more)
    return out


def records_per_person(tables: Mapping[str, DataFrame], person: str = "person_id") -> DataFrame:
    """One row per person, one column per table with the number of its records."""
    rows = None
    for name, df in tables.items():
        own = df.select(F.col(person).alias("person_id"), F.lit(name).alias("table_name"))
        rows = own if rows is None else rows.unionAll(own)
    return rows.groupBy("person_id").pivot("table_name", list(tables)).agg(F.count(F.lit(1))).na.fill(0)


def monthly(df: DataFrame, time: str) -> DataFrame:
    return df.where(F.col(time).isNotNull()).groupBy(F.date_format(time, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("records"))


def peak_month(df: DataFrame, time: str) -> DataFrame:
    """Busiest month (the earliest of ties), its records and the mean."""
    return monthly(df, time).agg(F.min_by("month", F.struct(-F.col("records"), F.col("month"))).alias("peak_month"), F.max("records").alias("peak_records"), F.avg("records").alias("mean_records"))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence, n: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def kinds(df: DataFrame) -> DataFrame:
    """column_name, kind (numeric or string) of a frame's schema; reads no rows."""
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind_of(t)).alias("kind")) for c, t in df.dtypes])
    return df.sparkSession.range(1).select(F.explode(rows).alias("x")).select("x.*")


def null_columns(tables: Mapping[str, DataFrame], n: int = 5, over: float = 0.0) -> DataFrame:
    """table_name, column_name, missing, missing_percentage of the n emptiest columns of each table, of those null in more than ``over`` percent of rows."""
    rows = None
    for name, df in tables.items():
        own = null_profile(df).where(F.col("missing_percentage") > over).select(F.lit(name).alias("table_name"), "column_name", "missing", "missing_percentage")
        rows = own if rows is None else rows.unionAll(own)
    return top_per_group(rows, ["table_name"], [F.desc("missing_percentage"), "column_name"], n)
