"""Stratified samples of an exact size, and the extraction of all rows of the sampled persons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.cohort import extract
from wardline.registry import SAMPLE_SIZE, SEED


def quotas(sizes: DataFrame, stratum: str, size: int) -> DataFrame:
    """stratum, g, quota by largest remainder, at least one and at most all of each; ``sizes`` has stratum and g.

    Runs over one row a stratum: base = max(1, floor(ideal)); a shortfall gives one more to the largest remainders, a
    surplus is taken from the largest quotas down to one each. Ties go by stratum."""
    every = Window.partitionBy(F.lit(0))
    rows = sizes.withColumn("_t", F.sum("g").over(every)).withColumn("_ideal", size * F.col("g") / F.col("_t"))
    rows = rows.withColumn("_base", F.greatest(F.lit(1), F.floor("_ideal")).cast("long")).withColumn("_rem", F.col("_ideal") - F.floor("_ideal"))
    rows = rows.withColumn("_d", size - F.sum("_base").over(every))
    by_rem = F.row_number().over(every.orderBy(F.desc("_rem"), stratum))
    largest = every.orderBy(F.desc("_base"), F.desc("g"), stratum)
    before = F.coalesce(F.sum(F.col("_base") - 1).over(largest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_more", F.when(by_rem <= F.col("_d"), 1).otherwise(0)).withColumn("_before", before)
    less = F.least(F.col("_base") - 1, F.greatest(F.lit(0), -F.col("_d") - F.col("_before")))
    quota = F.when(F.col("_d") >= 0, F.col("_base") + F.col("_more")).otherwise(F.col("_base") - less)
    whole = F.when(F.col("_t") <= size, F.col("g")).otherwise(F.least(quota, F.col("g")))
    return rows.select(stratum, "g", whole.cast("long").alias("quota"))


def stratified_sample(df: DataFrame, key: str, stratum: Column, size: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """An exact sample, the same for the same seed however rows are dealt out.

    Rows are ranked by a hash of their key within blocks of their stratum before they are ranked within it, so no task
    ranks a whole stratum that holds most rows: a block passes on only as many as the quota."""
    rows = df.withColumn("_s", stratum).withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    quota = quotas(rows.groupBy("_s").agg(F.count(F.lit(1)).alias("g")), "_s", size).select("_s", "quota")
    met = rows.join(quota, "_s").withColumn("_block", F.pmod("_h", F.lit(64)))
    first = met.withColumn("_r", F.row_number().over(Window.partitionBy("_s", "_block").orderBy("_h", key))).where("_r <= quota")
    last = first.withColumn("_r", F.row_number().over(Window.partitionBy("_s").orderBy("_h", key))).where("_r <= quota")
    return last.select(*df.columns)


def with_prefix(df: DataFrame, key: str, prefixes: Sequence[str]) -> DataFrame:
    """Rows whose key starts with any of the prefixes."""
    test = F.lit(False)
    for p in prefixes:
        test = test | F.col(key).startswith(p)
    return df.where(test)


def sample_and_extract(tables: Mapping[str, DataFrame], person: str = "person_id", size: int = SAMPLE_SIZE, seed: int = SEED, prefixes: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """A sample of PERSON by the first nine characters of the id, and every other table's rows of those persons."""
    people = with_prefix(tables["PERSON"], person, prefixes) if prefixes else tables["PERSON"]
    chosen = stratified_sample(people, person, F.substring(F.col(person).cast("string"), 1, 9), size, seed)
    return {"PERSON": chosen} | {n: extract(df, chosen, person) for n, df in tables.items() if n != "PERSON"}
