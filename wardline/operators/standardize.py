"""Standardization: quantile thresholds, outliers, dates, units, and the log of what was changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.scalars import convert_units, finite, normalise_date, to_double
from wardline.operators.split import Split, by_reason, first_rule
from wardline.registry import CONVERSIONS, MIN_VALUES, PERCENTILE, PLAUSIBLE_RANGES


#: Levels of a quantile table, in percent.
LEVELS = (1, 5, 25, 50, 75, 95, 99)


def snapped(percentile: float) -> tuple[float, float]:
    """Quantile levels that a percentile snaps to when a sketch holds only seven."""
    return (0.01, 0.99) if percentile >= 99 else (0.05, 0.95) if percentile >= 95 else (0.25, 0.75)


def thresholds(df: DataFrame, concept: str, value: str, percentile: float = PERCENTILE, least: int = MIN_VALUES, approx: bool = False) -> DataFrame:
    """concept, lower, upper, n, mean, std of the finite values of each concept that has ``least`` of them.

    Exact quantiles are taken over distinct values with their counts, so that repeated values are combined before they
    move; approx takes sketched ones at the snapped levels. For concepts of unbounded distinct values there is
    refined_quantiles()."""
    good = df.select(F.col(concept), to_double(F.col(value)).alias("_v")).where(finite(F.col("_v")) & F.col(concept).isNotNull())
    low, high = snapped(percentile) if approx else ((100 - percentile) / 100, percentile / 100)
    if approx:
        bounds = [F.percentile_approx("_v", low, 10000).alias("lower"), F.percentile_approx("_v", high, 10000).alias("upper")]
        grouped = good.groupBy(concept).agg(*bounds, F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"), F.stddev_pop("_v").alias("std"))
    else:
        counted = good.groupBy(concept, "_v").agg(F.count(F.lit(1)).alias("_c"))
        mean = F.sum(F.col("_v") * F.col("_c")) / F.sum("_c")
        spread = F.sqrt(F.greatest(F.sum(F.col("_v") * F.col("_v") * F.col("_c")) / F.sum("_c") - mean * mean, F.lit(0.0)))
        grouped = counted.groupBy(concept).agg(F.percentile("_v", low, F.col("_c")).alias("lower"), F.percentile("_v", high, F.col("_c")).alias("upper"), F.sum("_c").alias("n"), mean.alias("mean"), spread.alias("std"))
    return grouped.where(F.col("n") >= least)


def refined_quantiles(df: DataFrame, concept: str, value: str, levels: Sequence[float], least: int = MIN_VALUES, cells: int = 4096) -> DataFrame:
    """concept, n, quantiles: the same exact quantiles where one concept has more distinct values than a task can hold.

    Values are counted in ``cells`` equal cells between a concept's least and greatest; only the cells that hold a needed
    rank are then looked into, so no task gathers a concept."""
    good = df.select(F.col(concept), to_double(F.col(value)).alias("_v")).where(finite(F.col("_v")) & F.col(concept).isNotNull())
    counted = good.groupBy(concept, "_v").agg(F.count(F.lit(1)).alias("_c"))
    whole = counted.groupBy(concept).agg(F.sum("_c").alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).where(F.col("n") >= least)
    cell = F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (cells - 1))).otherwise(F.lit(0)).cast("int")
    placed = counted.join(whole, concept).withColumn("_cell", cell)
    cellwise = Window.partitionBy(concept).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.groupBy(concept, "_cell", "n").agg(F.sum("_c").alias("_in")).withColumn("_end", F.sum("_in").over(cellwise))
    rank = lambda p, f: f((F.col("n") - 1) * F.lit(p)).cast("long")
    wanted = F.array_distinct(F.array(*[rank(p, f) for p in levels for f in (F.floor, F.ceil)]))
    holds = F.exists(wanted, lambda k: (k >= F.col("_end") - F.col("_in")) & (k < F.col("_end")))
    near = sums.where(holds).select(concept, "_cell", (F.col("_end") - F.col("_in")).alias("_before"))
    inside = Window.partitionBy(concept, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.join(near, [concept, "_cell"]).withColumn("_stop", F.col("_before") + F.sum("_c").over(inside))
    hit = lambda k: F.max(F.when((k >= F.col("_stop") - F.col("_c")) & (k < F.col("_stop")), F.col("_v")))
    found = ranked.groupBy(concept, "n").agg(*[hit(rank(p, f)).alias(f"_{i}{f.__name__}") for i, p in enumerate(levels) for f in (F.floor, F.ceil)])
    share = lambda p: (F.col("n") - 1) * F.lit(p) - rank(p, F.floor)
    values = [F.col(f"_{i}floor") + (F.col(f"_{i}ceil") - F.col(f"_{i}floor")) * share(p) for i, p in enumerate(levels)]
    return found.select(concept, "n", F.array(*values).alias("quantiles"))


def sketched_quantiles(df: DataFrame, concept: str, value: str, least: int = MIN_VALUES, accuracy: int = 10000) -> DataFrame:
    """Seven sketched quantiles, and the exact count, least and greatest value, of each concept with ``least`` finite values.

    Sketches merge map-side, so a concept of any size is one small state a task; ranks err by n / accuracy at most, and
    concepts of fewer values than ``accuracy`` are exact (the value at rank ceil(p n))."""
    good = df.select(F.col(concept), to_double(F.col(value)).alias("_v")).where(finite(F.col("_v")) & F.col(concept).isNotNull())
    sketch = F.percentile_approx("_v", [p / 100 for p in LEVELS], accuracy).alias("_q")
    grouped = good.groupBy(concept).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("p0"), sketch, F.max("_v").alias("p100")).where(F.col("n") >= least)
    return grouped.select(concept, "n", "p0", *[F.col("_q")[k].alias(f"p{p}") for k, p in enumerate(LEVELS)], "p100")


def quantile_table(df: DataFrame, concept: str, value: str, least: int = MIN_VALUES) -> DataFrame:
    """Seven quantiles and the exact least and greatest value of each concept."""
    good = df.select(F.col(concept), to_double(F.col(value)).alias("_v")).where(finite(F.col("_v")))
    counted = good.groupBy(concept, "_v").agg(F.count(F.lit(1)).alias("_c"))
    grouped = counted.groupBy(concept).agg(F.sum("_c").alias("n"), F.min("_v").alias("p0"), *[F.percentile("_v", p / 100, F.col("_c")).alias(f"p{p}") for p in LEVELS], F.max("_v").alias("p100"))
    return grouped.where(F.col("n") >= least)


def outliers(df: DataFrame, limits: DataFrame, concept: str, value: str, ranges: Mapping[int, tuple] = PLAUSIBLE_RANGES) -> Split:
    """Rows beyond their concept's thresholds go, then rows beyond its plausible range.

    Rows without a finite value, or of concepts without thresholds, stay; bounds themselves stay."""
    met = df.join(limits.select(F.col(concept).alias("_c"), F.col("lower").alias("_low"), F.col("upper").alias("_high")), F.col(concept) == F.col("_c"), "left")
    v = to_double(F.col(value))
    known = F.col("_c").isNotNull() & finite(v)
    wide = F.lit(False)
    for c, (_, least, most, _) in ranges.items():
        wide = wide | ((F.col(concept) == c) & ((v < least) | (v > most)))
    reason = first_rule((known & ((v < F.col("_low")) | (v > F.col("_high"))), "percentile_outlier"), (known & wide, "range_outlier"))
    info = F.to_json(F.struct(v.alias("value"), F.col("_low").alias("lower"), F.col("_high").alias("upper")))
    split = by_reason(met.withColumn("removal_reason", reason).withColumn("additional_info", info).drop("_c", "_low", "_high"))
    return split._replace(kept=split.kept.drop("additional_info"))


def standardise_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: normalise_date(F.col(c), c) for c in columns if c in df.columns})


def standardise_distinct_dates(df: DataFrame, column: str) -> DataFrame:
    """The same for one column by its distinct texts: each is parsed once and joined back. It pays where texts repeat much and parsing is dear."""
    parsed = df.select(F.col(column).alias("_text")).distinct().withColumn("_date", normalise_date(F.col("_text"), column))
    return df.join(parsed, F.col(column).eqNullSafe(F.col("_text")), "left").withColumn(column, F.col("_date")).drop("_text", "_date")


def standardise_units(df: DataFrame, concept: str, value: str, unit: str | None, gate: bool = True) -> DataFrame:
    """Values, and with a unit column also units, in the unit each concept is kept in."""
    new = convert_units(F.col(concept), F.col(unit) if unit else None, to_double(F.col(value)), CONVERSIONS, gate and unit is not None)
    out = df.withColumn("_new", new)
    if unit:
        to = F.col(unit)
        for c, source, target, _, _ in CONVERSIONS:
            to = F.when((F.col(concept) == c) & (F.lower(F.col(unit)) == source.lower()), F.lit(target)).otherwise(to)
        out = out.withColumn(unit, to)
    return out.withColumn(value, F.coalesce(F.col("_new").cast(df.schema[value].dataType), F.col(value))).drop("_new")


def change_log(before: DataFrame, after: dict[str, tuple[Column, str]], row: Column) -> DataFrame:
    """row_number, field, original_value, new_value, change_type of every field whose text changes; ``after`` has the new value and the kind of each field."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("original_value"), new.cast("string").alias("new_value"), F.lit(kind).alias("change_type")) for f, (new, kind) in after.items()])
    rows = before.select(row.alias("row_number"), F.explode(pairs).alias("x")).where(~F.col("x.original_value").eqNullSafe(F.col("x.new_value")))
    return rows.select("row_number", "x.*")


def standardise_table(df: DataFrame, concept: str, value: str, unit: str | None, dates: Sequence[str], percentile: float = PERCENTILE, approx: bool = False) -> Split:
    """The standardization stage of measured values: dates, units, then thresholds over converted values and the split."""
    new = standardise_units(standardise_dates(df, dates), concept, value, unit)
    return outliers(new, thresholds(new, concept, value, percentile, approx=approx), concept, value)
