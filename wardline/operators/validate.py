"""Validation: tables, schemas, keys, and the verdict."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.registry import OPTIONAL_TABLES, TABLES, TableSpec


class Verdict(NamedTuple):
    passed: bool
    errors: list[str]
    warnings: list[str]
    notes: list[str]


def missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    return [c for c in spec.required if c not in df.columns]


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """records, distinct_keys, duplicates of a key column."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("records"), F.count_if(F.col(key).isNotNull()).alias("distinct_keys")).withColumn("duplicates", F.col("records") - F.col("distinct_keys"))


def critical_nulls(df: DataFrame, columns) -> DataFrame:
    """column_name, nulls of the columns that must not have any."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])).alias("x")).select("x.*")


def person_summary(person: DataFrame, top: int = 3) -> DataFrame:
    """persons, first_year, last_year of birth, and the ``top`` most frequent genders with their counts; one row."""
    genders = person.where(F.col("gender_concept_id").isNotNull()).groupBy("gender_concept_id").agg(F.count(F.lit(1)).alias("n"))
    first = genders.agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col("gender_concept_id").alias("g")))), 1, top).alias("g"))
    years = person.agg(F.count(F.lit(1)).alias("persons"), F.min(F.col("year_of_birth").cast("int")).alias("first_year"), F.max(F.col("year_of_birth").cast("int")).alias("last_year"))
    return years.join(F.broadcast(first)).select("persons", "first_year", "last_year", F.transform("g", lambda x: F.struct(x["g"].alias("gender_concept_id"), (-x["n"]).alias("records"))).alias("genders"))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Distinct keys of the child that the parent lacks."""
    known = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.select(key).where(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")


def same_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """only_a, only_b: both 0 for equal sets."""
    tagged = a.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(b.select(key, F.lit(0), F.lit(1)))
    by_id = tagged.groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return by_id.agg(F.count_if(F.expr("b = 0")).alias("only_a"), F.count_if(F.expr("a = 0")).alias("only_b"))


def validate(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = TABLES, sizes: Mapping[str, int] | None = None) -> Verdict:
    """Existence, then columns, sizes (bytes of each table, where known), then keys and nulls of PERSON, whose summary is noted.

    Missing optional tables and tables without records warn; only errors fail."""
    errors, warnings, notes = [], [], []
    for name, spec in specs.items():
        if name not in tables:
            errors.append(f"{name}: missing")
            continue
        gone = missing_columns(tables[name], spec)
        if gone:
            errors.append(f"{name}: missing columns {', '.join(gone)}")
        if sizes is not None and not sizes.get(name, 0):
            errors.append(f"{name}: empty file")
        elif tables[name].isEmpty():
            warnings.append(f"{name}: no records")
    warnings += [f"{name}: missing" for name in OPTIONAL_TABLES if name not in tables]
    person = tables.get("PERSON")
    if person is not None and "person_id" in person.columns:
        doubled = duplicate_keys(person, "person_id").first()["duplicates"]
        if doubled:
            errors.append(f"PERSON: {doubled} duplicate person_id")
        for r in critical_nulls(person, [c for c in specs["PERSON"].required if c in person.columns]).where("nulls > 0").collect():
            warnings.append(f"PERSON: {r.nulls} nulls in {r.column_name}")
        if {"gender_concept_id", "year_of_birth"} <= set(person.columns):
            r = person_summary(person).first()
            notes += [f"PERSON: {r.persons} persons", f"PERSON: born {r.first_year} to {r.last_year}", "PERSON: genders " + ", ".join(f"{g.gender_concept_id} ({g.records})" for g in r.genders)]
    return Verdict(not errors, errors, warnings, notes)
