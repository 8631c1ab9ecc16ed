"""Concept mapping: dictionary joins, deduplication after them, statistics, and the building of dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.scalars import blank
from wardline.operators.dedup import ranked
from wardline.operators.quality import reject_rare
from wardline.operators.split import Split, by_reason
from wardline.registry import MAPPED_CLASS, MIN_FREQUENCY


def last_wins(mapping: DataFrame, key: str, value: str, order: Sequence[Column]) -> DataFrame:
    """One row per key: the value of the last row in order."""
    last = mapping.groupBy(key).agg(F.max_by(F.col(value), F.struct(*order)).alias(value))
    return last.where(~blank(F.col(key)))


def apply_mapping(df: DataFrame, mapping: DataFrame | None, concept: str, source: str = "original_concept_id", target: str = "snomed_concept_id") -> DataFrame:
    """Rewrites the concept where the dictionary has it and adds <concept>_mapped (Y or N); a miss keeps the concept.

    The dictionary has one row per source. Its size is left to the optimizer's statistics: small ones are broadcast."""
    flag = f"{concept}_mapped"
    if mapping is None:
        return df.withColumn(flag, F.lit("N"))
    side = mapping.select(F.col(source).alias("_source"), F.col(target).alias("_target")).where(F.col("_target").isNotNull())
    met = df.join(side, F.col(concept) == F.col("_source"), "left")
    new = F.coalesce(F.col("_target").cast(df.schema[concept].dataType), F.col(concept))
    return met.withColumn(concept, new).withColumn(flag, F.when(F.col("_target").isNotNull(), F.lit("Y")).otherwise(F.lit("N"))).drop("_source", "_target")


def mapping_statistics(df: DataFrame, mapped: DataFrame, concept: str) -> DataFrame:
    """total_values (not blank), null_values, mapped_values, unique_concepts_mapped (used, by source) and the rate."""
    side = mapped.select(F.col("original_concept_id").alias("_source")).distinct()
    met = df.join(side, F.col(concept) == F.col("_source"), "left")
    hit, empty = F.col("_source").isNotNull(), blank(F.col(concept))
    rate = F.when(F.count_if(~empty) > 0, 100.0 * F.count_if(hit) / F.count_if(~empty)).otherwise(F.lit(0.0))
    return met.agg(F.count_if(~empty).alias("total_values"), F.count_if(empty).alias("null_values"), F.count_if(hit).alias("mapped_values"), F.countDistinct(F.when(hit, F.col(concept))).alias("unique_concepts_mapped"), rate.alias("mapping_rate"))


def map_table(df: DataFrame, mapping: DataFrame | None, concept: str, keys: Sequence[str], order: Sequence[Column], least: int = MIN_FREQUENCY, deduplicate: bool = True, prefer: Column | None = None) -> Split:
    """The mapping stage: rare source concepts go, the rest is mapped, then duplicates of the new key go.

    Rows keep their reason as they pass, so all three steps are one lineage; rejected rows show the concept they went by: the
    source's if it was rare, else the target's."""
    frequent = reject_rare(df, concept, least)
    reason = F.col("removal_reason")
    source = frequent.tagged.withColumn("_source_concept", F.col(concept))
    mapped = apply_mapping(source, mapping, concept)
    flag = f"{concept}_mapped"
    mapped = mapped.withColumns({concept: F.when(reason.isNull(), F.col(concept)).otherwise(F.col("_source_concept")), flag: F.when(reason.isNull(), F.col(flag))}).drop("_source_concept")
    if not deduplicate:
        return by_reason(mapped)
    # Rows that went before are ranked among themselves, so they take no place in a key's group.
    rows = ranked(mapped.withColumn("_gone", reason.isNotNull()), [*[k for k in keys if k in mapped.columns], "_gone"], order, prefer)
    return by_reason(rows.withColumn("removal_reason", F.when(reason.isNull() & (F.col("_rank") > 1), F.lit("duplicate")).otherwise(reason)).drop("_rank", "_size", "_gone"))


def unmapped(concepts: DataFrame, mapping: DataFrame, concept: str, source: str = "original_concept_id") -> DataFrame:
    """Concepts that the dictionary lacks."""
    return concepts.join(mapping.select(F.col(source).alias(concept)).distinct(), concept, "left_anti")


def mark_present(mapped: DataFrame, present: DataFrame, target: str = "snomed_concept_id", concept: str = "Id") -> DataFrame:
    """Adds already_present: whether the target is among the native concepts."""
    native = present.select(F.col(concept).alias("_native")).distinct()
    return mapped.join(native, F.col(target) == F.col("_native"), "left").withColumn("already_present", F.col("_native").isNotNull()).drop("_native")


def build_mapping(concepts: DataFrame, mappings: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Dictionary of a table and its statistics.

    ``concepts`` has Id, Code, Name, Vocab, Frequency; ``mappings`` has Id, mapping_status, snomed_* and mapping_relationship.
    Native SNOMED concepts stay; mapped ones get the target, class and domain of their table."""
    usable = mappings.where((F.col("mapping_status") == "Mapped") & ~blank(F.col("snomed_concept_id"))).select(F.col("Id").alias("_id"), "snomed_concept_id", "snomed_concept_code", F.trim("snomed_concept_name").alias("snomed_concept_name"), "mapping_relationship")
    native = concepts.where(F.col("Vocab") == "SNOMED")
    rest = concepts.where(F.col("Vocab") != "SNOMED").join(usable, F.col("Id") == F.col("_id"), "left").drop("_id")
    met = mark_present(rest, native)
    kind, domain = MAPPED_CLASS[table]
    reference = met.where(F.col("snomed_concept_id").isNotNull()).select(
        F.col("Id").alias("original_concept_id"), F.col("Code").alias("original_code"), F.col("Name").alias("original_name"), F.col("Vocab").alias("original_vocab"),
        "snomed_concept_id", "snomed_concept_code", "snomed_concept_name", F.lit("SNOMED").alias("snomed_vocab"), "mapping_relationship", F.col("Frequency").alias("frequency"), F.lit(kind).alias("standard_class"), F.lit(domain).alias("domain"),
    )
    hit = F.col("snomed_concept_id").isNotNull()
    outcome = F.when(hit & F.col("already_present"), "mapped_existing").when(hit, "mapped_new").otherwise("unmapped")
    outcomes = met.select(outcome.alias("o"), "Vocab").unionAll(native.select(F.lit("already_snomed").alias("o"), "Vocab"))
    cpt = F.count_if((F.col("o") == "unmapped") & (F.col("Vocab") == "CPT4")).alias("unmapped_cpt4")
    stats = outcomes.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("o") == k).alias(k) for k in ("already_snomed", "mapped_existing", "mapped_new", "unmapped")], cpt)
    return reference, stats


def relationships(reference: DataFrame) -> DataFrame:
    """mapping_relationship, original_vocab, concepts, share: how a reference maps, by kind of link and source vocabulary; shares are percentages of all."""
    counted = reference.groupBy("mapping_relationship", "original_vocab").agg(F.count(F.lit(1)).alias("concepts"))
    total = reference.agg(F.count(F.lit(1)).alias("_all"))
    return counted.join(F.broadcast(total)).withColumn("share", 100.0 * F.col("concepts") / F.col("_all")).drop("_all")


def consolidate(dictionaries: Sequence[DataFrame], mapping: DataFrame, drop: Sequence[str] = ("Domain", "Frequency")) -> DataFrame:
    """Union of concept dictionaries without the concepts a mapping already has, and without the columns to drop."""
    every = dictionaries[0]
    for more in dictionaries[1:]:
        every = every.unionByName(more, allowMissingColumns=True)
    kept = every.join(mapping.select(F.col("original_concept_id").alias("Id")).distinct(), "Id", "left_anti")
    return kept.drop(*drop)
