"""Operator 2, exact dedup: two-pass Bloom filtering, then an exact grouping of the few rows that may repeat.

Pass one hashes every whole text without its white space and folds the hashes into a filter of the positions that were hit
more than once. Pass two tests every row: rows that miss the filter are unique and pass straight through; only rows that
hit it shuffle, keyed by SHA-256. Of digests, copies are combined before the exchange, so one group that holds a third of
all rows costs a counter per task. exact_dedup() moves no text; drop_repeats() moves one text a group.

Defined results: null text counts as empty, and empty texts are one group. Of equal texts the one with the most code points
stays, then the smallest doc_id (null is smallest); if rows repeat with one doc_id, exactly one of them stays. An empty
table gives an empty result. Columns beside the id and the text are never read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import SPACE, row_of, staged, table

#: Filter bits for each row; two probes at this load let about 1 % of unique rows through.
BITS_PER_ROW = 16
#: The filter is broadcast and has at most so many 64-bit words (about 64 MB as a hash relation).
BROADCAST_WORDS = 1 << 20


class Digest(NamedTuple):
    """rows: one digest row per document, flagged ``_maybe``; groups: one row per text of those rows; words, bits: the filter."""

    rows: DataFrame
    groups: DataFrame
    words: DataFrame
    bits: int


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", "")


def _probes(h: Column, bits: int) -> list[Column]:
    return [F.pmod(h, F.lit(bits)), F.pmod(F.xxhash64(h), F.lit(bits))]


def filter_bits(rows: int) -> int:
    """Size of the filter for so many hashes; a full filter lets more rows through, but loses none."""
    return max(1024, min(64 * BROADCAST_WORDS, BITS_PER_ROW * rows))


def repeated_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """64-bit words (word, mask) of the Bloom filter of positions that at least two rows hit; column ``_h`` holds hashes."""
    hit = hashes.select(F.explode(F.array(*_probes(F.col("_h"), bits))).alias("p")).groupBy("p").count().where("count > 1")
    return hit.groupBy(F.shiftright("p", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("mask"))


def maybe_repeated(rows: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """Second pass: adds ``_maybe``, true where both probes hit the filter."""
    side = F.broadcast(words)
    for k, probe in enumerate(_probes(F.col("_h"), bits)):
        rows = rows.withColumn(f"_p{k}", probe).withColumn(f"_w{k}", F.shiftright(f"_p{k}", 6))
        rows = rows.join(side.toDF(f"_w{k}", f"_m{k}"), f"_w{k}", "left")
    hit = [F.coalesce(F.expr(f"getbit(_m{k}, cast(_p{k} & 63 AS int)) = 1"), F.lit(False)) for k in (0, 1)]
    return rows.withColumn("_maybe", hit[0] & hit[1]).drop(*(f"_{c}{k}" for c in "pwm" for k in (0, 1)))


def _row_key(id_col: Column, text: Column) -> Column:
    """Hash of the id and the whole text: rows that share it are alike but for columns that are never compared."""
    return F.xxhash64(id_col, F.coalesce(text, F.lit("")))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Digest:
    norm = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")).select("doc_id", F.length("_t").cast("long").alias("_n"), _row_key(F.col("doc_id"), F.col("_t")).alias("_key"), normalised(F.col("_t")).alias("_t"))
    rows = staged(norm.select("doc_id", "_n", "_key", F.xxhash64("_t").alias("_h"), F.sha2("_t", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("_row")), "digest")
    bits = filter_bits(rows.count())
    words = staged(repeated_filter(rows, bits), "bloom")
    rows = staged(maybe_repeated(rows, words, bits), "tested")
    first = F.min(F.struct((-F.col("_n")).alias("n"), "doc_id", "_row", "_key"))
    groups = rows.where("_maybe").groupBy("text_sha256").agg(first.alias("_first"), F.count(F.lit(1)).alias("group_size"))
    groups = staged(groups.select("text_sha256", F.col("_first.doc_id").alias("keep_id"), F.col("_first._row").alias("_keep"), F.col("_first._key").alias("_keep_key"), "group_size"), "groups")
    return Digest(rows, groups, words, bits)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    found = digest(docs, id_col, text_col)
    one = F.lit(1).cast("long")
    alone = found.rows.where(~F.col("_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), one.alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    # Rows that are alone in spite of the filter need no join.
    groups = found.groups.where("group_size > 1")
    grouped = found.rows.where("_maybe").drop("_h", "_key").join(groups, "text_sha256", "left")
    own = F.col("group_size").isNull()
    grouped = grouped.select("doc_id", F.when(own, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", one).alias("group_size"), (own | (F.col("_keep") == F.col("_row"))).alias("kept"), "text_sha256")
    return alone.unionByName(grouped)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: those that exact_dedup() keeps.

    Texts of unique rows do not move, nor do those of dropped ones: of the rows that the filter lets through, only those that
    a second filter takes for the one that stays are dealt, by a key that no two different rows share."""
    found = digest(docs, id_col, text_col)
    stay = found.groups.select(F.col("_keep_key").alias("_h"), F.col("text_sha256").alias("_sha"))
    bits = filter_bits(stay.count())
    words = staged(repeated_filter(stay.select("_h").unionAll(stay.select("_h")), bits), "bloom")
    text = F.col("_doc")[text_col]
    held = docs.select(row_of(docs).alias("_doc"), F.xxhash64(normalised(F.col(text_col))).alias("_h"))
    tested = maybe_repeated(held, found.words, found.bits).drop("_h")
    near = maybe_repeated(tested.where("_maybe").select("_doc", _row_key(F.col("_doc")[id_col], text).alias("_h")), words, bits).where("_maybe")
    # Rows alike in id and text are one before they are dealt.
    near = near.select("_doc", "_h", F.sha2(normalised(text), 256).alias("_sha")).dropDuplicates(["_h", "_sha"])
    kept = near.join(stay, ["_h", "_sha"], "left_semi").select("_doc.*")
    return tested.where(~F.col("_maybe")).select("_doc.*").unionByName(kept)


def query(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
