"""Operator 10, quality rules: word and line statistics, then a hashed n-gram log-likelihood ratio.

Every document is scored by the mean, over its hashed word n-grams, of log p_target(bucket) - log p_raw(bucket). The raw
multinomial counts every n-gram of every document; the target multinomial counts those of all trusted documents (labelled
quality 1), whose ids are joined by a shuffle of ids and texts. Documents whose mean is below ``THRESHOLD`` are rejected, all by the
same rule. Both tables have ``BUCKETS`` rows whatever the input, so the weights travel as one literal of 64 KB.

Scores are evaluated within the row. N-grams shuffle only as bucket counts, which are combined to at most BUCKETS rows a
task before.

Defined results: null and empty texts have no words, all counts 0, base_failed true, kept false, llr 0. Repeated rows and
null ids are scored each on their own. Without trusted documents all weights are 0 and only the base rule rejects.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import let, row_of, table, words_of

BUCKETS = 1 << 16
#: Mean log ratio under which a document is rejected.
THRESHOLD = -0.16
#: Share of the target's mean count of a bucket that is added to both its count of a bucket and the count the raw corpus would
#: lead one to expect: buckets that the target is too small to tell about weigh next to nothing, so clean texts of rare words
#: stay. A share, so that the same corpus at another size has the same weights; this one is 10 counts at 3,409 trusted documents.
PSEUDO = 0.24
#: Weights are kept as one byte each, in steps of 1/32 from -2.5 to 1.46875; 80 stands for 0.
STEP, LOWEST = 32, -2.5
MIN_WORDS, SYMBOLS = 50, "[#*$%&|<>]"


def buckets(words: Column) -> Column:
    """Buckets of all word 1- and 2-grams of an array of words."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    two = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.when(b.isNotNull(), F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int")))
    return F.array_compact(F.concat(one, two))


def fit_weights(docs: DataFrame, trusted: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> bytes:
    """One byte a bucket: the quantised log ratio of the target to the raw multinomial. ``trusted`` holds ids."""
    ids = trusted.select(F.col(id_col).alias("_id"), F.lit(0).cast("long").alias("_salt"), F.lit(1).alias("_target")).where("_id IS NOT NULL").distinct()
    text, salt = F.col(text_col), F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.lit(0))  # null ids are not trusted, and spread
    marked = docs.select(F.col(id_col).alias("_id"), salt.cast("long").alias("_salt"), text.alias("_t")).join(ids.hint("shuffle_hash"), ["_id", "_salt"], "left")
    grams = marked.select(F.coalesce("_target", F.lit(0)).alias("target"), F.explode(let(words_of(F.col("_t")), buckets)).alias("b"))
    counts = grams.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for r in counts:
        raw[r.b], target[r.b] = r.raw, r.target
    n_raw, n_target = sum(raw), sum(target)
    if not n_target:
        return bytes([int(-LOWEST * STEP)]) * BUCKETS
    more = PSEUDO * n_target / BUCKETS
    ratio = ((t + more) / (r * n_target / n_raw + more) for t, r in zip(target, raw, strict=True))
    return bytes(max(0, min(127, round((math.log(x) - LOWEST) * STEP))) for x in ratio)


def mean_ratio(words: Column, weights: bytes) -> Column:
    """Length-normalised log-likelihood ratio of an array of words; 0 without words."""
    packed = F.lit(bytearray(weights))
    weight = lambda b: F.ascii(F.substring(packed, b + 1, F.lit(1)).cast("string"))
    total = lambda g: F.aggregate(g, F.lit(0).cast("long"), lambda acc, b: acc + weight(b))
    return let(buckets(words), lambda g: F.when(F.size(g) > 0, F.round(total(g) / (F.size(g) * STEP) + LOWEST, 6)).otherwise(F.lit(0.0)))


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first occurrence included."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = lambda z: F.filter(z, lambda e, k: ((k > 0) & (F.get(z, k - 1)["h"] == e["h"])) | F.coalesce(F.get(z, k + 1)["h"] == e["h"], F.lit(False)))
        starts = F.array_sort(F.transform(let(ordered, again), lambda e: e["i"]))
        gaps = lambda p: F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(let(starts, gaps), F.lit(0), lambda acc, x: acc + x)

    return F.when(F.size(words) < 3, 0).otherwise(let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))


def statistics(text: Column, weights: bytes) -> Column:
    """Struct of the counts, the base verdict, the ratio and the final verdict."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    long = lambda c: c.cast("long")
    counted = let(words_of(text), lambda w: F.struct(long(F.size(w)).alias("n_words"), long(F.length(F.array_join(w, ""))).alias("word_chars"), long(repeat_words(w)).alias("n_repeat_words"), mean_ratio(w, weights).alias("llr")))
    symbols, again = long(F.regexp_count(plain, F.lit(SYMBOLS))), let(lines, lambda x: long(F.size(x) - F.size(F.array_distinct(x))))

    def verdict(s: Column) -> Column:
        failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
        fields = [s[k].alias(k) for k in ("n_words", "word_chars")] + [symbols.alias("n_symbols"), again.alias("n_dup_lines")]
        return F.struct(*fields, s["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"), (~failed & (s["llr"] >= THRESHOLD)).alias("kept"), s["llr"].alias("llr"))

    return let(counted, verdict)


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def score(docs: DataFrame, weights: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    scored = docs.select(F.col(id_col).alias("doc_id"), statistics(F.col(text_col), weights).alias("_s"))
    return scored.select("doc_id", "_s.*")


def keep_good(docs: DataFrame, weights: bytes, text_col: str = "text") -> DataFrame:
    """The documents that pass, unchanged."""
    held = docs.select(row_of(docs).alias("_doc"))
    return held.where(statistics(F.col("_doc")[text_col], weights)["kept"]).select("_doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit_weights(docs, trusted_ids(spark, sf_dir)))
