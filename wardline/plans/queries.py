"""Every operator bound to the driver's tables, each beside the SQL that gives the same rows.

Roles: customer is the person table, lineitem measurements (concept l_partkey, value l_extendedprice), orders
observations, events visits (an end is derived), part and nation concept dictionaries. Nulls, dirty text and units are
derived by the same expression on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import scalars as X
from wardline.operators import cohort, dedup, episodes, mapping, profile, quality, sampling, standardize, validate
from wardline.operators.split import by_reason, removal_summary
from wardline.sources import files
from wardline.registry import AGE_EDGES, CONVERSIONS, STAY_EDGES, VISIT_TYPE, TableSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Reads the driver's tables by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[name] = sql
        return f

    return register


# --- what both sides derive ------------------------------------------------------------------------------------------

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
BY = ", ".join(ORDER)
LINE_KEY = ["l_orderkey", "l_linenumber"]


def order_of(cols: list[str]) -> list:
    return [F.col(c) for c in cols]


def visits(t: Tables) -> DataFrame:
    """events as visits: an end up to two hours after the start."""
    return t("events").select(F.col("event_id").alias("visit_id"), F.col("user_id").alias("person_id"), F.col("event_type").alias("concept"), F.col("ts").alias("start"), F.expr("timestampadd(MINUTE, cast(event_id % 120 AS int), ts)").alias("end"), "value")


VISITS = "v AS (SELECT event_id AS visit_id, user_id AS person_id, event_type AS concept, ts AS start, ts + to_minutes(CAST(event_id % 120 AS BIGINT)) AS \"end\", value FROM events)"
EPISODES = (
    "o AS (SELECT *, lag(\"end\") OVER w AS before FROM v WINDOW w AS (PARTITION BY person_id, concept ORDER BY start, visit_id)), "
    "e AS (SELECT *, CAST(sum(CASE WHEN before IS NULL OR epoch_us(start) - epoch_us(before) > 3600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY person_id, concept ORDER BY start, visit_id ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS idx FROM o)"
)
EPISODE_ID = "CAST(person_id AS VARCHAR) || '_' || concept || '_' || CAST(idx AS VARCHAR)"
VISIT_ARGS = ("person_id", "concept", "start", "end", "visit_id")


def gaps(t: Tables) -> DataFrame:
    """lineitem columns with derived nulls; the last is null in more than 95 % of rows."""
    return t("lineitem").select(F.expr("nullif(l_returnflag, 'A')").alias("flag"), F.expr("nullif(l_linestatus, 'O')").alias("status"), F.expr("CASE WHEN l_quantity > 25 THEN l_quantity END").alias("quantity"), F.expr("CASE WHEN l_quantity > 49 THEN l_tax END").alias("tax"))


GAPS = "g AS (SELECT nullif(l_returnflag, 'A') AS flag, nullif(l_linestatus, 'O') AS status, CASE WHEN l_quantity > 25 THEN l_quantity END AS quantity, CASE WHEN l_quantity > 49 THEN l_tax END AS tax FROM lineitem)"
GAP_COUNTS = "c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS total, count(*) - count({c}) AS missing FROM g" for c in ("flag", "status", "quantity", "tax")) + ")"


def dirty_concepts(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", F.expr("CASE c_custkey % 7 WHEN 0 THEN ' 0 ' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '0.0' ELSE cast(c_nationkey AS string) END").alias("concept"))


DIRTY = "d AS (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN ' 0 ' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '0.0' ELSE CAST(c_nationkey AS VARCHAR) END AS concept FROM customer)"


def spells(t: Tables) -> DataFrame:
    """orders with a text start and an end one or two days around it, some empty."""
    end = "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE date_format(timestampadd(DAY, cast(o_custkey % 5 AS int) - 2, o_orderdate), 'yyyy-MM-dd') END"
    return t("orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.expr("date_format(o_orderdate, 'yyyy-MM-dd')").alias("start"), F.expr(end).alias("end"))


SPELLS = "s AS (SELECT o_orderkey, o_custkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS start, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE strftime(o_orderdate + to_days(CAST(o_custkey % 5 AS INTEGER) - 2), '%Y-%m-%d') END AS \"end\" FROM orders)"


def canonical(t: Tables) -> DataFrame:
    """Dictionary of parts: each to the first part of its brand and type; parts divisible by 4 are not in it."""
    first = t("part").groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("target"))
    return t("part").where("p_partkey % 4 <> 0").join(first, ["p_brand", "p_type"]).select(F.col("p_partkey").alias("original_concept_id"), F.col("target").alias("snomed_concept_id"))


CANONICAL = "m AS (SELECT p_partkey AS src, min(p_partkey) OVER (PARTITION BY p_brand, p_type) AS target FROM part QUALIFY p_partkey % 4 <> 0)"


def dictionary(t: Tables) -> tuple[DataFrame, DataFrame]:
    concepts = t("part").select(F.col("p_partkey").alias("Id"), F.col("p_brand").alias("Code"), F.col("p_name").alias("Name"), F.expr("CASE WHEN p_partkey % 3 = 0 THEN 'SNOMED' ELSE 'LOCAL' END").alias("Vocab"), F.col("p_size").cast("long").alias("Frequency"))
    maps = t("part").select(F.col("p_partkey").alias("Id"), F.expr("CASE WHEN p_partkey % 5 = 0 THEN 'Unmapped' ELSE 'Mapped' END").alias("mapping_status"), F.expr("CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey * 7 % 3000 END").alias("snomed_concept_id"), F.col("p_type").alias("snomed_concept_code"), F.expr("concat(' ', p_type, ' ')").alias("snomed_concept_name"), F.lit("Maps to").alias("mapping_relationship"))
    return concepts, maps


DICTIONARY = (
    "c AS (SELECT p_partkey AS id, p_brand AS code, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN 'SNOMED' ELSE 'LOCAL' END AS vocab, CAST(p_size AS BIGINT) AS freq, p_type FROM part), "
    "r AS (SELECT c.*, CASE WHEN id % 5 <> 0 AND id % 7 <> 0 THEN id * 7 % 3000 END AS target FROM c WHERE vocab <> 'SNOMED')"
)


def people(t: Tables) -> DataFrame:
    """customer as persons: two genders and another code, races with a missing one, a year of birth with gaps."""
    return t("customer").select(
        F.col("c_custkey").alias("person_id"), F.expr("CASE c_nationkey % 3 WHEN 0 THEN 8507 WHEN 1 THEN 8532 ELSE 8551 END").alias("gender_concept_id"),
        F.expr("CASE c_nationkey % 5 WHEN 0 THEN 8527 WHEN 1 THEN 8516 WHEN 2 THEN 0 WHEN 3 THEN 9999 END").alias("race_concept_id"), F.expr("CASE WHEN c_custkey % 10 <> 0 THEN cast(1920 + c_custkey % 80 AS int) END").alias("year_of_birth"),
    )


PEOPLE = (
    "p AS (SELECT c_custkey AS person_id, CASE c_nationkey % 3 WHEN 0 THEN 8507 WHEN 1 THEN 8532 ELSE 8551 END AS g, "
    "CASE c_nationkey % 5 WHEN 0 THEN 8527 WHEN 1 THEN 8516 WHEN 2 THEN 0 WHEN 3 THEN 9999 END AS r, CASE WHEN c_custkey % 10 <> 0 THEN CAST(1920 + c_custkey % 80 AS INTEGER) END AS yob, c_acctbal FROM customer)"
)
GENDER_SQL = "CASE g WHEN 8507 THEN 'Male' WHEN 8532 THEN 'Female' ELSE 'Other(' || CAST(g AS VARCHAR) || ')' END"
RACE_SQL = "CASE WHEN r IS NULL THEN NULL WHEN r = 8527 THEN 'White' WHEN r = 8516 THEN 'Black' WHEN r = 0 THEN 'Unknown' ELSE 'Other(' || CAST(r AS VARCHAR) || ')' END"


def index_of(t: Tables) -> DataFrame:
    """First and last urgent order of each person."""
    return cohort.index_times(t("orders"), "o_custkey", "o_orderpriority", "o_orderdate", "o_orderdate", ["1-URGENT", "2-HIGH"]).toDF("person_id", "first", "last")


def pooled(t: Tables) -> DataFrame:
    """Order dates and, as a second table, ship dates of the order's customer."""
    lines = t("lineitem").join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return cohort.events([(t("orders"), "o_custkey", "o_orderdate"), (lines, "o_custkey", "l_shipdate")])


INDEX = "i AS (SELECT o_custkey AS person_id, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1)"
POOLED = "q AS (SELECT o_custkey AS person, o_orderdate AS time FROM orders UNION ALL SELECT o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
BEFORE = (
    "b AS (SELECT i.person_id, i.first, count(q.time) AS n, min(q.time) AS earliest, max(q.time) AS latest FROM i LEFT JOIN q ON q.person = i.person_id AND q.time <= i.first GROUP BY 1, 2), "
    "k AS (SELECT b.*, CASE WHEN n = 0 THEN 0 ELSE (epoch_us(latest) - epoch_us(earliest)) // 86400000000 + 1 END AS days, year(first) - yob AS age, g, r, c_acctbal < 0 AS died FROM b LEFT JOIN p USING (person_id))"
)
COHORT_WITH = f"WITH {PEOPLE}, {INDEX}, {POOLED}, {BEFORE}"


def statistics(t: Tables) -> DataFrame:
    died = t("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("person_id"))
    return cohort.cohort_statistics(index_of(t), pooled(t), people(t), died, "person_id", "first")


def written(t: Tables) -> DataFrame:
    """Order dates as text in nine layouts, two of them none."""
    formats = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy-MM-dd HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy"]
    cases = " ".join(f"WHEN {k} THEN date_format(o_orderdate, '{f}')" for k, f in enumerate(formats))
    return t("orders").select("o_orderkey", F.expr(f"CASE o_orderkey % 9 {cases} WHEN 7 THEN '2024-13-01' ELSE concat(' ', date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), '.123') END").alias("raw"))


_DUCK = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y-%m-%d %H:%M", "%Y/%m/%d %H:%M:%S", "%Y/%m/%d", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y"]
WRITTEN = "w AS (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 9 " + " ".join(f"WHEN {k} THEN strftime(o_orderdate, '{f}')" for k, f in enumerate(_DUCK)) + " WHEN 7 THEN '2024-13-01' ELSE ' ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.123' END AS raw FROM orders)"
NORMAL = "CASE WHEN o_orderkey % 9 = 7 THEN raw WHEN o_orderkey % 9 IN (1, 4, 6) THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(CASE WHEN o_orderkey % 9 = 2 THEN date_trunc('minute', o_orderdate) ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') END"


def measured(t: Tables) -> DataFrame:
    """lineitem as measurements of nine concepts in mixed units."""
    concept = "CASE l_linenumber WHEN 1 THEN 37174455 WHEN 2 THEN 3036277 WHEN 3 THEN 4151414 WHEN 4 THEN 3020891 ELSE 4097430 END"
    unit = "CASE l_linenumber WHEN 1 THEN (CASE WHEN l_suppkey % 2 = 0 THEN 'lb' ELSE 'kg' END) WHEN 2 THEN (CASE WHEN l_suppkey % 2 = 0 THEN 'inch' ELSE 'cm' END) WHEN 3 THEN (CASE WHEN l_suppkey % 2 = 0 THEN 'mmol/L' ELSE 'mg/dL' END) WHEN 4 THEN (CASE WHEN l_suppkey % 2 = 0 THEN 'Fahrenheit' ELSE 'Celsius' END) ELSE 'mEq/L' END"
    return t("lineitem").select(*LINE_KEY, F.expr(concept).alias("concept"), F.expr(unit).alias("unit"), F.col("l_quantity").alias("value"))


MEASURED = (
    "x AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 37174455 WHEN 2 THEN 3036277 WHEN 3 THEN 4151414 WHEN 4 THEN 3020891 ELSE 4097430 END AS concept, "
    "CASE WHEN l_linenumber > 4 THEN 'mEq/L' WHEN l_suppkey % 2 = 0 THEN ['lb', 'inch', 'mmol/L', 'Fahrenheit'][l_linenumber] ELSE ['kg', 'cm', 'mg/dL', 'Celsius'][l_linenumber] END AS unit, l_quantity AS value FROM lineitem)"
)
CONVERTED = "CASE unit WHEN 'lb' THEN value * 0.453592 WHEN 'inch' THEN value * 2.54 WHEN 'mmol/L' THEN value * 18.0182 WHEN 'Fahrenheit' THEN (value - 32) * 5 / 9 ELSE value END"
LIMITS = "t AS (SELECT event_type, quantile_cont(value, 0.01) AS lower, quantile_cont(value, 0.99) AS upper FROM events GROUP BY 1 HAVING count(*) >= 10)"


# --- scans, filters, rejects -----------------------------------------------------------------------------------------

@query("scan_project", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem WHERE l_quantity > 45")
def _(t):
    return t("lineitem").where("l_quantity > 45").select(*LINE_KEY, F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"))


@query("null_profile", f"WITH {GAPS}, {GAP_COUNTS} SELECT column_name, total, missing, round(100.0 * missing / total, 6) AS missing_percentage FROM c")
def _(t):
    return quality.null_profile(gaps(t)).withColumn("missing_percentage", F.round("missing_percentage", 6))


@query("prune_columns_decision", f"WITH {GAPS}, {GAP_COUNTS} SELECT column_name, missing, 100.0 * missing / total > 95 AS removed FROM c")
def _(t):
    return quality.prune_columns(gaps(t))[1].select("column_name", "missing", "removed")


@query("invalid_key_reject", f"WITH {DIRTY} SELECT c_custkey, concept, coalesce(trim(concept), '') IN ('', '0') AS rejected FROM d")
def _(t):
    split = quality.reject_invalid(dirty_concepts(t), "concept")
    return split.kept.select("c_custkey", "concept", F.lit(False).alias("rejected")).unionAll(split.rejected.select("c_custkey", "concept", F.lit(True)))


@query("temporal_reject", f"WITH {SPELLS} SELECT o_orderkey, start AS start_datetime, \"end\" AS end_datetime, 'end_before_start' AS temporal_issue_reason FROM s WHERE \"end\" <> '' AND \"end\" < start")
def _(t):
    return quality.reject_temporal(spells(t), "start", "end").rejected.select("o_orderkey", "start_datetime", "end_datetime", "temporal_issue_reason")


@query("low_freq_filter", "SELECT l_partkey, count(*) AS records FROM lineitem GROUP BY 1 HAVING count(*) > 25")
def _(t):
    return quality.reject_rare(t("lineitem"), "l_partkey", 25).kept.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("records"))


@query("low_freq_rejects", f"WITH f AS (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS n FROM lineitem) SELECT l_orderkey, l_linenumber, l_suppkey, 'low_frequency_concept (l_partkey=' || l_partkey || ', freq=' || n || ')' AS removal_reason FROM f WHERE n <= 25")
def _(t):
    return quality.reject_rare(t("lineitem"), "l_partkey", 25).rejected.select(*LINE_KEY, "l_suppkey", "removal_reason")


@query("removal_summary", "WITH f AS (SELECT count(*) OVER (PARTITION BY l_partkey) AS n, count(*) OVER () AS total FROM lineitem) SELECT 'lineitem' AS \"table\", 'low_frequency_concept' AS removal_reason, count(*) AS count, round(100.0 * count(*) / any_value(total), 6) AS percentage FROM f WHERE n <= 25")
def _(t):
    rows = t("lineitem")
    gone = quality.reject_rare(rows, "l_partkey", 25).rejected.withColumn("removal_reason", F.split("removal_reason", " ")[0])
    return removal_summary(gone, "lineitem", rows.count()).withColumn("percentage", F.round("percentage", 6))


@query("membership_filter", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'purchase')")
def _(t):
    return t("events").where(F.col("event_type").isin("error", "purchase")).select("event_id", "event_type")


@query("prefix_filter", "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE 'Customer#00000001%' OR c_name LIKE 'Customer#00000002%' OR c_name LIKE 'C1%'")
def _(t):
    return sampling.with_prefix(t("customer"), "c_name", ["Customer#00000001", "Customer#00000002", "C1"]).select("c_custkey", "c_name")


@query("not_null_finite", "SELECT event_id, value FROM events WHERE event_id % 5 > 2 AND value IS NOT NULL")
def _(t):
    v = F.expr("CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') WHEN 2 THEN double('Infinity') ELSE value END")
    return t("events").select("event_id", v.alias("value")).where(X.finite(F.col("value")))


@query("duration_range", f"WITH {VISITS} SELECT visit_id, (epoch_us(\"end\") - epoch_us(start)) / 6e7 AS minutes FROM v WHERE (epoch_us(\"end\") - epoch_us(start)) / 6e7 BETWEEN 30 AND 60")
def _(t):
    return visits(t).select("visit_id", X.elapsed(F.col("start"), F.col("end"), "minutes").alias("minutes")).where(F.col("minutes").between(30, 60))


@query("status_filter_subset", f"WITH {DICTIONARY} SELECT id AS \"Id\", id * 7 % 3000 AS snomed_concept_id FROM c WHERE id % 5 <> 0 AND id % 7 <> 0")
def _(t):
    maps = dictionary(t)[1].where((F.col("mapping_status") == "Mapped") & ~X.blank(F.col("snomed_concept_id")))
    return maps.select([c for c in ("Id", "snomed_concept_id", "absent") if c in maps.columns])


# --- deduplication ---------------------------------------------------------------------------------------------------

RANKED = f"r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {BY}) AS rk, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)"


@query("dedup_keep_first", f"WITH {RANKED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM r WHERE rk = 1")
def _(t):
    return dedup.dedup(t("lineitem"), LINE_KEY, order_of(ORDER)).kept.select(*LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice")


@query("dedup_audit", f"WITH {RANKED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN rk = 1 THEN 'kept' ELSE 'removed' END AS duplicate_status, n AS group_size FROM r WHERE n > 1")
def _(t):
    rows = dedup.ranked(t("lineitem"), LINE_KEY, order_of(ORDER)).where("_size > 1")
    return rows.select(*LINE_KEY, "l_partkey", "l_suppkey", F.when(F.col("_rank") == 1, "kept").otherwise("removed").alias("duplicate_status"), F.col("_size").alias("group_size"))


@query("dup_group_numbers", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rk FROM events), g AS (SELECT user_id, event_type, 'EVENTS_' || row_number() OVER (ORDER BY event_id) AS gid FROM r WHERE rk = 2) SELECT event_id, gid AS duplicate_group_id, CASE WHEN rk = 1 THEN 'kept' ELSE 'removed' END AS duplicate_status, event_id AS original_row_number FROM r JOIN g USING (user_id, event_type)")
def _(t):
    return dedup.audit(t("events"), ["user_id", "event_type"], [F.col("event_id")], "event_id", "EVENTS").select("event_id", "duplicate_group_id", "duplicate_status", "original_row_number")


@query("dedup_prefer_value", f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity > 25 DESC, {BY}) AS rk FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM r WHERE rk = 1")
def _(t):
    return dedup.dedup(t("lineitem"), LINE_KEY, order_of(ORDER), F.col("l_quantity") > 25).kept.select(*LINE_KEY, "l_partkey", "l_quantity")


SPELL_RULES = "r AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) > 1 THEN 'duplicate' WHEN o_orderpriority = '5-LOW' THEN 'invalid_concept' WHEN \"end\" <> '' AND \"end\" < start THEN 'temporal_issue' END AS reason FROM s)"
SPELL_SPEC = TableSpec("SPELLS", "o_orderkey", ("o_custkey", "o_orderpriority"), ("o_orderkey",), "o_orderpriority", "concept", "start", "end")


def _spells_with_concept(t):
    return spells(t).withColumn("concept", F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN '0' ELSE o_orderpriority END"))


@query("rule_cascade_counts", f"WITH {SPELLS}, {SPELL_RULES} SELECT coalesce(reason, 'kept') AS outcome, count(*) AS records FROM r GROUP BY 1")
def _(t):
    return by_reason(quality.cascade(_spells_with_concept(t), SPELL_SPEC, [F.col("o_orderkey")])).stats


@query("clean_table", f"WITH {SPELLS}, {SPELL_RULES} SELECT o_orderkey, o_custkey, start FROM r WHERE reason IS NULL")
def _(t):
    return quality.clean_table(_spells_with_concept(t), SPELL_SPEC, [F.col("o_orderkey")]).kept.select("o_orderkey", "o_custkey", "start")


@query("first_per_person", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def _(t):
    return dedup.dedup(t("events"), ["user_id"], [F.col("ts"), F.col("event_id")]).kept.select("user_id", "event_id", "event_type")


# --- profiles and counts ---------------------------------------------------------------------------------------------

@query("distinct_ids", "SELECT 'o_orderkey' AS column_name, count(DISTINCT o_orderkey) AS distinct_count FROM orders UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey) FROM orders")
def _(t):
    return profile.distinct_ids(t("orders"), ["o_orderkey", "o_custkey"])


@query("value_counts", "SELECT o_orderpriority AS value, count(*) AS count FROM orders GROUP BY 1")
def _(t):
    return profile.value_counts(t("orders"), "o_orderpriority")


@query("date_ranges", "SELECT 'o_orderdate' AS column_name, CAST(min(o_orderdate) AS VARCHAR) AS least, CAST(max(o_orderdate) AS VARCHAR) AS most FROM orders UNION ALL SELECT 'o_custkey', CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders")
def _(t):
    return profile.ranges(t("orders"), ["o_orderdate", "o_custkey"])


_SIZED = ("customer", "orders", "lineitem", "part", "supplier")
_SIZES = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS records FROM {n}" for n in _SIZED)


@query("table_sizes_topk", f"SELECT * FROM ({_SIZES}) ORDER BY records DESC, table_name LIMIT 3")
def _(t):
    return profile.table_sizes({n: t(n) for n in _SIZED}).orderBy(F.desc("records"), "table_name").limit(3)


@query("topn_tables", f"SELECT * FROM ({_SIZES}) ORDER BY records DESC, table_name")
def _(t):
    return profile.table_sizes({n: t(n) for n in _SIZED}).orderBy(F.desc("records"), "table_name")


@query("table_summary", f"WITH {GAPS}, {GAP_COUNTS} SELECT any_value(total) AS records, count(*) AS columns, round(100.0 * sum(missing) / sum(total), 6) AS null_percentage FROM c")
def _(t):
    p = quality.null_profile(gaps(t))
    return p.agg(F.max("total").alias("records"), F.count(F.lit(1)).alias("columns"), F.round(100.0 * F.sum("missing") / F.sum("total"), 6).alias("null_percentage"))


@query("profile_table", "SELECT 'user_id' AS column_name, count(*) AS total, count(*) - count(user_id) AS missing, count(DISTINCT user_id) AS distinct_count FROM events UNION ALL SELECT 'event_id', count(*), count(*) - count(event_id), count(DISTINCT event_id) FROM events UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type), NULL FROM events")
def _(t):
    return profile.table_profile(t("events").select("user_id", "event_id", "event_type")).select("column_name", "total", "missing", "distinct_count")


@query("conditional_counts", "SELECT count(*) FILTER (event_type IN ('error', 'purchase')) AS visits, count(DISTINCT user_id) FILTER (event_type IN ('error', 'purchase')) AS patients FROM events")
def _(t):
    hit = F.col("event_type").isin("error", "purchase")
    return t("events").agg(F.count_if(hit).alias("visits"), F.countDistinct(F.when(hit, F.col("user_id"))).alias("patients"))


@query("mortality_rate", "SELECT count(*) FILTER (c_acctbal < 0) AS deaths, count(*) AS patients, round(100.0 * count(*) FILTER (c_acctbal < 0) / count(*), 6) AS rate FROM customer")
def _(t):
    died = F.count_if(F.col("c_acctbal") < 0)
    return t("customer").agg(died.alias("deaths"), F.count(F.lit(1)).alias("patients"), F.round(X.percent(died, F.count(F.lit(1))), 6).alias("rate"))


@query("grand_totals", f"WITH {SPELLS}, {SPELL_RULES} SELECT coalesce(reason, 'all') AS outcome, count(*) AS records FROM (SELECT coalesce(reason, 'kept') AS reason FROM r) GROUP BY ROLLUP (reason)")
def _(t):
    rows = quality.cascade(_spells_with_concept(t), SPELL_SPEC, [F.col("o_orderkey")]).select(F.coalesce("removal_reason", F.lit("kept")).alias("reason"))
    return rows.rollup("reason").agg(F.count(F.lit(1)).alias("records")).select(F.coalesce("reason", F.lit("all")).alias("outcome"), "records")


@query("group_proportion", "SELECT c_mktsegment, count(*) AS g, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM customer GROUP BY 1")
def _(t):
    sizes = t("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("g"))
    whole = sizes.agg(F.sum("g").alias("t")).first().t
    return sizes.withColumn("share", F.round(F.col("g") / F.lit(whole or 1), 6))


@query("records_per_person_pivot", "SELECT p AS person_id, count(*) FILTER (k = 'orders') AS orders, count(*) FILTER (k = 'events') AS events FROM (SELECT o_custkey AS p, 'orders' AS k FROM orders UNION ALL SELECT user_id, 'events' FROM events) GROUP BY 1")
def _(t):
    return profile.records_per_person({"orders": t("orders").withColumnRenamed("o_custkey", "person_id"), "events": t("events").withColumnRenamed("user_id", "person_id")})


@query("monthly_volume", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS records FROM orders GROUP BY 1")
def _(t):
    return profile.monthly(t("orders"), "o_orderdate")


@query("month_bucket", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def _(t):
    return t("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))


@query("peak_month", "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS records FROM orders GROUP BY 1) SELECT (SELECT month FROM m ORDER BY records DESC, month LIMIT 1) AS peak_month, max(records) AS peak_records, round(avg(records), 6) AS mean_records FROM m")
def _(t):
    return profile.peak_month(t("orders"), "o_orderdate").withColumn("mean_records", F.round("mean_records", 6))


def _bins(value: str, edges) -> str:
    last = len(edges) - 2
    return "CASE " + " ".join(f"WHEN {value} >= {a} AND {value} {'<=' if k == last else '<'} {b} THEN '{a}-{b}'" for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))) + " END"


@query("duration_bins", f"WITH {INDEX} SELECT {_bins('d', STAY_EDGES)} AS bin, count(*) AS records FROM (SELECT (epoch_us(last) - epoch_us(first)) // 86400000000 AS d FROM i) GROUP BY 1")
def _(t):
    days = index_of(t).select(X.elapsed(F.col("first"), F.col("last"), "days").alias("d"))
    return days.groupBy(X.binned(F.col("d"), STAY_EDGES).alias("bin")).agg(F.count(F.lit(1)).alias("records"))


@query("age_bins", f"WITH {PEOPLE} SELECT {_bins('2024 - yob', AGE_EDGES)} AS bin, count(*) AS records FROM p GROUP BY 1")
def _(t):
    return people(t).groupBy(X.binned(2024 - F.col("year_of_birth"), AGE_EDGES).alias("bin")).agg(F.count(F.lit(1)).alias("records"))


@query("topk_per_group", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 5")
def _(t):
    return profile.top_per_group(t("orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5).select("o_custkey", "o_orderkey", "o_totalprice")


@query("visit_type_topk", "SELECT event_type AS value, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def _(t):
    return profile.value_counts(t("events"), "event_type").orderBy(F.desc("count"), "value").limit(3)


@query("minmax_normalise", "SELECT c_custkey, round((c_acctbal - (SELECT min(c_acctbal) FROM customer)) / ((SELECT max(c_acctbal) FROM customer) - (SELECT min(c_acctbal) FROM customer)), 6) AS scaled FROM customer")
def _(t):
    ends = t("customer").agg(F.min("c_acctbal").alias("a"), F.max("c_acctbal").alias("b")).first()
    return t("customer").select("c_custkey", F.round(X.min_max(F.col("c_acctbal"), F.lit(ends.a), F.lit(ends.b)), 6).alias("scaled"))


@query("minmax_per_person", "SELECT user_id, min(ts) AS earliest, max(ts) AS latest FROM events GROUP BY 1")
def _(t):
    return t("events").groupBy("user_id").agg(F.min("ts").alias("earliest"), F.max("ts").alias("latest"))


# --- concepts and mapping --------------------------------------------------------------------------------------------

@query("concept_frequency", "SELECT l_partkey, count(*) AS freq FROM lineitem GROUP BY 1")
def _(t):
    return quality.frequency(t("lineitem"), "l_partkey")


@query("freq_histogram", "WITH f AS (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey) SELECT count(*) FILTER (n <= 25) AS rare, count(*) FILTER (n > 25) AS frequent FROM f")
def _(t):
    return quality.frequency(t("lineitem"), "l_partkey").agg(F.count_if(F.expr("freq <= 25")).alias("rare"), F.count_if(F.expr("freq > 25")).alias("frequent"))


@query("concept_map_left", f"WITH {CANONICAL} SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(target, l_partkey) AS l_partkey, CASE WHEN target IS NULL THEN 'N' ELSE 'Y' END AS l_partkey_mapped FROM lineitem LEFT JOIN m ON l_partkey = src")
def _(t):
    return mapping.apply_mapping(t("lineitem"), canonical(t), "l_partkey").select(*LINE_KEY, "l_suppkey", "l_partkey", "l_partkey_mapped")


_MAPPED = f"{CANONICAL}, f AS (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS n FROM lineitem), x AS (SELECT l_orderkey, l_shipdate, l_suppkey, l_linenumber, l_extendedprice, coalesce(target, l_partkey) AS c FROM f LEFT JOIN m ON l_partkey = src WHERE n > 25)"


@query("map_then_dedup", f"WITH {_MAPPED}, k AS (SELECT count(*) AS kept FROM (SELECT DISTINCT l_suppkey, c, l_shipdate FROM x)) SELECT 'kept' AS outcome, kept AS records FROM k UNION ALL SELECT 'duplicate', (SELECT count(*) FROM x) - kept FROM k UNION ALL SELECT 'rare', (SELECT count(*) FROM f WHERE n <= 25) FROM k")
def _(t):
    split = mapping.map_table(t("lineitem"), canonical(t), "l_partkey", ["l_suppkey", "l_partkey", "l_shipdate"], order_of(ORDER), 25)
    outcome = F.when(F.col("outcome").startswith("low_frequency"), "rare").otherwise(F.col("outcome"))
    return split.stats.groupBy(outcome.alias("outcome")).agg(F.sum("records").alias("records"))


@query("dedup_after_map", f"WITH {CANONICAL} SELECT DISTINCT l_suppkey, coalesce(target, l_partkey) AS l_partkey, l_shipdate FROM lineitem LEFT JOIN m ON l_partkey = src")
def _(t):
    return mapping.map_table(t("lineitem"), canonical(t), "l_partkey", ["l_suppkey", "l_partkey", "l_shipdate"], order_of(ORDER), 0).kept.select("l_suppkey", "l_partkey", "l_shipdate")


@query("mapping_rate", f"WITH {CANONICAL} SELECT count(l_partkey) AS total_values, count(*) - count(l_partkey) AS null_values, count(src) AS mapped_values, count(DISTINCT src) AS unique_concepts_mapped, round(100.0 * count(src) / count(l_partkey), 6) AS mapping_rate FROM lineitem LEFT JOIN m ON l_partkey = src")
def _(t):
    return mapping.mapping_statistics(t("lineitem"), canonical(t), "l_partkey").withColumn("mapping_rate", F.round("mapping_rate", 6))


@query("unmapped_concepts_anti", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 4 <> 0)")
def _(t):
    return mapping.unmapped(t("lineitem").select("l_partkey").distinct(), canonical(t), "l_partkey")


@query("already_present_mark", f"WITH {DICTIONARY} SELECT id AS \"Id\", target AS snomed_concept_id, coalesce(target IN (SELECT id FROM c WHERE vocab = 'SNOMED'), false) AS already_present FROM r WHERE target IS NOT NULL")
def _(t):
    concepts, maps = dictionary(t)
    usable = maps.where((F.col("mapping_status") == "Mapped") & F.col("snomed_concept_id").isNotNull()).join(concepts.where("Vocab <> 'SNOMED'").select("Id"), "Id", "left_semi")
    return mapping.mark_present(usable, concepts.where("Vocab = 'SNOMED'")).select("Id", "snomed_concept_id", "already_present")


@query("mapping_build", f"WITH {DICTIONARY} SELECT id AS original_concept_id, code AS original_code, vocab AS original_vocab, target AS snomed_concept_id, trim(p_type) AS snomed_concept_name, freq AS frequency, 'Clinical Observation' AS standard_class, 'Measurement' AS domain FROM r WHERE target IS NOT NULL")
def _(t):
    return mapping.build_mapping(*dictionary(t), "MEASUREMENT")[0].select("original_concept_id", "original_code", "original_vocab", "snomed_concept_id", "snomed_concept_name", "frequency", "standard_class", "domain")


@query("builder_stats", f"WITH {DICTIONARY}, n AS (SELECT id FROM c WHERE vocab = 'SNOMED') SELECT (SELECT count(*) FROM c) AS total, (SELECT count(*) FROM n) AS already_snomed, count(*) FILTER (target IN (FROM n)) AS mapped_existing, count(*) FILTER (target NOT IN (FROM n)) AS mapped_new, count(*) FILTER (target IS NULL) AS unmapped, count(*) FILTER (target IS NULL AND id % 2 = 0) AS unmapped_cpt4 FROM r")
def _(t):
    concepts, maps = dictionary(t)
    concepts = concepts.withColumn("Vocab", F.expr("CASE WHEN Vocab <> 'SNOMED' AND Id % 2 = 0 THEN 'CPT4' ELSE Vocab END"))
    return mapping.build_mapping(concepts, maps, "MEASUREMENT")[1]


@query("dictionary_consolidate", "SELECT k AS \"Id\", n AS \"Name\" FROM (SELECT n_nationkey AS k, n_name AS n FROM nation UNION ALL SELECT r_regionkey + 100, r_name FROM region) WHERE k NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 4 <> 0)")
def _(t):
    nations = t("nation").select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Name"), F.lit("nation").alias("Domain"))
    regions = t("region").select((F.col("r_regionkey") + 100).alias("Id"), F.col("r_name").alias("Name"), F.lit(1).alias("Frequency"))
    return mapping.consolidate([nations, regions], canonical(t))


@query("trim_names", "SELECT p_partkey, trim(' ' || p_name || '  ') AS name FROM part")
def _(t):
    return t("part").select("p_partkey", F.trim(F.concat(F.lit(" "), F.col("p_name"), F.lit("  "))).alias("name"))


# --- standardization -------------------------------------------------------------------------------------------------

@query("quantile_thresholds", "SELECT l_partkey, count(*) AS n, round(quantile_cont(l_extendedprice, 0.01), 4) AS lower, round(quantile_cont(l_extendedprice, 0.99), 4) AS upper, round(avg(l_extendedprice) + 1e-7, 4) AS mean, round(stddev_pop(l_extendedprice), 2) AS std FROM lineitem GROUP BY 1 HAVING count(*) >= 10")
def _(t):
    rows = standardize.thresholds(t("lineitem"), "l_partkey", "l_extendedprice")
    return rows.select("l_partkey", "n", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), F.round(F.col("mean") + 1e-7, 4).alias("mean"), F.round("std", 2).alias("std"))


_LEVELS = ", ".join(f"round(quantile_cont(value, {p / 100}), 4) AS p{p}" for p in (1, 5, 25, 50, 75, 95, 99))


@query("quantile_table_7", f"SELECT event_type, count(*) AS n, min(value) AS p0, {_LEVELS}, max(value) AS p100 FROM events GROUP BY 1")
def _(t):
    rows = standardize.quantile_table(t("events"), "event_type", "value")
    return rows.select("event_type", "n", "p0", *[F.round(f"p{p}", 4).alias(f"p{p}") for p in (1, 5, 25, 50, 75, 95, 99)], "p100")


@query("outlier_percentile_split", f"WITH {LIMITS} SELECT event_id, value < lower OR value > upper AS rejected FROM events JOIN t USING (event_type)")
def _(t):
    split = standardize.outliers(t("events"), standardize.thresholds(t("events"), "event_type", "value"), "event_type", "value", {})
    return split.kept.select("event_id", F.lit(False).alias("rejected")).unionAll(split.rejected.select("event_id", F.lit(True)))


_RANGES = {1: ("first", 5.0, 45.0, "u"), 2: ("second", 1.0, 30.0, "u")}


@query("outlier_range_split", "WITH t AS (SELECT l_linenumber, quantile_cont(l_quantity, 0.05) AS lower, quantile_cont(l_quantity, 0.95) AS upper FROM lineitem GROUP BY 1) SELECT l_linenumber, CASE WHEN l_quantity < lower OR l_quantity > upper THEN 'percentile_outlier' WHEN (l_linenumber = 1 AND (l_quantity < 5 OR l_quantity > 45)) OR (l_linenumber = 2 AND (l_quantity < 1 OR l_quantity > 30)) THEN 'range_outlier' ELSE 'kept' END AS outcome, count(*) AS records FROM lineitem JOIN t USING (l_linenumber) GROUP BY 1, 2")
def _(t):
    rows = t("lineitem")
    split = standardize.outliers(rows, standardize.thresholds(rows, "l_linenumber", "l_quantity", 95.0), "l_linenumber", "l_quantity", _RANGES)
    every = split.kept.select("l_linenumber", F.lit("kept").alias("outcome")).unionAll(split.rejected.select("l_linenumber", "removal_reason"))
    return every.groupBy("l_linenumber", "outcome").agg(F.count(F.lit(1)).alias("records"))


@query("threshold_join", "WITH t AS (SELECT l_partkey, quantile_cont(l_extendedprice, 0.99) AS upper FROM lineitem GROUP BY 1 HAVING count(*) >= 30) SELECT l_orderkey, l_linenumber, l_suppkey, upper IS NOT NULL AS has_threshold FROM lineitem LEFT JOIN t USING (l_partkey)")
def _(t):
    limits = standardize.thresholds(t("lineitem"), "l_partkey", "l_extendedprice", least=30).select("l_partkey", "upper")
    return t("lineitem").join(limits, "l_partkey", "left").select(*LINE_KEY, "l_suppkey", F.col("upper").isNotNull().alias("has_threshold"))


@query("unit_convert", f"WITH {MEASURED} SELECT concept, unit, count(*) AS n, round(sum({CONVERTED}), 3) AS total FROM x WHERE concept <> 3020891 GROUP BY 1, 2")
def _(t):
    rows = measured(t).where("concept <> 3020891").withColumn("new", X.convert_units(F.col("concept"), F.col("unit"), F.col("value"), CONVERSIONS))
    return rows.groupBy("concept", "unit").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("new"), 3).alias("total"))


@query("temp_convert", f"WITH {MEASURED} SELECT l_orderkey, unit, round({CONVERTED}, 6) AS celsius FROM x WHERE concept = 3020891")
def _(t):
    rows = measured(t).where("concept = 3020891")
    return rows.select("l_orderkey", "unit", F.round(X.convert_units(F.col("concept"), F.col("unit"), F.col("value"), CONVERSIONS), 6).alias("celsius"))


@query("unit_convert_literal", f"WITH {MEASURED} SELECT concept, count(*) AS n, round(sum(CASE concept WHEN 37174455 THEN value * 0.453592 * 0.453592 WHEN 3036277 THEN value * 2.54 * 2.54 WHEN 4151414 THEN value * 18.0182 WHEN 3020891 THEN (value - 32) * 5 / 9 ELSE value END), 3) AS total FROM x GROUP BY 1")
def _(t):
    rows = measured(t).withColumn("new", X.convert_units(F.col("concept"), None, F.col("value"), CONVERSIONS, gate=False))
    return rows.groupBy("concept").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("new"), 3).alias("total"))


@query("date_normalise", f"WITH {WRITTEN} SELECT o_orderkey, {NORMAL} AS normal FROM w")
def _(t):
    return written(t).select("o_orderkey", X.normalise_date(F.col("raw"), "o_date").alias("normal"))


@query("change_log", f"WITH {WRITTEN}, c AS (SELECT o_orderkey AS row_number, 'raw' AS field, raw AS original_value, {NORMAL} AS new_value, 'date_format' AS change_type FROM w) SELECT * FROM c WHERE original_value <> new_value")
def _(t):
    rows = written(t)
    return standardize.change_log(rows, {"raw": (X.normalise_date(F.col("raw"), "o_date"), "date_format")}, F.col("o_orderkey"))


# --- episodes --------------------------------------------------------------------------------------------------------

@query("episode_ids", f"WITH {VISITS}, {EPISODES} SELECT visit_id, {EPISODE_ID} AS episode_id, idx AS episode_index FROM e")
def _(t):
    return episodes.episode_ids(visits(t), *VISIT_ARGS).select("visit_id", "episode_id", "episode_index")


_GROUPED = "g AS (SELECT person_id, concept, idx, min(start) AS s, max(\"end\") AS f, count(*) AS n, CAST(to_json(list(visit_id ORDER BY start, visit_id)) AS VARCHAR) AS ids, min_by(visit_id, (start, visit_id)) AS base FROM e GROUP BY 1, 2, 3)"


@query("episode_merge", f"WITH {VISITS}, {EPISODES}, {_GROUPED} SELECT {EPISODE_ID} AS episode_id, base AS visit_id, s AS start, f AS \"end\", n AS visits_merged_count, ids AS original_visit_ids, CASE WHEN n > 1 THEN 'Y' ELSE 'N' END AS merge_flag, CASE WHEN n > 1 THEN round((epoch_us(f) - epoch_us(s)) / 3.6e9, 6) END AS merged_duration_hours FROM g")
def _(t):
    rows = episodes.merge(visits(t), *VISIT_ARGS)
    return rows.select("episode_id", "visit_id", "start", "end", "visits_merged_count", "original_visit_ids", "merge_flag", F.round("merged_duration_hours", 6).alias("merged_duration_hours"))


@query("merge_visits", f"WITH {VISITS}, {EPISODES}, {_GROUPED} SELECT merge_flag, count(*) AS episodes, sum(n)::BIGINT AS visits FROM (SELECT *, CASE WHEN n > 1 THEN 'Y' ELSE 'N' END AS merge_flag FROM g) GROUP BY 1")
def _(t):
    return episodes.merge(visits(t), *VISIT_ARGS).groupBy("merge_flag").agg(F.count(F.lit(1)).alias("episodes"), F.sum("visits_merged_count").alias("visits"))


@query("episode_running_end", f"WITH {VISITS}, o AS (SELECT *, max(\"end\") OVER (PARTITION BY person_id, concept ORDER BY start, visit_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v) SELECT person_id, concept, count(*) FILTER (before IS NULL OR epoch_us(start) - epoch_us(before) > 3600000000) AS episodes FROM o GROUP BY 1, 2")
def _(t):
    return episodes.episode_ids(visits(t), *VISIT_ARGS, running=True).groupBy("person_id", "concept").agg((F.max("episode_index") + 1).alias("episodes"))


@query("episode_mapping", f"WITH {VISITS}, {EPISODES} SELECT visit_id AS original_visit_id, {EPISODE_ID} AS merged_episode_id, person_id, concept AS concept_id, 'VISIT_OCCURRENCE' AS table_type FROM e QUALIFY count(*) OVER (PARTITION BY person_id, concept, idx) > 1")
def _(t):
    return episodes.merge_map(visits(t), *VISIT_ARGS)


@query("episode_validate", "SELECT count(*) FILTER (event_id % 7 <> 0) AS ids_in, count(*) FILTER (event_id % 10 <> 0) AS ids_out, count(*) FILTER (event_id % 7 <> 0 AND event_id % 10 = 0) AS lost, count(*) FILTER (event_id % 7 = 0 AND event_id % 10 <> 0) AS added FROM events")
def _(t):
    """A merge that lost a tenth of the visits and has others that were not to be in it."""
    return episodes.validate_merge(visits(t).where("visit_id % 7 <> 0"), episodes.merge(visits(t).where("visit_id % 10 <> 0"), *VISIT_ARGS), "visit_id")


@query("episode_union_missing_cols", f"WITH {VISITS}, {EPISODES}, {_GROUPED} SELECT {EPISODE_ID} AS episode_id, CASE WHEN n > 1 THEN s END AS merged_start_datetime, CASE WHEN n > 1 THEN f END AS merged_end_datetime FROM g")
def _(t):
    return episodes.merge(visits(t), *VISIT_ARGS).select("episode_id", "merged_start_datetime", "merged_end_datetime")


# --- cohorts ---------------------------------------------------------------------------------------------------------

@query("icu_like_summary", "SELECT user_id, min(ts) AS ts_earliest, max(ts) AS ts_latest FROM events WHERE event_type IN ('error', 'purchase') GROUP BY 1")
def _(t):
    return cohort.index_times(t("events"), "user_id", "event_type", "ts", "ts", ["error", "purchase"])


@query("before_index_filter", f"WITH {INDEX} SELECT o_orderkey, o_custkey FROM orders JOIN i ON person_id = o_custkey AND o_orderdate <= first")
def _(t):
    return t("orders").join(index_of(t), (F.col("o_custkey") == F.col("person_id")) & (F.col("o_orderdate") <= F.col("first"))).select("o_orderkey", "o_custkey")


@query("pre_index_stats", f"{COHORT_WITH} SELECT person_id AS patient_id, n AS count_before_icu, days AS days_of_data_before_icu, age AS age_at_icu_admission, {GENDER_SQL} AS gender, {RACE_SQL} AS race, died AS has_death_record FROM k")
def _(t):
    return statistics(t)


@query("cohort_summary", f"{COHORT_WITH} SELECT count(*) AS patients, round(avg(n), 6) AS mean_records, max(n) AS max_records, min(n) AS min_records, round(avg(days), 6) AS mean_days, count(*) FILTER (died) AS deaths, round(avg(age), 6) AS mean_age FROM k")
def _(t):
    rows = cohort.cohort_summary(statistics(t))
    return rows.withColumns({c: F.round(c, 6) for c in ("mean_records", "mean_days", "mean_age")})


@query("person_semi_extract", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(t):
    ids = t("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return cohort.extract(t("orders"), ids, "o_custkey").select("o_orderkey", "o_custkey")


@query("demographic_labels", f"WITH {PEOPLE} SELECT person_id, {GENDER_SQL} AS gender, {RACE_SQL} AS race FROM p")
def _(t):
    from wardline.registry import GENDER, RACE

    return people(t).select("person_id", X.labelled(F.col("gender_concept_id"), GENDER).alias("gender"), X.labelled(F.col("race_concept_id"), RACE).alias("race"))


@query("visit_labels", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Inpatient' WHEN 1 THEN 'Outpatient' WHEN 2 THEN 'ICU' WHEN 3 THEN 'ICU Admission' ELSE 'Other(77)' END AS visit_type FROM orders")
def _(t):
    code = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 9201 WHEN 1 THEN 9202 WHEN 2 THEN 32037 WHEN 3 THEN 581379 ELSE 77 END")
    return t("orders").select("o_orderkey", X.labelled(code, VISIT_TYPE).alias("visit_type"))


@query("label_join", "SELECT o_orderkey, c_mktsegment, coalesce(c_acctbal < 0, false) AS died FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(t):
    people_ = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    died = t("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")).distinct().withColumn("died", F.lit(True))
    return t("orders").join(people_, "o_custkey", "left").join(died, "o_custkey", "left").select("o_orderkey", "c_mktsegment", F.coalesce("died", F.lit(False)).alias("died"))


@query("age_at_index", f"WITH {PEOPLE}, {INDEX} SELECT i.person_id, year(first) - yob AS age FROM i LEFT JOIN p USING (person_id)")
def _(t):
    return index_of(t).join(people(t), "person_id", "left").select("person_id", (F.year("first") - F.col("year_of_birth")).alias("age"))


# --- keys and sets ---------------------------------------------------------------------------------------------------

@query("fk_orphans", "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)")
def _(t):
    return validate.orphans(t("events"), t("customer").where("c_custkey % 3 <> 0"), "user_id", "c_custkey")


@query("pk_duplicates", "SELECT count(*) AS records, count(DISTINCT l_orderkey) AS distinct_keys, count(*) - count(DISTINCT l_orderkey) AS duplicates FROM lineitem")
def _(t):
    return validate.duplicate_keys(t("lineitem"), "l_orderkey")


@query("critical_nulls", f"WITH {PEOPLE} SELECT 'race_concept_id' AS column_name, count(*) - count(r) AS nulls FROM p UNION ALL SELECT 'year_of_birth', count(*) - count(yob) FROM p")
def _(t):
    return validate.critical_nulls(people(t), ["race_concept_id", "year_of_birth"])


@query("union_tables", "SELECT c_custkey AS id, 'customer' AS origin FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def _(t):
    return t("customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("origin")).unionByName(t("supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("origin")))


@query("except_ids", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def _(t):
    return t("customer").select("c_custkey").subtract(t("orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")))


@query("intersect_ids", "SELECT c_custkey FROM customer INTERSECT SELECT user_id FROM events")
def _(t):
    return t("customer").select("c_custkey").intersect(t("events").select(F.col("user_id").alias("c_custkey")))


@query("person_union", "SELECT o_custkey AS person_id FROM orders UNION SELECT user_id FROM events")
def _(t):
    return t("orders").select(F.col("o_custkey").alias("person_id")).union(t("events").select("user_id")).distinct()


@query("set_equality", "SELECT (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT user_id FROM events)) AS only_a, (SELECT count(*) FROM (SELECT user_id FROM events EXCEPT SELECT o_custkey FROM orders)) AS only_b")
def _(t):
    return validate.same_ids(t("orders").select(F.col("o_custkey").alias("id")), t("events").select(F.col("user_id").alias("id")), "id")


# --- sampling and layout ---------------------------------------------------------------------------------------------

_QUOTA = (
    "WITH s AS (SELECT c_mktsegment AS k, count(*) AS g FROM customer GROUP BY 1), b AS (SELECT *, 137 * g / sum(g) OVER () AS ideal FROM s), "
    "f AS (SELECT *, greatest(1, floor(ideal)) AS base, ideal - floor(ideal) AS rem FROM b), d AS (SELECT *, 137 - sum(base) OVER () AS d, row_number() OVER (ORDER BY rem DESC, k) AS rk FROM f) "
    "SELECT k AS c_mktsegment, g, CAST(least(g, base + CASE WHEN rk <= d THEN 1 ELSE 0 END) AS BIGINT) AS quota FROM d"
)


@query("stratum_quota", _QUOTA)
def _(t):
    return sampling.quotas(t("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("g")), "c_mktsegment", 137)


@query("stratified_sample", f"SELECT c_mktsegment, quota AS sampled, quota AS persons, true AS known FROM ({_QUOTA})")
def _(t):
    """The sample by stratum; which persons are in it goes by a hash, so the SQL knows their number only."""
    chosen = sampling.stratified_sample(t("customer"), "c_custkey", F.col("c_mktsegment"), 137)
    met = chosen.select("c_custkey", "c_mktsegment").join(t("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("s")), (F.col("c_custkey") == F.col("k")) & (F.col("c_mktsegment") == F.col("s")), "left")
    return met.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("sampled"), F.countDistinct("c_custkey").alias("persons"), F.bool_and(F.col("k").isNotNull()).alias("known"))


@query("sample_extract", "SELECT count(*) AS orders, count(DISTINCT o_custkey) AS persons FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)")
def _(t):
    """A sample no smaller than the table takes everyone, and extraction all their rows."""
    people = t("customer").select(F.col("c_custkey").alias("person_id"))
    found = sampling.sample_and_extract({"PERSON": people, "ORDERS": t("orders").withColumnRenamed("o_custkey", "person_id")}, size=10**9)
    return found["ORDERS"].agg(F.count(F.lit(1)).alias("orders"), F.countDistinct("person_id").alias("persons"))


@query("person_chunk_join", f"WITH {VISITS}, c AS (SELECT DISTINCT person_id FROM v WHERE person_id % 8 = 3) SELECT v.person_id, count(*) AS visits FROM v JOIN c USING (person_id) GROUP BY 1")
def _(t):
    """One slice of persons, as a semi-join: the eighth whose id leaves 3."""
    rows = visits(t)
    return cohort.extract(rows, rows.select("person_id").where("person_id % 8 = 3").distinct(), "person_id").groupBy("person_id").agg(F.count(F.lit(1)).alias("visits"))


@query("partition_path", "WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '600000071' ELSE '600000072' END || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS id FROM customer) SELECT c_custkey, substr(id, 1, 9) AS prefix, CASE WHEN c_custkey % 2 = 0 THEN format('{:06d}-{:06d}', c_custkey // 1000 * 1000, c_custkey // 1000 * 1000 + 999) END AS bucket FROM p")
def _(t):
    ids = t("customer").select("c_custkey", F.concat(F.expr("CASE WHEN c_custkey % 2 = 0 THEN '600000071' ELSE '600000072' END"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("id"))
    prefix, bucket = X.partition_path(F.col("id"))
    return ids.select("c_custkey", prefix.alias("prefix"), bucket.alias("bucket"))


# --- scalars ---------------------------------------------------------------------------------------------------------

@query("text_keys", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '|' || o_orderpriority || '|' || strftime(o_orderdate, '%Y-%m-%d') AS key FROM orders")
def _(t):
    return t("orders").select("o_orderkey", X.text_key(F.col("o_custkey"), F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("key"))


@query("id_substrings", "SELECT c_custkey, substr(c_name, 1, 9) AS head, right(c_name, 6) AS tail, CAST(right(c_name, 6) AS BIGINT) // 100 AS bucket FROM customer")
def _(t):
    tail = F.substring("c_name", -6, 6)
    return t("customer").select("c_custkey", F.substring("c_name", 1, 9).alias("head"), tail.alias("tail"), F.floor(tail.cast("long") / 100).cast("long").alias("bucket"))


@query("strip_fraction", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS plain FROM events")
def _(t):
    return t("events").select("event_id", X.strip_fraction(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("plain"))


@query("parse_coerce", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END AS id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey AS DOUBLE) END AS number FROM orders")
def _(t):
    text = F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'x1' WHEN 1 THEN concat(o_orderkey, '.0') ELSE concat(' ', o_orderkey) END")
    return t("orders").select("o_orderkey", X.to_long(text).alias("id"), X.to_double(text).alias("number"))


@query("time_diff_units", f"WITH {VISITS} SELECT visit_id, (epoch_us(\"end\") - epoch_us(start)) / 6e7 AS minutes, round((epoch_us(\"end\") - epoch_us(start)) / 3.6e9, 6) AS hours, (epoch_us(\"end\") - epoch_us(start)) // 86400000000 AS days FROM v")
def _(t):
    span = lambda u: X.elapsed(F.col("start"), F.col("end"), u)
    return visits(t).select("visit_id", span("minutes").alias("minutes"), F.round(span("hours"), 6).alias("hours"), span("days").alias("days"))


@query("safe_percent", "SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'purchase') = 0 THEN 0.0::DOUBLE ELSE round(100.0 * count(*) FILTER (event_type = 'error') / count(*) FILTER (event_type = 'purchase'), 6)::DOUBLE END AS share FROM events GROUP BY 1")
def _(t):
    a, b = F.count_if(F.col("event_type") == "error"), F.count_if(F.col("event_type") == "purchase")
    return t("events").groupBy("user_id").agg(F.round(X.percent(a, b), 6).alias("share"))


@query("json_ids_roundtrip", "SELECT user_id, event_id FROM events")
def _(t):
    packed = t("events").groupBy("user_id").agg(F.to_json(F.collect_list("event_id")).alias("ids"))
    return packed.select("user_id", F.explode(F.from_json("ids", "array<bigint>")).alias("event_id"))


@query("format_numbers", "SELECT c_custkey, format('{:06d}', c_custkey) AS padded, format('{:,}', c_custkey * 1000) AS grouped FROM customer")
def _(t):
    return t("customer").select("c_custkey", F.format_string("%06d", "c_custkey").alias("padded"), F.format_number(F.col("c_custkey") * 1000, 0).alias("grouped"))


@query("ansi_strip", "SELECT c_custkey, c_name AS line FROM customer")
def _(t):
    coloured = F.concat(F.lit("\x1b[1;32m"), F.substring("c_name", 1, 4), F.lit("\x1b[0m"), F.expr("substring(c_name, 5)"), F.lit("\x1b[2K"))
    return t("customer").select("c_custkey", X.strip_ansi(coloured).alias("line"))


# --- scans, profiles and stages as a whole ---------------------------------------------------------------------------

@query("row_numbers", "SELECT c_custkey, row_number() OVER () AS original_row_number FROM customer")
def _(t):
    return files.with_position(t("customer")).select("c_custkey", "original_row_number")


@query("row_range", "SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER () AS n FROM customer) WHERE n BETWEEN 101 AND 250")
def _(t):
    return files.row_slice(files.with_position(t("customer")), 100, 250).select("c_custkey")


@query("head_tail", "WITH n AS (SELECT c_custkey, row_number() OVER () AS n, count(*) OVER () AS c FROM customer) SELECT 'head' AS side, c_custkey FROM n WHERE n <= 50 UNION ALL SELECT 'tail', c_custkey FROM n WHERE n > c - 50")
def _(t):
    rows = files.with_position(t("customer"))
    first, last = files.row_slice(rows, 0, 50), files.tail(rows, 50)
    return first.select(F.lit("head").alias("side"), "c_custkey").unionAll(last.select(F.lit("tail"), "c_custkey"))


@query("column_kinds", "SELECT column_name, CASE WHEN column_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE') OR column_type LIKE 'DECIMAL%' THEN 'numeric' ELSE 'string' END AS kind FROM (DESCRIBE lineitem)")
def _(t):
    return profile.kinds(t("lineitem"))


_SAMPLED = ("c_mktsegment", "c_nationkey", "c_custkey")


@query("column_samples", "WITH u AS (" + " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS v FROM customer WHERE {c} IS NOT NULL" for c in _SAMPLED) + "), r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY v) AS k FROM u) SELECT column_name, least(count(*), 1000) AS unique_values, string_agg(v, ',' ORDER BY v) FILTER (k <= 10) AS sample_values FROM r GROUP BY 1")
def _(t):
    return profile.column_samples(t("customer"), _SAMPLED).withColumn("sample_values", F.array_join("sample_values", ","))


@query("null_columns_top", f"WITH {GAPS}, {GAP_COUNTS} SELECT 'gaps' AS table_name, column_name, missing, round(100.0 * missing / total, 6) AS missing_percentage FROM c WHERE missing > 0 ORDER BY 4 DESC, 2 LIMIT 3")
def _(t):
    return profile.null_columns({"gaps": gaps(t)}, 3).withColumn("missing_percentage", F.round("missing_percentage", 6))


@query("null_columns_over_half", f"WITH {GAPS}, {GAP_COUNTS} SELECT 'gaps' AS table_name, column_name, missing FROM c WHERE 100.0 * missing / total > 50")
def _(t):
    return profile.null_columns({"gaps": gaps(t)}, 100, over=50.0).select("table_name", "column_name", "missing")


@query("person_summary", f"WITH {PEOPLE}, g AS (SELECT g, count(*) AS n FROM p GROUP BY 1) SELECT count(*) AS persons, min(yob) AS first_year, max(yob) AS last_year, (SELECT string_agg(g || ':' || n, ',' ORDER BY n DESC, g) FROM (FROM g ORDER BY n DESC, g LIMIT 3)) AS genders FROM p")
def _(t):
    genders = F.array_join(F.transform("genders", lambda x: F.concat_ws(":", x["gender_concept_id"], x["records"])), ",")
    return validate.person_summary(people(t)).withColumn("genders", genders)


_RANKS = "r AS (SELECT l_partkey, l_extendedprice AS v, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice) AS k, count(*) OVER (PARTITION BY l_partkey) AS n FROM lineitem)"


def _at(p: int) -> str:
    """The value at rank ceil(p n)."""
    return f"max(v) FILTER (k = greatest(1, CAST(ceil({p / 100} * n) AS BIGINT)))"


@query("sketched_quantiles", f"WITH {_RANKS} SELECT l_partkey, max(n) AS n, min(v) AS p0, " + ", ".join(f"{_at(p)} AS p{p}" for p in standardize.LEVELS) + ", max(v) AS p100 FROM r GROUP BY 1 HAVING max(n) >= 10")
def _(t):
    return standardize.sketched_quantiles(t("lineitem"), "l_partkey", "l_extendedprice")


@query("snapped_thresholds", " UNION ALL ".join(f"(WITH {_RANKS} SELECT {given} AS percentile, l_partkey, {_at(low)} AS lower, {_at(high)} AS upper FROM r GROUP BY 2 HAVING max(n) >= 10)" for given, low, high in ((99, 1, 99), (97, 5, 95), (80, 25, 75))))
def _(t):
    """Percentiles that a table of seven levels does not have snap to one it has."""
    every = [standardize.thresholds(t("lineitem"), "l_partkey", "l_extendedprice", p, approx=True).select(F.lit(p).alias("percentile"), "l_partkey", "lower", "upper") for p in (99, 97, 80)]
    return every[0].unionAll(every[1]).unionAll(every[2])


@query("distinct_dates", f"WITH {WRITTEN} SELECT o_orderkey, {NORMAL} AS normal FROM w")
def _(t):
    rows = written(t).withColumnRenamed("raw", "o_date")
    return standardize.standardise_distinct_dates(rows, "o_date").select("o_orderkey", F.col("o_date").alias("normal"))


@query("relationships", f"WITH {DICTIONARY}, m AS (SELECT CASE WHEN id % 2 = 0 THEN 'Maps to' ELSE 'Is a' END AS rel, vocab FROM r WHERE target IS NOT NULL) SELECT rel AS mapping_relationship, vocab AS original_vocab, count(*) AS concepts, round(100.0 * count(*) / (SELECT count(*) FROM m), 6) AS share FROM m GROUP BY 1, 2")
def _(t):
    concepts, maps = dictionary(t)
    maps = maps.withColumn("mapping_relationship", F.expr("CASE WHEN Id % 2 = 0 THEN 'Maps to' ELSE 'Is a' END"))
    return mapping.relationships(mapping.build_mapping(concepts, maps, "MEASUREMENT")[0]).withColumn("share", F.round("share", 6))


_MEASURED = "m AS (SELECT l_orderkey, l_linenumber, l_partkey % 3 AS concept, CASE WHEN l_linenumber % 2 = 0 THEN 'lb' ELSE 'kg' END AS unit, l_quantity AS v, strftime(l_shipdate, '%m/%d/%Y') AS d FROM lineitem)"


@query(
    "standardise_table",
    f"WITH {_MEASURED}, c AS (SELECT *, CASE WHEN concept = 1 AND unit = 'lb' THEN v * 0.453592 ELSE v END AS x, CASE WHEN concept = 1 THEN 'kg' ELSE unit END AS u FROM m), "
    "t AS (SELECT concept, quantile_cont(x, 0.05) AS lower, quantile_cont(x, 0.95) AS upper FROM c GROUP BY 1) "
    "SELECT CASE concept WHEN 1 THEN 37174455 ELSE concept END AS concept, u AS unit, CASE WHEN x < lower OR x > upper THEN 'percentile_outlier' WHEN concept = 1 AND x < 0.5 THEN 'range_outlier' ELSE 'kept' END AS outcome, "
    "count(*) AS records, min(substr(d, 7, 4) || '-' || substr(d, 1, 2) || '-' || substr(d, 4, 2)) AS first_date FROM c JOIN t USING (concept) GROUP BY 1, 2, 3",
)
def _(t):
    """Dates, units and both kinds of outliers in one stage: a third of the rows are weights in pounds and kilograms."""
    rows = t("lineitem").select(
        F.expr("CASE l_partkey % 3 WHEN 1 THEN 37174455 ELSE l_partkey % 3 END").alias("concept"), F.expr("CASE WHEN l_linenumber % 2 = 0 THEN 'lb' ELSE 'kg' END").alias("unit"),
        F.col("l_quantity").cast("double").alias("value"), F.date_format("l_shipdate", "MM/dd/yyyy").alias("o_date"),
    )
    every = standardize.standardise_table(rows, "concept", "value", "unit", ["o_date"], 95).tagged
    return every.groupBy("concept", "unit", F.coalesce("removal_reason", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("records"), F.min("o_date").alias("first_date"))


@query("csv_scan", "SELECT count(*) AS records, sum(CAST(c_custkey AS BIGINT)) AS ids FROM customer")
def _(t):
    """The person table written as CSV text and read back in splits, every field as text."""
    folder = files.scratch(t.spark, "csv_scan")
    files.write_csv(t("customer"), f"{folder}/customer")
    return files.read_csv(t.spark, f"{folder}/customer", ["c_custkey"]).agg(F.count(F.lit(1)).alias("records"), F.sum(X.to_long(F.col("c_custkey"))).alias("ids"))


@query("concept_outlier_summary", f"WITH {RANKED}, f AS (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS c FROM r WHERE rk = 1), k AS (SELECT * FROM f WHERE c > 10), t AS (SELECT l_partkey, quantile_cont(l_extendedprice, 0.01) AS lower, quantile_cont(l_extendedprice, 0.99) AS upper FROM k GROUP BY 1 HAVING count(*) >= 10) SELECT l_partkey, count(*) AS records, count(*) FILTER (l_extendedprice < lower OR l_extendedprice > upper) AS rejected FROM k JOIN t USING (l_partkey) GROUP BY 1")
def flagship(t):
    """Dedup, low-frequency filter, thresholds, outlier split, and a summary per concept."""
    rows = dedup.dedup(t("lineitem").select(*ORDER), LINE_KEY, order_of(ORDER)).kept.select("l_partkey", "l_extendedprice")
    rows = files.staged(rows, "deduplicated")  # two narrow columns, which counts, thresholds and the split all read
    rows = quality.reject_rare(rows, "l_partkey").kept
    limits = standardize.thresholds(rows, "l_partkey", "l_extendedprice")
    every = standardize.outliers(rows, limits, "l_partkey", "l_extendedprice", {}).tagged
    met = every.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("records"), F.count("removal_reason").alias("rejected"))
    return met.join(limits.select("l_partkey"), "l_partkey", "left_semi")
