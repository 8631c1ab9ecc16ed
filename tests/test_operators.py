"""Edge rows of every operator: nulls, blanks, ties, repeats, empty tables, and the conservation of rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from wardline.functions import scalars as X
from wardline.operators import cohort, dedup, episodes, mapping, profile, quality, sampling, standardize, validate
from wardline.operators.split import by_reason, first_rule
from wardline.plans import pipeline
from wardline.registry import CONVERSIONS, TABLES, TableSpec
from wardline.sources import files

T = dt.datetime


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_dedup_nulls_are_equal_and_first_wins(spark):
    df = frame(spark, [(1, "a", None, "x"), (2, "a", None, "y"), (3, "a", "t", "z"), (4, None, None, "n"), (5, None, None, "m")], "pos int, k string, d string, v string")
    split = dedup.dedup(df, ["k", "d"], [F.col("pos")])
    assert sorted(one(split.kept, "v")) == ["n", "x", "z"]
    assert split.kept.count() + split.rejected.count() == 5
    assert dedup.dedup(df, ["k", "absent"], [F.col("pos")]).kept.count() == 2


def test_dedup_prefers_rows_with_a_value(spark):
    df = frame(spark, [(1, "a", None), (2, "a", "7"), (3, "b", None), (4, "b", " ")], "pos int, k string, v string")
    assert sorted(one(dedup.dedup(df, ["k"], [F.col("pos")], ~X.blank(F.col("v"))).kept, "pos")) == [2, 3]


def test_audit_numbers_groups_with_duplicates_only(spark):
    df = frame(spark, [(1, "a"), (2, "b"), (3, "b"), (4, "a"), (5, "c"), (6, None), (7, None)], "pos long, k string")
    rows = {r.pos: (r.duplicate_status, r.duplicate_group_id, r.original_row_number) for r in dedup.audit(df, ["k"], [F.col("pos")], "pos", "M").collect()}
    assert rows == {2: ("kept", "M_1", 2), 3: ("removed", "M_1", 3), 1: ("kept", "M_2", 1), 4: ("removed", "M_2", 4), 6: ("kept", "M_3", 6), 7: ("removed", "M_3", 7)}


@pytest.mark.parametrize(("value", "gone"), [(None, True), ("", True), (" ", True), ("0", True), (" 0 ", True), ("0.0", False), ("00", False), ("7", False)])
def test_invalid_concepts(spark, value, gone):
    split = quality.reject_invalid(frame(spark, [(value,)], "c string"), "c")
    assert split.rejected.count() == int(gone)
    assert quality.reject_invalid(frame(spark, [(value,)], "c string"), "absent").rejected.count() == 0


def test_temporal_order_compares_text(spark):
    df = frame(spark, [(1, "2020-01-02", "2020-01-01"), (2, "2020-01-01", "2020-01-01"), (3, "2020-01-01", None), (4, None, "2020-01-01"), (5, "2020-01-01 10:00:00", "2020-01-01"), (6, " ", "2020")], "i int, s string, e string")
    assert sorted(one(quality.reject_temporal(df, "s", "e", "i").rejected, "i")) == [1, 5]


def test_prune_is_strict_and_empty_tables_give_zeros(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 50, 1).alias("at95"), F.when(F.col("id") < 49, 1).alias("above"), F.lit(None).cast("int").alias("none"))
    pruned, prof = quality.prune_columns(df)
    assert pruned.columns == ["at95"]
    empty = {r.column_name: r.missing_percentage for r in quality.null_profile(df.limit(0)).collect()}
    assert empty == {"at95": 0.0, "above": 0.0, "none": 0.0}


def test_low_frequency_rejects_at_the_limit(spark):
    rows = [("ten",)] * 10 + [("eleven",)] * 11 + [(None,)] * 2 + [("",)]
    split = quality.reject_rare(frame(spark, rows, "c string"), "c")
    assert {r.c for r in split.kept.collect()} == {"eleven", None, ""}
    assert one(split.rejected, "removal_reason")[0] == "low_frequency_concept (c=ten, freq=10)"
    assert quality.reject_rare(frame(spark, rows, "c string"), "c", 0).kept.count() == len(rows)


def test_cascade_invalid_first_row_shadows_its_key(spark):
    spec = TableSpec("D", "p", ("p",), ("p",), None, "d", "s", "e")
    df = frame(spark, [(1, 7, "0", None, None), (2, 7, "x", None, None), (3, 8, "x", "2020-02-01", "2020-01-01"), (4, 9, "x", None, None)], "pos int, p int, d string, s string, e string")
    split = quality.clean_table(df, spec, [F.col("pos")], 100.0)
    assert one(split.kept, "pos") == [4]
    assert {r.pos: r.removal_reason for r in split.rejected.collect()} == {1: "invalid_concept", 2: "duplicate", 3: "temporal_issue"}
    assert quality.clean_table(split.kept, spec, [F.col("pos")], 100.0).kept.count() == 1


def test_mapping_hits_misses_blanks_and_no_dictionary(spark):
    df = frame(spark, [(1, "10"), (2, "11"), (3, "12"), (4, ""), (5, None)], "i int, c string")
    maps = frame(spark, [("10", "99"), ("11", "99"), ("13", None)], "original_concept_id string, snomed_concept_id string")
    got = {r.i: (r.c, r.c_mapped) for r in mapping.apply_mapping(df, maps, "c").collect()}
    assert got == {1: ("99", "Y"), 2: ("99", "Y"), 3: ("12", "N"), 4: ("", "N"), 5: (None, "N")}
    assert {r.c_mapped for r in mapping.apply_mapping(df, None, "c").collect()} == {"N"}
    stats = mapping.mapping_statistics(df, maps, "c").first()
    assert (stats.total_values, stats.null_values, stats.mapped_values, stats.unique_concepts_mapped) == (3, 2, 2, 2)
    split = mapping.map_table(df, maps, "c", ["c"], [F.col("i")], 0)
    assert sorted(x or "" for x in one(split.kept, "c")) == ["", "", "12", "99"]
    assert mapping.map_table(df, maps, "c", ["c"], [F.col("i")], 0, deduplicate=False).kept.count() == 5


def test_last_dictionary_row_wins(spark):
    rows = frame(spark, [(1, "a", "x"), (2, "a", "y"), (3, "", "z")], "pos int, k string, v string")
    assert {r.k: r.v for r in mapping.last_wins(rows, "k", "v", [F.col("pos")]).collect()} == {"a": "y"}


DATES = [
    ("2024-01-02 03:04:05", "2024-01-02 03:04:05"), ("2024-01-02", "2024-01-02"), ("2024-01-02 03:04", "2024-01-02 03:04:00"), ("2024/01/02 03:04:05", "2024-01-02 03:04:05"), ("2024/01/02", "2024-01-02"),
    ("01/02/2024 03:04:05", "2024-01-02 03:04:05"), ("01/02/2024", "2024-01-02"), (" 2024-01-02 03:04:05.678 ", "2024-01-02 03:04:05"), ("2024-13-01", "2024-13-01"), ("2024-02-30", "2024-02-30"), ("", ""), (None, None), ("soon", "soon"),
]


@pytest.mark.parametrize(("raw", "normal"), DATES)
def test_dates(spark, raw, normal):
    assert frame(spark, [(raw,)], "d string").select(X.normalise_date(F.col("d"), "x_date")).first()[0] == normal


def test_unpadded_dates_follow_the_column_name(spark):
    row = frame(spark, [("2024-1-2", "2024-1-2 3:4:5")], "a string, b string").select(X.normalise_date(F.col("a"), "a_date"), X.normalise_date(F.col("a"), "a"), X.normalise_date(F.col("b"), "b_datetime")).first()
    assert tuple(row) == ("2024-01-02", "2024-1-2", "2024-01-02 03:04:05")


def test_units_gated_and_literal(spark):
    df = frame(spark, [(37174455, "lb", 10.0), (37174455, "LBS", 10.0), (37174455, "kg", 10.0), (3020891, "Fahrenheit", 98.6), (3020891, "Celsius", 37.0), (1, "lb", 10.0)], "c int, u string, v double")
    gated = one(df.select(X.convert_units(F.col("c"), F.col("u"), F.col("v"), CONVERSIONS).alias("x")), "x")
    assert gated == pytest.approx([4.53592, 4.53592, 10, 37, 37, 10])
    literal = one(df.select(X.convert_units(F.col("c"), None, F.col("v"), CONVERSIONS, gate=False).alias("x")), "x")
    assert literal[0] == pytest.approx(10 * 0.453592**2)
    units = standardize.standardise_units(df, "c", "v", "u")
    assert one(units, "u") == ["kg", "kg", "kg", "Celsius", "Celsius", "lb"]


def test_thresholds_need_ten_finite_values(spark):
    rows = [("nine", str(i)) for i in range(9)] + [("nine", "nan"), ("nine", "inf"), ("nine", "x"), ("nine", None)] + [("ten", str(i)) for i in range(10)] + [("same", "5")] * 12
    limits = {r.c: (r.lower, r.upper, r.n) for r in standardize.thresholds(frame(spark, rows, "c string, v string"), "c", "v", 90.0).collect()}
    assert set(limits) == {"ten", "same"}
    assert limits["ten"] == (pytest.approx(0.9), pytest.approx(8.1), 10)
    assert limits["same"][:2] == (5.0, 5.0)
    assert standardize.snapped(99) == (0.01, 0.99) and standardize.snapped(96) == (0.05, 0.95) and standardize.snapped(75) == (0.25, 0.75)
    assert standardize.thresholds(frame(spark, rows, "c string, v string"), "c", "v", approx=True).count() == 2


@pytest.mark.parametrize("cells", [1, 7, 4096])
def test_refined_quantiles_are_exact(spark, cells):
    df = spark.range(3000).select((F.col("id") % 4).alias("c"), F.expr("CASE id % 4 WHEN 0 THEN pow(id % 97, 3) WHEN 1 THEN 5 WHEN 2 THEN exp(id % 31) ELSE -id END").cast("double").alias("v")).unionAll(spark.sql("SELECT 9L, 1.0D"))
    levels = (0.01, 0.25, 0.5, 0.99)
    expected = {r.c: (r.n, [r[f"p{k}"] for k in range(4)]) for r in df.groupBy("c").agg(F.count(F.lit(1)).alias("n"), *[F.percentile("v", p).alias(f"p{k}") for k, p in enumerate(levels)]).where("n >= 10").collect()}
    got = {r.c: (r.n, r.quantiles) for r in standardize.refined_quantiles(df, "c", "v", levels, cells=cells).collect()}
    assert got.keys() == expected.keys() == {0, 1, 2, 3}
    assert all(got[c][0] == expected[c][0] and got[c][1] == pytest.approx(expected[c][1]) for c in got)


def test_outliers_keep_bounds_and_what_is_no_number(spark):
    limits = frame(spark, [(1, 0.0, 10.0)], "c int, lower double, upper double")
    rows = [(1, "0"), (1, "10"), (1, "10.1"), (1, "9"), (1, None), (1, "x"), (1, "nan"), (1, "inf"), (2, "1000"), (None, "5")]
    split = standardize.outliers(frame(spark, rows, "c int, v string"), limits, "c", "v", {1: ("r", 0.0, 8.0, "u"), 2: ("s", 0.0, 1.0, "u")})
    assert [(r.v, r.removal_reason) for r in split.rejected.orderBy("v").collect()] == [("10", "range_outlier"), ("10.1", "percentile_outlier"), ("9", "range_outlier")]
    assert split.kept.count() == 7 and split.kept.columns == ["c", "v"]
    assert math.isclose(float(one(split.rejected.where("v = '10.1'").select(F.get_json_object("additional_info", "$.upper").alias("u")), "u")[0]), 10.0)


def test_change_log_lists_changed_fields_only(spark):
    df = frame(spark, [(1, "2024/01/02", "a"), (2, "2024-01-02", None)], "i int, d string, x string")
    log = standardize.change_log(df, {"d": (X.normalise_date(F.col("d")), "date"), "x": (F.upper("x"), "case")}, F.col("i"))
    assert sorted(map(tuple, log.collect())) == [(1, "d", "2024/01/02", "2024-01-02", "date"), (1, "x", "a", "A", "case")]


VISIT = "id long, p long, c long, s timestamp, e timestamp"
AT = lambda h, m=0: T(2024, 1, 1, h, m)
VISITS = [
    (1, 1, 9, AT(0), AT(1)), (2, 1, 9, AT(2), AT(3)), (3, 1, 9, AT(4, 0), AT(4, 30)), (4, 1, 9, AT(5, 31), AT(6)),  # gap at the threshold merges, one minute over does not
    (5, 2, 9, AT(0), AT(10)), (6, 2, 9, AT(1), AT(2)), (7, 2, 9, AT(4), AT(5)),  # nested
    (8, 3, 9, AT(0), None), (9, 3, 9, AT(0, 30), AT(1)), (10, 3, 9, None, AT(2)), (11, 4, None, AT(0), AT(1)), (12, 4, None, AT(0), AT(1)), (13, 5, 9, AT(1), AT(2)), (14, 5, 9, AT(1), AT(2)),
]


def test_episodes(spark):
    df = frame(spark, VISITS, VISIT)
    ids = {r.id: r.episode_index for r in episodes.episode_ids(df, "p", "c", "s", "e", "id").collect()}
    assert [ids[k] for k in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert [ids[k] for k in (5, 6, 7)] == [0, 0, 1]
    assert [ids[k] for k in (8, 9, 10)] == [0, 1, 2] and ids[11] != ids[12] and ids[13] == ids[14] == 0
    running = {r.id: r.episode_index for r in episodes.episode_ids(df, "p", "c", "s", "e", "id", running=True).collect()}
    assert [running[k] for k in (5, 6, 7)] == [0, 0, 0]
    merged = episodes.merge(df, "p", "c", "s", "e", "id")
    first = merged.where("id = 1").first()
    assert (first.merge_flag, first.original_visit_ids, first.visits_merged_count, first.s, first.e, first.merged_duration_hours, first.original_e) == ("Y", "[1,2,3]", 3, AT(0), AT(4, 30), 4.5, AT(1))
    alone = merged.where("id = 4").first()
    assert (alone.merge_flag, alone.merged_start_datetime, alone.original_s) == ("N", None, None)
    assert tuple(episodes.validate_merge(df, merged, "id").first()) == (14, 14, 0, 0)
    assert sorted(one(episodes.merge_map(df, "p", "c", "s", "e", "id"), "original_visit_id")) == [1, 2, 3, 5, 6, 13, 14]


def test_cohort_edges(spark):
    index = frame(spark, [(1, AT(12)), (2, AT(12)), (3, AT(12))], "p long, t timestamp")
    pool = cohort.events([(frame(spark, [(1, AT(12)), (1, T(2023, 12, 30, 12)), (1, AT(13)), (2, None)], "p long, t timestamp"), "p", "t")])
    people = frame(spark, [(1, 8507, 8527, 1980), (2, 8551, 0, None), (2, 8551, 0, None)], "p long, gender_concept_id int, race_concept_id int, year_of_birth int")
    stats = {r.patient_id: tuple(r)[1:] for r in cohort.cohort_statistics(index, pool, people, frame(spark, [(2,), (2,)], "p long"), "p", "t").collect()}
    assert stats[1] == (2, 3, 44, "Male", "White", False)
    assert stats[2] == (0, 0, None, "Other(8551)", "Unknown", True)
    assert stats[3] == (0, 0, None, None, None, False)
    visits = frame(spark, [(1, 581379, AT(1), AT(2)), (1, 32037, AT(0), AT(1)), (1, 7, AT(0), AT(9)), (None, 32037, AT(0), AT(1))], "p long, c int, s timestamp, e timestamp")
    assert [tuple(r) for r in cohort.index_times(visits, "p", "c", "s", "e", [581379, 32037]).collect()] == [(1, AT(0), AT(2))]


@pytest.mark.parametrize(("sizes", "n", "expected"), [({"a": 1, "b": 50, "c": 49}, 10, {"a": 1, "b": 5, "c": 4}), ({"a": 5, "b": 5}, 20, {"a": 5, "b": 5}), ({"a": 5, "b": 5, "c": 5}, 2, {"a": 1, "b": 1, "c": 1}), ({"a": 50, "b": 50}, 5, {"a": 3, "b": 2}), ({"a": 97, "b": 1, "c": 1, "d": 1}, 5, {"a": 2, "b": 1, "c": 1, "d": 1})])
def test_quotas(spark, sizes, n, expected):
    got = sampling.quotas(frame(spark, list(sizes.items()), "k string, g long"), "k", n)
    assert {r.k: r.quota for r in got.collect()} == expected


def test_sample_is_exact_and_stable(spark):
    df = spark.range(1000).select(F.format_string("%09d", F.col("id") % 3).alias("s"), F.col("id"))
    a = sorted(one(sampling.stratified_sample(df, "id", F.col("s"), 100), "id"))
    assert len(a) == 100 == len(set(a))
    assert a == sorted(one(sampling.stratified_sample(df.repartition(7), "id", F.col("s"), 100), "id"))
    assert a != sorted(one(sampling.stratified_sample(df, "id", F.col("s"), 100, seed=1), "id"))
    ids = lambda n: spark.range(600000071000000, 600000071000000 + n).withColumnRenamed("id", "person_id")
    assert sampling.sample_and_extract({"PERSON": ids(1000), "X": ids(2000)}, size=50)["X"].count() == 50
    prefixed = sampling.sample_and_extract({"PERSON": ids(1000).withColumn("person_id", F.col("person_id").cast("string"))}, size=50, prefixes=["600000071", "7"])
    assert prefixed["PERSON"].count() == 50


def test_profiles(spark):
    df = frame(spark, [(1, "a", None), (2, "b", "x"), (2, None, "NA")], "p_id int, v string, d string")
    assert {r.column_name: r.distinct_count for r in profile.table_profile(df).collect()} == {"p_id": 2, "v": None, "d": None}
    assert profile.id_columns(df) == ["p_id"] and profile.kind_of("decimal(3,1)") == "numeric" and profile.kind_of("string") == "string"
    assert df.where(X.null_by_list(F.col("d"))).count() == 2 == df.where(X.null_by_frame(F.col("d"))).count()
    assert {r.column_name: (r.unique_values, r.sample_values) for r in profile.column_samples(df, ["p_id"], 1).collect()} == {"p_id": (2, ["1"])}
    assert profile.time_columns(frame(spark, [], "a_date string, b_time string, c int")) == ["a_date", "b_time"]


def test_bins(spark):
    df = frame(spark, [(0,), (17,), (18,), (120,), (121,), (None,)], "v int")
    assert one(df.select(X.binned(F.col("v"), (0, 18, 120)).alias("b")), "b") == ["0-18", "0-18", "18-120", "18-120", None, None]
    assert one(df.select(X.binned(F.col("v"), (0, 18, 120), right=True).alias("b")), "b") == [None, "0-18", "0-18", "18-120", None, None]


@pytest.mark.parametrize(("person", "prefix", "bucket"), [("600000071000000", "600000071", "000000-000999"), ("600000071000999", "600000071", "000000-000999"), ("600000071001000", "600000071", "001000-001999"), ("600000072001000", "600000072", None)])
def test_partition_path(spark, person, prefix, bucket):
    assert tuple(frame(spark, [(person,)], "p string").select(*X.partition_path(F.col("p"))).first()) == (prefix, bucket)


def test_validation(spark):
    good = {n: frame(spark, [tuple("1" for _ in s.required)], ", ".join(f"{c} string" for c in s.required)) for n, s in TABLES.items()}
    assert validate.validate(good).passed and "LOCATION: missing" in validate.validate(good).warnings
    person = good["PERSON"].unionAll(good["PERSON"])
    assert validate.validate({**good, "PERSON": person}).errors == ["PERSON: 1 duplicate person_id"]
    assert not validate.validate({k: v for k, v in good.items() if k != "DEATH"}).passed
    assert validate.validate({**good, "DEATH": good["DEATH"].drop("death_date")}).errors == ["DEATH: missing columns death_date"]
    assert one(validate.orphans(frame(spark, [(1,), (2,), (None,)], "p int"), frame(spark, [(1,)], "p int"), "p"), "p") == [2]
    assert tuple(validate.same_ids(frame(spark, [(1,), (2,)], "p int"), frame(spark, [(2,), (2,), (3,)], "p int"), "p").first()) == (1, 1)


def test_first_rule_and_stats(spark):
    df = frame(spark, [(None,), (1,), (2,)], "v int").withColumn("removal_reason", first_rule((F.col("v") > 1, "big"), (F.col("v") > 0, "some")))
    split = by_reason(df)
    assert {r.outcome: r.records for r in split.stats.collect()} == {"kept": 1, "some": 1, "big": 1}


def test_files(spark, tmp_path):
    text = 'id,name\n1,"a, b"\n2,"two ""lines"""\n3,'
    (tmp_path / "T.csv").write_text(text)
    (tmp_path / "E.csv").write_text("id,name\n")
    tables = files.catalog(spark, f"file://{tmp_path}")
    assert [tuple(r) for r in tables["T"].collect()] == [("1", "a, b"), ("2", 'two "lines"'), ("3", None)]
    assert tables["E"].columns == ["id", "name"] and tables["E"].count() == 0
    assert files.with_position(tables["E"]).count() == 0
    rows = files.with_position(spark.range(10).repartition(3))
    assert sorted(one(rows, "original_row_number")) == list(range(1, 11))
    assert files.row_slice(rows, 2, 5).count() == 3 and files.head(rows, 4).count() == 4
    files.write_csv(tables["T"], f"file://{tmp_path}/out", single=True)
    assert files.read_csv(spark, f"file://{tmp_path}/out", ["name", "absent"]).columns == ["name"]
    files.write_csv(tables["T"], f"file://{tmp_path}/out", "append")
    files.write_csv(tables["T"], f"file://{tmp_path}/out", "ignore")
    assert files.read_csv(spark, f"file://{tmp_path}/out").count() == 6
    people = frame(spark, [("600000071000001", 1), ("600000072000001", 2), (None, 3)], "person_id string, v int")
    files.write_by_person(people, f"file://{tmp_path}/people")
    back = spark.read.option("header", True).csv(f"file://{tmp_path}/people")
    assert files.entity_count(back) == 2 and {r.bucket for r in back.collect()} == {"000000-000999", "all"}
    (tmp_path / "m.csv").write_text("k,v\na,1\na,2\n,3\n")
    assert [tuple(r) for r in files.load_dictionary(spark, f"file://{tmp_path}/m.csv", "k", "v").collect()] == [("a", "2")]
    files.write_json({"x": people}, str(tmp_path / "x.json"))
    assert "| person_id | v |" in files.markdown("t", {"x": people})
    typed = files.typed(frame(spark, [("12.0", "x", "2024-01-01 00:00:00")], "a string, b string, c string"), ["a"], ["b"], ["c"])
    assert tuple(typed.first()) == (12, None, T(2024, 1, 1))


def test_pipeline_runs_all_stages_and_reports(spark):
    visit = frame(spark, [("1", "1", "32037", "2024-01-01 00:00:00", "2024-01-01 01:00:00"), ("2", "1", "32037", "2024-01-01 01:30:00", "2024-01-01 03:00:00"), ("3", "1", "0", "2024-01-01 00:00:00", None)], "visit_detail_id string, person_id string, visit_detail_concept_id string, visit_detail_start_datetime string, visit_detail_end_datetime string")
    era = frame(spark, [("1", "1", "5", "2023-12-30", "2023-12-31")], "condition_era_id string, person_id string, condition_concept_id string, condition_era_start_date string, condition_era_end_date string")
    person = frame(spark, [("1", 8507, 1980, 8527)], "person_id string, gender_concept_id int, year_of_birth int, race_concept_id int")
    death = frame(spark, [("2", "2024-01-01", "2024-01-01 00:00:00")], "person_id string, death_date string, death_datetime string")
    tables = {n: files.with_position(df) for n, df in {"VISIT_DETAIL": visit, "CONDITION_ERA": era, "PERSON": person, "DEATH": death}.items()}
    state, outcome = pipeline.run(tables, pipeline.Config(min_concept_freq=0))
    assert set(outcome.values()) == {"done"}
    assert state.rejected["cleaning/VISIT_DETAIL"].count() == 1
    assert one(state.tables["VISIT_DETAIL"], "visits_merged_count") == [2]
    row = state.stats["extraction/cohort"].first()
    assert (row.count_before_icu, row.days_of_data_before_icu, row.age_at_icu_admission) == (1, 1, 44)
    assert pipeline.run(tables, dry_run=True, skip=["mapping"])[1]["mapping"] == "skipped"
    assert pipeline.plan("standardization") == ["standardization", "extraction"]
