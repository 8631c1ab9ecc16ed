"""Scans, sinks, caches and reports over real files, and the stage runner with its folder."""

import json
import os

from pyspark.sql import functions as F

from wardline.operators import mapping, profile, quality, standardize, validate
from wardline.plans import pipeline
from wardline.registry import TABLES
from wardline.sources import files


def write(path, text):
    path.write_text(text)
    return f"file://{path}"


def test_csv_is_read_in_splits(spark, tmp_path):
    path = write(tmp_path / "T.csv", "a,b\n" + "".join(f"{k},{'x' * 40}\n" for k in range(4000)))
    size = os.path.getsize(tmp_path / "T.csv")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], str(size // 3 + 1))
        spark.conf.set(keys[1], str(size // 3 + 1))
        df = files.read_csv(spark, path)
        assert df.rdd.getNumPartitions() == 3 and files.read_csv(spark, path, multiline=True).rdd.getNumPartitions() == 1
        assert df.select(F.sum(F.col("a").cast("long"))).first()[0] == sum(range(4000))
        numbered = files.with_position(df)
        assert numbered.where("original_row_number <> cast(a AS bigint) + 1").count() == 0
        assert sorted(int(r.a) for r in files.tail(numbered, 5).collect()) == list(range(3995, 4000))
    finally:
        for k, v in zip(keys, old, strict=True):
            spark.conf.set(k, v)
    assert files.header(spark, path) == ["a", "b"]
    assert abs(files.estimated_rows(spark, path) - 4000) < 5 and abs(files.estimated_rows(spark, path, 1 << 14) - 4000) < 200
    assert files.estimated_rows(spark, f"file://{tmp_path}/absent.csv") == 0


def test_line_breaks_in_quotes_need_whole_files(spark, tmp_path):
    path = write(tmp_path / "Q.csv", 'a,b\n1,"two\nlines"\n2,"say ""x"""\n')
    assert [tuple(r) for r in files.read_csv(spark, path, multiline=True).orderBy("a").collect()] == [("1", "two\nlines"), ("2", 'say "x"')]


def test_row_counts_are_cached_by_length_and_time(spark, tmp_path, monkeypatch):
    write(tmp_path / "A.csv", "x\n1\n2\n")
    write(tmp_path / "B.csv", "x\n1\n")
    folder, cache = f"file://{tmp_path}", f"file://{tmp_path}/counts.json"
    assert files.counted(spark, folder, cache) == {"A": 2, "B": 1}
    read = []
    own = files.read_csv
    monkeypatch.setattr(files, "read_csv", lambda spark, path, *a, **k: read.append(path) or own(spark, path, *a, **k))
    assert files.counted(spark, folder, cache) == {"A": 2, "B": 1} and read == []
    write(tmp_path / "B.csv", "x\n1\n2\n3\n")
    assert files.counted(spark, folder, cache) == {"A": 2, "B": 3} and len(read) == 1
    assert files.sizes(spark, folder) == {"A": 6, "B": 8}


def test_resume_writes_what_is_not_whole(spark, tmp_path):
    df, path = spark.range(5).withColumnRenamed("id", "x"), f"file://{tmp_path}/out"
    files.write_csv(df, path)
    files.write_csv(df.limit(1), path, "resume")
    assert files.read_csv(spark, path).count() == 5
    (tmp_path / "out" / "_SUCCESS").unlink()
    assert not files.is_complete(spark, path)
    files.write_csv(df.limit(2), path, "resume")
    assert files.read_csv(spark, path).count() == 2
    (tmp_path / "empty").mkdir()
    assert not files.is_complete(spark, f"file://{tmp_path}/empty")


def test_one_file_and_header_only(spark, tmp_path):
    df = spark.range(100).repartition(4).select(F.col("id").alias("x"), F.concat(F.lit('a "'), "id").alias("y,z"))
    files.write_one_file(df, f"file://{tmp_path}/one.csv")
    lines = (tmp_path / "one.csv").read_text().splitlines()
    assert len(lines) == 101 and lines[0] == 'x,"y,z"' and lines.count(lines[0]) == 1
    assert files.read_csv(spark, f"file://{tmp_path}/one.csv").count() == 100 and not (tmp_path / "one.csv.parts").exists()
    files.write_csv(df.limit(0), f"file://{tmp_path}/none", single=True)
    assert files.header(spark, f"file://{tmp_path}/none") == ["x", "y,z"] and files.read_csv(spark, f"file://{tmp_path}/none").count() == 0
    files.write_one_file(df.limit(0), f"file://{tmp_path}/none.csv")
    assert (tmp_path / "none.csv").read_text().strip() == 'x,"y,z"'


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, "x", "b"), (4, None, "c")], "id long, p string, q string")
    assert files.text_report({"T": df, "U": df.select("id")}, 1).splitlines() == ["T: 4 rows, 3 columns", "  p: 3 null (75.0 %)", "", "U: 4 rows, 1 columns", "  no nulls"]
    svg = files.bar_chart(profile.table_sizes({"T & U": df, "V": df.limit(1)}), "table_name", "records", "sizes", log=True)
    assert svg.startswith("<svg") and "T &amp; U" in svg and svg.count("<rect") == 2
    files.write_json({"x": df}, f"file://{tmp_path}/x.json")
    assert json.loads((tmp_path / "x.json").read_text())["x"][2] == {"id": 3, "p": "x", "q": "b"}
    assert files.read_text(spark, f"file://{tmp_path}/absent") is None


def test_cleaning_uses_a_profile_that_was_handed_off(spark, tmp_path):
    df = spark.createDataFrame([(k, None, "1", "2024-01-01", k) for k in range(4)], "person_id long, note string, drug_concept_id string, drug_era_start_date string, original_row_number long")
    path = f"file://{tmp_path}/profile"
    assert files.read_handoff(spark, path) is None
    files.profile_handoff(profile.table_profile(df), path)
    handed = files.read_handoff(spark, path)
    assert quality.columns_to_prune(handed) == ["note"]
    order = [F.col("original_row_number")]
    assert quality.clean_table(df, TABLES["DRUG_ERA"], order, profile=handed).kept.columns == [c for c in df.columns if c != "note"]
    assert quality.clean_table(df, TABLES["DRUG_ERA"], order, profile=handed.limit(0)).kept.columns == df.columns


def test_validation_sizes_and_person_summary(spark):
    person = spark.createDataFrame([(1, 8507, 1950, 1, 1), (2, 8532, 1990, 1, 1), (3, 8507, None, 1, 1)], "person_id long, gender_concept_id long, year_of_birth int, race_concept_id long, ethnicity_concept_id long")
    verdict = validate.validate({"PERSON": person}, {"PERSON": TABLES["PERSON"]}, {"PERSON": 100})
    assert verdict.passed and "PERSON: born 1950 to 1990" in verdict.notes and "PERSON: genders 8507 (2), 8532 (1)" in verdict.notes
    assert not validate.validate({"PERSON": person}, {"PERSON": TABLES["PERSON"]}, {"PERSON": 0}).passed


def test_mapping_keeps_one_lineage(spark):
    rows = [(1, "a", k) for k in range(4)] + [(1, "b", 9), (2, "a", 10), (2, "c", 11), (2, "c", 12), (2, "c", 13)]
    df = spark.createDataFrame(rows, "person long, concept string, pos long")
    mapped = spark.createDataFrame([("a", "z"), ("c", "z")], "original_concept_id string, snomed_concept_id string")
    split = mapping.map_table(df, mapped, "concept", ["person", "concept"], [F.col("pos")], 2)
    assert {(r.pos, r.concept, r.concept_mapped) for r in split.kept.collect()} == {(0, "z", "Y"), (10, "z", "Y")}
    gone = {r.pos: (r.concept, r.removal_reason.split(" ")[0]) for r in split.rejected.collect()}
    assert gone == {1: ("z", "duplicate"), 2: ("z", "duplicate"), 3: ("z", "duplicate"), 9: ("b", "low_frequency_concept"), 11: ("z", "duplicate"), 12: ("z", "duplicate"), 13: ("z", "duplicate")}
    assert sum(r.records for r in split.stats.collect()) == len(rows)
    whole = mapping.map_table(df, None, "concept", ["person", "concept"], [F.col("pos")], 0, deduplicate=False)
    assert whole.kept.count() == len(rows) and whole.rejected.count() == 0


def test_sketch_of_a_large_concept(spark):
    df = spark.range(50000).select(F.lit(1).alias("c"), F.col("id").cast("double").alias("v"))
    r = standardize.sketched_quantiles(df, "c", "v", accuracy=1000).first()
    assert (r.n, r.p0, r.p100) == (50000, 0.0, 49999.0) and all(abs(r[f"p{p}"] - 500 * p) <= 100 for p in standardize.LEVELS)


def clinical(spark):
    era = spark.createDataFrame([(k, 1 + k % 3, "201826" if k % 7 else "0", f"2024-01-{1 + k % 9:02d}", f"2024-02-{1 + k % 9:02d}", None) for k in range(60)], "drug_era_id long, person_id long, drug_concept_id string, drug_era_start_date string, drug_era_end_date string, note string")
    return {"DRUG_ERA": files.with_position(era)}


def test_runner_writes_each_stage_once(spark, tmp_path):
    tables, folder = clinical(spark), f"file://{tmp_path}/stages"
    state, outcome = pipeline.run(tables, folder=folder)
    lazily, _ = pipeline.run(tables)
    assert set(outcome.values()) == {"done"}
    assert "note" not in state.tables["DRUG_ERA"].columns
    order = sorted(state.tables["DRUG_ERA"].columns)
    assert sorted(map(tuple, state.tables["DRUG_ERA"].select(order).collect())) == sorted(map(tuple, lazily.tables["DRUG_ERA"].select(order).collect()))
    for step in ("cleaning/DRUG_ERA", "mapping/DRUG_ERA"):
        assert state.rejected[step].inputFiles()[0].startswith(f"{folder}/{step}")
        assert sorted(map(tuple, state.stats[step].collect())) == sorted(map(tuple, lazily.stats[step].collect()))
    timed = pipeline.timings(state, spark)
    assert {r.step for r in pipeline.slowest(timed, "cleaning").collect()} == {"cleaning/DRUG_ERA"}
    assert timed.where("step = 'cleaning/DRUG_ERA' AND records = 60 AND records_per_second > 0").count() == 1
    left = state.tables["DRUG_ERA"].count()
    again, outcome = pipeline.run(tables, start_from="standardization", folder=folder)  # reads the mapping stage's table and writes its own anew
    assert outcome["cleaning"] == "skipped" and again.tables["DRUG_ERA"].count() == left


def test_a_job_that_fails_fails_its_stage(spark, tmp_path):
    tables = {n: df.withColumn("drug_concept_id", F.when(F.col("drug_era_id") == 31, F.raise_error(F.lit("bad block"))).otherwise(F.col("drug_concept_id"))) for n, df in clinical(spark).items()}
    state, outcome = pipeline.run(tables, skip=["profile"], folder=f"file://{tmp_path}/stages")
    assert outcome == {"profile": "skipped", "cleaning": "failed", "mapping": "not run", "standardization": "not run", "extraction": "not run"}
    assert "bad block" in state.stats["cleaning/error"].first().error
