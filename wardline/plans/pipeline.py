"""The stages as functions over named tables, and a runner that orders and times them.

With a folder every stage writes each table once, all rows with the reason they went by, and the next stage, the rejected
rows and the counts read that; a job that fails fails its stage, and a later run can start from any stage. Without a folder
stages chain lazily (tests, small tables)."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.cohort import cohort_statistics, events, index_times
from wardline.operators.episodes import merge
from wardline.operators.mapping import map_table
from wardline.operators.profile import table_profile
from wardline.operators.quality import clean_table
from wardline.operators.split import Split, by_reason
from wardline.operators.standardize import standardise_dates, standardise_table
from wardline.registry import ICU_CONCEPTS, MERGE_MINUTES, MIN_FREQUENCY, PERCENTILE, PRE_INDEX_TABLES, TABLES
from wardline.sources import files


@dataclass
class State:
    """Tables as they stand, what each stage set aside or counted, and the seconds each step took."""

    tables: dict[str, DataFrame]
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    stats: dict[str, DataFrame] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    folder: str | None = None

    def stage(self, step: str, df: DataFrame) -> DataFrame:
        """Write a frame once and read it from then on."""
        if self.folder is None:
            return df
        df.write.mode("overwrite").parquet(f"{self.folder}/{step}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.folder}/{step}")

    def take(self, stage: str, table: str, split: Split) -> None:
        start, step = time.monotonic(), f"{stage}/{table}"
        again = by_reason(self.stage(step, split.tagged), split.reason)
        self.tables[table] = again.kept.select(*split.kept.columns)
        self.rejected[step], self.stats[step] = again.rejected, again.stats
        self._note(step, start, split.kept.columns)

    def put(self, stage: str, table: str, df: DataFrame) -> None:
        """A stage that sets nothing aside."""
        start, step = time.monotonic(), f"{stage}/{table}"
        self.tables[table] = self.stage(step, df)
        self._note(step, start, df.columns)

    def _note(self, step: str, start: float, columns: list[str]) -> None:
        self.seconds[step] = time.monotonic() - start
        if self.folder is not None:
            files.write_text(next(iter(self.tables.values())).sparkSession, f"{self.folder}/{step}.columns.json", json.dumps(columns))


@dataclass(frozen=True)
class Config:
    position: str = "original_row_number"
    min_concept_freq: int = MIN_FREQUENCY
    deduplicate: bool = True
    outlier_percentile: float = PERCENTILE
    approx: bool = False
    merge_visits: bool = True
    merge_minutes: float = MERGE_MINUTES
    mappings: Mapping[str, DataFrame] = field(default_factory=dict)
    index_concepts: Sequence[int] = ICU_CONCEPTS


def profile_stage(state: State, config: Config) -> None:
    for name, df in list(state.tables.items()):
        start, profile = time.monotonic(), table_profile(df)
        if state.folder is not None:
            path = f"{state.folder}/profile/{name}"
            files.profile_handoff(profile, path)
            profile = files.read_handoff(df.sparkSession, path)
        state.stats[f"profile/{name}"] = profile
        state.seconds[f"profile/{name}"] = time.monotonic() - start


def cleaning_stage(state: State, config: Config) -> None:
    """Uses the profiles of the profiling stage, of this run or handed off by an earlier one."""
    for name, df in list(state.tables.items()):
        if name in TABLES:
            profile = state.stats.get(f"profile/{name}")
            if profile is None and state.folder is not None:
                profile = files.read_handoff(df.sparkSession, f"{state.folder}/profile/{name}")
            state.take("cleaning", name, clean_table(df, TABLES[name], [F.col(config.position)], profile=profile))


def mapping_stage(state: State, config: Config) -> None:
    for name, df in list(state.tables.items()):
        spec = TABLES.get(name)
        if spec and spec.concept and spec.concept in df.columns:
            mapping = config.mappings.get(name)
            keys = (spec.person, spec.concept, spec.event_time or spec.start or spec.id)
            state.take("mapping", name, map_table(df, mapping, spec.concept, keys, [F.col(config.position)], config.min_concept_freq, config.deduplicate and spec.mapped))


def standardization_stage(state: State, config: Config) -> None:
    for name, df in list(state.tables.items()):
        spec = TABLES.get(name)
        if spec is None:
            continue
        if name == "MEASUREMENT" and "value_as_number" in df.columns:
            unit = "unit" if "unit" in df.columns else None
            state.take("standardization", name, standardise_table(df, spec.concept, "value_as_number", unit, spec.dates, config.outlier_percentile, config.approx))
        else:
            new = standardise_dates(df, spec.dates)
            if config.merge_visits and name in ("VISIT_OCCURRENCE", "VISIT_DETAIL"):
                times = {c: F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss")) for c in (spec.start, spec.end)}
                new = merge(new.withColumns(times), spec.person, spec.concept, spec.start, spec.end, spec.id, config.merge_minutes)
            state.put("standardization", name, new)


def extraction_stage(state: State, config: Config) -> None:
    spec = TABLES["VISIT_DETAIL"]
    if spec.name not in state.tables:
        return
    index = index_times(state.tables[spec.name], spec.person, spec.concept, spec.start, spec.end, config.index_concepts)
    start = time.monotonic()
    state.stats["extraction/index"] = state.stage("extraction/index", index)
    state.seconds["extraction/index"] = time.monotonic() - start
    pooled = [(state.tables[t], "person_id", c) for t, c in PRE_INDEX_TABLES.items() if t in state.tables]
    if pooled and {"PERSON", "DEATH"} <= state.tables.keys():
        timed = [(df.withColumn(c, F.coalesce(F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd")))), p, c) for df, p, c in pooled]
        start = time.monotonic()
        cohort = cohort_statistics(state.stats["extraction/index"], events(timed), state.tables["PERSON"], state.tables["DEATH"], "person_id", f"{spec.start}_earliest")
        state.stats["extraction/cohort"] = state.stage("extraction/cohort", cohort)
        state.seconds["extraction/cohort"] = time.monotonic() - start


#: name, function, and whether a failure stops the run.
STAGES: list[tuple[str, Callable[[State, Config], None], bool]] = [
    ("profile", profile_stage, True),
    ("cleaning", cleaning_stage, True),
    ("mapping", mapping_stage, True),
    ("standardization", standardization_stage, True),
    ("extraction", extraction_stage, False),
]


def plan(start_from: str | None = None, skip: Sequence[str] = ()) -> list[str]:
    """Names of the stages that would run, in order."""
    names = [n for n, _, _ in STAGES]
    return [n for n in names[names.index(start_from) if start_from else 0 :] if n not in skip]


def restore(state: State, spark: SparkSession, before: str) -> None:
    """Tables as the stages before the named one left them in the folder."""
    for stage in plan()[: plan().index(before)]:
        for name in list(state.tables):
            path = f"{state.folder}/{stage}/{name}"
            columns = files.read_text(spark, f"{path}.columns.json")
            if columns is not None and files.is_complete(spark, path):
                rows = spark.read.parquet(path)
                kept = rows.where("removal_reason IS NULL") if "removal_reason" in rows.columns else rows
                state.tables[name] = kept.select(*json.loads(columns))


def run(tables: Mapping[str, DataFrame], config: Config | None = None, start_from: str | None = None, skip: Sequence[str] = (), dry_run: bool = False, folder: str | None = None) -> tuple[State, dict[str, str]]:
    """State after the chosen stages, and the outcome of each; a required stage that fails ends the run."""
    state, outcome, chosen, ended = State(dict(tables), folder=folder), {}, plan(start_from, skip), False
    spark = next(iter(tables.values())).sparkSession if tables else None
    if start_from and folder and spark and not dry_run:
        restore(state, spark, start_from)
    for name, stage, required in STAGES:
        if name not in chosen:
            outcome[name] = "skipped"
        elif dry_run:
            outcome[name] = "planned"
        elif ended:
            outcome[name] = "not run"
        else:
            start = time.monotonic()
            try:
                stage(state, config or Config())
                outcome[name] = "done"
            except (PySparkException, Py4JError, OSError) as e:  # a job, its plan or a store; faults of this code are not outcomes
                outcome[name], ended = "failed", required
                state.stats[f"{name}/error"] = spark.createDataFrame([(type(e).__name__, str(e)[:2000])], "kind string, error string")
            state.seconds[name] = time.monotonic() - start
    return state, outcome


def timings(state: State, spark: SparkSession) -> DataFrame:
    """step, seconds, records, records_per_second of each stage (without records) and of each table in it."""
    rows = []
    for step, seconds in state.seconds.items():
        stats = state.stats.get(step)
        counted = stats is not None and stats.columns == ["outcome", "records"]
        records = (stats.agg(F.sum("records").alias("n")).first().n or 0) if counted else None
        rows.append((step, float(seconds), records, records / seconds if records and seconds else None))
    return spark.createDataFrame(rows, "step string, seconds double, records long, records_per_second double")


def slowest(timed: DataFrame, stage: str, n: int = 5) -> DataFrame:
    """The n steps of a stage that took longest."""
    return timed.where(F.col("step").startswith(f"{stage}/")).orderBy(F.desc("seconds"), "step").limit(n)
