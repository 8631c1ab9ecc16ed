"""Scans and sinks: CSV tables as text, typed projections, positions, catalogs, partitioned and report outputs."""

from __future__ import annotations

import atexit
import json
import math
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.functions.scalars import blank, partition_path, to_double, to_long
from wardline.operators.profile import null_columns, table_sizes


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir), or in a temporary one where all run on one machine; removed when the driver ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}" if shared else f"file://{tempfile.mkdtemp(prefix=f'{name}-')}"

    def remove() -> None:
        try:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session may have ended before the interpreter
            return

    atexit.register(remove)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it from then on, for what several branches of a plan use."""
    path = f"{scratch(df.sparkSession, name)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, multiline: bool = False) -> DataFrame:
    """A headered CSV table, every column text, empty fields null; optionally some columns only.

    Files are read in splits, as many tasks as they are long. Where quoted fields hold line breaks, ``multiline`` reads each
    file whole, by one task."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=multiline, escape='"')
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV table; reads its first line only."""
    return spark.read.csv(path, header=True, inferSchema=False, escape='"').columns


def with_position(df: DataFrame, name: str = "original_row_number") -> DataFrame:
    """Adds the 1-based row number in source order.

    Rows are numbered within their partition; where each partition starts is a running sum over one row a partition."""
    marked = df.withColumn("_m", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_m", 33))
    sizes = marked.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_p", F.coalesce(before, F.lit(0)).alias("_start"))
    met = marked.join(F.broadcast(starts), "_p")  # as many rows as the scan has tasks
    return met.withColumn(name, F.col("_start") + F.col("_m").bitwiseAND((1 << 33) - 1) + 1).select(*df.columns, name)


def typed(df: DataFrame, longs: Sequence[str] = (), doubles: Sequence[str] = (), timestamps: Sequence[str] = ()) -> DataFrame:
    """Casts that give null where a text is no value of the type."""
    new = {c: to_long(F.col(c)) for c in longs if c in df.columns} | {c: to_double(F.col(c)) for c in doubles if c in df.columns}
    return df.withColumns(new | {c: F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss")) for c in timestamps if c in df.columns})


def _listing(spark: SparkSession, path: str) -> list:
    """Statuses of the files of a folder, or of the file itself, through the path's own file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(system.listStatus(where)) if system.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, from any store that Spark reads; None where there is none."""
    if not _listing(spark, path):
        return None
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, in any store that Spark writes."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def catalog(spark: SparkSession, folder: str, suffix: str = "", multiline: bool = False) -> dict[str, DataFrame]:
    """Every CSV of a folder by its stem (without the suffix), also registered as a view."""
    out = {}
    for status in _listing(spark, folder):
        name = status.getPath().getName()
        if name.endswith(f"{suffix}.csv"):
            stem = name.removesuffix(f"{suffix}.csv")
            out[stem] = read_csv(spark, status.getPath().toString(), multiline=multiline)
            out[stem].createOrReplaceTempView(stem)
    return dict(sorted(out.items()))


def sizes(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, int]:
    """Bytes of every CSV of a folder by its stem; a table that is a folder counts its parts."""
    out = {}
    for status in _listing(spark, folder):
        name = status.getPath().getName()
        if name.endswith(suffix):
            parts = _listing(spark, status.getPath().toString()) if status.isDirectory() else [status]
            out[name.removesuffix(suffix)] = sum(x.getLen() for x in parts)
    return out


def estimated_rows(spark: SparkSession, path: str, sample: int = 1 << 20) -> int:
    """Rows of a CSV file by the line density of its first ``sample`` bytes; for progress and planning, never for results."""
    total, seen, lines = 0, 0, 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for status in _listing(spark, path):
        total += status.getLen()
        if seen < sample and status.getLen():
            stream = status.getPath().getFileSystem(conf).open(status.getPath())
            try:
                data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, sample - seen)))
            finally:
                stream.close()
            seen, lines = seen + len(data), lines + data.count(b"\n")
    return max(0, round(total * lines / seen) - 1) if seen else 0


def counted(spark: SparkSession, folder: str, cache: str) -> dict[str, int]:
    """Rows of every CSV of a folder, kept in a JSON file with the length and time of each: only changed tables are counted anew."""
    known = json.loads(read_text(spark, cache) or "{}")
    found = {}
    for status in _listing(spark, folder):
        name, stamp = status.getPath().getName(), [status.getLen(), status.getModificationTime()]
        if name.endswith(".csv"):
            old = known.get(name)
            rows = old["rows"] if old and old["stamp"] == stamp else read_csv(spark, status.getPath().toString()).count()
            found[name] = {"rows": rows, "stamp": stamp}
    if found != known:
        write_text(spark, cache, json.dumps(found, indent=2, sort_keys=True))
    return {name.removesuffix(".csv"): x["rows"] for name, x in sorted(found.items())}


def head(df: DataFrame, n: int = 1000) -> DataFrame:
    return df.limit(n)


def tail(df: DataFrame, n: int = 1000, position: str = "original_row_number") -> DataFrame:
    """The last n rows of a positioned frame, in no order; a task passes on n rows at most."""
    return df.orderBy(F.desc(position)).limit(n)


def row_slice(df: DataFrame, start: int, stop: int, position: str = "original_row_number") -> DataFrame:
    """Rows start (included) to stop of a positioned frame, both 0-based."""
    return df.where((F.col(position) > start) & (F.col(position) <= stop))


def load_dictionary(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """One row per key of a mapping CSV; a later row wins."""
    rows = with_position(read_csv(spark, path)).where(~blank(F.col(key)))
    return rows.groupBy(key).agg(F.max_by(value, "original_row_number").alias(value))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a written table is there as a whole: its job was committed, and it has a file that is not empty."""
    found = {s.getPath().getName(): s.getLen() for s in _listing(spark, path)}
    return "_SUCCESS" in found and any(n and not name.startswith("_") for name, n in found.items())


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single: bool = False) -> None:
    """Headered CSV; ``mode`` append adds, resume leaves a table that is complete and writes any other anew. A table without rows is a header."""
    if mode == "resume":
        if is_complete(df.sparkSession, path):
            return
        mode = "overwrite"
    (df.coalesce(1) if single else df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_one_file(df: DataFrame, path: str) -> None:
    """One CSV file with one header: parts are written by all tasks, then their bytes are put one after the other."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    parts = f"{path}.parts"
    df.write.mode("overwrite").option("escape", '"').csv(f"{parts}/rows")
    df.limit(0).coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{parts}/header")
    where = jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(conf)
    out = system.create(where, True)
    try:
        for folder in ("header", "rows"):
            files = [s.getPath() for s in _listing(df.sparkSession, f"{parts}/{folder}") if s.getPath().getName().startswith("part-")]
            for part in sorted(files, key=lambda x: x.getName()):
                stream = system.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
                finally:
                    stream.close()
    finally:
        out.close()
    system.delete(jvm.org.apache.hadoop.fs.Path(parts), True)


def write_by_person(df: DataFrame, path: str, person: str = "person_id", records: int = 0) -> None:
    """One folder per person below prefix and bucket; rows of a person are brought together, and large persons split by ``records`` a file."""
    prefix, bucket = partition_path(F.col(person).cast("string"))
    rows = df.where(F.col(person).isNotNull()).withColumn("prefix", prefix).withColumn("bucket", F.coalesce(bucket, F.lit("all"))).withColumn("person", F.col(person))
    rows.repartition("prefix", "bucket", "person").write.mode("overwrite").option("header", True).option("maxRecordsPerFile", records).partitionBy("prefix", "bucket", "person").csv(path)


def entity_count(df: DataFrame, person: str = "person_id") -> int:
    return df.select(person).distinct().count()


def write_json(stats: Mapping[str, DataFrame], path: str) -> None:
    """Small statistics frames as one JSON object of row lists."""
    rows = {k: [r.asDict(True) for r in df.collect()] for k, df in stats.items()}
    write_text(next(iter(stats.values())).sparkSession, path, json.dumps(rows, default=str, indent=2))


def markdown(title: str, stats: Mapping[str, DataFrame]) -> str:
    """Small statistics frames as a report of tables."""
    out = [f"# {title}", ""]
    for name, df in stats.items():
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join(f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else f"{v:.2f}" if isinstance(v, float) else str(v) for v in r) + " |" for r in df.collect()]
        out.append("")
    return "\n".join(out)


def text_report(tables: Mapping[str, DataFrame], n: int = 5) -> str:
    """Rows and columns of each table and its n columns with most nulls, as plain text."""
    counts = {r.table_name: r.records for r in table_sizes(tables).collect()}
    empty: dict[str, list[str]] = {}
    for r in null_columns(tables, n).orderBy("table_name", F.desc("missing_percentage"), "column_name").collect():
        empty.setdefault(r.table_name, []).append(f"  {r.column_name}: {r.missing:,} null ({r.missing_percentage:.1f} %)")
    out = []
    for name, df in tables.items():
        out += [f"{name}: {counts[name]:,} rows, {len(df.columns)} columns", *empty.get(name, ["  no nulls"]), ""]
    return "\n".join(out)


def bar_chart(df: DataFrame, label: str, value: str, title: str = "", log: bool = False, most: int = 40) -> str:
    """Bars of a small frame, the greatest ``most`` values in descending order, as an SVG image; ``log`` scales them by powers of ten."""
    rows = df.select(F.col(label).cast("string").alias("k"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL").orderBy(F.desc("v"), "k").limit(most).collect()
    scale = (lambda v: math.log10(max(v, 0) + 1)) if log else (lambda v: max(v, 0))
    top = max((scale(r.v) for r in rows), default=0) or 1
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" width="760" height="{40 + 22 * len(rows)}" font-family="sans-serif" font-size="12">', f'<text x="8" y="20" font-size="15">{escape(title)}</text>']
    for k, r in enumerate(rows):
        y, width = 34 + 22 * k, 440 * scale(r.v) / top
        out.append(f'<text x="200" y="{y + 13}" text-anchor="end">{escape(r.k or "")}</text><rect x="208" y="{y}" width="{width:.1f}" height="16" fill="#4878a8"/><text x="{214 + width:.1f}" y="{y + 13}">{r.v:,.6g}</text>')
    return "\n".join([*out, "</svg>"])


def profile_handoff(profile: DataFrame, path: str) -> None:
    """Write a table's profile for the cleaning stage of another run."""
    profile.write.mode("overwrite").json(path)


def read_handoff(spark: SparkSession, path: str) -> DataFrame | None:
    """A profile that was handed off, or None: cleaning then profiles the table itself."""
    if not is_complete(spark, path):
        return None
    return spark.read.schema("column_name string, total long, missing long, missing_percentage double, distinct_count long").json(path)


def total_order(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]
