"""Shared helpers of the training-data operators: staged tables, let-bindings and column hygiene."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words in every contract of this subpackage, as a Java regex class.
SPACE = "\\x20\\x09-\\x0D"

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and all run on one machine (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='wardline-')}"
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; removed when the driver ends."""
    if not _made:
        atexit.register(_clean)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a path of the shared folder through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            discard(spark, path)
        except Exception:  # the session may have ended before the interpreter
            return


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read again, so that a lost executor costs one task, not the plan."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks and share an executor's memory with the JVM."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        return


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow, after this package was sent to the workers, which may not have it on their path."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="wardline-")
        atexit.register(shutil.rmtree, folder, True)
        made = os.path.join(folder, "wardline.zip")
        with zipfile.ZipFile(made, "w") as out:
            for inner, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(inner, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(made)
        _shipped.add(context.applicationId)

    def run(batches):
        import gc

        gc.disable()  # the operators make no cycles, and a collection walks every cached word
        try:
            yield from function(batches)
        finally:
            gc.enable()
            give_back()

    return df.mapInArrow(run, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and bind it in ``body``; Catalyst would inline a plain column into each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text, in order; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+", -1), "")


def row_of(docs: DataFrame) -> Column:
    """All columns as one struct, whatever they are called."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
