"""Tables written to the folder that the whole cluster shares.

Iterative or multi-pass operators cut their lineage by writing an
intermediate table and reading it back: a lost executor then costs a re-read,
never a recomputation of the whole history.  The folder is the one the cluster
names in ``spark.checkpoint.dir``; only where that is unset and the master is
local (tests, a laptop) does a temporary folder stand in.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import re
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_made: set[str] = set()
_collecting: contextvars.ContextVar[set[str] | None] = contextvars.ContextVar("tables", default=None)
_lock = threading.Lock()
_writers: list[int] = []  # writes under way, in any thread
_before: list[str | None] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared working folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="dockmill-")
        spark.conf.set("spark.checkpoint.dir", root)
        _made.add(root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root.rstrip("/") + "/dockmill")
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/(?!/)", "file:///", whole)  # as other file systems than Hadoop's spell it


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.add(path)
    return path


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, Spark deletes an execution's shuffle files when it ends: nothing reads them again once a table is written."""
    with _lock:
        if not _writers:
            _before.append(spark.conf.get(_CLEANUP, None))
            spark.conf.set(_CLEANUP, "true")
        _writers.append(1)
    try:
        yield
    finally:
        with _lock:
            _writers.pop()
            if not _writers:
                before = _before.pop()
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str, bucketed: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    With ``bucketed``, in as many buckets of that column as exchanges have
    partitions: grouping or joining by it then leaves these rows where they lie.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if (made := _collecting.get()) is not None:
        made.add(path)
    with shuffles_dropped(spark):
        writer = df.write.option("compression", "zstd")
        if bucketed:
            writer.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), bucketed).option("path", path).saveAsTable(listed := f"dockmill_{uuid.uuid4().hex}")
        else:
            writer.parquet(path)
    if bucketed:
        out = spark.table(listed)
        spark.sql(f"DROP TABLE {listed}")  # only buckets need the catalog; an external table's files stay
    else:
        out = spark.read.schema(df.schema).parquet(path)
    out._dockmill_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing will read again."""
    for df in tables:
        if path := getattr(df, "_dockmill_path", None):
            delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _made.discard(path)


def spread(df: DataFrame, most: int = 1 << 30) -> DataFrame:
    """``df`` over all cores, if it is a small table in fewer files than there are cores.

    A file's row group is one task, however much work its rows are.  Larger
    tables are left as they lie.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= most and 0 < len(df.inputFiles()) < cores else df


def small(df: DataFrame, most: int) -> DataFrame:
    """``df``, to be broadcast if it has no more than ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


@contextlib.contextmanager
def tables_made():
    """Inside, in this thread, the paths of tables that :func:`materialize` writes are collected in the set given."""
    made: set[str] = set()
    token = _collecting.set(made)
    try:
        yield made
    finally:
        _collecting.reset(token)


@atexit.register
def _clean() -> None:
    spark = SparkSession.getActiveSession() if _made else None
    for path in sorted(_made):
        if path.startswith("file:"):
            shutil.rmtree(re.sub(r"^file:/*", "/", path), ignore_errors=True)
        elif spark is not None:
            try:
                delete(spark, path)
            except Exception:  # the JVM may be gone already; the folder is scratch space
                return
