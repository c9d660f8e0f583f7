"""Session settings and the shared folder every intermediate table is written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_local_dirs: dict[str, str] = {}
ROW_GROUP_BYTES = 16 << 20
#: Codec of the tables that stay.
CODEC = "zstd"
#: Rows that one write shuffles at once, up to MOST_SLICES writes; from there on a slice grows with the table.
SLICE_ROWS = 2 << 20
MOST_SLICES = 16
#: Folders that :func:`stage` has written inside the innermost :func:`passing_stages`.
_passing: ContextVar[list[str] | None] = ContextVar("passing_stages", default=None)


def build_session(app: str = "ledgerlake", cpus: int | str = "*", driver_memory: str = "12g") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    parallel = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", parallel)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, whose
    executors share one machine, falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="ledgerlake-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/ledgerlake/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` as Parquet, by the session's codec unless ``options`` names one, and read it back.

    Cuts lineage in a way that survives a lost executor, fixes the rows a
    two-pass operator looks at twice, and gives the planner real file sizes to
    decide on a broadcast.
    """
    path = fresh_path(df.sparkSession, label)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    # Row groups well below a task's share: also a single file is read by many tasks.
    write_parts(df.sparkSession, [lambda: df], path, **{"parquet.block.size": ROW_GROUP_BYTES, **options})
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_parts(
    spark: SparkSession,
    parts: Iterable[Callable[[], DataFrame]],
    path: str,
    mode: str = "errorifexists",
    partition_by: Iterable[str] = (),
    **options,
) -> StructType:
    """Write frames one after the other into one folder; each is built when its turn comes. Returns their schema.

    What building a frame has staged goes when it is written, and its shuffle files can. A part
    that fails takes the parts before it along, as the failure of a single write would.
    """
    schema = None
    try:
        for part in parts:
            with passing_stages(spark):
                rows = part()
                writer = rows.write.mode("append" if schema else mode).options(**options)
                (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
            schema = schema or rows.schema
    except Exception:
        if schema:
            drop(spark, path)
        raise
    return schema


def drop(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


@contextmanager
def passing_stages(spark: SparkSession) -> Iterator[None]:
    """Folders staged inside the block are removed at its end; no frame that reads them may outlive it."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            drop(spark, path)


def drop_shuffles_early(spark: SparkSession) -> None:
    """Shuffle files go when their statement ends, not when the driver happens to collect its garbage.

    A frame that is evaluated twice computes its shuffles again.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def slices(rows: DataFrame, key: str) -> list[DataFrame]:
    """``rows`` cut into ranges of ``key`` of about equal size, in key order; rows without a key are in the first.

    What shuffles them slice by slice needs disk for one slice at a time. ``rows`` is read once more
    for each slice; of a table that lies in key order, a slice reads its own row groups only.
    """
    number = min(MOST_SLICES, -(-rows.count() // SLICE_ROWS))
    if number <= 1:
        return [rows]
    cuts = rows.agg(F.percentile_approx(key, [i / number for i in range(1, number)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return [rows]
    place = F.col(key)
    inner = [rows.where((place > low) & (place <= high)) for low, high in zip(cuts, cuts[1:])]
    return [rows.where(place.isNull() | (place <= cuts[0])), *inner, rows.where(place > cuts[-1])]


def run_together(spark: SparkSession, tasks: list[Callable[[], object]], at_once: int = 4) -> list:
    """Run independent Spark jobs side by side; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(copy_context().run, inheritable_thread_target(spark)(task)) for task in tasks]
    return [job.result() for job in running]
