"""Session settings and the shared place for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a job of this package wants from a session. The cluster's own settings
# win; nothing here sizes the cluster.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed side is split even where the join's output is shuffled again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfcount")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by the cluster, or by an earlier call on the context."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    return current.get() if current.isDefined() else None


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the cluster's shared folder.

    One is made up only where driver and executors are one process and none is set, as in tests.
    """
    folder = checkpoint_dir(spark)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = f"/tmp/shelfcount-{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder


# Folders of the copies that each application has made.
_COPIES: dict[str, list[str]] = {}


def materialize(df: DataFrame, name: str = "part") -> DataFrame:
    """Write a table to the shared folder and read it back.

    For what a plan uses more than once. The copy is columnar, survives the
    loss of any executor, and its size is known to the planner.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _COPIES.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    copy._copy_path = path
    return copy


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*copies: DataFrame) -> None:
    """Delete what ``materialize`` has written, once nothing reads it any more: neither these copies nor what comes of them."""
    for copy in copies:
        _COPIES[copy.sparkSession.sparkContext.applicationId].remove(copy._copy_path)
        _delete(copy.sparkSession, copy._copy_path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows, known as such to the planner."""
    return spark.range(0).select(F.from_json(F.lit("{}"), schema).alias("r")).filter("false").select("r.*")


MAX_BROADCAST_ROWS = 100_000


def checked_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a dimension after counting it; one that is too long is left to the planner.

    Without statistics the planner would shuffle the large side by a handful
    of dimension keys. It is counted each time, so one that grows is noticed.
    """
    return F.broadcast(df) if df.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else df


# A table of this size may be one split, and text work on it one task; above it, files have splits enough.
SPREAD_BYTES = (1 << 20, 256 << 20)


def spread(scan: DataFrame) -> DataFrame:
    """A small scan dealt out to all cores, 32 at most; a larger one stays as it is, so no large table is moved."""
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if not SPREAD_BYTES[0] <= size <= SPREAD_BYTES[1]:
        return scan
    return scan.repartition(min(32, scan.sparkSession.sparkContext.defaultParallelism))


#: Rows that a task is given where it has to hold or sort them.
ROWS_PER_TASK = 1_000_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows shuffled by keys into as many partitions as keep a task's share bounded, for a table of about ``rows`` rows;
    never fewer than the session asks for. With few rows the number is left to the session."""
    wanted = -(-rows // ROWS_PER_TASK)
    given = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(wanted, *keys) if wanted > given else df.repartition(*keys)


def drop_copies(spark: SparkSession) -> int:
    """Delete the copies made so far by this application; how many. For when no result that reads them is needed
    any more: a DataFrame cannot tell."""
    paths = _COPIES.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for the rounds of a loop."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
