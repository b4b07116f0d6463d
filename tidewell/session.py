"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCRATCH_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "tidewell", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume: AQE, skew joins, UTC."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
        # Streaming state on local disk instead of executor memory, checkpointed as usual.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        # Recording the call site of every column expression multiplies planning time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, because there every task sees the same disk.
    """
    configured = spark.conf.get(SCRATCH_KEY, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SCRATCH_KEY} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidewell-")
        spark.conf.set(SCRATCH_KEY, configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path below the scratch root that no other run uses."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/tidewell/{app}/{purpose}-{uuid.uuid4().hex[:12]}"


@contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of a job as soon as it has ended, not when the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def _write_copy(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    with _dropping_shuffles(df.sparkSession):
        writer.mode("errorifexists").parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    return copy.select(*[f"`{c}`" for c in df.columns])


def stage(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the scratch folder and return a scan of the copy.

    Later readers see exactly these rows even if an executor is lost, which
    matters when the rows carry values fixed by one physical layout, such as a
    range-partition number. The copy stays until ``clear_scratch``, because the
    returned frame is lazy.
    """
    return _write_copy(df, scratch_path(df.sparkSession, purpose), partition_by)


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Like ``stage``, for a copy that is used up inside the block and deleted after it."""
    path = scratch_path(df.sparkSession, purpose)
    try:
        yield _write_copy(df, path, ())
    finally:
        delete_path(df.sparkSession, path)


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, for checks and deletes that need no job."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> bool:
    target, fs = hadoop_path(spark, path)
    return fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None where there is none."""
    target, fs = hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and rename it over the old one, so readers see one or the other."""
    jvm = spark._jvm
    target, fs = hadoop_path(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}.tmp")
    fs.mkdirs(target.getParent())
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(beside), fs.makeQualified(target), options)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete all that this application staged. Call it when no staged frame is still in use."""
    return delete_path(spark, f"{scratch_root(spark)}/tidewell/{spark.sparkContext.applicationId}")
