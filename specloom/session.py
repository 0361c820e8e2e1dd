"""Session settings and the one place where intermediate tables are kept."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int = 1) -> int:
    """Partitions that keep a shuffle of this size within the memory of a task."""
    return max(cores, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def get_session(
    app: str = "specloom", master: str | None = None, shuffled_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the operators are written for.

    Adaptive execution merges small shuffle partitions, turns a join into a
    broadcast only after it has measured the side, and splits skewed join
    partitions.  It cannot add partitions, so for large inputs name the bytes
    that the largest shuffle moves.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLE_PARTITION_BYTES))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffled_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffled_bytes)))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application.

    Python steps are sent by name, so every worker must be able to import the
    code, wherever its working directory is.
    """
    context = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    name = f"{os.path.basename(root)}.zip"
    if any(str(path).endswith(name) for path in getattr(context, "_python_includes", [])):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="spark-"), name)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in os.walk(root):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared checkpoint folder the cluster names.

    Only a local session that names none gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor, so the
    missing setting is an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


_written: dict[str, list[str]] = {}


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it from there.

    What is read back no longer depends on how or where it was computed, and
    later passes read only the columns they need.  The table stays until
    ``release`` or the end of the ``released`` block it was written in.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: int = 0) -> int:
    """Delete the tables ``cut_lineage`` has written, but for the first ``keep``; returns how many went.

    Frames that still read one of them can no longer be run.
    """
    paths = _written.get(spark.sparkContext.applicationId, [])
    gone, paths[keep:] = paths[keep:], []
    for path in gone:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(gone)


@contextlib.contextmanager
def released(spark: SparkSession):
    """Delete, at the end of the block, the tables written in it."""
    before = len(_written.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, before)
