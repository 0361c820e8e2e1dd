"""Tables that many readers share, bucketed by their key, so that readers need no shuffle for it.

A bucketed table is written once; grouping, windows and joins on its key, or on
the key and more columns, then read each bucket where it lies.  A bucket is read
by one task.  So the table says, when it is written, how uneven its buckets
are: where the largest holds more than ``UNEVEN`` times its even share, one key
is likely to be behind it, and readers get the same files without their
buckets.  Plans then shuffle as for any table, with partial aggregation and
adaptive splits; the rows are the same.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import ensure_checkpoint_dir

UNEVEN = 4
OPEN_FILES = 16
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def placed_by(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """Rows of a bucket together, in a rebalancing shuffle: a bucket that is much larger than others goes to several tasks."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("rebalance", buckets, F.col(key))


def write_shared(df: DataFrame, key: str, buckets: int | None = None, placed: bool = False) -> DataFrame:
    """Write ``df`` bucketed by ``key`` to the shared folder and read it from there.

    Rows go to their bucket in a rebalancing shuffle, unless ``placed_by`` has done that to narrower
    rows that ``df`` is made of.  A task writes one file a bucket it has rows of, all at the same time
    rather than sorted by bucket, as long as these are ``OPEN_FILES`` at most.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"shared_{uuid.uuid4().hex}"
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}"
    before = spark.conf.get(_WRITERS, "0")
    spark.conf.set(_WRITERS, str(max(int(before), OPEN_FILES)))
    try:
        rows = df if placed else placed_by(df, key, buckets)
        rows.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    finally:
        spark.conf.set(_WRITERS, before)
    stored = spark.table(name)
    sizes = stored.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).count()
    most, total = sizes.agg(F.max("count"), F.sum("count")).first()
    if total and most * buckets > UNEVEN * total + buckets * buckets:
        return spark.read.schema(stored.schema).parquet(path)
    return stored
