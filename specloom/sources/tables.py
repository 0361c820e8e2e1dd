"""Raw tables by format, and tables under names for free SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("csv", "json", "parquet")


def read_table(
    spark: SparkSession, path: str, kind: str | None = None, schema: str | None = None, multi_line: bool = False
) -> DataFrame:
    """A raw table; the format is the path's ending unless named.

    CSV columns stay text unless a schema is given: guessing would take a scan
    of its own and could lose the original of mixed columns.  A CSV file is read
    in splits; fields with line breaks need ``multi_line``, which reads each
    file in one task.
    """
    kind = kind or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in FORMATS:
        raise ValueError(f"not a raw table format: {kind}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "csv":
        return reader.csv(path, header=True, multiLine=multi_line, escape='"')
    return reader.json(path) if kind == "json" else reader.parquet(path)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Give tables names, so that any SELECT or WITH can be run with ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
