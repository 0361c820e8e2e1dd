"""The corpus pipeline: five stages, each one operator, each on what the one before kept.

``STAGES`` lists name and function of the stages.  A function takes the session,
the documents so far and the folder of the tables, and returns documents; what
it returns is written as Parquet and read again for the next one.  All stages
but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.llm import decontaminate, language_id, mixing, token_files, wide_simhash
from specloom.llm.queries import vocabulary
from specloom.session import cut_lineage, ensure_checkpoint_dir, released, ship_package

#: Words of a shingle, and bits of 256 in which near-copies differ at most.
SHINGLE, DISTANCE = 5, 48
#: A language is accepted from this share of the posterior on.
LEAST_SCORE = 0.5


def _key(docs: DataFrame) -> Column:
    """What tells rows apart where ids repeat or are null: id and text; ids that are null come last."""
    return F.struct(
        docs["doc_id"].isNull().alias("no_id"), docs["doc_id"].alias("id"), F.xxhash64(docs["text"]).alias("text_hash")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """The key, as doc_id, and the text, for the operators."""
    return docs.select(_key(docs).alias("doc_id"), "text")


def _whole(docs: DataFrame) -> DataFrame:
    """The row as one column, in doc_id's place, and the text: operators that judge rows one by one hand it through."""
    row = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    return docs.select(row.alias("doc_id"), "text")


def _rows(found: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that ``_whole`` has wrapped."""
    return found.select(*[F.col(f"doc_id.c{i}").alias(c) for i, c in enumerate(columns)])


def _with_key(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents whose key is in ``found``."""
    keys = found.select(F.col("doc_id.id").alias("_id"), F.col("doc_id.text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(keys["_id"]) & (F.xxhash64(docs["text"]) == keys["_hash"])
    return docs.join(keys, same, "left_semi")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; those of no or doubtful language go."""
    ship_package(spark)
    remainder = language_id.fold_of(F.col("doc_id"), 4)
    model = language_id.train(docs.filter(F.coalesce(remainder != 2, F.lit(True))))
    found = language_id.identify(_whole(docs), *model)
    accepted = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return _rows(accepted, docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: that of the least doc_id, and one row of it."""
    ship_package(spark)
    classes = cut_lineage(wide_simhash.near_texts(_keyed(docs), SHINGLE, DISTANCE).select("doc_id", "component_id"))
    first = classes.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").count()
    once = _with_key(docs, first.filter("count = 1"))
    again = _with_key(docs, first.filter("count > 1")).dropDuplicates(["doc_id", "text"])
    return once.unionByName(again)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mixture that keeps the target weights for as long as sources last."""
    ship_package(spark)
    return mixing.interleaved(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the documents' files; returns each document's place and digest as read back.

    Files are in the order of their number, so the mixture that was written is the order of the ids.
    """
    ship_package(spark)
    number = F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).try_cast("long")
    placed = docs.select(
        "doc_id", "text", number.alias("_number"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    index = token_files.write_token_files(
        placed, token_files.output_folder(docs), vocabulary(), order=["_number", "_file", "_row"]
    )
    return token_files.read_digests(index)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark_text),
    ("mix_sources", mix_sources),
    ("token_files", write_tokens),
]

#: SQL can state neither the language model nor the encoding; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        if name == STAGES[-1][0]:
            return stage(spark, docs, sf_dir)
        with released(spark):  # a stage's own tables go as soon as its result is written
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
