"""The registered queries of this subpackage, and their SQL where SQL can state them."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.llm import (
    decontaminate, language_id, licenses, main_text, manifest, mixing, periodic_runs, personal_data, quality_rules, simhash,
    token_files, toxicity, url_filter,
)
from specloom.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The content of the tokenizer file the queries use."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


@_query("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    index = token_files.write_token_files(docs, token_files.output_folder(docs), vocabulary())
    return token_files.read_digests(index)


@_query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    remainder = language_id.fold_of(F.col("doc_id"), 5)
    model = toxicity.train(docs.filter(remainder != 0), labels.filter(remainder != 0))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "score", "predicted"
    )


@_query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(_table(spark, sf_dir, "documents"))


@_query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(_table(spark, sf_dir, "documents"), whole=True)


@_query("op5_quality_rules", quality_rules.oracle())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


@_query("op6_decontaminate", decontaminate.oracle())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.drop("items")


@_query("op7_url_filter")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"))


@_query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    remainder = language_id.fold_of(F.col("doc_id"), 4)
    learn = docs.filter(F.coalesce(remainder != 2, F.lit(True)))
    found = language_id.identify(docs, *language_id.train(learn))
    return found.select(
        "doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@_query("op9_licenses", licenses.oracle())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


@_query("op10_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(_table(spark, sf_dir, "pages"))


@_query("op11_personal_data", personal_data.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.find_spans(_table(spark, sf_dir, "documents")))


@_query("op12_manifest", manifest.oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_table(spark, sf_dir, "documents"))


@_query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(_table(spark, sf_dir, "documents"))
