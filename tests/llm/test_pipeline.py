import zlib

import corpus_pipeline
import numpy as np
import pytest
from helpers import SCHEMA, empty, odd, prose
from test_decontaminate import brute_force as contaminated
from test_mixing import brute_force_order, in_files
from test_token_files import in_order
from test_wide_simhash import brute_force as near_texts

from specloom.llm import mixing


def applied(spark, docs, folder, sf_dir):
    """Every stage's input and output."""
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        yield name, docs, out
        docs = out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = []
    for i in range(150):
        text = "the man and the dog " + prose(i if i % 10 else 3, 70)
        if i % 13 == 0:
            text += " " + prose(500 + i % 3, 12)
        rows.append((i, text if i % 29 else "12 34 !", "en" if i % 2 else "fr", f"s{i % 3}" if i % 5 else "s0", 1, "x", 1, 1))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    items = [(i, prose(500 + i, 12)) for i in range(3)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def test_stages_against_brute_force(spark, tables, tmp_path):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, given, out in applied(spark, docs, str(tmp_path), folder):
        before = {r.doc_id: r for r in given.collect()}
        kept = {r.doc_id: r for r in out.collect()}
        if name == "token_files":
            # the ids stand in the order of the mixture's files
            ordered = [(r.doc_id, r.text) for r in in_files(spark, f"{tmp_path}/mix_sources")]
            assert sorted(map(tuple, out.collect())) == sorted(in_order(ordered)) and len(ordered) == len(before)
            continue
        assert out.columns == given.columns and out.count() == len(kept)
        assert all(kept[i] == before[i] for i in kept)
        rows = [(i, r.text) for i, r in before.items()]
        if name == "language_id":
            assert set(before) - set(kept) >= {i for i, t in rows if not any(c.isalpha() for c in t)}
            assert len(kept) > 100
        elif name == "simhash_dedup":
            assert set(kept) == {c for _, _, c in near_texts(rows)} and len(kept) < len(before)
        elif name == "decontaminate":
            assert set(before) - set(kept) == {r[0] for r in contaminated(rows, items) if r[5]} != set()
        else:
            assert kept == before
            found = [r.doc_id for r in in_files(spark, f"{tmp_path}/{name}")]
            assert found == [i for i, _ in brute_force_order(given, mixing.BLOCK)]


def test_run_is_all_stages(spark, tables, tmp_path):
    folder, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    *_, (_, _, last) = applied(spark, docs, str(tmp_path), folder)
    found = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, last.collect())) != []


def test_odd_rows_and_empty_table(spark, tables, tmp_path):
    folder, _ = tables
    for name, given, out in applied(spark, odd(spark), f"{tmp_path}/odd", folder):
        if name == "simhash_dedup":  # one row of each group, a known id before a null one
            rows = [(r.doc_id, r.text) for r in given.collect()]
            groups = {f for _, f, _ in near_texts(rows)}
            assert out.count() <= len(groups) and out.filter("doc_id = 7").count() >= 1
    for _, _, out in applied(spark, empty(spark), f"{tmp_path}/empty", folder):
        assert out.count() == 0


def test_digest_is_that_of_the_ids():
    assert zlib.crc32(np.array([1, 0], "<u4").tobytes()) == zlib.crc32(b"\x01\0\0\0\0\0\0\0")
