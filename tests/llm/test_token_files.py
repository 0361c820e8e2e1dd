import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from helpers import empty, odd, prose
from tokenizers import Tokenizer

from specloom.llm import token_files
from specloom.llm.queries import QUERIES, vocabulary


def tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def expected(rows):
    """doc_id, start, n_tokens, ids_crc32 by direct encoding, in the order of the ids."""
    return in_order(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())))


def in_order(rows):
    made, start, out = tokenizer(), 0, []
    for doc_id, text in rows:
        ids = np.array([*made.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def written(docs, **settings):
    return token_files.write_token_files(docs, token_files.output_folder(docs), vocabulary(), **settings)


@pytest.mark.parametrize("seq_len", [7, 2048])
def test_files_give_back_what_direct_encoding_gives(spark, seq_len):
    docs = odd(spark)
    found = token_files.read_digests(written(docs, seq_len=seq_len)).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_pieces_are_encoded_as_in_the_whole_text():
    texts = ["a  x  y\n b\t c　d  \n\n e", "'s it's", " ", "    x \u0085 z \x00 q", "a    x   y", "\r\n ok!  ...? 12 34"]
    encoder, made = token_files.Encoder(vocabulary(), cache_pieces=5), tokenizer()
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, counts = encoder.encode(data, np.cumsum([0, *map(len, raw)]))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [made.encode(t, add_special_tokens=False).ids for t in texts]


def test_sequences_have_equal_length_and_masks_only_at_the_end(spark):
    docs = spark.createDataFrame([(i, prose(i, 50)) for i in range(40)], "doc_id long, text string").coalesce(1)
    index = written(docs, seq_len=16)
    for file in {r.file for r in index.collect()}:
        reader = token_files.Reader(file)
        kind = reader.file.schema.field("tokens").type
        assert pa.types.is_fixed_size_list(kind) and kind.list_size == 16
        rows = sum(reader.file.get_batch(i).num_rows for i in range(reader.file.num_record_batches))
        masks = np.concatenate([reader.sequence(i)[1] for i in range(rows)])
        total = sum(r.n_tokens for r in index.filter(index.file == file).collect())
        assert masks.sum() == total and not masks[total:].any() and len(masks) - total < 16


def test_no_documents_no_rows(spark):
    assert token_files.read_digests(written(empty(spark))).collect() == []


def test_query_against_direct_encoding(spark, tmp_path):
    docs = spark.createDataFrame([(i, prose(i, 30 + i)) for i in range(60, 0, -1)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op1_token_files"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == sorted(expected([(r.doc_id, r.text) for r in docs.collect()]))
