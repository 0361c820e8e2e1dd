"""Token ids as Arrow files of equal-length sequences with masks.

Documents are spread over tasks by ranges of doc_id.  Each task writes one file
in the Arrow IPC file format: batches of ``BATCH_ROWS`` rows with the columns
``tokens`` (fixed-size list of ``seq_len`` ids; 16 bits wide if the vocabulary
fits) and ``mask`` (fixed-size list of booleans, false only in the padding at
the end of the file).  Buffers are not compressed, so a reader maps a file and
gets any sequence, or any document's ids, without a copy.  An index table tells
each document's file and place.

A file is written under a name of its own by every attempt of a task, and only
the index of the attempt that succeeded is kept, so a lost executor does no harm.

Defined results: a null text is an empty one, which still gets its end id;
documents with a null doc_id come first; rows with equal ids are kept, ordered
by their text; no documents give no files and an empty index; the vocabulary's
special tokens count as ordinary text when they stand in a document; further
columns are not looked at.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm import ragged
from specloom.session import cut_lineage, ensure_checkpoint_dir

SEQ_LEN = 2048
END_ID = 0
#: Sequences in one batch of a file.
BATCH_ROWS = 64
#: Pieces of text whose ids a worker process remembers (the first ones it meets, so all frequent ones).
CACHE_PIECES = 400_000
#: Bytes of text encoded at a time.
SLICE_BYTES = 4 << 20

# The vocabulary's own pattern always splits a text (1) before a space, if a character follows that is not white
# space, (2) before a point or comma that ends an ASCII word, (3) before and (4) after a line break between two
# characters that are not white space.  Pieces between such places are encoded alike in any text.
_SOLID = np.zeros(256, bool)  # bytes that begin a character other than white space
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xF5] = True
_SOLID[[0xE1, 0xE2, 0xE3]] = False
_ASCII = np.zeros(256, bool)
_ASCII[0x21:0x7F] = True
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin; the last entry is the end."""
    opens = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        solid = _SOLID[data[1:]]
        opens[:-2] = (data[:-1] == 0x20) & solid
        point = ((data == 0x2E) | (data == 0x2C))[1:] & _WORD[data[:-1]]
        after = np.append((data[2:] == 0x20) | (data[2:] == 0x0A), True)
        opens[1:-1] |= point & after
        broken = np.append((data[1:-1] == 0x0A) & _ASCII[data[:-2]] & solid[1:], False)
        opens[1:-1] |= broken
        opens[2:] |= broken
    # a text's first and last bytes have no neighbour in another text
    opens[np.minimum(offsets[:-1] + 1, len(data))] &= np.diff(offsets) > 1
    opens[offsets] = True
    return np.flatnonzero(opens)


class Encoder:
    """Ids of whole texts; each distinct piece between spaces is encoded once."""

    def __init__(self, vocabulary: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.limit = cache_pieces
        self.cache: dict[bytes, bytes] = {}

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        found = []
        for i in range(0, len(pieces), 1000):
            part = pieces[i : i + 1000]
            encoded = self.tokenizer.encode(
                [x.decode("utf-8", "replace") for x in part], is_pretokenized=True, add_special_tokens=False
            )
            ids = np.array(encoded.ids, "<u4").tobytes()
            at = 4 * np.searchsorted(np.array(encoded.word_ids, np.int64), np.arange(len(part) + 1))
            found.extend(ids[a:b] for a, b in itertools.pairwise(at.tolist()))
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, one after the other, and the number for each text."""
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        cuts = piece_starts(data, offsets)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        distinct, codes = pieces.dictionary.to_pylist(), pieces.indices.to_numpy()
        known = list(map(self.cache.get, distinct))
        missing = [i for i, x in enumerate(known) if x is None]
        for i, ids in zip(missing, self._ids([distinct[i] for i in missing])):
            known[i] = ids
            if len(self.cache) < self.limit:
                self.cache[distinct[i]] = ids
        ids = np.frombuffer(b"".join(known), "<u4")
        sizes = np.array([len(x) for x in known], np.int64) // 4
        begin = np.cumsum(sizes) - sizes
        size = sizes[codes]
        out = ids[np.repeat(begin[codes], size) + ragged.runs(size)]
        total = np.concatenate([[0], np.cumsum(size)])
        return out, np.diff(total[np.searchsorted(cuts, offsets)])


_encoders: dict[int, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    """One encoder for all tasks of a worker process, which thus keeps what it knows."""
    key = zlib.crc32(vocabulary.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


class _Writer:
    """One file of sequences, written to wherever ``folder`` is."""

    def __init__(self, folder: str, kind: pa.DataType, seq_len: int):
        self.fs, base = filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{folder}/{uuid.uuid4().hex}.arrow"
        self.kind, self.seq_len = kind, seq_len
        self.schema = pa.schema([("tokens", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.stream = self.fs.open_output_stream(filesystem(self.path)[1])
        self.writer = pa.ipc.new_file(self.stream, self.schema)
        self.held: list[np.ndarray] = []
        self.n = 0

    def _put(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(x, t), self.seq_len)
            for x, t in ((ids, self.kind), (mask, pa.bool_()))
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind.to_pandas_dtype()))
        self.n += len(ids)
        full = self.seq_len * BATCH_ROWS
        if self.n >= full:
            ids = np.concatenate(self.held)
            for at in range(0, len(ids) - full + 1, full):
                self._put(ids[at : at + full], full)
            self.held = [ids[len(ids) // full * full :]]
            self.n = len(self.held[0])

    def close(self) -> None:
        if self.n:
            ids = np.concatenate(self.held)
            self._put(np.pad(ids, (0, -len(ids) % self.seq_len)), len(ids))
        self.writer.close()
        self.stream.close()


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, seq_len: int = SEQ_LEN, end_id: int = END_ID,
    order: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Write the ids of all texts in the ``order`` of columns, each followed by ``end_id``; returns the index.

    ``vocabulary`` is the content of a tokenizer file.  The index has doc_id, part
    (its order is that of the columns), at (the document's first id within the part),
    n_tokens, file.  It is a written table in the order of the files.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    shared = spark.sparkContext.broadcast(vocabulary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, at = None, None, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for row, data, offsets in ragged.text_slices(batch.column("text"), SLICE_BYTES):
                if writer is None:
                    encoder = _encoder(shared.value)
                    small = encoder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
                    writer = _Writer(folder, pa.uint16() if small else pa.uint32(), seq_len)
                ids, counts = encoder.encode(data, offsets)
                ends = np.cumsum(counts)
                writer.add(np.insert(ids, ends, end_id))
                counts = counts + 1
                begin = at + np.cumsum(counts) - counts
                at += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, len(counts)), pa.array([part] * len(counts), pa.int64()),
                        pa.array(begin, pa.int64()), pa.array(counts, pa.int64()),
                        pa.array([writer.path] * len(counts), pa.string()),
                    ],
                    ["doc_id", "part", "at", "n_tokens", "file"],
                )
        if writer is not None:
            writer.close()

    ordered = docs.select("doc_id", "text", *[c for c in order if c != "doc_id"]).repartitionByRange(*order).sortWithinPartitions(
        *order, "text"
    ).select("doc_id", "text")
    return cut_lineage(
        ragged.map_in_arrow(ordered, write, f"doc_id {kind}, part long, at long, n_tokens long, file string")
    )


class Reader:
    """Random access to one file; local files are mapped, not read."""

    def __init__(self, file: str):
        fs, path = filesystem(file)
        source = pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.seq_len = self.file.schema.field("tokens").type.list_size
        self.held: tuple[int, pa.RecordBatch] | None = None

    def _batch(self, i: int) -> pa.RecordBatch:
        if self.held is None or self.held[0] != i:
            self.held = (i, self.file.get_batch(i))
        return self.held[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence."""
        batch, row = self._batch(i // BATCH_ROWS), i % BATCH_ROWS
        return batch.column(0)[row].values.to_numpy(), batch.column(1)[row].values.to_numpy(zero_copy_only=False)

    def ids(self, at: int, n: int) -> Iterator[np.ndarray]:
        """The ids from place ``at`` on, in pieces that lie in one batch."""
        full = self.seq_len * BATCH_ROWS
        while n > 0:
            inner = at % full
            take = min(n, full - inner)
            yield self._batch(at // full).column(0).values.slice(inner, take).to_numpy()
            at, n = at + take, n - take


def read_digests(index: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the files."""
    kind = dict(index.dtypes)["doc_id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            sums = []
            for file, at, n in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "n_tokens"))):
                if file != opened:
                    reader, opened = Reader(file), file
                crc = 0
                for ids in reader.ids(at, n):
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                sums.append(crc)
            columns = [batch.column(c) for c in ("doc_id", "part", "at", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.int64())], ["doc_id", "part", "at", "n_tokens", "ids_crc32"]
            )

    read_back = ragged.map_in_arrow(index, read, f"doc_id {kind}, part long, at long, n_tokens long, ids_crc32 long")
    # one row per file
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    return read_back.join(before, "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def output_folder(docs: DataFrame) -> str:
    """A fresh folder on the storage that all executors share."""
    ensure_checkpoint_dir(docs.sparkSession)
    return f"{docs.sparkSession.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"
