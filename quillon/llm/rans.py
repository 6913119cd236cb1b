"""Token-id files: a static range asymmetric numeral system with interleaved lanes.

One frequency table, counted over all ids of the corpus, is shared by all blocks. A block holds whole
documents, BLOCK ids or a little more (one longer document is a block of its own), and is a frame of
bytes that needs nothing but the table:

    magic, bits of the table, lanes, ids, words, CRC-32 of the ids (little-endian unsigned 32-bit)
    the lanes' final states (64 bits each), the words (32 bits each)
    CRC-32 of all before it

Id i of a block belongs to lane i mod lanes. Files are Parquet, so that Spark commits them to any store
whole or not at all; each row is a frame with its checkpoint: file, block, number of the block's first id
in its file, ids, and the documents in it with their lengths. Any frame can be decoded alone, and the
checkpoints can be read without the frames. Files are in ascending order of doc_id.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm import _text as T
from quillon.llm._ship import ship
from quillon.llm._store import Store, sized

#: Ids of a block, about; lanes of a block at most, and ids that a lane has at least.
BLOCK, LANES, LANE_IDS = 1 << 16, 1024, 64
#: Id that ends a document.
END = 0
#: A frequency table has so many bits more than it takes to number its ids.
SPARE_BITS = 4
#: Bytes and rows of text tokenized in one step; pieces of text, and ids of theirs, that a Python worker remembers before it starts over; bytes of the longest piece that it finds again; pieces given to the library at a time.
STEP, STEP_ROWS, PIECES, PIECE_IDS, LONGEST, AT_ONCE = 4 << 20, 8192, 1_500_000, 8_000_000, 256, 10_000

_HEAD = struct.Struct("<4sIIQQI")
_MAGIC = b"QRA1"
_LOW = np.uint64(1 << 31)
#: Bytes in another order, for a second hash of a piece.
_OTHERWISE = np.random.default_rng(1).permutation(256).astype(np.uint8)
_WORD = np.uint64(0xFFFFFFFF)

#: Kinds of bytes: letters, figures and marks of ASCII, the apostrophe, the blank, other white space, leads of two-byte characters none of which is white space, others.
_LETTER, _DIGIT, _MARK, _QUOTE, _BLANK, _BREAK, _LEAD, _OTHER = range(8)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127], _KIND[48:58], _KIND[65:91], _KIND[97:123] = _MARK, _DIGIT, _LETTER, _LETTER
_KIND[39], _KIND[32], _KIND[9:14], _KIND[0xC3:0xE0] = _QUOTE, _BLANK, _BREAK, _LEAD
#: Whether tokenization begins anew between two neighbouring bytes of these kinds.
_ANEW = np.zeros((8, 8), bool)
_ANEW[_LETTER, [_DIGIT, _MARK, _QUOTE, _BLANK, _BREAK]] = True
_ANEW[_DIGIT, [_LETTER, _MARK, _QUOTE, _BLANK, _BREAK]] = True
_ANEW[_MARK, [_LETTER, _DIGIT, _BLANK, _BREAK]] = True
_ANEW[_QUOTE, [_BLANK, _BREAK]] = True


def _cuts(buf: np.ndarray) -> np.ndarray:
    """Where (before which bytes) a text may be cut without changing its ids; one place more than bytes."""
    kind = _KIND[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[1:-1] = _ANEW[kind[:-1], kind[1:]]
    # after a lone line break or tab: in a longer run of white space the last one belongs to no other
    cut[2:-1] |= (kind[:-2] <= _QUOTE) & (kind[1:-1] == _BREAK) & ((kind[2:] <= _QUOTE) | (kind[2:] == _LEAD))
    # white space after a two-byte character
    cut[2:-1] |= (kind[:-2] == _LEAD) & ((kind[2:] == _BLANK) | (kind[2:] == _BREAK))
    return cut


class Table:
    """Frequencies of the ids, scaled to a power of two in which every counted id has a place."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, bits: int):
        self.bits, self.ids = bits, ids.astype(np.uint32)
        self.freq = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint64)
        self.freq[ids] = freq
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))

    @staticmethod
    def scaled(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids, frequencies and bits: floors of shares, one at least, and what is left to the most frequent id."""
        ids = sorted(counts)
        bits = max(12, len(ids).bit_length() + SPARE_BITS)
        total, free = sum(counts.values()), (1 << bits) - len(ids)
        freq = [1 + counts[i] * free // total for i in ids]
        if ids:
            freq[max(range(len(ids)), key=lambda k: freq[k])] += (1 << bits) - sum(freq)
        return np.array(ids, np.int64), np.array(freq, np.int64), bits

    def encode(self, ids: np.ndarray) -> bytes:
        """A frame of ids (unsigned 32-bit)."""
        n = len(ids)
        lanes = 1 << max(0, min(LANES, n // LANE_IDS).bit_length() - 1)
        freq, start = self.freq[ids], self.start[ids]
        if not freq.all():
            raise ValueError("ids that the table doesn't have")
        limit = freq << np.uint64(63 - self.bits)
        state = np.full(lanes, _LOW)
        shift, bits, words = np.uint64(32), np.uint64(self.bits), []
        for at in range((n - 1) // lanes * lanes if n else -1, -1, -lanes):
            to = min(n, at + lanes)
            f, x = freq[at:to], state[: to - at]
            full = x >= limit[at:to]
            words.append((x[full] & _WORD).astype(np.uint32))
            x = np.where(full, x >> shift, x)
            q, r = np.divmod(x, f)
            state[: to - at] = (q << bits) + r + start[at:to]
        words = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        raw = _HEAD.pack(_MAGIC, self.bits, lanes, n, len(words), zlib.crc32(ids.astype("<u4").tobytes())) + state.astype("<u8").tobytes() + words.astype("<u4").tobytes()
        return raw + struct.pack("<I", zlib.crc32(raw))

    def decode(self, frame: bytes) -> np.ndarray:
        """The ids of a frame; both checksums must hold."""
        magic, width, lanes, n, many, crc = _HEAD.unpack_from(frame)
        if magic != _MAGIC or width != self.bits or len(frame) != _HEAD.size + 8 * lanes + 4 * many + 4 or struct.unpack("<I", frame[-4:])[0] != zlib.crc32(memoryview(frame)[:-4]):
            raise ValueError("a damaged frame, or one of another table")
        state = np.frombuffer(frame, "<u8", lanes, _HEAD.size).astype(np.uint64)
        words = np.frombuffer(frame, "<u4", many, _HEAD.size + 8 * lanes).astype(np.uint64)
        out = np.empty(n, np.uint32)
        mask, shift, bits, used = np.uint64((1 << self.bits) - 1), np.uint64(32), np.uint64(self.bits), 0
        for at in range(0, n, lanes):
            to = min(n, at + lanes)
            x = state[: to - at]
            slot = x & mask
            s = self.slots[slot]
            out[at:to] = s
            x = self.freq[s] * (x >> bits) + slot - self.start[s]
            low = np.flatnonzero(x < _LOW)
            x[low] = (x[low] << shift) | words[used : used + len(low)]
            used += len(low)
            state[: to - at] = x
        if used != many or zlib.crc32(out.astype("<u4").tobytes()) != crc:
            raise ValueError("a frame whose ids don't have their checksum")
        return out


class Encoder:
    """The tokenizers library on pieces of text, each distinct piece once for as long as it is remembered.

    A byte-level tokenizer's pattern takes runs of letters, of figures, of marks (each with one blank before it), of
    white space and a few endings after an apostrophe. So it begins anew between runs of ASCII letters, figures and marks,
    but for what follows an apostrophe, at white space after anything else, and after a lone line break or tab. Texts are
    cut there, and not inside the strings of special tokens; the ids of a text are those of its pieces, one after the other.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding(), self.library.no_truncation()
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        split = self.library.pre_tokenizer
        if self.library.normalizer is not None or type(split).__name__ != "ByteLevel" or split.add_prefix_space or not split.use_regex:
            raise ValueError(f"{path}: not a plain byte-level tokenizer")
        self.clear()

    def clear(self) -> None:
        """Remembered are sorted keys with a second hash and a number each; ids and first have the ids by number."""
        self.keys, self.check, self.number = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.first, self.many = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), 0

    def _add(self, pieces: list[bytes]) -> np.ndarray:
        """The numbers of pieces that aren't known yet."""
        found = [e.ids for at in range(0, len(pieces), AT_ONCE) for e in self.library.encode_batch_fast([p.decode() for p in pieces[at : at + AT_ONCE]], add_special_tokens=False)]
        at, n = self.many, self.first[self.many]
        self.many += len(found)
        if len(self.first) <= self.many:
            self.first = np.concatenate([self.first, np.zeros(self.many + 1, np.int64)])
        ends = n + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        self.first[at + 1 : self.many + 1] = ends
        if len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros(int(ends[-1]), np.uint32)])
        self.ids[n : ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(ends[-1] - n))
        return np.arange(at, self.many)

    def _numbers(self, pieces: pa.LargeBinaryArray) -> np.ndarray:
        """The number of each of some distinct pieces; those of up to LONGEST bytes are remembered by two hashes of 64 bits."""
        _, offsets, data = pieces.buffers()
        offsets = np.frombuffer(offsets, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        raw = np.frombuffer(data, np.uint8)
        key, check = (T.word_hashes(x, offsets[:-1], offsets[1:]) for x in (raw, _OTHERWISE[raw]))
        short = np.diff(offsets) <= LONGEST
        at = np.searchsorted(self.keys, key)
        near = np.minimum(at, max(len(self.keys) - 1, 0))
        same = self.keys[near] == key if len(self.keys) else np.zeros(len(key), bool)
        known = same & short & (self.check[near] == check if len(self.keys) else False)
        number = np.where(known, self.number[near] if len(self.keys) else 0, -1)
        new = np.flatnonzero(~known)
        if len(new):
            number[new] = self._add(pieces.take(pa.array(new)).to_pylist())
            _, once = np.unique(key[new], return_index=True)
            kept = new[once][(short & ~same)[new[once]]]
            self.keys, self.check, self.number = (np.insert(x, at[kept], y[kept]) for x, y in ((self.keys, key), (self.check, check), (self.number, number)))
        return number

    def pieces(self, buf: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece among the known ones, and each row's first piece."""
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
        cut = _cuts(buf)
        for special in self.special:
            if special in (raw := buf.tobytes()):
                for m in re.finditer(re.escape(special), raw):
                    cut[m.start() + 1 : m.end()] = False
        cut[rows] = True
        starts = np.flatnonzero(cut[:-1])
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(buf))), pa.py_buffer(buf)]).dictionary_encode()
        if self.many + len(found.dictionary) > PIECES or self.first[self.many] > PIECE_IDS:
            self.clear()
        return self._numbers(found.dictionary)[found.indices.to_numpy()], np.searchsorted(starts, rows)

    def encode(self, buf: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows of a step, END after each, and each row's first."""
        number, row = self.pieces(buf, rows)
        first = self.first[number]
        size = self.first[number + 1] - first
        place = np.concatenate([[0], np.cumsum(size)])
        bounds = place[row] + np.arange(len(row))
        out = np.full(bounds[-1], END, np.uint32)
        inside = np.ones(len(out), bool)
        inside[bounds[1:] - 1] = False
        out[inside] = self.ids[np.repeat(first - place[:-1], size) + np.arange(place[-1])]
        return out, bounds


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a Python worker, which keeps what it remembers from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """Blocks (file, block, first, n_ids, doc_ids, lengths, ids binary) of docs(doc_id, text) in the order of their rows; a task's blocks are a file.

    ids are little-endian unsigned integers of _width(path) bytes.
    """
    kind = np.dtype(f"<u{_width(path)}")
    schema = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, file = encoder(path), TaskContext.get().partitionId()
        first, block, size = 0, 0, 0
        names: list[int | None] = []
        parts: list[np.ndarray] = []

        def done() -> pa.RecordBatch:
            row = [file, block, first, size, names, [len(x) for x in parts], np.concatenate(parts).astype(kind).tobytes()]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema)

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for a, _, buf, offsets in T.steps(batch.column("text"), STEP, STEP_ROWS):
                ids, bounds = e.encode(buf, offsets)
                for k in range(len(bounds) - 1):
                    names.append(doc_ids[a + k])
                    parts.append(ids[bounds[k] : bounds[k + 1]])
                    size += len(parts[-1])
                    if size >= BLOCK:
                        yield done()
                        first, block, size, names, parts = first + size, block + 1, 0, [], []
        if parts:
            yield done()

    return docs.select("doc_id", "text").mapInArrow(run, _CHECKPOINT + ", ids binary")


def _width(path: str) -> int:
    return 2 if Encoder(path).library.get_vocab_size() <= 1 << 16 else 4


def count_ids(blocks: DataFrame, width: int) -> DataFrame:
    """(id, n) over blocks of tokens()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1, np.int64)
        for batch in batches:
            for raw in batch.column("ids"):
                found = np.bincount(np.frombuffer(raw.as_py(), f"<u{width}"), minlength=len(counts))
                found[: len(counts)] += counts
                counts = found
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], names=["id", "n"])

    return blocks.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


_CHECKPOINT = "file int, block int, first long, n_ids long, doc_ids array<long>, lengths array<long>"


def write_files(spark: SparkSession, docs: DataFrame, path: str, folder: str) -> None:
    """Writes the ids of docs(doc_id, text, ...) under a new folder: `table` and `blocks`, in ascending order of doc_id.

    A null doc_id comes first; rows that repeat a doc_id go by a hash of their text, equal rows in any order. A null
    text counts as empty: END alone. An empty table gives an empty table and no blocks. Strings of special
    tokens in a text give their ids. Other columns are ignored, so their names can't clash. Texts are
    tokenized once, into blocks that stand until the files are written. What comes to the driver is bounded
    by the vocabulary.
    """
    ship(spark)
    store, width = Store(spark, "ids"), _width(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows that repeat a doc_id, or are wholly equal, may be many: the further keys let a range end among them.
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("seq"))
    files = max(2 * spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    rows = rows.repartitionByRange(files, "doc_id", "hash", "seq").sortWithinPartitions("doc_id", "hash", "seq")
    blocks = store.keep(tokens(rows, path), "ids", codec="zstd")

    counts = {r["id"]: r["n"] for r in count_ids(blocks, width).collect()}
    ids, freq, bits = Table.scaled(counts)
    spark.createDataFrame(pa.table({"id": ids, "freq": freq, "bits": np.full(len(ids), bits)}), "id long, freq long, bits long").coalesce(1).write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast((ids, freq, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)
        for batch in batches:
            for k, raw in enumerate(batch.column("ids")):
                frame = table.encode(np.frombuffer(raw.as_py(), f"<u{width}").astype(np.uint32))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(k, 1) for c in batch.schema.names[:-1]), pa.array([frame], pa.binary())], names=[*batch.schema.names[:-1], "frame"])

    blocks.mapInArrow(run, _CHECKPOINT + ", frame binary").write.parquet(f"{folder}/blocks")
    store.drop(blocks)


def _tables(spark: SparkSession, folder: str):
    rows = spark.read.parquet(f"{folder}/table").orderBy("id").collect()
    return np.array([r["id"] for r in rows], np.int64), np.array([r["freq"] for r in rows], np.int64), rows[0]["bits"] if rows else 12


def _places(blocks: DataFrame) -> DataFrame:
    """(file, before): ids of all files before each; the window runs over one row a file."""
    sums = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    return sized(sums.select("file", (F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before")))


def read_documents(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents in a folder of write_files; digests: ids_crc32 in place of ids.

    start: ids of all documents before it; ids and n_tokens have the END. A damaged frame stops the reading.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast(_tables(spark, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)
        for batch in batches:
            for file, first, docs_in, lengths, frame in zip(*(batch.column(c) for c in ("file", "first", "doc_ids", "lengths", "frame")), strict=True):
                ids = table.decode(frame.as_py())
                size = lengths.values.to_numpy()
                bounds = np.concatenate([[0], np.cumsum(size)])
                if bounds[-1] != len(ids):
                    raise ValueError("a checkpoint whose lengths don't fit its frame")
                if digests:
                    raw = memoryview(ids.astype("<u4").tobytes())
                    last = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(size), file.as_py()), pa.int32()), docs_in.values, pa.array(first.as_py() + bounds[:-1]), pa.array(size), last], names=["file", "doc_id", "at", "n_tokens", "last"])

    blocks = spark.read.parquet(f"{folder}/blocks")
    found = blocks.select("file", "first", "doc_ids", "lengths", "frame").mapInArrow(run, f"file int, doc_id long, at long, n_tokens long, last {'long' if digests else 'array<int>'}")
    return found.join(_places(blocks), "file").select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", F.col("last").alias("ids_crc32" if digests else "ids"))


def round_trip(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Writes docs in the shared folder and gives the digests of what is read back; cases as in write_files."""
    folder = Store(spark, "rans").root
    write_files(spark, docs, path, folder)
    return read_documents(spark, folder, digests=True)
