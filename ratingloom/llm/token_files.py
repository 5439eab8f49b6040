"""Token ids in seekable zstandard files.

Every document is one independent zstandard frame of little-endian ids, so a reader decompresses only the documents
asked for. A file ends in a skippable frame with the document ids and the ids' width, and in the seek table of the
public zstandard seekable format: compressed size, decompressed size and checksum of every frame. Between two frames
stands an empty skippable frame, which any zstandard decoder passes over and the seek table counts to the frame before.

Spark's text writer puts the files down, one per partition: each record is a frame, the empty frame is the line
separator. So the files go through Spark's commit protocol to any file system, and a lost executor leaves no half file.
"""

from __future__ import annotations

import io
import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm import textpack as tp
from ratingloom.llm.common import text_frame
from ratingloom.session import materialise

#: Fixed values of the zstandard formats.
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80  # of the seek table's descriptor
IDS = SKIPPABLE + 1  # our skippable frame with document ids
EMPTY = struct.pack("<II", SKIPPABLE, 0)

FILE_TEXT_BYTES = 48 << 20  # of text that one file holds the ids of
SLICE_BYTES = 1 << 20
REMEMBERED = 2_000_000  # pieces of text whose ids a worker process keeps from task to task, about 30 bytes each
ENCODED_AT_ONCE = 2_000
LEVEL = 3

MARK = "\x01"  # stands between pieces that are encoded together
WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")  # one word to the tokenizer

#: Bytes by what a cut next to them needs: letters and digits 1, punctuation 2, the apostrophe, which may begin a token with letters, 3.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 2
_KINDS[0x27] = 3
_KINDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_CUTS = np.zeros(16, bool)
_CUTS[[1 * 4 + 2, 1 * 4 + 3, 2 * 4 + 1]] = True
#: `<`, and first bytes of other characters than U+00C0 to U+00FF and U+0140 to U+017F.
_FOREIGN = np.zeros(256, bool)
_FOREIGN[[0x3C, *range(0xC0, 0x100)]] = True
_FOREIGN[[0xC3, 0xC5]] = False
_ENTRY = np.dtype([("compressed", "<u4"), ("raw", "<u4"), ("checksum", "<u4")])
_DOC = np.dtype([("doc_id", "<i8"), ("known", "u1")])


def _checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def pieces(w: tp.Words) -> tp.Words:
    """The words as pieces to encode.

    Two steps make more of them equal, in words of ASCII bytes without `<`, where special tokens begin, and letters of
    Latin-1 and U+0140 to U+017F, whose small forms are letters without marks. Letters up to U+00DE are lower-cased,
    as the tokenizer does anyway. Punctuation is cut from the letters and digits before and behind it, where the
    tokenizer cuts too; but not behind an apostrophe, which may take letters along.
    """
    data = w.data
    if not len(w.starts):
        return w
    latin = np.flatnonzero(data == 0xC3) + 1
    latin = latin[latin < len(data)]
    signs = latin[(data[latin] == 0x97) | (data[latin] == 0xB7)]
    foreign = np.concatenate([np.flatnonzero(_FOREIGN[data]), signs])
    word = np.searchsorted(w.starts, foreign, "right") - 1
    plain = np.ones(len(w.starts), bool)
    plain[word[(word >= 0) & (foreign < w.ends[word])]] = False
    lowered = tp.LOWER[data]
    lowered[latin[(data[latin] >= 0x80) & (data[latin] < 0x9F)]] += 0x20
    other = np.flatnonzero(~plain)
    at = _ranges(w.starts[other], w.ends[other] - w.starts[other])
    lowered[at] = data[at]
    kinds = _KINDS[data]
    inner = np.flatnonzero(_CUTS[kinds[:-1] * 4 + kinds[1:]]) + 1
    word = np.searchsorted(w.starts, inner, "right") - 1
    inner = inner[(word >= 0) & plain[word] & (inner > w.starts[word]) & (inner < w.ends[word])]
    edge = np.zeros((2, len(data) + 1), bool)
    edge[0, w.starts], edge[1, w.ends], edge[:, inner] = True, True, True
    before = np.append(np.searchsorted(inner, w.starts), len(inner))
    return tp.Words(lowered, np.flatnonzero(edge[0]), np.flatnonzero(edge[1]), w.bounds + before[w.bounds])


class _Known:
    """Ids of pieces by the hash of the piece: hashes in order, and the place and number of each piece's ids."""

    def __init__(self, tokenizer, kind: str):
        self.tokenizer, self.kind = tokenizer, np.dtype(kind)
        self.hashes, self.first, self.n, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.kind)
        mark = tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.ends = None  # which ids end a word
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            vocabulary = tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def ids_of(self, p: tp.Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and n + 1 bounds by piece."""
        hashes = tp.word_hashes(p)
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        new = self.hashes[place] != distinct if len(self.hashes) else np.ones(len(distinct), bool)
        found, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        at = at[new]
        for lo in range(0, len(at), ENCODED_AT_ONCE):
            some = at[lo : lo + ENCODED_AT_ONCE]
            ids, n = self._encoded(tp.strings(p.data, p.starts[some], p.ends[some]).to_pylist())
            found.append(ids)
            sizes.append(n)
        fresh, n = np.concatenate(found), np.concatenate(sizes)
        if fresh.max(initial=0) > np.iinfo(self.kind).max:
            raise ValueError("ids need a width of 4 bytes")
        where = np.searchsorted(self.hashes, distinct[new])
        all_hashes = np.insert(self.hashes, where, distinct[new])
        first = np.insert(self.first, where, len(self.ids) + np.cumsum(n) - n)
        total = np.insert(self.n, where, n)
        ids = np.concatenate([self.ids, fresh.astype(self.kind)])
        if len(all_hashes) <= REMEMBERED:
            self.hashes, self.first, self.n, self.ids = all_hashes, first, total, ids
        at = np.searchsorted(all_hashes, distinct)[back]
        n = total[at]
        bounds = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        return ids[np.arange(bounds[-1]) + np.repeat(first[at] - bounds[:-1], n)], bounds

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and their number by text.

        Texts of letters are encoded as one, told apart by the ids that end a word, where the tokenizer has such; then
        the others, told apart by the mark behind each. If there are not as many ends as texts, they are encoded one by one.
        """
        word = np.array([WORD.fullmatch(t) is not None for t in texts], bool)
        if self.ends is None or word.all() or not word.any():
            return self._split(texts, bool(word.all()))
        parts = [self._split([t for t, x in zip(texts, word, strict=True) if x == kind], kind) for kind in (True, False)]
        n, first = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        n[word], n[~word] = parts[0][1], parts[1][1]
        first[word] = np.cumsum(parts[0][1]) - parts[0][1]
        first[~word] = np.cumsum(parts[1][1]) - parts[1][1] + len(parts[0][0])
        return np.concatenate([parts[0][0], parts[1][0]])[_ranges(first, n)], n

    def _split(self, texts: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        if words and self.ends is not None:
            ids = self._ids(" ".join(texts))
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == len(texts) and ends[-1] == len(ids) - 1:
                return ids, np.diff(ends, prepend=-1)
        if self.mark is not None:
            joined = f" {MARK} ".join([*texts, ""])
            if joined.count(MARK) == len(texts):
                ids = self._ids(joined)
                ends = np.flatnonzero(ids == self.mark)
                if len(ends) == len(texts):
                    return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter((i for ids in encoded for i in ids), np.uint32), np.array([len(ids) for ids in encoded], np.int64)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)


_memories: dict[tuple[str, int], _Known] = {}


def _memory(tokenizer_file: str, width: int) -> _Known:
    """What this worker process knows of the tokenizer; Spark gives a process one task after another."""
    if (tokenizer_file, width) not in _memories:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _memories.clear()  # one at a time, so that memory stays bounded
        _memories[tokenizer_file, width] = _Known(Tokenizer.from_file(tokenizer_file), f"<u{width}")
    return _memories[tokenizer_file, width]


def encode(docs: DataFrame, tokenizer_file: str, end_id: int, width: int = 2) -> DataFrame:
    """doc_id and the frame of its ids, ``end_id`` last.

    Text is cut at ASCII white space and each distinct piece is encoded once in a worker process, told by a 64-bit
    hash, as long as the process can keep its ids. This is exact for tokenizers that lower-case, drop white space, split
    letters from punctuation, never join what stands on two sides of a cut and leave out no character.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _memory(tokenizer_file, width)
        compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True).compress
        end = np.array([end_id], known.kind).tobytes()
        for batch in batches:
            for lo, hi, data, offsets in tp.slices(batch.column(1), SLICE_BYTES):
                p = pieces(tp.words(data, offsets, tp.SPACES))
                ids, bounds = known.ids_of(p)
                cuts = bounds[p.bounds]
                raws = [ids[a:b].tobytes() + end for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([compress(x) for x in raws], pa.binary()), pa.array(list(map(len, raws)), pa.int64()), pa.array(list(map(_checksum, raws)), pa.int64())],
                    schema=tp.arrow_schema(FRAMES),
                )

    return text_frame(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, FRAMES)


FRAMES = "doc_id long, frame binary, raw long, checksum long"


def _trailer(ids: list, sizes: list[int], raws: list[int], checksums: list[int], width: int) -> bytes:
    docs = np.zeros(len(ids), _DOC)
    docs["doc_id"], docs["known"] = [x or 0 for x in ids], [x is not None for x in ids]
    body = struct.pack("<B", width) + docs.tobytes()
    entries = np.zeros(len(ids) + 1, _ENTRY)
    entries["compressed"][:-1], entries["raw"][:-1], entries["checksum"][:-1] = sizes, raws, checksums
    entries["compressed"][-1] = len(body) + 8  # the id frame is an entry without content
    table = entries.tobytes() + struct.pack("<IBI", len(entries), CHECKSUMS, SEEKABLE)
    return struct.pack("<II", IDS, len(body)) + body + struct.pack("<II", SEEK_TABLE, len(table)) + table


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, width: int = 2, file_text_bytes: int = FILE_TEXT_BYTES) -> None:
    """Write the ids of every whole text (null: empty) in ascending doc_id order, null ids first, rows of one id in any order.

    Files follow each other by name and hold ranges of ids; their number follows the bytes of text. Texts are encoded
    once into a table of compressed frames, from whose ids Spark samples the ranges; the frames are shuffled once,
    straight to the file of their id. An empty table gives files without documents; other columns are ignored.
    """
    bytes_of_text = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    files = max(1, -(-bytes_of_text // file_text_bytes))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = tp.arrow_schema("value binary")
        ids: list = []
        sizes: list[int] = []
        raws: list[int] = []
        checksums: list[int] = []
        for batch in batches:
            frames = batch.column(1).to_pylist()
            ids += batch.column(0).to_pylist()
            sizes += [len(f) + len(EMPTY) for f in frames]
            raws += batch.column(2).to_pylist()
            checksums += batch.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], schema=schema)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([_trailer(ids, sizes, raws, checksums, width)], pa.binary())], schema=schema)

    frames = materialise(encode(docs, tokenizer_file, end_id, width), "frames")
    ordered = frames.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    records = ordered.mapInArrow(assemble, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", EMPTY.decode("latin-1")).text(path)


class Reader:
    """Random access to one file: the seek table is read first, then only the frames asked for."""

    def __init__(self, file: BinaryIO):
        self.file = file
        size = file.seek(0, io.SEEK_END)
        if size == 0:
            self.docs, self.entries, self.at, self.width = np.zeros(0, _DOC), np.zeros(0, _ENTRY), np.zeros(1, np.int64), 2
            return
        end = size - len(EMPTY)  # the separator behind the last record
        n, _, magic = struct.unpack("<IBI", self._bytes(end - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        table = end - 9 - n * _ENTRY.itemsize
        entries = np.frombuffer(self._bytes(table, n * _ENTRY.itemsize), _ENTRY)
        body = int(entries["compressed"][-1]) - 8
        raw = self._bytes(table - 8 - body, body)
        self.width, self.docs = raw[0], np.frombuffer(raw[1:], _DOC)
        self.entries = entries[:-1]
        self.at = np.concatenate([[0], np.cumsum(self.entries["compressed"], dtype=np.int64)])
        self._decompress = zstandard.ZstdDecompressor().decompress

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.docs)

    def doc_ids(self) -> list[int | None]:
        return [int(d) if k else None for d, k in self.docs.tolist()]

    def ids(self, i: int) -> np.ndarray:
        """Token ids of the i-th document of the file; raises if they don't match their checksum."""
        raw = self._decompress(self._bytes(int(self.at[i]), int(self.entries["compressed"][i]) - len(EMPTY)))
        if len(raw) != self.entries["raw"][i] or _checksum(raw) != self.entries["checksum"][i]:
            raise ValueError(f"frame {i} is damaged")
        return np.frombuffer(raw, f"<u{self.width}")


def read(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """One row per document of the files below ``path``: file, place in it, doc_id, ids.

    ``only`` names documents; no other frame is decompressed. A folder without documents gives no rows.
    """
    schema = "file string, place long, doc_id long, ids array<long>"
    wanted = None if only is None else set(only)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, i, doc, reader in _documents(batches, wanted):
            ids = reader.ids(i)
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([i], pa.int64()), pa.array([doc], pa.int64()), tp.lists_of(ids, np.array([0, len(ids)]))], schema=tp.arrow_schema(schema))

    return _files(spark, path).mapInArrow(decode, schema)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _documents(batches: Iterator[pa.RecordBatch], wanted: set | None = None):
    for batch in batches:
        for k in range(batch.num_rows):
            reader = Reader(pa.BufferReader(batch.column(1)[k].as_buffer()))
            for i, doc in enumerate(reader.doc_ids()):
                if wanted is None or doc in wanted:
                    yield batch.column(0)[k].as_py(), i, doc, reader


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document, from the files alone."""
    schema = "file string, place long, doc_id long, before long, n_tokens long, ids_crc32 long"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last, before = None, 0
        for file, i, doc, reader in _documents(batches):
            ids = reader.ids(i)
            before = 0 if file != last else before
            last = file
            rows.append((file, i, doc, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            before += len(ids)
            if len(rows) >= 10_000:
                yield _batch(rows, schema)
                rows = []
        if rows:
            yield _batch(rows, schema)

    rows = materialise(_files(spark, path).mapInArrow(sums, schema).withColumn("file", F.element_at(F.split("file", "/"), -1)), "sums")  # one pass over the files
    ends = rows.groupBy("file").agg(F.max(F.col("before") + F.col("n_tokens")).alias("total"))
    # one row per file
    starts = ends.select("file", F.coalesce(F.sum("total").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return rows.join(starts, "file").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = tp.arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)
