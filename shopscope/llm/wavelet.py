"""Token ids in wavelet-matrix shard files.

Documents are range-partitioned by id, encoded, and written in that order: one
compressed file after another, each with whole documents of about
``FILE_TOKENS`` ids. A file holds a document table and one bit-plane per bit of
an id. At every plane the sequence is parted stably by that plane's bit, so
rank counts on the planes lead from a position down to its id (access), from
an id to its number of occurrences (count, rank) and back up to the place of
an occurrence (select). Files are written under a name of their own attempt
and renamed, so a task that runs again leaves the same file.

File layout: magic, counts, then sections (document ids, their lengths, zeros
per plane, planes) each compressed. A null doc_id is stored by a flag; a null
text is an empty one and holds only the end id. Documents with equal ids are
ordered by a hash of their token ids. An empty table gives no files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopscope.llm.common import BATCH_BYTES, released, saved, shared_uri, text_slices
from shopscope.llm.encode import WORD_BPE, encoder

FILE_TOKENS = 4_000_000
MAGIC = b"WVMX1\0\0\0"
_HEAD = struct.Struct("<8sQQQ")
_BLOCK = 512  # bits per entry of the rank directory


class Plane:
    """A bit vector with rank and select."""

    def __init__(self, packed: np.ndarray, n: int) -> None:
        self.packed, self.n = packed, n
        per_block = np.bitwise_count(np.pad(packed, (0, -len(packed) % (_BLOCK // 8)))).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.int64)
        self.directory = np.concatenate([[0], np.cumsum(per_block)])

    def bit(self, i: int) -> int:
        return int(self.packed[i >> 3] >> (i & 7)) & 1

    def rank1(self, i: int) -> int:
        """Ones before position i."""
        block = i // _BLOCK
        full = self.packed[block * _BLOCK // 8:i >> 3]
        rest = int(self.packed[i >> 3]) & ((1 << (i & 7)) - 1) if i & 7 else 0
        return int(self.directory[block]) + int(np.bitwise_count(full).sum()) + rest.bit_count()

    def select(self, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit."""
        before = self.directory if bit else np.arange(len(self.directory)) * _BLOCK - self.directory
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.packed[block * _BLOCK // 8:(block + 1) * _BLOCK // 8], bitorder="little")
        return block * _BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])


    def ranks(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block = at // _BLOCK
        width = _BLOCK // 8
        padded = np.append(self.packed, np.zeros(width + 1, np.uint8))
        byte = at >> 3
        out = self.directory[block].copy()
        for k in range(0, len(at), 4096):  # a block's bytes for each position, in parts
            part = slice(k, k + 4096)
            places = (block[part] * width)[:, None] + np.arange(width)
            ones = np.bitwise_count(padded[np.minimum(places, len(padded) - 1)])
            out[part] += (ones * (places < byte[part][:, None])).sum(axis=1, dtype=np.int64)
        return out + np.bitwise_count(padded[byte] & ((1 << (at & 7)) - 1).astype(np.uint8))

    def selects(self, bit: int, ks: np.ndarray) -> np.ndarray:
        """Positions of the k-th such bits."""
        before = self.directory if bit else np.arange(len(self.directory)) * _BLOCK - self.directory
        block = np.searchsorted(before, ks, side="right") - 1
        width = _BLOCK // 8
        padded = np.append(self.packed, np.zeros(width, np.uint8))
        out = np.empty(len(ks), np.int64)
        for k in range(0, len(ks), 4096):
            part = slice(k, k + 4096)
            bits = np.unpackbits(padded[(block[part] * width)[:, None] + np.arange(width)], axis=1, bitorder="little") == bit
            rank = (ks[part] - before[block[part]]) + 1
            out[part] = block[part] * _BLOCK + (np.cumsum(bits, axis=1) >= rank[:, None]).argmax(axis=1)
        return out


class WaveletMatrix:
    """Planes from the highest bit down; see the module text."""

    def __init__(self, planes: list[Plane], zeros: list[int], n: int) -> None:
        self.planes, self.zeros, self.n = planes, zeros, n

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        planes, zeros = [], []
        for level in reversed(range(levels)):
            bits = (ids & ids.dtype.type(1 << level)) != 0
            planes.append(Plane(np.packbits(bits, bitorder="little"), len(ids)))
            zeros.append(len(ids) - int(np.count_nonzero(bits)))
            if level:
                # by places, as a mask costs far more on random bits
                ids = np.concatenate([ids.take(np.flatnonzero(~bits)), ids.take(np.flatnonzero(bits))])
        return cls(planes, zeros, len(ids))

    def all(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for shift, plane, zeros in zip(range(len(self.planes)), reversed(self.planes), reversed(self.zeros)):
            bits = np.unpackbits(plane.packed, count=self.n, bitorder="little").view(bool)
            up = np.empty_like(ids)
            up[np.flatnonzero(~bits)] = ids[:zeros]
            up[np.flatnonzero(bits)] = ids[zeros:] | kind(1 << shift)
            ids = up
        return ids.astype(np.uint32)

    def access(self, i: int) -> int:
        value = 0
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.bit(i), plane.rank1(i)
            value, i = 2 * value + bit, zeros + ones if bit else i - ones
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.rank1(start), plane.rank1(end)
            one = value >> (len(self.planes) - 1 - k) & 1
            start, end = (zeros + a, zeros + b) if one else (start - a, end - b)
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of an id between two positions."""
        if value >> len(self.planes):
            return 0
        a, b = self._range(value, start, self.n if end is None else end)
        return b - a

    def select(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of an id."""
        start, end = self._range(value, 0, self.n)
        if not 0 <= k < end - start:
            raise IndexError(f"{value} occurs {end - start} times")
        at = start + k
        for shift, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            at = plane.select(1, at - zeros) if value >> shift & 1 else plane.select(0, at)
        return at

    def counts_before(self, value: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of an id before each of the positions."""
        if value < 0 or value >> len(self.planes):
            return np.zeros(len(at), np.int64)
        start, end = 0, at
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.rank1(start), plane.ranks(end)
            one = value >> (len(self.planes) - 1 - k) & 1
            start, end = (zeros + a, zeros + b) if one else (start - a, end - b)
        return end - start

    def places(self, value: int) -> np.ndarray:
        """Positions of all occurrences of an id, in order."""
        if value < 0 or value >> len(self.planes):
            return np.zeros(0, np.int64)
        at = np.arange(*self._range(value, 0, self.n))
        for shift, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            at = plane.selects(1, at - zeros) if value >> shift & 1 else plane.selects(0, at)
        return at

    def locate(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]


def to_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, levels: int) -> bytes:
    matrix = WaveletMatrix.build(ids, levels)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    sections = [known.tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), lengths.astype("<u8").tobytes(),
                np.array(matrix.zeros, "<u8").tobytes(), *(p.packed.tobytes() for p in matrix.planes)]
    out = [_HEAD.pack(MAGIC, len(ids), len(doc_ids), levels)]
    codec = pa.Codec("zstd", compression_level=1)
    for raw in sections:
        small = codec.compress(raw, asbytes=True)
        out.append(struct.pack("<QQ", len(raw), len(small)) + small)
    return b"".join(out)


class WaveletFile:
    """One shard file: its documents and the matrix of all their ids."""

    def __init__(self, data: bytes) -> None:
        magic, n, docs, levels = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        at, sections, codec = _HEAD.size, [], pa.Codec("zstd")
        for _ in range(4 + levels):
            raw, small = struct.unpack_from("<QQ", data, at)
            sections.append(np.frombuffer(codec.decompress(data[at + 16:at + 16 + small], raw, asbytes=True), np.uint8))
            at += 16 + small
        self.doc_ids = [int(x) if known else None for known, x in zip(sections[0], sections[1].view("<i8"))]
        self.lengths = sections[2].view("<u8").astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.matrix = WaveletMatrix([Plane(s, n) for s in sections[4:]], sections[3].view("<u8").astype(int).tolist(), n)

    @staticmethod
    def open(uri: str) -> WaveletFile:
        where, path = fs.FileSystem.from_uri(uri)
        with where.open_input_stream(path) as f:
            return WaveletFile(f.read())


def encoded(docs: DataFrame, end_id: int = 2, tokenizer: str = WORD_BPE) -> DataFrame:
    """doc_id and ``ids``: each text's ids and the end id, as little-endian integers of the smallest width."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _width(tokenizer, end_id)
        for batch in batches:
            for part in text_slices(batch):
                flat, n = encoder(tokenizer).flat(part.column("text"))
                ids = np.insert(flat.astype(kind), np.cumsum(n), end_id)  # one end id after each document
                offsets = np.concatenate([[0], np.cumsum(n + 1)]) * ids.itemsize
                packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), packed], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def _width(tokenizer: str, end_id: int) -> str:
    return "<u2" if max(encoder(tokenizer).size - 1, end_id) < 1 << 16 else "<u4"


def write(docs: DataFrame, folder: str, end_id: int = 2, tokenizer: str = WORD_BPE, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encodes and writes all documents; one row for each file: file, n_docs, n_tokens.

    ``folder`` is one that all executors reach. File names sort in document order.
    Texts are encoded where they are read; the range shuffle moves their ids only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        where, path = fs.FileSystem.from_uri(folder)
        where.create_dir(path, recursive=True)
        kind = np.dtype(_width(tokenizer, end_id))
        levels = max(1, int(max(encoder(tokenizer).size - 1, end_id)).bit_length())
        ids, counts, doc_ids, made, held = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, counts, doc_ids, made, held
            name = f"part-{context.partitionId():06d}-{made:06d}.wm"
            lengths = np.concatenate(counts)
            data = to_bytes(doc_ids, lengths, np.concatenate(ids), levels)
            draft = f"{path}/.{name}.{context.taskAttemptId()}"
            with where.open_output_stream(draft) as f:
                f.write(data)
            where.move(draft, f"{path}/{name}")
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(doc_ids)]), pa.array([int(lengths.sum())])], ["file", "n_docs", "n_tokens"])
            ids, counts, doc_ids, made, held = [], [], [], made + 1, 0
            return row

        for batch in batches:
            for part in text_slices(batch, "ids", min(BATCH_BYTES, file_tokens * kind.itemsize)):
                packed = part.column("ids")
                offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1]
                flat = np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(kind)
                ids.append(flat.copy())
                counts.append(np.diff(offsets).astype(np.int64) // kind.itemsize)
                doc_ids.extend(part.column("doc_id").to_pylist())
                held += len(flat)
                if held >= file_tokens:
                    yield flush()
        if doc_ids:
            yield flush()
        released()

    rows = saved(encoded(docs, end_id, tokenizer), "encoded")  # the range shuffle reads its input twice
    # rows of one id, or of none, go by the bytes of their first ids; a hash spreads those that begin alike
    keys = [F.asc_nulls_first("doc_id"), "head", "tie"]
    ordered = rows.withColumns({"head": F.substring("ids", 1, 16), "tie": F.xxhash64("ids")}).repartitionByRange(
        *keys).sortWithinPartitions(*keys, "ids").select("doc_id", "ids")
    return ordered.mapInArrow(run, "file string, n_docs long, n_tokens long")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document from the files: file, doc_id, at (its place in the file), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                shard = WaveletFile(content.as_py())
                ids = shard.matrix.all().astype("<u4")
                crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(shard.starts, shard.lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.rpartition("/")[2]] * len(crc)), pa.array(shard.doc_ids, pa.int64()), pa.array(shard.starts),
                     pa.array(shard.lengths), pa.array(crc, pa.int64())], ["file", "doc_id", "at", "n_tokens", "ids_crc32"])

    return _files(spark, folder).mapInArrow(run, "file string, doc_id long, at long, n_tokens long, ids_crc32 long")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(folder).select("path", "content")


def counts(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """(id, n, n_docs): occurrences of stated ids over all shards, and the documents
    that hold them, by rank on the bit-planes; no shard is unpacked. An id that
    does not occur has zeros."""
    wanted = sorted({int(i) for i in ids})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                shard = WaveletFile(content.as_py())
                ends = np.concatenate([shard.starts, shard.starts[-1:] + shard.lengths[-1:]])
                found = [np.diff(shard.matrix.counts_before(value, ends)) for value in wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wanted, pa.int64()), pa.array([int(f.sum()) for f in found], pa.int64()),
                     pa.array([int((f > 0).sum()) for f in found], pa.int64())], ["id", "n", "n_docs"])

    every = spark.createDataFrame([(i, 0, 0) for i in wanted], "id long, n long, n_docs long")
    found = _files(spark, folder).mapInArrow(run, "id long, n long, n_docs long")
    return every.unionByName(found).groupBy("id").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def located(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """(id, doc_id, place, file): every occurrence of stated ids, its place in its
    document, by select on the bit-planes, all occurrences of a shard at once."""
    wanted = sorted({int(i) for i in ids})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                shard = WaveletFile(content.as_py())
                doc_ids = pa.array(shard.doc_ids, pa.int64())
                for value in wanted:
                    at = shard.matrix.places(value)
                    doc = np.searchsorted(shard.starts, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([value] * len(at), pa.int64()), doc_ids.take(pa.array(doc)), pa.array(at - shard.starts[doc]),
                         pa.array([path.rpartition("/")[2]] * len(at), pa.string())], ["id", "doc_id", "place", "file"])

    return _files(spark, folder).mapInArrow(run, "id long, doc_id long, place long, file string")


def written_and_read(docs: DataFrame, end_id: int = 2, tokenizer: str = WORD_BPE) -> DataFrame:
    """Writes the documents to shard files in the shared folder and returns
    doc_id, start, n_tokens and ids_crc32 as the files have them."""
    spark = docs.sparkSession
    folder = f"{shared_uri(spark)}/wavelet-{uuid.uuid4().hex}"
    manifest = saved(write(docs, folder, end_id, tokenizer), "manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    first = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    return read(spark, folder).join(first, "file").select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
