"""Alignment of two tokenizers' tokens over the same bytes.

Each text, with a blank before it, is encoded by a byte-level BPE (A) and a
sentence-piece model (B); every token is a range of the bytes. The two lists of
token ends are intersected by galloping: each end of the shorter list starts at
its share of the longer one, doubles its steps until it has passed its value,
and halves the last step. Common ends cut the tokens into groups. Differences
of the ranks found say which tokens of the other side a token overlaps (links).

How many documents hold a pair of ids linked is counted over the corpus:

1. A task takes its documents in chunks of about ``CHUNK_BYTES``, and writes
   for each chunk its documents (their distinct pairs, how often each, packed)
   and the chunk's distinct pairs with the documents that hold each.
2. Chunk counts are added by pair, and the best count of every A id is found.
   A pair that is everywhere has one row for each chunk, however many documents
   have it, and partial sums before the shuffle.
3. Each chunk gets the counts of its own pairs back, and its documents' links
   are looked up there. A chunk is bounded in bytes (a longer text is a chunk of
   its own), so is the group; the counts are never broadcast.

Tokenisation: A's slices are cut by ``bytebpe``. No piece of B's has a blank
after another character (checked when the model is loaded), so merges never
cross the place between a character and a following blank, and B's ids of a
text are those of its slices cut there. Both remember slices.

Defined results: a null or empty text, or one whose joined bytes of A or B
differ from blank + text, has no tokens: zeros and an empty groups column. Null
and repeated ids are rows of their own; repeated rows count as documents each.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm import bytebpe
from shopscope.llm.common import ranges, saved, text_slices, worker_file

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text bytes of a step, and of a chunk of documents.
STEP_BYTES, CHUNK_BYTES = 1 << 20, 32 << 20
_BLANK = "▁"


class Pieces:
    """Ids of a sentence-piece BPE, by remembered slices that begin with their blanks."""

    def __init__(self, name: str = PIECES) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=worker_file(name))
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(_BLANK in p.lstrip(_BLANK) for p in pieces):
            raise ValueError("a piece has a blank after another character: texts cannot be cut at blanks")
        self.size = len(pieces)
        self.tokens = bytebpe.Table([
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(pieces)])
        one_blank = [model.piece_to_id(_BLANK)]

        def learn(new: list[bytes]) -> list[list[int]]:
            # the model puts a blank before each text itself, which is the slice's first one
            found = model.encode([s[1:].decode() for s in new], num_threads=1)
            return [ids or one_blank for ids in found]

        self._slices = bytebpe.Remembered(learn)

    def flat(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (each begins with a blank) in a row, and each text's number of ids."""
        blank = data == 32
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[places[:-1]] = True
        starts = np.flatnonzero(begins)
        ids, counts = self._slices.flat(data, starts)
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(before[np.searchsorted(starts, places)])


def gallop(values: np.ndarray, longer: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value, how many of the sorted ``longer`` are less than it, looking between
    ``low`` and ``high`` only: exponential steps from ``start``, then binary search."""
    if not len(values):
        return np.zeros(0, np.int64)
    padded = np.append(longer, np.iinfo(longer.dtype).max)
    at = np.clip(start, low, high)
    up = (at < high) & (padded[at] < values)
    left, right = np.where(up, at, low), np.where(up, high, at)
    # upwards: left is known to be less; downwards: right is known not to be
    step = 1
    todo = np.flatnonzero(left < right)
    while len(todo):
        rising = up[todo]
        probe = np.where(rising, np.minimum(left[todo] + step, right[todo]), np.maximum(right[todo] - step, left[todo]))
        less = (probe < high[todo]) & (padded[probe] < values[todo])
        left[todo] = np.where(less, probe, left[todo])
        right[todo] = np.where(less, right[todo], probe)
        passed = np.where(rising, ~less, less) | (probe == np.where(rising, high[todo], low[todo]))
        todo = todo[~passed]
        step *= 2
    # the first place not less lies in (left, right] where left is known to be less, else in [left, right]
    left = np.where((left < high) & (padded[left] < values), left + 1, left)
    while len(todo := np.flatnonzero(left < right)):
        middle = (left[todo] + right[todo]) >> 1
        less = padded[middle] < values[todo]
        left[todo] = np.where(less, middle + 1, left[todo])
        right[todo] = np.where(less, right[todo], middle)
    return left


def ranks(ends_a: np.ndarray, in_a: np.ndarray, ends_b: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token ends of many documents (``in_a``, ``in_b``: bounds of each in the two
    lists, which both grow over all documents). The shorter list of each document
    drives. Returns, for A's ends, B's ends below each; whether each is common;
    and the places in B of the common ones."""
    docs = len(in_a) - 1
    n_a, n_b = np.diff(in_a), np.diff(in_b)
    below, common = np.zeros(len(ends_a), np.int64), np.zeros(len(ends_a), bool)
    for a_drives in (True, False):
        of = np.flatnonzero((n_a <= n_b) == a_drives)
        own, other, own_in, other_in = (ends_a, ends_b, in_a, in_b) if a_drives else (ends_b, ends_a, in_b, in_a)
        count = np.diff(own_in)[of]
        who = ranges(own_in[:-1][of], count)
        doc = np.repeat(of, count)
        low, high = other_in[:-1][doc], other_in[1:][doc]
        share = (who - own_in[:-1][doc]) * (high - low) // np.maximum(own_in[1:][doc] - own_in[:-1][doc], 1)
        found = gallop(own[who], other, low, high, low + share)
        same = (found < high) & (np.append(other, -1)[found] == own[who])
        if a_drives:
            below[who], common[who] = found, same
        else:
            common[found[same]] = True
            # B's ends below an end of A: those whose own place lies at or before it
            first = np.zeros(len(ends_a) + 1, np.int64)
            np.add.at(first, found + same, 1)  # such an end is below A's ends from there on
            mine = np.zeros(docs, bool)
            mine[of] = True
            a_doc = np.repeat(np.arange(docs), n_a)
            mine_a = mine[a_doc]
            total = np.cumsum(first)[:-1]
            # ends of earlier driving documents were all counted; ends of the others were not
            counted = np.concatenate([[0], np.cumsum(np.where(mine, n_b, 0))])
            below[mine_a] = (total - counted[a_doc] + in_b[:-1][a_doc])[mine_a]
    return below, common, below[common]


class Aligner:
    """Both tokenizers, and all that is found in one batch of texts."""

    def __init__(self, table: np.ndarray, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> None:
        self.a, self.b = bytebpe.Encoder(table, byte_bpe), Pieces(pieces)
        most = max(len(self.a.tokens.length), self.b.size)
        self._digits = bytebpe.Table([b"%d," % i for i in range(most)])
        if len(self.a.tokens.length) * self.b.size >= 1 << 31:
            raise ValueError("pairs of ids do not fit 31 bits")

    def tokens(self, texts: pa.Array):
        """(ids, ends, bounds) of A and B over all texts; texts that cannot be aligned have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
        data, places = bytebpe.text_bytes(texts)
        if not len(data):
            none = np.zeros(0, np.int64)
            return [(none, none, np.zeros(len(places), np.int64))] * 2
        sides, good = [], np.ones(len(places) - 1, bool)
        empty = np.diff(places) == 0
        full = places[:-1][~empty]
        for coder in (self.a, self.b):
            ids, counts = coder.flat(data, np.append(full, len(data)))
            every = np.zeros(len(places) - 1, np.int64)
            every[~empty] = counts
            joined, lengths = coder.tokens.gather(ids)
            bounds = np.concatenate([[0], np.cumsum(every)])
            ends = np.concatenate([[0], np.cumsum(lengths)])
            begin, end = ends[bounds[:-1]], ends[bounds[1:]]  # of each text among the joined bytes
            right = end - begin == np.diff(places)
            if right.all() and len(joined) == len(data):
                differs = np.flatnonzero(joined != data)
                right[np.searchsorted(places, differs, side="right") - 1] = False
            else:
                for i in np.flatnonzero(right):
                    right[i] = np.array_equal(joined[begin[i]:end[i]], data[places[i]:places[i + 1]])
            good &= right
            sides.append((ids, lengths, bounds))
        out = []
        for ids, lengths, bounds in sides:
            counts = np.diff(bounds)
            keep = np.repeat(good, counts)
            ids, lengths = ids[keep].astype(np.int64), lengths[keep]
            # byte places over all texts: ends grow from one text to the next
            out.append((ids, np.cumsum(lengths), np.concatenate([[0], np.cumsum(np.where(good, counts, 0))])))
        return out

    def aligned(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """Everything about a batch of texts; arrays over texts, groups or links."""
        (a, ends_a, in_a), (b, ends_b, in_b) = self.tokens(texts)
        docs = len(in_a) - 1
        below, common, common_b = ranks(ends_a, in_a, ends_b, in_b)
        # token i of A overlaps the B tokens from the one after the last end at or below its start, to the first end at or above its own
        start = np.zeros(len(a), np.int64)
        start[1:] = below[:-1] + common[:-1]
        first_of = in_a[:-1][np.diff(in_a) > 0]
        start[first_of] = in_b[:-1][np.diff(in_a) > 0]
        width = below - start + 1
        link_b = ranges(start, width)
        link_a = np.repeat(np.arange(len(a)), width)
        doc_of_a = np.repeat(np.arange(docs), np.diff(in_a))
        group_ends_a = np.flatnonzero(common)
        return {
            "n_a": np.diff(in_a), "n_b": np.diff(in_b), "a": a, "b": b, "group_ends_a": group_ends_a, "group_ends_b": common_b,
            "n_groups": np.bincount(doc_of_a[group_ends_a], minlength=docs), "n_links": np.bincount(doc_of_a, weights=width, minlength=docs).astype(np.int64),
            "link_doc": doc_of_a[link_a], "pair": a[link_a] * self.b.size + b[link_b]}

    def written(self, found: dict[str, np.ndarray]) -> list[str]:
        """groups_sha256 of each text."""
        a, b, ends_a, ends_b = found["a"], found["b"], found["group_ends_a"], found["group_ends_b"]
        groups = len(ends_a)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[ends_a], last_b[ends_b] = True, True
        sizes_a, sizes_b = np.diff(ends_a, prepend=-1), np.diff(ends_b, prepend=-1)
        # A's tokens of a group come after the B tokens of all earlier groups, B's after A's of their own too
        place_a = np.arange(len(a)) + np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_a)
        place_b = np.arange(len(b)) + np.repeat(np.cumsum(sizes_a), sizes_b)
        ids = np.empty(len(a) + len(b), np.int64)
        mark = np.full(len(ids), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        mark[place_a[last_a]], mark[place_b[last_b]] = ord("|"), ord(";")
        text, widths = self._digits.gather(ids)
        ends = np.cumsum(widths)
        text[ends - 1] = mark
        bounds = np.concatenate([[0], np.cumsum(found["n_a"] + found["n_b"])])
        places = np.concatenate([[0], ends])[bounds].tolist()
        assert groups == int(found["n_groups"].sum())
        return [hashlib.sha256(text[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(places[:-1], places[1:])]


_OF_WORKER: dict[tuple[str, str], Aligner] = {}


def aligner(table: np.ndarray, byte_bpe: str, pieces: str) -> Aligner:
    if (byte_bpe, pieces) not in _OF_WORKER:
        _OF_WORKER[byte_bpe, pieces] = Aligner(table, byte_bpe, pieces)
    return _OF_WORKER[byte_bpe, pieces]


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def groups(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """One row for each group of tokens between common ends: doc_id, group, first byte
    (of blank + text), a_ids and b_ids."""
    table = docs.sparkSession.sparkContext.broadcast(bytebpe.classes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(table.value, byte_bpe, pieces)
        for batch in batches:
            for part in text_slices(batch, limit=STEP_BYTES):
                found = tool.aligned(part.column("text"))
                bounds = [pa.array(np.concatenate([[0], found[f"group_ends_{s}"] + 1]).astype(np.int32)) for s in "ab"]
                n = found["n_groups"]
                lengths = np.add.reduceat(tool.a.tokens.length[found["a"]], bounds[0].to_numpy()[:-1]) if n.sum() else np.zeros(0, np.int64)
                before = np.cumsum(lengths) - lengths
                first = np.repeat(before[(np.cumsum(n) - n)[n > 0]], n[n > 0]) if n.sum() else before
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(ranges(np.zeros_like(n), n)),
                     pa.array(before - first), *(pa.ListArray.from_arrays(o, pa.array(found[s], pa.int32())) for o, s in zip(bounds, "ab"))],
                    ["doc_id", "group", "at", "a_ids", "b_ids"])

    return _rows(docs).mapInArrow(run, "doc_id long, group long, at long, a_ids array<int>, b_ids array<int>")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


_FOUND = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def chunks(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """(chunk, packed, pairs, held): documents packed with their pairs, and each chunk's pairs with the documents that hold them."""
    table = docs.sparkSession.sparkContext.broadcast(bytebpe.classes())
    names = ["chunk", "packed", "pairs", "held"]
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(table.value, byte_bpe, pieces)
        chunk, size = TaskContext.get().partitionId() << 32, 0
        all_pairs, all_held = np.zeros(0, np.int32), np.zeros(0, np.int64)

        def row(packed: bytes | None, pairs=None, held=None) -> pa.RecordBatch:
            values = ([chunk], [packed], [pairs], [held])
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for part in text_slices(batch, limit=STEP_BYTES):
                found = tool.aligned(part.column("text"))
                key = found["link_doc"] << 31 | found["pair"]
                key.sort()
                first = np.flatnonzero(np.diff(key, prepend=-1))
                times = np.diff(np.append(first, len(key))).astype(np.int32)
                key = key[first]
                pair = (key & ((1 << 31) - 1)).astype(np.int32)
                bounds = np.searchsorted(key, np.arange(part.num_rows + 1, dtype=np.int64) << 31).astype(np.int32)
                yield row(_packed(pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(found[n], pa.int64()) for n in _FOUND[1:5]), pa.array(tool.written(found), pa.string()),
                     # differences of neighbours are small numbers, which pack better
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.diff(pair, prepend=np.int32(0)))),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(times))], [*_FOUND, "pairs", "times"])))
                new, n = np.unique(pair, return_counts=True)
                both, place = np.unique(np.concatenate([all_pairs, new]), return_inverse=True)
                all_pairs, all_held = both, np.bincount(place, weights=np.concatenate([all_held, n]), minlength=len(both)).astype(np.int64)
                size += part.column("text").nbytes
                if size >= CHUNK_BYTES:
                    yield row(None, all_pairs, all_held)
                    chunk, size, all_pairs, all_held = chunk + 1, 0, all_pairs[:0], all_held[:0]
        if size:
            yield row(None, all_pairs, all_held)

    return _rows(docs).mapInArrow(run, "chunk long, packed binary, pairs array<int>, held array<int>")


def pair_counts(written: DataFrame, pieces_size: int) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no pair of its A id is in more."""
    counts = written.filter("packed is null").select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).groupBy(
        F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("n"))
    counts = saved(counts, "pairs")
    a = F.floor(F.col("pair") / pieces_size).cast("int")
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def report(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    import sentencepiece

    size = sentencepiece.SentencePieceProcessor(model_file=worker_file(pieces)).get_piece_size()
    written = saved(chunks(docs, byte_bpe, pieces), "chunks")
    asked = written.filter("packed is null").select(F.col("chunk").alias("asking"), F.explode("pairs").alias("pair"))
    counts = asked.join(pair_counts(written, size), "pair")
    names = [*_FOUND[:5], "n_best", "count_sum", "groups_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()]

    def run(packed: pa.Table, table: pa.Table) -> pa.Table:
        pair = table.column("pair").to_numpy()
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        n, best = table.column("n").to_numpy()[order], table.column("best").to_numpy()[order]
        out = []
        for blob in packed.column("packed"):
            with pa.ipc.open_stream(blob.as_buffer()) as stream:
                for b in stream:
                    times = b.column("times").flatten().to_numpy().astype(np.int64)
                    at = np.searchsorted(pair, np.cumsum(b.column("pairs").flatten().to_numpy(), dtype=np.int32))
                    bounds = b.column("pairs").offsets.to_numpy()
                    sums = [np.concatenate([[0], np.cumsum(v)])[bounds] for v in (times * best[at], times * n[at])]
                    columns = [*(b.column(c) for c in _FOUND[:5]), *(np.diff(s) for s in sums), b.column("groups_sha256")]
                    out.append(pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names))
        return pa.Table.from_batches(out, pa.schema(list(zip(names, kinds))))

    return written.filter("packed is not null").select("chunk", "packed").groupBy("chunk").cogroup(
        counts.select("asking", "pair", "n", "best").groupBy("asking")).applyInArrow(
        run, ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names))
