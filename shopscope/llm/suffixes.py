"""Removal of long repeated strings by column-wise suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts
somewhere else. The suffixes that can agree that far are lined up and sorted
column by column, as a collection's Burrows-Wheeler transform is built:

1. Anchors. In each window of ``length`` bytes the smallest hash value of its
   ``KEY``-byte strings marks an anchor. The choice depends on the window's
   bytes alone, so equal windows have equal anchors at the same place. Only
   hash values, text names and positions are shuffled; anchors whose key occurs
   once in the corpus are dropped (minimum and maximum of their places differ
   otherwise, a partial aggregate).
2. Segments. Around each anchor that is left, the bytes any window through it
   can reach are cut out of the text: ``length - KEY`` to its left, ``length``
   to its right. All suffixes that can agree in a window now stand in one column of
   the segments of one key. A task passes on at most two copies of a segment.
3. Rounds. A shard takes the segments of some keys and inserts one symbol of
   every segment a round, from the last column to the first. The order of the
   suffixes (the transform's column: stable by new symbol) and the common
   prefixes of neighbours follow from the round before. Where a common prefix
   reaches ``length``, the window that starts there is repeated.
4. Spans of all anchors of a text are merged and cut out. Texts that occur
   more than once are repeated as a whole.

Rows are handled by the hash of their text, so equal texts are searched once
and ids may be null or repeated. A key with more than ``HOT`` segments is not
given to one task: each of its windows is counted on its own by a partial
aggregate instead (the exact way for large groups). A null text is an empty
one; texts shorter than ``length`` bytes keep all bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.common import free_name, ranges, released, saved, text_slices
from shopscope.llm.contain import TABLE_BITS, bit_table

LENGTH = 400
#: Segments of one key that a shard may take, and segments of one shard (their
#: keys are numbered in 16 bits).
HOT, SEGMENTS = 20_000, 10_000
#: Texts, or segments, a task remembers, only to send fewer copies of them.
MET = 50_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def key_length(length: int) -> int:
    return length // 2 + length // 50


def _powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of the base and of its inverse modulo 2^64, kept by the worker."""
    if len(cache.get("up", ())) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            cache[name] = np.cumprod(p)
    return cache["up"][:n], cache["down"][:n]


def key_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Mixed polynomial hash of the k bytes from each position on."""
    up, down = _powers(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)])
    h = (total[k:] - total[:-k]) * down[:len(data) - k + 1]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def _sliding(values: np.ndarray, w: int, best, worst) -> np.ndarray:
    """best(values[i:i + w]) for each i, from running bests of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // w) * w, worst, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, w)
    right = best.accumulate(blocks, axis=1).reshape(-1)
    left = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(left[:n - w + 1], right[w - 1:n])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and keys of a text's anchors: each window of ``length`` bytes has one."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = key_length(length)
    h = key_hashes(data, k)
    w = length - k + 1
    low = _sliding(h, w, np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF))
    # position p is the smallest of a window that has it if the largest of those windows' minima is its value
    spread = np.zeros(len(low) + 2 * (w - 1), np.uint64)
    spread[w - 1:w - 1 + len(low)] = low
    at = np.flatnonzero(_sliding(spread, w, np.maximum, np.uint64(0)) == h)
    return at, h[at].view(np.int64)


def _name(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()[:16]


def _place(name: bytes, at: np.ndarray) -> np.ndarray:
    """A number for (text, position) that differs between places."""
    x = (np.uint64(int.from_bytes(name[:8], "little")) + at.astype(np.uint64) * _BASE)
    x ^= x >> np.uint64(31)
    return (x * _MIX).view(np.int64)


def _named(docs: DataFrame) -> DataFrame:
    """Every row's text as bytes, and its name."""
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.select(_name_of(F.col("text")).alias("name"), "text")


def _name_of(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def found_anchors(docs: DataFrame, length: int) -> DataFrame:
    """(name, at, key, place): one row per anchor; a text met again by the same task is passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for part in text_slices(batch):
                names, counts, ats, keys, places = [], [], [], [], []
                for text in part.column("text").to_pylist():
                    if len(text) < length or (name := _name(text)) in met:
                        continue
                    if len(met) < MET:
                        met.add(name)
                    at, key = anchors(np.frombuffer(text, np.uint8), length)
                    names.append(name)
                    counts.append(len(at))
                    ats.append(at)
                    keys.append(key)
                    places.append(_place(name, at))
                if names:
                    name = pa.array(names, pa.binary()).take(pa.array(np.repeat(np.arange(len(names)), counts)))
                    yield pa.RecordBatch.from_arrays(
                        [name, pa.array(np.concatenate(ats).astype(np.int32)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(places))],
                        ["name", "at", "key", "place"])
        met.clear()
        released()

    return _named(docs).select("text").mapInArrow(run, "name binary, at int, key long, place long")


def _cut(text: bytes, at: int, length: int) -> tuple[int, bytes]:
    """How much of the left reach there is, and the segment's bytes."""
    left = min(at, length - key_length(length))
    return left, text[at - left:at + length]


def segments(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """One row per wanted anchor: key, segment (its name), text name, at; the
    bytes come along with the first two of equal segments that a task meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, int] = {}
        for batch in batches:
            for part in text_slices(batch):
                out: list[list] = [[], [], [], [], [], []]
                for name, text, ats, keys in zip(*(part.column(c).to_pylist() for c in ("name", "text", "ats", "keys"))):
                    for at, key in zip(ats, keys):
                        left, data = _cut(text, at, length)
                        own = hashlib.blake2b(data, digest_size=16, salt=f"{left}".encode()).digest()
                        times = met.get(own, 0)
                        if len(met) < MET or times:
                            met[own] = times + 1
                        for column, x in zip(out, (key, own, name, at, left, data if times < 2 else None)):
                            column.append(x)
                    if len(out[0]) > 5_000:
                        yield _batch(out)
                        out = [[], [], [], [], [], []]
                yield _batch(out)
        met.clear()
        released()

    def _batch(out: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["key", "segment", "name", "at", "left", "data"])

    by_text = wanted.groupBy("name").agg(F.sort_array(F.collect_set(F.struct("at", "key"))).alias("a")).select(
        "name", F.col("a.at").alias("ats"), F.col("a.key").alias("keys"))
    rows = texts.join(by_text, "name")
    return rows.mapInArrow(run, "key long, segment binary, name binary, at int, left int, data binary")


def repeated_windows(keys: np.ndarray, lefts: np.ndarray, data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last column at which a repeated window starts, for each segment
    of a shard (-1 for none); ``data`` has the segments' bytes in a row. Column 0
    is the leftmost byte a segment can have."""
    m, reach = len(keys), length - key_length(length)
    width = reach + length
    begin = reach - lefts.astype(np.int32)  # the column a segment begins at
    end = begin + sizes.astype(np.int32)
    columns = np.zeros((width, m), np.uint8)  # symbols column by column; where a segment has none, see below
    starts = np.cumsum(sizes) - sizes
    for i in range(0, m, 4096):  # in parts, so that the places of the bytes stay few
        part = slice(i, min(i + 4096, m))
        count = sizes[part]
        row = np.repeat(np.arange(part.start, part.stop), count)
        columns[ranges(begin[part].astype(np.int64), count), row] = data[starts[i]:starts[i] + int(count.sum())]
    group = np.unique(keys, return_inverse=True)[1].astype(np.uint16)
    order = np.argsort(group, kind="stable")
    common = np.zeros(m, np.int32)  # common prefix of a suffix with the one before it in order
    first, last = np.full(m, -1, np.int32), np.full(m, -1, np.int32)
    for c in reversed(range(width)):
        symbol = columns[c].astype(np.uint16)
        symbol[(c < begin) | (c >= end)] = 256  # no byte there: sorted last, equal to nothing
        symbol = symbol[order]
        by_symbol = np.argsort(symbol, kind="stable")
        step = by_symbol[np.argsort(group[order][by_symbol], kind="stable")]
        new = order[step]
        s, g = symbol[step], group[new]
        follows = np.zeros(m, bool)
        follows[1:] = (s[1:] == s[:-1]) & (g[1:] == g[:-1]) & (s[1:] != 256)
        now = np.zeros(m, np.int32)
        at = np.flatnonzero(follows)
        if len(at):
            a, b = step[at - 1], step[at]
            near = b == a + 1
            now[at[near]] = common[b[near]] + 1
            far = at[~near]
            if len(far):  # the smallest common prefix on the way between two that are no longer apart
                pairs = np.stack([step[far - 1] + 1, step[far] + 1], axis=1).reshape(-1)
                bound = np.append(common, 0)
                now[far] = np.minimum.reduceat(bound, pairs)[::2] + 1
        order, common = new, now
        if c <= reach:
            hit = common >= length
            hit[:-1] |= hit[1:]
            rows = order[hit]
            first[rows] = c
            last[rows] = np.where(last[rows] < 0, c, last[rows])
    return first, last


def _sorted_shards(cold: DataFrame, length: int) -> DataFrame:
    """(key, segment, first, last) of the segments with a repeated window.

    A shard is held as Arrow buffers, at most ``SEGMENTS`` of them and the rest
    of the last key, so a worker holds a symbol matrix of a few dozen MB at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def shard(table: pa.RecordBatch) -> pa.RecordBatch:
            texts = table.column("data")
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
            first, last = repeated_windows(table.column("key").to_numpy(), table.column("left").to_numpy(), data, np.diff(offsets), length)
            on = pa.array(np.flatnonzero(first >= 0))
            found = table.select(["key", "segment"]).take(on)
            return pa.RecordBatch.from_arrays(
                [*found.columns, pa.array(first).take(on), pa.array(last).take(on)], ["key", "segment", "first", "last"])

        for batch in batches:  # sorted by key: a shard ends where a key does
            for k in range(0, batch.num_rows, SEGMENTS):
                held.append(batch.slice(k, SEGMENTS))
                rows += held[-1].num_rows
                if rows <= SEGMENTS:
                    continue
                whole = pa.concat_batches(held)
                key = whole.column("key").to_numpy()
                ends = np.flatnonzero(key[1:] != key[:-1]) + 1  # places where a new key begins
                if len(ends):  # up to the last of them: the key that is not over yet stays
                    n = int(ends[-1])
                    yield shard(whole.slice(0, n))
                    whole = pa.concat_batches([whole.slice(n)])
                held, rows = [whole], whole.num_rows
        if rows:
            yield shard(pa.concat_batches(held))
        held = []
        released()

    ordered = cold.select("key", "segment", "left", "data").repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "key long, segment binary, first int, last int")


def _hot_windows(hot: DataFrame, length: int) -> DataFrame:
    """The same result for keys with very many segments: every window counted by itself."""
    reach = length - key_length(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                out: list[list] = [[], [], [], []]
                part = batch.slice(k, 500)
                for key, own, left, data in zip(*(part.column(c).to_pylist() for c in ("key", "segment", "left", "data"))):
                    for s in range(0, min(left, len(data) - length) + 1):
                        for column, x in zip(out, (key, own, s + reach - left, hashlib.blake2b(data[s:s + length], digest_size=16).digest())):
                            column.append(x)
                kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["key", "segment", "c", "window"])

    windows = hot.select("key", "segment", "left", "data").mapInArrow(run, "key long, segment binary, c int, window binary")
    windows = saved(windows, "windows")
    twice = windows.groupBy("key", "c", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return windows.join(twice, ["key", "c", "window"]).groupBy("key", "segment").agg(F.min("c").alias("first"), F.max("c").alias("last"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(name, spans): for each distinct text that has them, its repeated spans
    (start, end) in bytes, unmerged. ``name`` is the text's 16-byte hash."""
    spark = docs.sparkSession
    reach = length - key_length(length)
    found = saved(found_anchors(docs, length), "anchors")
    # written first, so that the join may split a key that very many anchors share
    shared_keys = saved(found.groupBy("key").agg(F.min("place").alias("a"), F.max("place").alias("b")).filter("a <> b").select("key"), "keys")
    wanted = saved(found.select("name", "at", "key").join(shared_keys, "key").distinct(), "shared")
    # a fixed-size bit table spares most texts without such anchors the shuffle; the join decides
    named = _named(docs).filter(F.octet_length("text") >= length)
    bits = spark.sparkContext.broadcast(bit_table(wanted.select(F.xxhash64("name").alias("h"))))

    texts = chosen(named.withColumn("h", F.xxhash64("name")), bits, True).drop("h")
    cut = saved(segments(texts, wanted, length), "segments")
    with_data = cut.filter("data is not null")
    hot_keys = with_data.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("key")
    hot_keys = saved(hot_keys, "hot")
    cold = with_data.join(hot_keys, "key", "left_anti")
    windows = _sorted_shards(cold, length).unionByName(_hot_windows(with_data.join(hot_keys, "key", "left_semi"), length))
    windows = saved(windows.groupBy("key", "segment").agg(F.min("first").alias("first"), F.max("last").alias("last")), "windows")
    inside = cut.select("key", "segment", "name", "at").distinct().join(windows, ["key", "segment"]).select(
        "name", (F.col("at") - reach + F.col("first")).alias("start"), (F.col("at") - reach + F.col("last") + length).alias("end"))
    twice = named.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("end")).filter("n > 1")
    whole = twice.select("name", F.lit(0).alias("start"), "end")
    return inside.unionByName(whole).distinct().groupBy("name").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def chosen(rows: DataFrame, bits, inside: bool) -> DataFrame:
    """The rows whose last column (a hash) has its bit set in the table, or not set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            bit = batch.column(batch.num_columns - 1).to_numpy() & (TABLE_BITS - 1)
            yield batch.filter(pa.array((table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 != 0) == inside))

    return rows.mapInArrow(run, rows.schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as maximal runs."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for start, end in spans:
        parts.append(text[at:start])
        at = end
    return b"".join([*parts, text[at:]])


def _split(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The rows surely without repeated spans; and the others, with the spans as last column (null or a list)."""
    spans = saved(repeated_spans(docs, length), "spans")
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    of, bit, found_as = (free_name(n, docs) for n in ("_spans_of", "_bit_of", "_spans"))
    rows = docs.withColumn(of, _name_of(text)).withColumn(bit, F.xxhash64(of))
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(spans.select(F.xxhash64("name").alias("h"))))
    plain = chosen(rows, bits, False).drop(of, bit)
    found = spans.select(F.col("name").alias(of), F.col("spans").alias(found_as))
    others = chosen(rows, bits, True).join(found, of, "left")
    return plain, others.select(*(others[f"`{c}`"] for c in docs.columns), found_as)


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                out: list[list] = [[], [], [], []]
                for text, found in zip(part.column("text").to_pylist(), part.column("_spans").to_pylist()):
                    spans = merged([(x["start"], x["end"]) for x in found or []])
                    kept = _kept(text, spans)
                    for column, x in zip(out, (len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())):
                        column.append(x)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    plain, others = _split(rows, length)
    plain = plain.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    others = others.select("doc_id", F.col("text").cast("binary").alias("text"), "_spans")
    return plain.unionByName(others.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows with repeated bytes cut out of ``text`` (a character that is cut
    apart goes as a whole; a null text stays null), all other columns as they
    are but ``n_chars``, if there is one, which follows the text."""
    plain, others = _split(docs, length)
    columns, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, whole.schema.names[at]):
                texts = []
                for text, found in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                    if text is not None and found:
                        text = _kept(text.encode(), merged([(x["start"], x["end"]) for x in found])).decode("utf-8", "ignore")
                    texts.append(text)
                arrays = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays(arrays, columns)
        released()

    others = others.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.withColumn("text", F.col("text").cast("string")).schema)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        others = others.withColumn("n_chars", F.length("text").cast(kind))
    return plain.unionByName(others)
