"""Best-two-fit packing of encoded documents into sequences of fixed capacity.

Lengths are whole numbers up to the capacity, so the corpus is packed through
its histogram of lengths: at most ``capacity`` counts go to the driver,
whatever the number of documents. A bin is filled greedily with the longest
lengths that still fit; then its smallest document is taken out again if two
unpacked documents fill the widened gap better. The same bin is repeated as
often as the counts allow, which is one row of the plan. Each piece then finds
its place from its rank among the pieces of its length: ranks come from a
window over (length, salt), so a length that a third of all pieces share is
spread over many tasks.

A null text is an empty one: its only id is the end id. Rows are packed one by
one, also when ids repeat or are null. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopscope.llm.common import saved, text_slices
from shopscope.llm.encode import WORD_BPE, encoder

CAPACITY = 4096
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 1, tokenizer: str = WORD_BPE, with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids, the end id included;
    with ``with_ids`` the ids of each piece come along as an array."""
    schema = _PIECE + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                ids, counts = encoder(tokenizer).flat(part.column("text"))
                ends = np.cumsum(counts)
                out: list[list] = [[], [], [], [], [], []]
                for doc_id, end, n in zip(part.column("doc_id").to_pylist(), ends, counts):
                    own = np.append(ids[end - n:end].astype("<u4"), np.uint32(end_id))
                    for k in range(0, len(own), capacity):
                        piece = own[k:k + capacity]
                        for column, value in zip(out, (doc_id, k // capacity, k, len(piece), zlib.crc32(piece))):
                            column.append(value)
                        if with_ids:
                            out[5].append(piece.astype(np.int32))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][:5 + with_ids]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def bins(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-two-fit over ``counts`` (pieces of each length, by length). Returns
    (how many bins, [(length, pieces of it in each)]) until all are placed."""
    left = np.zeros(capacity + 1, np.int64)
    left[:len(counts)] = counts
    lengths = np.arange(capacity + 1)

    def longest() -> np.ndarray:
        """For each gap the longest length left that fits it, 0 for none."""
        return np.maximum.accumulate(np.where(left > 0, lengths, 0))

    plan = []
    fits = longest()
    while fits[capacity]:
        own: dict[int, int] = {}
        gap = capacity
        while gap and (x := int(fits[gap])):
            k = min(int(left[x]) - own.get(x, 0), gap // x)
            if k == 0:  # all of that length are in this bin: the next shorter one
                x = next((y for y in range(x - 1, 0, -1) if left[y] - own.get(y, 0) > 0), 0) if own else 0
                if not x:
                    break
                k = min(int(left[x]) - own.get(x, 0), gap // x)
            own[x] = own.get(x, 0) + k
            gap -= k * x
        if gap and len(own) + max(own.values()) > 2:
            two = _two(left, own, gap, capacity)
            if two:
                small = min(own)
                own[small] -= 1
                for x in two:
                    own[x] = own.get(x, 0) + 1
                own = {x: k for x, k in own.items() if k}
        times = min(int(left[x]) // k for x, k in own.items())
        for x, k in own.items():
            left[x] -= times * k
        plan.append((times, sorted(own.items(), reverse=True)))
        fits = longest()
    return plan


def _two(left: np.ndarray, own: dict[int, int], gap: int, capacity: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum fills the gap widened by the bin's smallest document best, if better than it."""
    small = min(own)
    wide = gap + small
    free = left.copy()
    for x, k in own.items():
        free[x] -= k
    free[small] = 0  # it is the one to go; putting it back gains nothing
    fits = np.maximum.accumulate(np.where(free > 0, np.arange(capacity + 1), 0))
    x = np.flatnonzero(free[:wide] > 0)
    if not len(x):
        return None
    y = fits[np.minimum(wide - x, x)]
    alone = (y == x) & (free[x] < 2)
    y = np.where(alone, fits[np.maximum(np.minimum(wide - x, x) - 1, 0)], y)
    total = np.where(y > 0, x + y, 0)
    best = int(total.argmax())
    return (int(x[best]), int(y[best])) if total[best] > small else None


def _table(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length: first rank, pieces per bin, first sequence, offset, for each row of the plan that uses it."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, own in plan:
        offset = 0
        for x, k in own:
            rows.setdefault(x, []).append((used.get(x, 0), k, sequence, offset))
            used[x] = used.get(x, 0) + times * k
            offset += x * k
        sequence += times
    return {x: np.array(r, np.int64).T for x, r in rows.items()}


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns of :func:`pieces`)."""
    spark = made.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = saved(made, "pieces").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    parts = saved(made.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row for each length up to the capacity
        counts[r.length] = r.n
    places = spark.sparkContext.broadcast(_table(bins(counts, capacity)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = made.withColumn("rank", F.row_number().over(inside) - 1).join(offsets, ["length", "salt"])
    columns = [c for c in made.columns if c != "salt"]
    ranked = ranked.select(*columns, (F.col("rank") + F.col("first")).cast("long").alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = places.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                first, k, start, off = table[int(x)]
                row = np.searchsorted(first, rank[at], side="right") - 1
                nth = rank[at] - first[row]
                sequence[at] = start[row] + nth // k[row]
                offset[at] = off[row] + nth % k[row] * x
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema if f.name != "salt")
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
