"""Benchmark items inside documents: size-partitioned MinHash containment.

An item is contained in a document if at least ``threshold`` of its distinct
word shingles are among the document's. A document that contains an item of n
shingles lacks at most n - ceil(threshold * n) of them, so of any
k(n) = n - ceil(threshold * n) + 1 shingles it has one. Items are therefore
partitioned by size, and the sketch of an item is its k(n) smallest hash values
(bottom-k MinHash): a document that meets none of them is out, and no other is
lost, however long it is beside the item. Documents are partitioned too: one
with fewer distinct shingles than ceil(threshold * n) never meets an item of
size n.

The documents' shingle values first pass a bit table of the sketch values. The
table has a fixed size whatever the number of items; it lets too many values
through once there are very many items, and loses none. What passes is joined
with the sketches by a shuffle join, and each candidate pair is verified on the
words themselves.

Words are the maximal runs without ASCII white space, A-Z in lower case. Items
or documents with fewer words than a shingle have their whole word sequence as
the only shingle. An item of fewer words than a shingle is contained wherever
its words stand in a row: for each such word count that occurs among the items
(fewer than ``width`` of them), documents are cut into runs of that many words
too. Items or documents without words (null and empty texts) contain nothing
and are in nothing. Null ids are kept apart from no id: rows are reported under
their id, null included; repeated rows are reported once. Only id and text
columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.common import free_name, saved, text_slices

WIDTH, THRESHOLD = 5, 0.8
#: Bits of the table that the documents' shingle values pass first (2 MB, fixed).
TABLE_BITS = 1 << 24
_BITMAP = 32_768


def _runs(words: list[bytes], width: int) -> set[bytes]:
    return set(map(b" ".join, zip(*(words[i:] for i in range(width)))))


def shingles(text: bytes | None, width: int = WIDTH) -> set[bytes]:
    words = (text or b"").lower().split()
    if not words:
        return set()
    return _runs(words, width) if len(words) >= width else {b" ".join(words)}


def short_runs(text: bytes | None, counts: list[int]) -> set[bytes]:
    """The runs of as many words as short items have."""
    words = (text or b"").lower().split() if counts else []
    return set().union(*(_runs(words, n) for n in counts))


def _hashed(grams: set[bytes]) -> np.ndarray:
    import xxhash

    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), np.uint64))


def _values(text: bytes | None, width: int) -> np.ndarray:
    return _hashed(shingles(text, width))


def needed(n: int, threshold: float) -> int:
    """Shingles that a document must share with an item of n."""
    return max(1, math.ceil(threshold * n - 1e-9))


def sketches(items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """(item, n, h, short): the bottom k(n) hash values of each item; ``short`` is
    its number of words if they are fewer than a shingle's, else 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                key, size, value, short = [], [], [], []
                for item, text in zip(part.column("item").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                    h = _values(text, width)
                    low = h[:len(h) - needed(len(h), threshold) + 1] if len(h) else h
                    key.extend([item] * len(low))
                    size.extend([len(h)] * len(low))
                    value.extend(low.view(np.int64).tolist())
                    words = len((text or b"").split())
                    short.extend([words if words < width else 0] * len(low))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.string()), *(pa.array(c, pa.int64()) for c in (size, value, short))], ["item", "n", "h", "short"])

    return items.select("item", "text").mapInArrow(run, "item string, n long, h long, short long")


def bit_table(values: DataFrame) -> np.ndarray:
    """Which of ``TABLE_BITS`` bits a column ``h`` sets; at most TABLE_BITS / 32768 rows come to the driver."""
    bit = F.pmod("h", F.lit(TABLE_BITS))
    rows = values.select(F.floor(bit / _BITMAP).alias("part"), (bit % _BITMAP).alias("bit")).groupBy("part").agg(
        F.bitmap_construct_agg("bit").alias("bits")).collect()
    table = np.zeros(TABLE_BITS // 8, np.uint8)
    for r in rows:
        table[r.part * _BITMAP // 8:(r.part + 1) * _BITMAP // 8] = np.frombuffer(r.bits, np.uint8)
    return table


def _named(rows: DataFrame, id_column: str, name: str) -> DataFrame:
    """Id, text, and the text's hash as its name in the search, so equal texts are searched once."""
    return rows.select(F.col(id_column), F.col("text").cast("string").alias("text")).filter("text is not null").withColumn(
        name, F.sha2("text", 256))


def matches(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of texts by their hashes: doc, item, n_shingles of the item, n_shared."""
    spark = docs.sparkSession
    unique = saved(_named(items, "item_id", "item").select("item", "text").distinct(), "items")
    sketch = saved(sketches(unique, width, threshold), "sketches")
    table = spark.sparkContext.broadcast(bit_table(sketch))
    counts = sorted(r.short for r in sketch.filter("short > 0").select("short").distinct().collect())  # fewer than width

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            for part in text_slices(batch):
                at, size, values = [], [], []
                for i, text in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    h = _values(text, width).view(np.int64)
                    n = len(h)
                    if counts:
                        h = np.union1d(h, _hashed(short_runs(text, counts)).view(np.int64))
                    bit = h & (TABLE_BITS - 1)
                    hit = h[bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 != 0]
                    if len(hit):
                        at.append(i)
                        size.append(n)
                        values.append(hit)
                rows = part.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(size, pa.int64()), pa.array(values, pa.list_(pa.int64()))], ["doc_id", "text", "size", "hs"])

    # texts that pass the table go on with their values; no other text is moved
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    passed = texts.mapInArrow(meet, "doc_id long, text string, size long, hs array<long>")
    passed = saved(passed.withColumn("doc", F.sha2("text", 256)), "passed")
    enough = F.col("size") >= F.ceil(F.lit(threshold) * F.col("n") - F.lit(1e-9))
    hits = passed.select("doc", "size", F.explode("hs").alias("h"))
    pairs = saved(hits.join(sketch, "h").filter(enough).select("doc", "item").distinct(), "candidates")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc, text, item, words in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "item", "item_text"))):
                if doc != last:
                    last, own = doc, shingles(text.encode(), width) | short_runs(text.encode(), counts)
                wanted = shingles(words.encode(), width)
                shared = len(wanted & own)
                if wanted and shared >= needed(len(wanted), threshold):
                    for column, x in zip(out, (doc, item, len(wanted), shared)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["doc", "item", "n_shingles", "n_shared"])

    # one copy of each candidate text; its other rows come back by their hash
    copies = passed.select("doc", "text").join(pairs.select("doc").distinct(), "doc", "left_semi").groupBy("doc").agg(F.first("text").alias("text"))
    with_text = pairs.join(unique.withColumnRenamed("text", "item_text"), "item").join(copies, "doc")
    found = with_text.select("doc", "text", "item", "item_text").mapInArrow(verify, "doc string, item string, n_shingles long, n_shared long")
    return saved(found, "contained")


def contained(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """Every (doc_id, item_id) with the item contained in the document, with
    n_shingles of the item, n_shared and containment. A document with no such
    pair has no row."""
    found = matches(docs, items, width, threshold)
    return found.join(_named(docs, "doc_id", "doc").select("doc_id", "doc").distinct(), "doc").join(
        _named(items, "item_id", "item").select("item", "item_id").distinct(), "item").select(
        "doc_id", "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def without_contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    key = free_name("_bad", docs)
    bad = matches(docs, items, width, threshold).select(F.col("doc").alias(key)).distinct()
    return docs.join(bad, F.sha2(docs["text"].cast("string"), 256) == bad[key], "left_anti")
