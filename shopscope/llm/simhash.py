"""SimHash near-duplicates found exactly with vantage-point trees.

1. Every text gets a 64-bit fingerprint from the XXH64 values of its word
   shingles (Arrow batches).
2. A vantage-point tree built from a bounded sample of the distinct
   fingerprints cuts Hamming space into shards: a fingerprint lives in one
   leaf, and visits every other leaf that its ball of ``max_bits`` may reach
   (triangle bound at each node). Of two neighbours on both sides of a node,
   only the nearer-side one visits, so each pair meets once.
   A leaf with too many residents gets a tree of its own from a bounded sample
   of them, level by level, until every leaf is a shard.
3. Inside a shard the same tree goes on over the residents, with all visitors
   carried down together; what is left is compared bit by bit. A shard returns
   a spanning star of each group it sees, never its pairs.
4. Large-star/small-star rounds join the stars into components.

Definitions for odd input: a null text is an empty one; a text without words
has fingerprint zero and links like any other; rows with a null ``doc_id`` take
part and get the smallest non-null id of their group (null if there is none);
repeated rows come back as often as they came; an empty table gives an empty
result. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.common import free_name, saved, text_slices

#: Residents aimed at in one shard, and below which a shard compares directly.
SHARD, DIRECT = 32_768, 192
#: Fingerprints a tree is built from; it bounds the tree that tasks receive.
SAMPLE = 16_384
#: Residents in units of SHARD from which a leaf is cut by a tree of its own.
FULL = 4
#: Rows of an overfull leaf that one task routes at once.
CHUNK = 200_000
#: Pairs a shard holds before it folds them into stars.
FOLD = 1_000_000


def fingerprint(text: bytes, width: int = 3) -> int:
    """64-bit SimHash of one text, as a signed integer."""
    import xxhash

    words = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    h = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64)
    bits = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        bits += np.unpackbits(h[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(h)).view(np.int64)[0])


def _row_key() -> Column:
    """Digest of a row's id and text; rows that share it are alike in both."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit("|"), text).cast("binary"), 256))


def fingerprints(docs: DataFrame, width: int = 3, keyed: bool = False) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a long) of every row, and its ``row_key`` if wanted."""
    also = ["row_key"] if keyed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                fps = [fingerprint(t or b"", width) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(fps, pa.int64()), *map(part.column, also)], ["doc_id", "fp", *also])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *(_row_key().alias(c) for c in also))
    return rows.mapInArrow(run, "doc_id long, fp long" + ", row_key binary" * keyed)


def _distance(fps: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(fps ^ np.uint64(point)).astype(np.int16)


def vantage_tree(sample: np.ndarray, leaves: int) -> list[tuple[int, int, int, int]]:
    """Nodes (point, radius, inner child, outer child); a child below 0 is leaf ``-1 - child``."""
    nodes: list[tuple[int, int, int, int]] = []
    made = 0

    def grow(part: np.ndarray, share: int) -> int:
        nonlocal made
        if share > 1 and len(part) > 1:
            d = _distance(part, int(part[0]))
            radius = int(np.median(d))
            if radius == d.max() and d.min() < radius:
                radius = int(d[d < radius].max())
            inner = d <= radius
            if not inner.all():
                at = len(nodes)
                nodes.append((0, 0, 0, 0))
                nodes[at] = (int(part[0]), radius, grow(part[inner], share // 2), grow(part[~inner], share - share // 2))
                return at
        made += 1
        return -made

    grow(sample, leaves)
    return nodes


def route(fps: np.ndarray, nodes: list[tuple[int, int, int, int]], reach: int,
          resident: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaf, row and whether it lives there, for each leaf that a fingerprint lives
    in or visits. ``resident`` tells who lives under the tree's root (else all)."""
    leaf, row, lives = [], [], []
    todo = [(0 if nodes else -1, np.arange(len(fps)), np.ones(len(fps), bool) if resident is None else resident)]
    while todo:
        at, rows, home = todo.pop()
        if not len(rows):
            continue
        if at < 0:
            leaf.append(np.full(len(rows), -1 - at, np.int32))
            row.append(rows)
            lives.append(home)
            continue
        point, radius, inner, outer = nodes[at]
        d = _distance(fps[rows], point)
        near = np.where(home, d <= radius, d <= radius + reach)
        far = np.where(home, d > radius, d > radius - reach)
        cross = home & (d <= radius) & (d > radius - reach)
        todo.append((inner, rows[near], home[near]))
        go = far | cross
        todo.append((outer, rows[go], (home & ~cross)[go]))
    return np.concatenate(leaf or [[]]).astype(np.int32), np.concatenate(row or [[]]).astype(np.int64), np.concatenate(lives or [[]]).astype(bool)


def _stars(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Components of a few links among n points: each point that has one, and its root."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    on = np.flatnonzero(root != np.arange(n))
    return on, root[on]


def shard_stars(fps: np.ndarray, lives: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``reach`` bits that have a resident, as stars over positions in ``fps``."""
    n = len(fps)
    links_a, links_b, held = [], [], 0
    todo = [(np.flatnonzero(lives), np.flatnonzero(~lives))]
    while todo:
        own, guests = todo.pop()
        if not len(own) or len(own) == 1 and not len(guests):
            continue
        split = None
        if len(own) > DIRECT:
            point = int(fps[own[0]])
            d = _distance(fps[own], point)
            radius = int(np.median(d))
            inner = d <= radius
            if not inner.all():
                split = inner
        if split is not None:
            e = _distance(fps[guests], point)
            todo.append((own[split], guests[e <= radius + reach]))
            cross = own[split & (d > radius - reach)]
            todo.append((own[~split], np.concatenate([guests[e > radius - reach], cross])))
            continue
        everyone = np.concatenate([own, guests])
        for k in range(0, len(everyone), 2048):
            part = everyone[k:k + 2048]
            for o in range(0, len(own), 1024):
                x, y = np.nonzero(np.bitwise_count(fps[part][:, None] ^ fps[own[o:o + 1024]][None, :]) <= reach)
                a, b = part[x], own[o:o + 1024][y]
                keep = a != b
                links_a.append(a[keep])
                links_b.append(b[keep])
                held += int(keep.sum())
            if held > FOLD:
                a, b = _stars(np.concatenate(links_a), np.concatenate(links_b), n)
                links_a, links_b, held = [a], [b], 0
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _stars(np.concatenate(links_a), np.concatenate(links_b), n)


def near_links(distinct: DataFrame, reach: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: enough of them to
    connect all that are joined by steps of at most ``reach`` bits."""
    spark = distinct.sparkSession
    n = distinct.count()
    sample = [r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    tree = vantage_tree(np.array(sample, np.int64).view(np.uint64), min(math.ceil(n / SHARD), SAMPLE // 4))
    nodes = spark.sparkContext.broadcast(tree)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 20_000):
                fps = batch.column(0).slice(k, 20_000).to_numpy()
                leaf, row, lives = route(fps.view(np.uint64), nodes.value, reach)
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(pa.array(leaf), pa.string()), pa.array(fps[row]), pa.array(lives)], ["leaf", "fp", "lives"])

    def meet(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy()
        on, root = shard_stars(fps.view(np.uint64), table.column("lives").to_numpy(), reach)
        return pa.table({"a": fps[on], "b": fps[root]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    sent = saved(distinct.select("fp").mapInArrow(send, _ROUTED), "routed")
    depth = 0
    while True:
        sizes = sent.groupBy("leaf").agg(F.count_if("lives").alias("own"), F.count(F.lit(1)).alias("n"))
        full = saved(sizes.filter(F.col("own") > FULL * SHARD), "overfull")
        if full.isEmpty():
            return sent.groupBy("leaf").applyInArrow(meet, "a long, b long")
        depth += 1
        sent = saved(_cut(sent, full, reach, depth), "routed")


_ROUTED = "leaf string, fp long, lives boolean"


def _cut(sent: DataFrame, full: DataFrame, reach: int, depth: int) -> DataFrame:
    """The routed rows with those of overfull leaves (leaf, own, n) in the leaves
    of a tree of their own. Each tree comes from about SAMPLE residents, chosen by a
    hash that differs by level; it meets the leaf's rows in chunks of about CHUNK."""
    shard, most = SHARD, SAMPLE // 4
    chunks = F.ceil(F.col("n") / CHUNK)
    share = F.pmod(F.xxhash64("fp", F.lit(depth)), F.lit(1 << 40)) / float(1 << 40)
    sample = sent.filter("lives").join(full, "leaf").filter(share * F.col("own") < SAMPLE).select("leaf", "own", "fp")

    def grow(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        fps = np.sort(table.column("fp").to_numpy()).view(np.uint64)
        leaves = min(math.ceil(table.column("own")[0].as_py() / shard), most)
        nodes = vantage_tree(np.random.default_rng(depth).permutation(fps), leaves)
        flat = np.array([(p - (1 << 64) if p >> 63 else p, *rest) for p, *rest in nodes], np.int64)
        return pa.table({"leaf": pa.array([key[0].as_py()], pa.string()), "tree": pa.array([flat.tobytes()], pa.binary())})

    def go(key: tuple[pa.Scalar, ...], rows: pa.Table, tree: pa.Table) -> pa.Table:
        flat = np.frombuffer(tree.column("tree")[0].as_py() if tree.num_rows else b"", np.int64).reshape(-1, 4)
        nodes = [(p & (1 << 64) - 1, *rest) for p, *rest in flat.tolist()]
        fps = rows.column("fp").to_numpy()
        leaf, row, lives = route(fps.view(np.uint64), nodes, reach, rows.column("lives").to_numpy())
        names = pc.binary_join_element_wise(pa.scalar(key[0].as_py()), pc.cast(pa.array(leaf), pa.string()), "/")
        return pa.table({"leaf": names, "fp": fps[row], "lives": lives})

    trees = sample.groupBy("leaf").applyInArrow(grow, "leaf string, tree binary").join(full, "leaf").select(
        "leaf", "tree", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"))
    rows = sent.join(full, "leaf").select("leaf", "fp", "lives", F.pmod(F.xxhash64("fp"), chunks).alias("chunk"))
    moved = rows.groupBy("leaf", "chunk").cogroup(trees.groupBy("leaf", "chunk")).applyInArrow(go, _ROUTED)
    return sent.join(full, "leaf", "left_anti").select("leaf", "fp", "lives").unionByName(moved)


def components(links: DataFrame) -> DataFrame:
    """Every node of the links (a, b) with the smallest node it reaches: (node, root).

    Alternating large-star and small-star rounds; each round's links are
    written to the shared folder, so lineage stays short. Minima are partial
    aggregates and the joins may be split at a hot node.
    """
    links = saved(links.filter("a <> b").distinct(), "links")
    state = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(F.greatest("a", "b"), F.least("a", "b")))).first()
        if now == state or now[0] == 0:
            return links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        state = now
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = saved(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")


def _rooted(docs: DataFrame, width: int, reach: int, keyed: bool = False) -> DataFrame:
    """The fingerprint rows of ``docs`` with ``group_fp``, the key of their group."""
    marked = saved(fingerprints(docs, width, keyed), "fingerprints")
    roots = components(near_links(marked.select("fp").distinct(), reach))
    return marked.join(roots, marked.fp == roots.node, "left").select(
        *(marked[c] for c in marked.columns), F.coalesce("root", "fp").alias("group_fp"))


def near_duplicates(docs: DataFrame, width: int = 3, reach: int = 3) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id (smallest id of the group), group_fp (the group's own key)."""
    rooted = _rooted(docs, width, reach)
    first = rooted.groupBy("group_fp").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(first, "group_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_fp")


def keep_one(docs: DataFrame, width: int = 3, reach: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: exactly one row of each
    group stays, one with its smallest id (null only if the group has no other).

    Groups choose by row key, not by id: rows with null or shared ids may lie in
    different groups. A key holds the text, so it lies in one group only.
    """
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    kept = _rooted(docs, width, reach, keyed=True).groupBy("group_fp").agg(F.min(row).alias("row"))
    key = free_name("_row_key", docs)
    return docs.withColumn(key, _row_key()).join(
        kept.select(F.col("row.row_key").alias(key)), key, "left_semi").dropDuplicates([key]).drop(key)
