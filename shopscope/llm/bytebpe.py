"""Byte-level BPE over slices that are cut without regular expressions.

Pre-tokenisation. A batch of texts is one array of code points, and a table
maps each to a character class. Ten states say what the text before a
character is in the middle of; every class is a function from states to
states. Functions are composed, which is associative, so the states of all
characters come from a blocked scan: every block's functions are composed side
by side, the blocks' compositions are scanned by doubling, and each block is
run through once more from the state it begins in. A text's first character is
a constant function, so nothing crosses texts. Where a token begins follows
from the states around a character.

Merging. Equal slices of a batch are merged once; slices met before take their
ids from a bounded table of the worker. A new slice's pairs are merged lowest
rank first, with a heap, so a slice of any length takes n log n steps.

Decoding. A token's bytes are known by its id, so byte offsets are sums of
lengths; the bytes of any run of tokens are gathered in one step.

A null text is an empty one: no ids, and no bytes. Rows with any doc_id are
encoded one by one; an empty table gives none; other columns are not read.
Texts are never cut: a long one is a batch of its own.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.common import ranges, text_slices, worker_file

BYTE_BPE = "byte_bpe_50k.tiktoken"
#: Text bytes of one step, and slices remembered by a worker before its table starts anew.
STEP_BYTES, REMEMBERED = 1 << 20, 400_000
#: Characters of one block of the scan, and how many are run before looking whether a block's function is constant.
BLOCK, LOOK = 1024, 64

#: States: what the last character read belongs to.
LETTERS, NUMBERS, MARKS, SPACE, BLANK, QUOTE, SHORT, MAYBE_E, MAYBE_L, LONG = range(10)
#: Classes: letters by their part in the endings 's 't 'm 'd 're 've 'll, then the others.
OTHER_LETTER, END_LETTER, R_OR_V, L_LETTER, E_LETTER, NUMBER, PLAIN_SPACE, OTHER_SPACE, APOSTROPHE, MARK = range(10)


def _transitions() -> np.ndarray:
    """[class, state before] -> state; classes from 10 on are a text's first character."""
    to = np.zeros((20, 10), np.uint8)
    to[NUMBER], to[PLAIN_SPACE], to[OTHER_SPACE], to[MARK] = NUMBERS, SPACE, BLANK, MARKS
    to[APOSTROPHE] = QUOTE
    to[APOSTROPHE, [MARKS, SPACE, QUOTE]] = MARKS  # not at the beginning of a token
    to[[OTHER_LETTER, END_LETTER, R_OR_V, L_LETTER, E_LETTER]] = LETTERS
    to[END_LETTER, QUOTE], to[R_OR_V, QUOTE], to[L_LETTER, QUOTE] = SHORT, MAYBE_E, MAYBE_L
    to[E_LETTER, MAYBE_E] = to[L_LETTER, MAYBE_L] = LONG
    to[10:] = to[:10, [BLANK]]  # as after a blank that belongs to nothing
    return to


_TO = _transitions()
#: [state before, state] -> a token begins at the character (blanks are decided apart).
_BEGINS = np.zeros((10, 10), bool)
_BEGINS[[NUMBERS, MARKS, BLANK, QUOTE, SHORT, LONG], LETTERS] = True
_BEGINS[:, NUMBERS] = True
_BEGINS[[NUMBERS, SPACE], NUMBERS] = False
_BEGINS[:, MARKS] = True
_BEGINS[[MARKS, SPACE, QUOTE], MARKS] = False
_BEGINS[:, QUOTE] = True


def classes() -> np.ndarray:
    """Class of every code point. Letters and numbers newer than this Python's
    character tables are asked of the tokenizer library, so that both agree."""
    import tiktoken

    table = np.full(sys.maxunicode + 1, MARK, np.uint8)
    unknown = []
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LN":
            table[c] = OTHER_LETTER if kind[0] == "L" else NUMBER
        elif kind == "Cn":
            unknown.append(chr(c))
    single = {bytes([b]): b for b in range(256)}
    for pattern, value in ((r"\p{L}", OTHER_LETTER), (r"\p{N}", NUMBER)):
        library = tiktoken.Encoding(f"class {value}", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        table[[ord(c) for c in bytes(library.encode_ordinary("".join(unknown))).decode()]] = value
    blanks = [c for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F]
    table[blanks] = OTHER_SPACE
    for letters, value in (("stmd", END_LETTER), ("rv", R_OR_V), ("l", L_LETTER), ("e", E_LETTER), (" ", PLAIN_SPACE), ("'", APOSTROPHE)):
        table[[ord(c) for c in letters]] = value
    return table


def states(kinds: np.ndarray) -> np.ndarray:
    """The state after each character, by the blocked scan of transition functions."""
    n = len(kinds)
    if not n:
        return np.zeros(0, np.uint8)
    width = min(BLOCK, max(1, int(np.sqrt(n))))
    rows = -(-n // width)
    grid = np.full(rows * width, MARK, np.uint8)
    grid[:n] = kinds
    steps = np.ascontiguousarray(grid.reshape(rows, width).T).astype(np.int16) * 10  # one row for each place in a block
    flat = _TO.reshape(-1)
    whole = np.tile(np.arange(10, dtype=np.uint8), (rows, 1))
    open_ = np.arange(rows)
    function = whole.copy()
    for j in range(width):  # composed functions of all blocks; a constant one only needs one of its values
        function = flat[steps[j][open_, None] + function]
        if j % LOOK == LOOK - 1 or j == width - 1:
            if j < width - 1 and function.shape[1] > 1 and (function == function[:, :1]).all():
                function = function[:, :1]
    whole = np.broadcast_to(function, (rows, 10)) if function.shape[1] == 1 else function
    step, after = 1, np.ascontiguousarray(whole)
    while step < rows:  # doubling: after[i] composes the blocks up to i
        after = np.concatenate([after[:step], np.take_along_axis(after[step:], after[:-step], axis=1)])
        step *= 2
    at = np.concatenate([np.zeros(1, np.uint8), after[:-1, BLANK]])
    at[0] = BLANK
    out = np.empty((width, rows), np.uint8)
    for j in range(width):
        at = flat[steps[j] + at]
        out[j] = at
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


def boundaries(points: np.ndarray, firsts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each character, whether a token begins there; ``firsts`` are the places of texts' first characters."""
    n = len(points)
    kinds = table[points]
    kinds[firsts] += 10
    state = states(kinds)
    first = np.zeros(n + 1, bool)
    first[firsts] = True
    first[n] = True
    before = np.concatenate([np.full(1, BLANK, np.uint8), state[:-1]])
    before[firsts] = BLANK
    begins = _BEGINS[before, state]
    after = np.concatenate([state[1:], np.zeros(1, np.uint8)])
    after[first[1:]] = LETTERS  # nothing comes after a text's last character
    maybe = (state == MAYBE_E) | (state == MAYBE_L)
    begins[maybe] = after[maybe] != LONG  # an apostrophe alone, then letters
    blank = (state == SPACE) | (state == BLANK)
    ends_run = np.ones(n, bool)  # the last blank before something else goes with that, or stands alone
    ends_run[:-1] = ~blank[1:]
    ends_run &= ~first[1:]
    inside = np.zeros(n, bool)
    inside[1:] = blank[:-1]
    inside[firsts] = False
    begins[blank] = (ends_run | ~inside)[blank]
    begins[firsts] = True
    return begins


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: neighbouring parts are joined, lowest rank and then leftmost first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part begins at i and ends at ends[i]
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, end = heapq.heappop(heap)
        if gone[i] or ends[i] == n or ends[ends[i]] != end:  # one of the two parts has changed since
            continue
        gone[ends[i]] = 1
        ends[i] = end
        if end < n:
            before[end] = i
            if (r := ranks.get(piece[i:ends[end]])) is not None:
                heapq.heappush(heap, (r, i, ends[end]))
        left = before[i]
        if left >= 0 and (r := ranks.get(piece[left:end])) is not None:
            heapq.heappush(heap, (r, left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:ends[i]]])
        i = ends[i]
    return out


class Remembered:
    """Ids of slices, learned when first met; bounded, and started anew when full."""

    def __init__(self, learn: Callable[[list[bytes]], list[list[int]]]) -> None:
        self._learn = learn
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}
        self._ids = np.zeros(1 << 16, np.int32)
        self._used = 0
        self._start = np.zeros(1 << 12, np.int64)
        self._count = np.zeros(1 << 12, np.int64)

    def _add(self, slices: list[bytes], found: list[list[int]]) -> None:
        first = len(self._known)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        total = int(counts.sum())
        while self._used + total > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while first + len(slices) > len(self._start):
            self._start = np.concatenate([self._start, np.zeros_like(self._start)])
            self._count = np.concatenate([self._count, np.zeros_like(self._count)])
        self._ids[self._used:self._used + total] = np.fromiter((i for f in found for i in f), np.int32, total)
        self._start[first:first + len(slices)] = self._used + np.cumsum(counts) - counts
        self._count[first:first + len(slices)] = counts
        self._used += total
        self._known.update(zip(slices, range(first, first + len(slices))))

    def flat(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices of ``data`` that begin at ``starts`` (the first at 0), and each slice's number of ids."""
        offsets = np.append(starts, len(data)).astype(np.int64)
        slices = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = slices.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self._known) > REMEMBERED or self._used > 8 * REMEMBERED:
            self._forget()
        known = self._known
        new = [s for s in distinct if s not in known]
        if new:
            self._add(new, self._learn(new))
        place = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        place = place[coded.indices.to_numpy()]
        counts = self._count[place]
        return self._ids[ranges(self._start[place], counts)], counts


class Table:
    """Byte strings by number, gathered in one step."""

    def __init__(self, strings: list[bytes]) -> None:
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.fromiter(map(len, strings), np.int64, len(strings))
        self.start = np.cumsum(self.length) - self.length

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all those strings in a row, and each one's length."""
        lengths = self.length[which]
        return self.bytes[ranges(self.start[which], lengths)], lengths


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}


def vocabulary(name: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file, or of a byte-level vocabulary in JSON (without its special tokens)."""
    path = worker_file(name)
    if name.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        letters, special = byte_letters(), {t["content"] for t in model["added_tokens"]}
        return {bytes(letters[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the place where each begins, with the end."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8)[places[0]:places[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, places - places[0]


class Encoder:
    """Ids of texts and back, with byte offsets."""

    def __init__(self, table: np.ndarray, name: str = BYTE_BPE) -> None:
        self._table = table
        ranks = vocabulary(name)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.tokens = Table(tokens)
        self._slices = Remembered(lambda new: [merged(s, ranks) for s in new])

    def cut(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Byte places in ``data`` where slices begin; texts begin at ``places``."""
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # where characters begin
        starts = places[:-1][places[:-1] < places[1:]]
        firsts = np.searchsorted(lead, starts)
        return lead[boundaries(points, firsts, self._table)]

    def flat(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's number of ids."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(places) - 1, np.int64)
        starts = self.cut(data, places)
        ids, counts = self._slices.flat(data, starts)
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(before[np.searchsorted(starts, places)])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids in a row, and where each id's bytes end."""
        data, lengths = self.tokens.gather(ids)
        return data, np.cumsum(lengths)


_OF_WORKER: dict[str, Encoder] = {}


def encoder(table: np.ndarray, name: str = BYTE_BPE) -> Encoder:
    """The worker's encoder of that vocabulary, its remembered slices shared by tasks that follow each other."""
    if name not in _OF_WORKER:
        _OF_WORKER[name] = Encoder(table, name)
    return _OF_WORKER[name]


def encoded(docs: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """doc_id, ids, and for each id the byte ``offsets`` where its bytes begin in the text's UTF-8."""
    table = docs.sparkSession.sparkContext.broadcast(classes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(table.value, tokenizer)
        for batch in batches:
            for part in text_slices(batch, limit=STEP_BYTES):
                data, places = text_bytes(part.column("text"))
                ids, counts = coder.flat(data, places)
                lengths = coder.tokens.length[ids]
                offsets = np.cumsum(lengths) - lengths - np.repeat(places[:-1], counts)
                bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32())),
                     pa.ListArray.from_arrays(bounds, pa.array(offsets, pa.int64()))], ["doc_id", "ids", "offsets"])

    return _rows(docs).mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>")


def decoded(rows: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """doc_id and ``decoded`` (bytes) of rows with ids; null ids are no ids."""
    table = rows.sparkSession.sparkContext.broadcast(classes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(table.value, tokenizer)
        for batch in batches:
            found = []
            for ids in batch.column("ids"):
                found.append(coder.decode(np.array(ids.as_py() or [], np.int64))[0].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def digests(docs: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: texts encoded, their ids written out, and decoded again."""
    table = docs.sparkSession.sparkContext.broadcast(classes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(table.value, tokenizer)
        numbers = Table([b"%d " % i for i in range(len(coder.tokens.length))])
        for batch in batches:
            for part in text_slices(batch, limit=STEP_BYTES):
                ids, counts = coder.flat(*text_bytes(part.column("text")))
                last = np.concatenate([[0], np.cumsum(counts)])
                written, widths = numbers.gather(ids)
                back, ends = coder.decode(ids)
                in_written = np.concatenate([[0], np.cumsum(widths)])[last]
                in_back = np.concatenate([[0], ends])[last]
                a, b = written.data, back.data
                out = [[hashlib.sha256(a[s:max(s, e - 1)]).hexdigest() for s, e in zip(in_written[:-1].tolist(), in_written[1:].tolist())],
                       [hashlib.sha256(b[s:e]).hexdigest() for s, e in zip(in_back[:-1].tolist(), in_back[1:].tolist())]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(out[0], pa.string()), pa.array(out[1], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
