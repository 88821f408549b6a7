"""Language of words and documents by a linear-chain conditional random field.

Every word has hashed features: itself if it is in the learned lexicon, its
affixes, and its character n-grams. A weight for each feature and language
gives emissions; learned transitions between the languages of neighbouring
words do the rest. Forward-backward gives each word's probabilities, so runs
of words in another language are labelled where they stand. A document's
language is the one with the largest share of its words' probabilities, and
that share is the score.

Learning: at most about ``PER_LANGUAGE`` training documents of each language
(by a hash of their id), chained in random order so that languages do switch;
gradient steps on the log-likelihood. Prediction covers every word of every
text: a batch of documents is one chain that is cut into equal blocks, whose
transfer products join the blocks exactly, however long one text is.

A null text, or one without a letter, is ``und`` with score 0. A null id
counts as the empty text, whose remainder is not held out. Repeated rows are
predicted each. Without labelled documents everything is ``und``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.common import crc_mod, hash_sample, ranges, text_slices, texts_of

#: Bound on the training documents of each language (about; by hash).
PER_LANGUAGE = 160
#: Hashed features, words in the lexicon, passes over the sample.
SIZE, LEXICON, PASSES = 1 << 16, 4000, 4
#: Words of a block, and tokens and cores remembered by a worker before it starts anew.
STEP, REMEMBERED = 96, 300_000
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def word_features(token: str, lexicon: frozenset[str]) -> list[int]:
    """Feature numbers of a token; none if it has no letter."""
    word = _EDGE.sub("", token.lower())
    if not any(map(str.isalpha, word)):
        return []
    marked = f"^{word}$"
    names = [f"p{word[:k]}" for k in (1, 2, 3)] + [f"s{word[-k:]}" for k in (1, 2, 3)]
    names += [marked[i:i + n] for n in (2, 3) for i in range(len(marked) - n + 1)]
    if word in lexicon:
        names.append(f"w{word}")
    crc = zlib.crc32
    return [crc(n.encode()) % SIZE for n in names]


def core(token: str) -> str:
    """The token's word in lower case, without the marks and digits around it."""
    low = token.lower()
    return low if low.isalpha() else _EDGE.sub("", low)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC, _NONE = _crc_table(), np.uint32(0xFFFFFFFF)


def _fed(crc: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """crc32 registers after the UTF-8 bytes of one more character each."""
    lead = np.where(chars < 0x80, chars, np.where(chars < 0x800, 0xC0 | chars >> 6, np.where(chars < 0x10000, 0xE0 | chars >> 12, 0xF0 | chars >> 18)))
    crc = _CRC[(crc ^ lead) & 255] ^ (crc >> 8)
    for shift, least in ((12, 0x10000), (6, 0x800), (0, 0x80)):  # the bytes that follow
        on = np.flatnonzero(chars >= least)
        if len(on):
            crc[on] = _CRC[(crc[on] ^ (0x80 | chars[on] >> shift & 63)) & 255] ^ (crc[on] >> 8)
    return crc


def features(words: list[str], lexicon: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """``word_features`` of many cores at once: all numbers in a row, and the count of each core."""
    lettered = np.fromiter((w.isalpha() or any(map(str.isalpha, w)) for w in words), bool, len(words))
    size = np.zeros(len(words), np.int64)
    used = [w for w, some in zip(words, lettered) if some]
    if not used:
        return np.zeros(0, np.int64), size
    known = np.fromiter(map(lexicon.__contains__, used), bool, len(used))
    n = np.fromiter(map(len, used), np.int64, len(used))
    size[lettered] = 6 + (n + 1) + n + known  # affixes, pairs and triples of the marked word, itself
    begin = (np.cumsum(size) - size)[lettered]
    flat = np.empty(int(size.sum()), np.uint32)
    chars = np.frombuffer("".join([f"^{w}$" for w in used]).encode("utf-32-le"), np.uint32)
    start = np.cumsum(n + 2) - (n + 2)  # of the marked words
    for at, mark in ((0, "p"), (3, "s")):
        head = _fed(np.full(len(used), _NONE), np.full(len(used), ord(mark), np.uint32))
        for k in (1, 2, 3):
            crc = head.copy()
            for j in range(k):
                place = np.full(len(used), j) if mark == "p" else n - k + j
                on = np.flatnonzero((place >= 0) & (place < n))
                crc[on] = _fed(crc[on], chars[start[on] + 1 + place[on]])
            flat[begin + at + k - 1] = crc
    pairs = _fed(_fed(np.full(len(chars) - 1, _NONE), chars[:-1]), chars[1:])
    triples = _fed(pairs[:-1], chars[2:])
    flat[ranges(begin + 6, n + 1)] = pairs[ranges(start, n + 1)]
    flat[ranges(begin + 7 + n, n)] = triples[ranges(start, n)]
    flat[(begin + 7 + 2 * n)[known]] = [zlib.crc32(f"w{w}".encode()) ^ 0xFFFFFFFF for w, some in zip(used, known) if some]
    return (~flat & np.uint32(SIZE - 1)).astype(np.int64), size


def tokens(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct tokens of all texts, the place of every token among them, and each text's number of tokens."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), np.diff(lists.offsets.to_numpy())


def _chain(emit: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward vectors (each scaled to sum 1) of one chain.

    ``emit`` (n, k) are the words' factors; where ``first`` is true a document
    begins: whatever came before, its first word has the start weights.
    """
    n, k = emit.shape
    blocks = -(-n // STEP)
    e = np.ones((blocks * STEP, k))
    e[:n] = emit
    new = np.zeros(blocks * STEP, bool)
    new[:n] = first
    new[n:n + 1] = True  # what fills the last block is no neighbour of the last word
    e, new = e.reshape(blocks, STEP, k), new.reshape(blocks, STEP)

    def step(v: np.ndarray, t: int) -> np.ndarray:
        """Rows of v (blocks, ..., k) moved over the words at place t of their blocks."""
        reset = new[:, t].reshape(-1, *[1] * (v.ndim - 1))
        out = np.where(reset, v.sum(axis=-1, keepdims=True) * start, v @ move)
        out *= e[:, t].reshape(blocks, *[1] * (v.ndim - 2), k)
        return out / np.maximum(out.sum(axis=tuple(range(1, v.ndim)), keepdims=True), 1e-300)

    product = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for t in range(STEP):
        product = step(product, t)
    ahead, back = np.empty((blocks, k)), np.empty((blocks, k))
    v = start / start.sum()
    for b in range(blocks):
        ahead[b] = v
        v = v @ product[b]
        v /= max(v.sum(), 1e-300)
    v = np.ones(k) / k
    for b in reversed(range(blocks)):
        back[b] = v
        v = product[b] @ v
        v /= max(v.sum(), 1e-300)
    forward, backward = np.empty_like(e), np.empty_like(e)
    v = ahead
    for t in range(STEP):
        v = step(v, t)
        forward[:, t] = v
    v = back
    for t in reversed(range(STEP)):
        backward[:, t] = v
        w = v * e[:, t]
        v = np.where(new[:, t, None], (w @ start)[:, None], w @ move.T)
        v /= np.maximum(v.sum(axis=1, keepdims=True), 1e-300)
    return forward.reshape(-1, k)[:n], backward.reshape(-1, k)[:n]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (SIZE, languages)
    moves: np.ndarray  # log weights (from, to)
    start: np.ndarray
    lexicon: frozenset[str]

    def __post_init__(self) -> None:
        self._known: dict[str, int] = {}
        self._used = 0
        self._rows = np.zeros((1024, max(1, len(self.languages))))
        self._letters = np.zeros(1024, bool)

    def __getstate__(self):
        return self.languages, self.weights.astype(np.float32), self.moves, self.start, self.lexicon

    def __setstate__(self, state) -> None:
        self.languages, self.weights, self.moves, self.start, self.lexicon = state
        self.__post_init__()

    def _emissions(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._known) > REMEMBERED:
            self.__post_init__()
        known = self._known
        new = [t for t in distinct if t not in known]
        cores = list(map(core, new))
        fresh = [c for c in dict.fromkeys(cores) if c not in known]  # a core is a token of the same features
        at = self._used
        while at + len(fresh) > len(self._rows):
            self._rows = np.concatenate([self._rows, np.zeros_like(self._rows)])
            self._letters = np.concatenate([self._letters, np.zeros_like(self._letters)])
        for k in range(0, len(fresh), 10_000):
            part = fresh[k:k + 10_000]
            flat, size = features(part, self.lexicon)
            sums = np.concatenate([np.zeros((1, self.weights.shape[1])), np.cumsum(self.weights[flat], axis=0, dtype=float)])
            ends = np.cumsum(size)
            self._rows[at + k:at + k + len(part)] = sums[ends] - sums[ends - size]
            self._letters[at + k:at + k + len(part)] = size > 0
        known.update(zip(fresh, range(at, at + len(fresh))))
        known.update(zip(new, map(known.__getitem__, cores)))
        self._used = at + len(fresh)
        place = np.fromiter(map(self._known.__getitem__, distinct), np.int64, len(distinct))
        return self._rows[place], self._letters[place]

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of each word's languages, whether it has letters, and the words of each text."""
        distinct, where, counts = tokens(texts)
        k = len(self.languages)
        if not len(where):
            return np.zeros((0, k)), np.zeros(0, bool), counts
        scores, letters = self._emissions(distinct)
        emit = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -30, 0))[where]
        first = np.zeros(len(where), bool)
        first[(np.cumsum(counts) - counts)[counts > 0]] = True
        forward, backward = _chain(emit, first, np.exp(self.moves), np.exp(self.start))
        return _unit(forward * backward), letters[where], counts

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        p, letters, counts = self.words(texts)
        sums = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(p * letters[:, None], axis=0)])
        n = np.concatenate([[0], np.cumsum(letters)])
        ends = np.cumsum(counts)
        share = (sums[ends] - sums[ends - counts]) / np.maximum(n[ends] - n[ends - counts], 1)[:, None]
        best = share.argmax(axis=1)
        some = n[ends] > n[ends - counts]
        return ([self.languages[b] if s else "und" for b, s in zip(best, some)],
                np.where(some, np.clip(share[np.arange(len(best)), best], 0, 1), 0.0))


def train(texts: list[str], labels: list[str], passes: int = PASSES, batch: int = 24, rate: float = 0.3) -> Model:
    """Adagrad on the chain's log-likelihood; documents are chained in random order."""
    languages = sorted(set(labels))
    k = len(languages)
    model = Model(languages, np.zeros((SIZE, max(1, k))), np.zeros((k, k)), np.zeros(k), frozenset())
    if not k:
        return model
    distinct, where, counts = tokens(pa.array(texts, pa.large_string()))
    used = np.bincount(where, minlength=len(distinct))
    common = sorted((-int(n), w) for t, n in zip(distinct, used) if (w := _EDGE.sub("", t.lower())))[:LEXICON]
    model.lexicon = frozenset(w for _, w in common)
    found = [word_features(t, model.lexicon) for t in distinct]
    size = np.array([len(f) for f in found])
    flat = np.array([i for f in found for i in f], np.int64)
    begin = np.cumsum(size) - size
    truth = np.array([languages.index(x) for x in labels])
    ends = np.cumsum(counts)
    gw, gm, gs = np.full_like(model.weights, 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
    rng = np.random.default_rng(7)
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for b in range(0, len(order), batch):
            part = order[b:b + batch]
            at = np.concatenate([np.arange(ends[d] - counts[d], ends[d]) for d in part])
            gold = np.repeat(truth[part], counts[part])
            if not len(at):
                continue
            ids, inverse = np.unique(where[at], return_inverse=True)
            feats = np.concatenate([flat[begin[i]:begin[i] + size[i]] for i in ids])
            owner = np.repeat(np.arange(len(ids)), size[ids])
            scores = np.zeros((len(ids), k))
            np.add.at(scores, owner, model.weights[feats])
            emit = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -30, 0))[inverse]
            first = np.zeros(len(at), bool)
            first[0] = True
            move = np.exp(model.moves)
            forward, backward = _chain(emit, first, move, np.exp(model.start))
            wrong = _unit(forward * backward)
            pairs = forward[:-1, :, None] * move * (emit[1:] * backward[1:])[:, None, :]
            pairs /= np.maximum(pairs.sum(axis=(1, 2), keepdims=True), 1e-300)
            gain_m = -pairs.sum(axis=0)
            np.add.at(gain_m, (gold[:-1], gold[1:]), 1.0)
            gain_s = -wrong[0]
            gain_s[gold[0]] += 1
            wrong[np.arange(len(at)), gold] -= 1
            by_word = np.stack([np.bincount(inverse, wrong[:, j], len(ids)) for j in range(k)], axis=1)
            gain_w = np.zeros_like(model.weights)
            np.add.at(gain_w, feats, -by_word[owner])
            gain_w = gain_w / len(at) - 1e-7 * model.weights
            gain_m, gain_s = gain_m / len(at) - 1e-4 * model.moves, gain_s / len(at)
            for value, gain, seen in ((model.weights, gain_w, gw), (model.moves, gain_m, gm), (model.start, gain_s, gs)):
                seen += gain * gain
                value += rate * gain / np.sqrt(seen)
    return model


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learns from text and lang of documents that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod(F.col("doc_id"), 4) != 2))
    # ids of at most per_language rows a language; an id with several rows has its largest lang and least text
    chosen = hash_sample(known.select("doc_id", "lang"), "lang", per_language).select("doc_id", "lang")
    sample = texts_of(known, F.broadcast(chosen)).collect()
    sample.sort(key=lambda r: (r.doc_id, r.text))
    return train([r.text for r in sample], [r.lang for r in sample])


def runs(docs: DataFrame, model: Model) -> DataFrame:
    """The stretches of one language in every text: doc_id, run (from 0), first and
    last word, lang, score (mean probability of that language over the run's words
    with letters). Words without letters belong to the run they stand in; a text
    without letters has no run."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "run", "first_word", "last_word", "lang", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in text_slices(batch):
                p, letters, counts = model.words(part.column("text"))
                own = np.flatnonzero(letters)
                if not len(own):
                    continue
                doc = np.repeat(np.arange(len(counts)), counts)[own]
                best = p[own].argmax(axis=1)
                begin = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (best[1:] != best[:-1])]))
                ends = np.append(begin[1:], len(own))
                offsets = (np.cumsum(counts) - counts)[doc[begin]]
                score = np.add.reduceat(p[own, best], begin) / (ends - begin)
                number = np.arange(len(begin)) - np.searchsorted(doc[begin], doc[begin])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc[begin])), pa.array(number, pa.int64()), pa.array(own[begin] - offsets, pa.int64()),
                     pa.array(own[ends - 1] - offsets, pa.int64()), pa.array([model.languages[b] for b in best[begin]], pa.string()),
                     pa.array(np.clip(score, 0, 1), pa.float64())], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, run long, first_word long, last_word long, lang string, score double")


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                names, score = shared.value.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double").select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
