"""Toxicity by a learned lexicon, matched through Levenshtein automata.

Learning (training rows only): words, and stems that several words share, are
counted by class over all labelled rows in a Spark aggregate, and those that
mark label 1 become the lexicon: at least ``LEAST_ROWS`` toxic rows, whatever
the size of the corpus, and a log-likelihood ratio that chance rarely reaches.
Word variants that clean training rows use are noted as harmless. A logistic
regression over a handful of counts of hits gives the score; it learns from at
most about ``PER_CLASS`` rows of each class, chosen by a hash of their id, and
from a copy of each with one letter of every spelled hit changed: what a
misspelled hit weighs is learned from misspelled hits, toxic and clean ones.

Matching: the lexicon is a trie; the Levenshtein automata of all its words are
run over it together. A state is the set of (trie node, edits so far); states
and their moves are made when first needed and kept, so a word costs one table
look-up per letter until it leaves every automaton, which is soon. Words of 4
to 8 letters may have one edit, longer ones two. Stems are nodes of the same
trie that take any ending: a word is on a stem if one of its beginnings is
within the stem's edits. A word on a stem is an entry of its own as well.

Context: a window of ``WINDOW`` words around each hit tells abuse (words of
address) from quotation (quotation marks around it, words of reporting); the
three kinds of hits are counted apart.

A null or empty text scores as a text without hits. A null id counts as the
empty text, whose remainder holds it out; repeated rows are scored each. An id
with several rows or labels is learned from once: its least text, its larger label. With
no labelled training rows every score is 0.5; with one class only, that class's.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.common import crc_mod, hash_sample, released, saved, text_slices, texts_of

#: Bound on the labelled rows of each class that the regression learns from (about; by hash).
PER_CLASS = 4000
#: What a term needs to be an entry: toxic rows, and a log-likelihood ratio (15.1: chance reaches it once in 10,000 terms).
LEAST_ROWS, LEAST_RATIO = 3, 15.1
#: Bounds on lexicon entries and harmless words, only so that they fit the
#: driver and a broadcast: a term has at most 24 letters, so at most 2 MB and 20 MB.
ENTRIES, HARMLESS = 20_000, 200_000
#: Stems are the first letters shared by words.
STEM_LENGTHS = (4, 5, 6, 7)
WINDOW = 6
#: Fixed word lists of the context window.
ADDRESS = frozenset("you your youre yourself u ur tu te toi vous votre ton ta du dich dein deine ihr euch tú usted vos".split())
REPORTING = frozenset("said says wrote called quote quoted quoting word term dit écrit cité citation sagte schrieb zitat wort dijo escribió cita palabra".split())
OPEN, CLOSE = "\"“«„‚‘'", "\"”»“’‘'"
_EDGE = re.compile(r"^\W+|\W+$")
#: Words, and trie nodes in automaton states, remembered by a worker before it starts anew.
REMEMBERED, HELD = 300_000, 2_000_000
#: The moves of a state that no letter has left yet.
_NO_MOVES: dict[str, int] = {}


def edits_allowed(length: int) -> int:
    return 0 if length < 4 else 1 if length < 9 else 2


class Lexicon:
    """Trie of words and stems, intersected with their Levenshtein automata; a stem accepts any ending.

    ``like``, a lexicon of the same entries with other harmless words, lends its automata."""

    def __init__(self, words: list[str], stems: list[str], harmless: frozenset[str] = frozenset(), like: Lexicon | None = None) -> None:
        self.words, self.stems, self.harmless, self._like = list(words), list(stems), harmless, like
        self._restart()

    def __getstate__(self):
        return self.words, self.stems, self.harmless, self._like

    def __setstate__(self, state) -> None:
        self.words, self.stems, self.harmless, self._like = state
        self._restart()

    def _restart(self) -> None:
        self._seen: dict[str, int] = {}
        if self._like is not None:
            return
        self._next: list[dict[str, int]] = [{}]
        self._word: dict[int, int] = {}  # trie node -> letters of the word that ends there
        self._stem: dict[int, int] = {}  # the same of a stem
        self._most: list[int] = [0]  # most edits any entry below the node may have
        for w, ends in [*((w, self._word) for w in self.words), *((w, self._stem) for w in self.stems)]:
            at, allowed = 0, edits_allowed(len(w))
            self._most[0] = max(self._most[0], allowed)
            for c in w:
                if c not in self._next[at]:
                    self._next[at][c] = len(self._next)
                    self._next.append({})
                    self._most.append(0)
                at = self._next[at][c]
                self._most[at] = max(self._most[at], allowed)
            ends[at] = allowed
        self._forget()

    def forget(self) -> None:
        """Drops what was remembered of words and states; both are made again when needed."""
        self._seen = {}
        (self._like or self)._forget()

    def _forget(self) -> None:
        self._states: dict[bytes, int] = {}
        self._sets: list[bytes] = []  # sorted node * 4 + edits, four bytes each
        self._moves: list[dict[str, int]] = []
        self._accepts: list[int] = []
        self._stem_accepts: list[int] = []
        self._held = 0
        self._start = self._state({0: 0})

    def _state(self, active: dict[int, int]) -> int:
        todo = list(active.items())
        while todo:  # a letter of the lexicon word left out
            node, e = todo.pop()
            if active.get(node) != e or e >= self._most[node]:
                continue
            for child in self._next[node].values():
                if e + 1 <= self._most[child] and e + 1 < active.get(child, 99):
                    active[child] = e + 1
                    todo.append((child, e + 1))
        key = array("I", sorted(node * 4 + e for node, e in active.items())).tobytes()
        if key not in self._states:
            self._states[key] = len(self._sets)
            self._sets.append(key)
            self._moves.append(_NO_MOVES)
            self._held += len(active)
            for ends, accepts in ((self._word, self._accepts), (self._stem, self._stem_accepts)):
                accepts.append(min((e for node, e in active.items() if node in ends and e <= ends[node]), default=-1))
        return self._states[key]

    def _move(self, state: int, c: str) -> int:
        active: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= self._most[node] and e < active.get(node, 99):
                active[node] = e

        for packed in memoryview(self._sets[state]).cast("I"):
            node, e = packed >> 2, packed & 3
            if e >= self._most[node]:  # no edit is left: the letter itself or nothing
                if c in self._next[node]:
                    reach(self._next[node][c], e)
                continue
            reach(node, e + 1)  # a letter too many
            for letter, child in self._next[node].items():
                reach(child, e + (letter != c))  # the letter itself, or another in its place
        to = self._state(active) if active else -1
        if self._moves[state] is _NO_MOVES:
            self._moves[state] = {}
        self._moves[state][c] = to
        return to

    def match(self, word: str) -> tuple[int, int]:
        """Edits to the nearest lexicon word, and from a beginning of the word
        to the nearest stem, each within its allowance; -1 for none."""
        if self._like is not None:
            return self._like.match(word)
        if self._held > HELD:
            self._forget()
        state, moves, stem = self._start, self._moves, -1
        for c in word:
            to = moves[state].get(c)
            if to is None:
                to = self._move(state, c)
            if to < 0:
                return -1, stem
            state = to
            on = self._stem_accepts[state]
            if on >= 0 and (stem < 0 or on < stem):
                stem = on
        return self._accepts[state], stem

    def distance(self, word: str) -> int:
        """Edits to the nearest lexicon word within its allowance; -1 for none."""
        return self.match(word)[0]

    def kind(self, token: str) -> int:
        """0 no hit, 1 a lexicon word, 2 a misspelled one or a misspelled stem, 3 another word on a lexicon stem."""
        return min(found, 2) if (found := self.family(token)) != 3 else 3

    def family(self, token: str) -> int:
        """As ``kind``, but a word on a misspelled stem is 4."""
        word = _EDGE.sub("", token)
        d, stem = self.match(word)
        if d == 0 or stem == 0:
            return 1 if d == 0 else 3
        if (d > 0 or stem > 0) and word not in self.harmless:
            return 2 if d > 0 else 4
        return 0

    def hits(self, tokens: list[str]) -> list[tuple[int, int]]:
        """(position, family) of the hits among lower-case tokens."""
        if len(self._seen) > REMEMBERED:
            self._seen = {}
        seen = self._seen
        distinct = set(tokens)
        for token in distinct:
            if token not in seen:
                seen[token] = self.family(token)
        hot = {t: k for t in distinct if (k := seen[t])}
        return [(i, hot[t]) for i, t in enumerate(tokens) if t in hot] if hot else []


def _context(tokens: list[str], i: int) -> int:
    """0 plain, 1 address (abuse), 2 quotation, from the window around a hit."""
    around = tokens[max(0, i - WINDOW):i + WINDOW + 1]
    before, after = tokens[max(0, i - WINDOW):i + 1], tokens[i:i + WINDOW + 1]
    if any(t[0] in OPEN for t in before) and any(t[-1] in CLOSE for t in after):
        return 2
    plain = {_EDGE.sub("", t) for t in around}
    return 2 if plain & REPORTING else 1 if plain & ADDRESS else 0


def misspelled(text: str | None, lexicon: Lexicon) -> str:
    """The text in lower case with one letter of every hit that is spelled as in the lexicon replaced."""
    tokens = (text or "").lower().split()
    for i, kind in lexicon.hits(tokens):
        if kind % 2:
            token = tokens[i]
            begin = len(token) - len(_EDGE.sub("", token)) if not token[0].isalpha() else 0
            at = min(begin + zlib.crc32(token.encode()) % max(1, len(_EDGE.sub("", token))), len(token) - 1)
            tokens[i] = token[:at] + ("x" if token[at] != "x" else "q") + token[at + 1:]
    return " ".join(tokens)


KINDS, FEATURES = 4, 17


def features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """Counts of hits by kind and context, as logarithms, and their share of the words."""
    tokens = (text or "").lower().split()
    x = np.zeros(FEATURES)
    hits = lexicon.hits(tokens)
    for i, kind in hits:
        x[3 * (kind - 1) + _context(tokens, i)] += 1
    by_kind = x[:3 * KINDS].reshape(KINDS, 3).sum(axis=1)
    if hits:
        x[12] = 100 * by_kind[:3].sum() / len(tokens)
    x[13:] = by_kind >= 2
    x[:13] = np.log1p(x[:13])
    return x


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    bias: float = 0.0

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts]).reshape(-1, FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def _terms(text: str) -> Iterator[tuple[str, bool]]:
    """Words (False) of a text, and stems (True) that at least two different words of it begin with."""
    words = {w for t in set(text.lower().split()) if (w := t if t.isalpha() else _EDGE.sub("", t)).isalpha() and 3 <= len(w) <= 24}
    for w in words:
        yield w, False
    for n in STEM_LENGTHS:
        stems: dict[str, int] = {}
        for w in words:
            if len(w) > n:
                stems[w[:n]] = stems.get(w[:n], 0) + 1
        for stem, k in stems.items():
            if k >= 2:
                yield stem, True


def term_counts(labelled: DataFrame) -> DataFrame:
    """(term, stem, pos, neg, neg0, neg1): how many rows of each label have the
    term, and of label 0 in either half of the rows; all rows under the null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                found: dict[tuple[str | None, bool], list[int]] = {}
                for text, label, half in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "half"))):
                    for term in ((None, False), *_terms(text or "")):
                        found.setdefault(term, [0, 0, 0])[0 if label else 1 + half] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in found], pa.string()), pa.array([s for _, s in found], pa.bool_()),
                     *(pa.array([v[k] for v in found.values()], pa.float64()) for k in range(3))], ["term", "stem", "pos", "neg0", "neg1"])

    rows = labelled.select("text", "toxic", _half().alias("half")).mapInArrow(
        run, "term string, stem boolean, pos double, neg0 double, neg1 double")
    sums = rows.groupBy("term", "stem").agg(*(F.sum(c).alias(c) for c in ("pos", "neg0", "neg1")))
    return sums.withColumn("neg", F.col("neg0") + F.col("neg1"))


def _half() -> Column:
    """0 or 1, by a hash of the id."""
    return F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int")


def _ratio(pos: float, neg: float) -> Column:
    """Log-likelihood ratio (G squared) of a term's rows in the two classes against equal shares."""
    p, n, share = F.col("pos"), F.col("neg"), pos / (pos + neg)
    cells = ((p, (p + n) * share), (n, (p + n) * (1 - share)), (pos - p, (pos + neg - p - n) * share), (neg - n, (pos + neg - p - n) * (1 - share)))
    return sum((F.when(seen > 0, 2 * seen * F.log(seen / due)).otherwise(0.0) for seen, due in cells), F.lit(0.0))


def _lexicon(counts: DataFrame, pos: float, neg: float) -> Lexicon:
    """The lexicon alone, of counts without halves."""
    return _lexicons(counts.withColumn("neg0", F.col("neg")).withColumn("neg1", F.lit(0.0)), pos, neg)[0]


def _lexicons(counts: DataFrame, pos: float, neg: float) -> tuple[Lexicon, list[Lexicon]]:
    """The entries that mark label 1, best first as far as ``ENTRIES``; then the harmless near words among the counts.

    Also the lexicon as each half of the rows may see it while weights are
    learned: a row's own clean words must not count as known to be harmless, or
    the near words of unseen texts would look like abuse.
    """
    odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    counts = counts.filter(F.col("term").isNotNull())
    enough = (F.col("pos") >= LEAST_ROWS) & (_ratio(pos, neg) >= LEAST_RATIO)
    best = counts.withColumn("odds", odds).filter(enough & (F.col("odds") > 3.0)).orderBy(
        F.desc(F.col("odds") * F.col("pos")), "term", "stem").limit(ENTRIES).collect()
    stems: list[str] = []
    chosen, heads = set(), set()
    for r in best:  # the best stem of a family stands for it
        begins = {r.term[:n] for n in range(1, len(r.term) + 1)}
        if r.stem and r.term not in heads and not begins & chosen:
            stems.append(r.term)
            chosen.add(r.term)
            heads |= begins
    words = [r.term for r in best if not r.stem]
    lexicon = Lexicon(words, stems)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([max(lexicon.match(t)) > 0 for t in batch.column("term").to_pylist()], pa.bool_()))
        lexicon.forget()
        released()

    # words within the automata that clean rows use, the most used first
    clean = counts.filter(~F.col("stem") & (F.col("neg") > 0) & (F.col("neg") * pos > 0.2 * F.col("pos") * neg))
    harmless = clean.select("term", "neg", "neg0", "neg1").mapInArrow(near, "term string, neg double, neg0 double, neg1 double").orderBy(
        F.desc("neg"), "term").limit(HARMLESS).collect()
    others = [frozenset(r.term for r in harmless if r[f"neg{1 - half}"] > 0) for half in (0, 1)]
    first = Lexicon(words, stems, others[0])
    return Lexicon(words, stems, frozenset(r.term for r in harmless)), [first, Lexicon(words, stems, others[1], like=first)]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    w = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + penalty @ w
        hessian = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learns from labelled documents outside the held-out fifth."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & (crc_mod(F.col("doc_id"), 5) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = hash_sample(known, "toxic", per_class)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the chosen ids are bounded by per_class, so no text is shuffled but theirs
    sample = saved(texts_of(texts, F.broadcast(chosen)), "labelled")
    totals = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
    pos, neg = totals.get(1, 0.0), totals.get(0, 0.0)
    if not pos or not neg:
        return Model(Lexicon([], []), bias=30.0 if pos else -30.0 if neg else 0.0)
    # every labelled text goes to its label once
    counts = saved(term_counts(texts_of(texts, known)), "terms")
    every = counts.filter(F.col("term").isNull()).first()
    lexicon, halves = _lexicons(counts, every.pos, every.neg)
    model, shared = Model(lexicon), spark.sparkContext.broadcast(halves)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                texts = [(t, shared.value[half]) for t, half in zip(part.column("text").to_pylist(), part.column("half").to_pylist())]
                for spelled in (lambda t, _: t, misspelled):
                    x = [features(spelled(t, lexicon), lexicon).tolist() for t, lexicon in texts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.list_(pa.float64())), part.column("toxic"), part.column("weight")], ["x", "toxic", "weight"])
        for each in shared.value:
            each.forget()
        released()

    rows = sample.select("text", "toxic", "weight", _half().alias("half")).mapInArrow(count, "x array<double>, toxic int, weight double")
    # equal rows of counts are one row with their weight: the driver gets at most the bounded sample
    rows = rows.groupBy("x", "toxic").agg(F.sum("weight").alias("weight")).orderBy("x", "toxic").collect()
    model.weights, model.bias = logistic(
        np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float), np.array([r.weight for r in rows]) * 2000 / (pos + neg))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                score = shared.value.score(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])
        released()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, batch.schema.names[at]):
                yield part.filter(pa.array(shared.value.score(part.column(at).to_pylist()) < 0.5))
        released()

    return docs.mapInArrow(run, docs.schema)
