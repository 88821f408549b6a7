"""Exact batch encoding with a public word-BPE tokenizer.

The tokenizer drops white space and never joins characters across it, so a
text's ids are the ids of its blank-separated chunks in a row. A batch's distinct
chunks are taken apart by column operations: a plain Latin word in lower case and the
ASCII marks after it, or the chunk as it is. A piece met again takes its ids from a
bounded table, which is far cheaper than encoding the repeated words of a corpus
each time. New words are encoded in one call (every word ends in a token marked as
an end), marks once for all words; any other chunk is encoded alone. Tests hold the
result against ``Tokenizer.encode`` of whole texts.
"""

from __future__ import annotations

import os
from itertools import chain, repeat
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shopscope.llm.common import ranges, worker_file

WORD_BPE = "word_bpe_49k.json"
#: Chunks remembered by one worker before its table starts anew.
REMEMBERED = 600_000
#: A word of letters that Unicode's composition (NFC) leaves alone, being below U+0300, and that stay letters in lower case.
_PLAIN = "^[" + "".join(f"\\x{{{c:x}}}" for c in range(0x300) if chr(c).isalpha() and chr(c).lower().isalpha()) + "]+$"


class Encoder:
    """``flat(texts)`` gives the ids of all texts in a row and each text's count."""

    def __init__(self, name: str = WORD_BPE) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(worker_file(name))
        self._words, self._ascii = Tokenizer(self._tokenizer.model), Tokenizer(self._tokenizer.model)  # of one model
        self._words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()  # ByteLevel leaves ASCII letters as they are
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self._ends[i] = token.endswith("</w>")
        self.size = len(self._ends)
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._ids = np.zeros(1 << 16, np.uint16)
        self._used = 0
        self._start = np.zeros(1 << 12, np.uint32)
        self._count = np.zeros(1 << 12, np.uint32)

    def _add(self, chunks: list[str], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        first, n, total = len(self._known), len(chunks), len(ids)
        while self._used + total > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while first + n > len(self._start):
            self._start = np.concatenate([self._start, np.zeros_like(self._start)])
            self._count = np.concatenate([self._count, np.zeros_like(self._count)])
        self._ids[self._used:self._used + total] = ids
        self._start[first:first + n] = self._used + np.cumsum(counts) - counts
        self._count[first:first + n] = counts
        self._used += total
        self._known.update(zip(chunks, range(first, first + n)))
        return np.arange(first, first + n)

    def _places(self, pieces: pa.Array, plain: np.ndarray) -> np.ndarray:
        """Places in the table of distinct pieces (plain words or anything else); new ones are encoded."""
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self._known.get, names, repeat(-1)), np.int64, len(names))
        new = place < 0
        if new.any():
            is_ascii = pc.string_is_ascii(pieces).to_numpy(zero_copy_only=False)
            for known_as, chosen in ((self._ascii, new & plain & is_ascii), (self._words, new & plain & ~is_ascii)):
                every = np.flatnonzero(chosen)
                for k in range(0, len(every), 5000):
                    part = [names[i] for i in every[k:k + 5000].tolist()]
                    ids = np.array(known_as.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int64)
                    last = np.flatnonzero(self._ends[ids])
                    place[every[k:k + 5000]] = self._add(part, ids, np.diff(last, prepend=-1))
            every = np.flatnonzero(new & ~plain)
            if len(every):
                odd = [names[i] for i in every.tolist()]
                found = [e.ids for e in self._tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
                counts = np.fromiter(map(len, found), np.int64, len(found))
                place[every] = self._add(odd, np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts)
        return place

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks in a row, and their counts. A plain word followed by ASCII marks
        has its word's ids and the marks' (a run of marks is a piece of its own wherever it stands)."""
        core = pc.ascii_rtrim(chunks, characters=punctuation)
        is_plain = pc.match_substring_regex(core, _PLAIN)
        plain = is_plain.to_numpy(zero_copy_only=False)
        words = pc.if_else(is_plain, pc.utf8_lower(core), chunks).dictionary_encode()
        of = words.indices.to_numpy()
        plain_words = np.zeros(len(words.dictionary), bool)
        plain_words[of] = plain
        place = np.full((len(chunks), 2), -1)
        place[:, 0] = self._places(words.dictionary, plain_words)[of]
        size = np.where(plain, pc.subtract(pc.binary_length(chunks), pc.binary_length(core)).to_numpy(), 0)
        marked = np.flatnonzero(size)
        if len(marked):
            size = size[marked]
            ends = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset + 1:chunks.offset + 1 + len(chunks)][marked]
            text = np.frombuffer(chunks.buffers()[2], np.uint8)[ranges(ends - size, size)]
            offsets = np.concatenate([[0], np.cumsum(size)])
            marks = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(text)).dictionary_encode()
            place[marked, 1] = self._places(marks.dictionary, np.zeros(len(marks.dictionary), bool))[marks.indices.to_numpy()]
        counts = np.where(place < 0, 0, self._count[place]).astype(np.int64)
        return self._ids[ranges(self._start[place].reshape(-1).astype(np.int64), counts.reshape(-1))], counts.sum(axis=1)

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint16) of all texts one after another, and the count of each; null is empty."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        if len(self._known) > REMEMBERED:
            self._forget()
        ids, counts = self._chunks(coded.dictionary)
        where = coded.indices.to_numpy()
        starts = (np.cumsum(counts) - counts)[where]
        counts = counts[where]
        ids = ids[ranges(starts, counts)]
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(before[bounds])


_OF_WORKER: dict[str, Encoder] = {}


def encoder(name: str = WORD_BPE) -> Encoder:
    """The worker's encoder: loaded once, its table shared by the tasks that follow each other."""
    if name not in _OF_WORKER:
        _OF_WORKER[name] = Encoder(name)
    return _OF_WORKER[name]
