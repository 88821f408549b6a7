import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shopscope.llm import alignment, bytebpe
from tests.conftest import SF_SMALL

ODD = [None, "", " ", "  ", "   x  ", "don't stop", "naïve 漢字 ½ ﬁne", "a▁b", "a ▁ b", "<s> and <|endoftext|> </s> <unk>", "line\nbreak\r\n\ttab", "😀😀 ok", "é" * 300,
       "internationalisation " * 40, "x" * 3000, "\u0000 nul", " leading", "é", "  nbsp "]


class Force:
    """Whole texts through the libraries, pairs by comparing all ranges."""

    def __init__(self):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_BPE))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES))
        self.letters = bytebpe.byte_letters()

    def tokens(self, text):
        whole = (" " + text).encode() if text else b""
        if not text:
            return [], []
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def rows(self, texts):
        found = []
        for t in texts:
            a, b = self.tokens(t)
            spans = []
            for side in (a, b):
                at, s = 0, []
                for i, x in side:
                    s.append((at, at + len(x), i))
                    at += len(x)
                spans.append(s)
            links, j = [], 0
            for s, e, i in spans[0]:
                while j and spans[1][j - 1][1] > s:
                    j -= 1
                while spans[1][j][1] <= s:
                    j += 1
                k = j
                while k < len(spans[1]) and spans[1][k][0] < e:
                    links.append((i, spans[1][k][2]))
                    k += 1
            common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
            low, parts = 0, []
            for c in common:
                parts.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= c) for side in spans))
                low = c
            found.append((a, b, links, len(common), hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
        counts = Counter(p for f in found for p in set(f[2]))
        most = {}
        for (i, _), n in counts.items():
            most[i] = max(most.get(i, 0), n)
        return [(len(a), len(b), g, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), sha)
                for a, b, links, g, sha in found]


@pytest.fixture(scope="module")
def force():
    return Force()


def held(table, force):
    given = table.collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    want = sorted(((r.doc_id is None, r.doc_id or 0), w) for r, w in zip(given, force.rows([r.text for r in given])))
    got = sorted(((r.doc_id is None, r.doc_id or 0), tuple(r[n] for n in names)) for r in alignment.report(table).collect())
    assert got == want


@pytest.mark.parametrize("chunk", [alignment.CHUNK_BYTES, 1])
def test_tables_equal_force(spark, force, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", chunk)  # workers forked later see it; results do not depend on it
    schema = "doc_id long, text string, chunk long, pair int, n_a string"
    odd = spark.createDataFrame([(i % 7 if i % 3 else None, t, 1, 2, "x") for i, t in enumerate(ODD * 2)], schema)
    held(odd, force)
    held(spark.createDataFrame([], schema), force)


def test_documents_equal_force(spark, force):
    held(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), force)


def test_gallop_counts_the_smaller_ones():
    rng = np.random.default_rng(2)
    for n, m in ((0, 5), (5, 0), (1, 1), (30, 4000), (500, 700)):
        longer = np.sort(rng.choice(10_000, m, replace=False))
        values = np.sort(rng.choice(10_000, n, replace=False))
        for start in (np.zeros(n, np.int64), np.full(n, m), rng.integers(0, m + 1, n)):
            got = alignment.gallop(values, longer, np.zeros(n, np.int64), np.full(n, m), start)
            assert got.tolist() == np.searchsorted(longer, values).tolist()


def test_chunks_of_any_size_hold_the_same(force):
    tool = alignment.Aligner(bytebpe.classes())
    for texts in (ODD, ODD[:1], ["a"], [None]):
        found = tool.aligned(pa.array(texts, pa.string()))
        rows = force.rows(texts)
        assert found["n_links"].tolist() == [r[3] for r in rows] and found["n_groups"].tolist() == [r[2] for r in rows]
        assert tool.written(found) == [r[6] for r in rows]


def test_groups_cover_the_text(spark, force):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    rows = alignment.groups(table).collect()
    tokens = [dict(a) | {("b", i): x for i, x in b} for a, b in map(force.tokens, ODD)]
    for i, text in enumerate(ODD):
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.group)
        at = 0
        for k, r in enumerate(mine):
            data = b"".join(tokens[i][x] for x in r.a_ids)
            assert (r.group, r["at"]) == (k, at) and data == b"".join(tokens[i]["b", x] for x in r.b_ids)
            at += len(data)
        assert at in (0, len(" " + (text or "")) if text is None else len((" " + text).encode()))
