import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopscope.llm import bytebpe
from tests.conftest import SF_SMALL

ODD = [None, "", " ", "  ", "a", "don't we'll they've I'd 's ''s 'll 'lx 'rx 're 've! it's's", "x\n 's \n\n  y ", "\t'm", "a  b\r\n", "don'", "'r", "'l",
       "naïve 漢字 １２３ ½ x²", "<|endoftext|> is plain", "é" * 700, "a" * 5000, " " * 3000 + "z", " 　 x", "\x1c\x1d a", "😀😀 '😀", "A'S 'T", "9's9'll"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.vocabulary(bytebpe.BYTE_BPE), special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bytebpe.Encoder(bytebpe.classes())


def encoded(coder, texts):
    ids, counts = coder.flat(*bytebpe.text_bytes(pa.array(texts, pa.string())))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_odd_texts_equal_the_library(coder, library):
    assert encoded(coder, ODD) == [library.encode_ordinary(t or "") for t in ODD]


def test_every_code_point_has_the_librarys_class(coder, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c}'" for c in points[k:k + 5000]) for k in range(0, len(points), 5000)]
    assert encoded(coder, texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=400, deadline=None, derandomize=True)
@given(st.lists(st.text(st.sampled_from("a'strevlmdx 1\n\t.!é漢")), min_size=1, max_size=5))
def test_short_mixed_texts(texts):
    import public_tokenizers
    import tiktoken

    global _SHARED
    if "_SHARED" not in globals():
        ranks = bytebpe.vocabulary(bytebpe.BYTE_BPE)
        _SHARED = (bytebpe.Encoder(bytebpe.classes()),
                   tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    assert encoded(_SHARED[0], texts) == [_SHARED[1].encode_ordinary(t) for t in texts]


def test_scan_equals_one_character_after_another(monkeypatch):
    rng = np.random.default_rng(5)
    for n, width in ((1, 4), (17, 4), (5000, 64), (5000, 1024), (70000, 1024)):
        monkeypatch.setattr(bytebpe, "BLOCK", width)
        for few in (False, True):  # few constant functions: blocks stay open
            kinds = rng.choice([0, 1, 2, 3, 4, 8], n).astype(np.uint8) if few else rng.integers(0, 10, n).astype(np.uint8)
            kinds[0] += 10
            state, want = bytebpe.BLANK, []
            for k in kinds:
                state = bytebpe._TO[k, state]
                want.append(state)
            assert bytebpe.states(kinds).tolist() == want


def test_forgetting_changes_nothing(monkeypatch, coder, library):
    monkeypatch.setattr(bytebpe, "REMEMBERED", 3)
    for t in ODD:
        assert encoded(coder, [t, t]) == [library.encode_ordinary(t or "")] * 2


def digest(ids, text):
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_tables_equal_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(i % 5 if i % 3 else None, t, "x", "y", 0) for i, t in enumerate(ODD * 2)], docs.schema)
    for table in (docs, odd, docs.limit(0)):
        want = sorted((r.doc_id is None, r.doc_id or 0, *digest(library.encode_ordinary(r.text or ""), r.text)) for r in table.collect())
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bytebpe.digests(table).collect())
        assert got == want


def test_offsets_and_decoding_round_trip(spark):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(ODD)], "doc_id long, text string, ids long")
    rows = bytebpe.encoded(docs)
    back = {r.doc_id: bytes(r.decoded) for r in bytebpe.decoded(rows).collect()}
    words = {i: t for t, i in bytebpe.vocabulary(bytebpe.BYTE_BPE).items()}
    for r in rows.collect():
        data = (ODD[r.doc_id] or "").encode()
        assert back[r.doc_id] == data
        assert all(data[o:o + len(words[i])] == words[i] for i, o in zip(r.ids, r.offsets))
