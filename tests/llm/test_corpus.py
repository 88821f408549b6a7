"""The corpus operators against brute force, on odd input and on the small tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopscope.llm import contain, langid, lengths, packing, quality, simhash, suffixes, toxicity, warc, wavelet
from shopscope.llm.encode import Encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, h long, score double"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with clashing names."""
    long = prose(1, 9000)
    texts = [None, "", " \n ", "A", "two words", long, long, prose(2, 300), prose(2, 300) + " more", "x" * 3000,
             prose(3, 200) + "\n" + prose(2, 120), "Ünï cödé ñ 中文 " + prose(4, 30)]
    rows = [(i, t, "en" if i % 2 else None, "s", None, "n", 1, 0.5) for i, t in enumerate(texts)]
    rows += [rows[7], (None, prose(5, 60), None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_encoder_equals_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [None, "", " ", "á ́b", "x<|endoftext|>y z", "it's  '  s\tq\r\nΣΑΣ ΟΔΟΣ İ", "Å ‍\n\n ﬁ ½", "Foo., BAR, .,, é. É, a.b", prose(6, 400)]
    ids, counts = Encoder().flat(pa.array(texts, pa.string()))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_simhash_links_all_pairs_within_reach():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = base[:120] ^ (np.uint64(1) << rng.integers(0, 63, 120, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 63, 120, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, near, np.zeros(1, np.uint64)]))
    leaf, row, lives = simhash.route(fps, simhash.vantage_tree(fps, 9), 3)
    assert sorted(row[lives]) == list(range(len(fps)))
    root = np.arange(len(fps))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k in np.unique(leaf):
        at = row[leaf == k]
        for a, b in zip(*simhash.shard_stars(fps[at], lives[leaf == k], 3)):
            root[find(at[a])] = find(at[b])
    want = np.arange(len(fps))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            want[want == want[j]] = want[i]
    same = np.array([find(i) for i in range(len(fps))])
    assert ((same[:, None] == same[None]) == (want[:, None] == want[None])).all()


def _partition(fps, links):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    groups = {}
    for f in fps:
        groups.setdefault(find(f), set()).add(f)
    return {frozenset(g) for g in groups.values()}


def test_overfull_leaves_get_trees_of_their_own(spark, monkeypatch):
    rng = np.random.default_rng(11)
    base = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (3, 500)).astype(np.uint64), axis=0)
    star = np.uint64(1) << np.arange(64, dtype=np.uint64)  # many at one distance from each other
    fps = np.unique(np.concatenate([base, base ^ flips, star, np.zeros(1, np.uint64)])).view(np.int64)
    depths = []
    cut = simhash._cut
    monkeypatch.setattr(simhash, "SHARD", 4)
    monkeypatch.setattr(simhash, "SAMPLE", 32)
    monkeypatch.setattr(simhash, "CHUNK", 50)
    monkeypatch.setattr(simhash, "_cut", lambda *a: depths.append(a[-1]) or cut(*a))
    links = simhash.near_links(spark.createDataFrame([(int(f),) for f in fps], "fp long")).collect()
    u = fps.view(np.uint64)
    x, y = np.nonzero(np.bitwise_count(u[:, None] ^ u[None]) <= 3)
    assert len(depths) > 1
    assert _partition(fps.tolist(), [(r.a, r.b) for r in links]) == _partition(fps.tolist(), zip(fps[x].tolist(), fps[y].tolist()))


def test_simhash_query(odd, empty):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd).collect()}
    blank = "0" * 16
    assert {(0, blank, 0), (1, blank, 0), (2, blank, 0), (None, blank, 0)} <= got
    assert {r[2] for r in got if r[0] in (5, 6)} == {5}
    assert simhash.near_duplicates(odd).count() == odd.count() and simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and {5} == {r.doc_id for r in kept.collect()} & {5, 6}


def test_keep_one_keeps_a_row_of_every_group(spark, odd):
    a, b, c = prose(40, 50), prose(41, 50), prose(42, 50)
    more = [(None, a), (None, b), (7, c), (7, prose(43, 50)), (8, c), (None, c), (None, None), (9, b)]
    more += [(None, prose(50 + i, 40)) for i in range(5)]
    docs = odd.union(spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in more], SCHEMA))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [simhash.fingerprint((t or "").encode()) & (1 << 64) - 1 for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and group[i] != group[j]:
                group = [group[i] if g == group[j] else g for g in group]
    kept = simhash.keep_one(docs)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == docs.columns and sorted({group[rows.index(r)] for r in got}) == sorted(set(group)) and len(got) == len(set(group))
    smallest = {g: min(((i is None, i) for (i, _), h in zip(rows, group) if h == g), key=lambda x: (x[0], x[1] or 0))[1] for g in set(group)}
    assert all(i == smallest[group[rows.index((i, t))]] for i, t in got)


def test_wavelet_round_trip(odd, empty, spark):
    ids = np.random.default_rng(1).integers(0, 1000, 3000).astype(np.uint32)
    data = wavelet.to_bytes([4, None], np.array([1000, 2000]), ids, 16)
    shard = wavelet.WaveletFile(data)
    m = shard.matrix
    assert (m.all() == ids).all() and shard.doc_ids == [4, None]
    for i in (0, 511, 512, 2999):
        assert m.access(i) == ids[i]
    for v in (int(ids[5]), int(ids[2999]), 65535, 1 << 20):
        assert m.count(v) == int((ids == v).sum()) and m.count(v, 100, 2000) == int((ids[100:2000] == v).sum())
    assert m.locate(int(ids[7])) == np.flatnonzero(ids == ids[7]).tolist()
    enc, start = Encoder(), 0
    got = sorted(wavelet.written_and_read(odd).collect(), key=lambda r: r.start)
    want = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    for r, w in zip(got, want, strict=True):
        own = np.append(enc.flat(pa.array([w.text], pa.string()))[0].astype("<u4"), np.uint32(2))
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (w.doc_id, start, len(own), zlib.crc32(own))
        start += len(own)
    assert wavelet.written_and_read(empty).count() == 0


def test_language_chain_equals_plain_forward_backward():
    rng = np.random.default_rng(0)
    emit, move, start = rng.random((500, 3)) + 0.01, rng.random((3, 3)), rng.random(3)
    first = np.zeros(500, bool)
    first[[0, 120, 121, 400]] = True
    f, b = langid._chain(emit, first, move, start)
    got = langid._unit(f * b)
    for a, z in ((0, 120), (120, 121), (121, 400), (400, 500)):
        alpha, beta = np.zeros((z - a, 3)), np.ones((z - a, 3))
        alpha[0] = start * emit[a]
        for t in range(a + 1, z):
            alpha[t - a] = langid._unit(alpha[t - a - 1] @ move * emit[t])
        for t in range(z - 2, a - 1, -1):
            beta[t - a] = langid._unit(move @ (emit[t + 1] * beta[t - a + 1]))
        assert np.allclose(got[a:z], langid._unit(alpha * beta))


def test_language_of_mixed_and_odd_texts(odd, empty):
    en, fr = "the house and the garden were with this thing", "les maisons et le jardin étaient dans une rue"
    model = langid.train([en] * 20 + [fr] * 20, ["en"] * 20 + ["fr"] * 20, passes=10)
    names, score = model.predict(pa.array([en, fr, None, "", "12 ;; 3"], pa.string()))
    assert names == ["en", "fr", "und", "und", "und"] and (score[:2] > 0.7).all() and (score[2:] == 0).all()
    p, _, counts = model.words(pa.array([en + " " + fr]))
    labels = p.argmax(axis=1)
    assert labels[:6].tolist() == [0] * 6 and labels[-6:].tolist() == [1] * 6 and counts.tolist() == [len(labels)]
    got = langid.predicted(odd, langid.fit(odd)).collect()
    assert len(got) == odd.count() and {r.lang_pred for r in got if r.doc_id in (0, 1, 2)} == {"und"}
    assert langid.predicted(empty, langid.fit(empty)).count() == 0


def test_warc_links_and_nulls(spark):
    html = '<html lang="en"><head><title>T &amp; x</title><script>var t="</p>";</script></head><body><p>One&nbsp;two<br>three</p><!-- no --><a href="/u">go</a>'
    pages = spark.createDataFrame([(1, "http://x/", html, "z"), (2, None, None, None), (None, "", "", "")], "page_id long, url string, html string, record_id string")
    found = warc.responses(pages)
    records = {(r.page_id, r.record_type): r for r in warc.derivatives(found).collect()}
    ids = {r.page_id: r.record_id for r in found.collect()}
    conversion, metadata = records[1, "conversion"], records[1, "metadata"]
    assert conversion.content == "One two\nthree\ngo" and conversion.refers_to == metadata.refers_to == ids[1]
    assert conversion.record_id in metadata.content and "outlink: /u" in metadata.content and "title: T & x" in metadata.content
    assert conversion.block_digest == "sha256:" + hashlib.sha256(conversion.content.encode()).hexdigest()
    assert conversion.source_digest == "sha256:" + hashlib.sha256(html.encode()).hexdigest() and len(records) == 6
    assert records[2, "conversion"].content == "" and f"Content-Length: {len(html)}" in conversion.source_headers
    text = {r.record_id: r.record for r in warc.serialised(warc.derivatives(found)).collect()}
    assert f"WARC-Refers-To: <{ids[1]}>" in text[conversion.record_id]


def test_warc_decodes_all_references_and_reads_all_attribute_forms(spark):
    from html import unescape
    from html.entities import html5

    texts = ["".join(f"x&{n} " for n in html5), "&copy; 2024 &middot; &eacute;&#233;&#xE9;&#XE9 &#0233;", "&amp;lt; &amp;amp;copy; & && &; &# &#x; &#;",
             "&copy2024 &notit; &notin; &nosuch; &AMP", "&#0;&#x110000;&#99999999999;&#xD800;&#128;&#x9f;&#1114111;|&#x1F600;", "no reference", "\n&#10;$1\\&lt;"]
    got = [r.t for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(warc.unescaped(F.col("t")).alias("t")).collect()]
    want = [unescape(t).replace("\u00a0", " ") for t in texts]
    want[4] = want[4].replace("|", "\U0010ffff|")  # unescape leaves noncharacters out
    assert got == want
    html = "<html lang='fr' class=x><a title=t href='/one'>1</a><a href=/two>2</a><A HREF = \"/three\" data-href='/no'>&copy;&#233;</a><a href=\"\">4</a>"
    rows = warc.derivatives(warc.responses(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"))).collect()
    content = {r.record_type: r.content for r in rows}
    assert "language: fr\r\n" in content["metadata"] and content["conversion"] == "12©é4"
    assert [x[9:] for x in content["metadata"].split("\r\n") if x.startswith("outlink: ")] == ["/one", "/two", "/three", ""]


def test_containment_equals_brute_force(spark, odd, empty):
    item, short = prose(2, 40), "just three words"
    changed = " ".join("zz" if i == 20 else w for i, w in enumerate(prose(2, 60).split()))
    items = spark.createDataFrame([(1, item), (2, item), (3, short), (4, None), (5, ""), (6, changed), (7, "Words")], "item_id long, text string")
    docs = odd.union(spark.createDataFrame([(50, "Well " + short, None, None, None, None, None, None), (51, short, None, None, None, None, None, None),
                                            (52, prose(8, 3000) + " JUST three\n words " + prose(9, 30), None, None, None, None, None, None),
                                            (53, "just three more words5 and wordsmiths", None, None, None, None, None, None)], SCHEMA))
    want = set()
    for d in docs.collect():
        own = contain.shingles((d.text or "").encode())
        line = " ".join(["", *(d.text or "").lower().split(), ""])
        for i in items.collect():
            s = contain.shingles((i.text or "").encode())
            words = (i.text or "").lower().split()
            if 0 < len(words) < 5:  # a short item: its words in a row
                if f" {' '.join(words)} " in line:
                    want.add((d.doc_id, i.item_id, 1, 1))
            elif s and len(s & own) >= contain.needed(len(s), 0.8):
                want.add((d.doc_id, i.item_id, len(s), len(s & own)))
    assert {(50, 3), (51, 3), (52, 3), (52, 7)} <= {w[:2] for w in want} and not any(w[0] == 53 for w in want)
    got = contain.contained(docs, items)
    assert {tuple(r)[:4] for r in got.collect()} == want and len(want) > 6 and got.count() == len(want)
    assert contain.contained(empty, items).count() == 0 and contain.contained(docs, items.limit(0)).count() == 0
    kept = contain.without_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - sum(d.doc_id in {w[0] for w in want} for d in docs.collect())


def test_histogram_answers(spark, odd, empty):
    sizes = [3, 3, 7, 5000, 12, 7, 7, 2048, 2047]
    hist = lengths.histogram(spark.createDataFrame([(x,) for x in sizes], "n_tokens long")).cache()
    for r in hist.collect():
        n = r.n_tokens
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (sizes.count(n), sum(x >= n for x in sizes), sum(x for x in sizes if x >= n))
        assert r.truncated_total == sum(min(x, n) for x in sizes) and r.docs_at_most == sum(x <= n for x in sizes)
    for r in lengths.at_limits(hist, [1, 8, 2048, 9999]).collect():
        assert r.truncated_total == sum(min(x, r.context_limit) for x in sizes) and r.docs_at_least == sum(x >= r.context_limit for x in sizes)
    assert {r.q: r.n_tokens for r in lengths.quantiles(hist, [0.5, 1.0]).collect()} == {0.5: 7, 1.0: 5000}
    made = lengths.histogram(lengths.token_lengths(odd))
    assert made.agg({"n_docs": "sum"}).first()[0] == odd.count()
    assert lengths.histogram(lengths.token_lengths(empty)).count() == 0


def spans_by_force(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("hot", [20_000, 0])
def test_repeats_equal_brute_force(spark, odd, empty, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    passage = prose(9, 30)
    more = [prose(10 + i, 40)[: 50 + 13 * i] + passage[i:] + prose(30 + i, 20) for i in range(6)] + ["ab" * 300, "c" * 130, passage[:100], passage[:99]]
    docs = odd.filter("length(text) < 20000 or text is null").union(
        spark.createDataFrame([(100 + i, t, None, None, None, None, None, None) for i, t in enumerate(more)], SCHEMA))
    data = [((r.text or "").encode(), r.doc_id) for r in docs.collect()]
    want = []
    for (t, i), gone in zip(data, spans_by_force([t for t, _ in data], 100)):
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        want.append((i, len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert rows_of(suffixes.report(docs, 100)) == sorted(want, key=repr)
    if hot:
        cut = suffixes.without_repeats(docs, 100)
        assert cut.columns == docs.columns and cut.count() == docs.count() and suffixes.report(empty).count() == 0


def test_quality_counts(spark, odd, empty):
    text = "a b c d e f g a b c d e x ##\n\nsame line\nsame line\n \n"
    docs = odd.union(spark.createDataFrame([(77, text, None, None, None, None, None, None)], SCHEMA))
    got = {r.doc_id: r for r in quality.judged(docs).select(*quality.REPORT).collect()}
    r = got[77]
    assert (r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == (18, 2, 1, 10, True, False)
    assert (got[0].n_words, got[0].kept, got[1].n_dup_lines) == (0, False, 0)
    for d in docs.collect():
        w = [x for x in (d.text or "").replace("\n", " ").split(" ") if x]
        if d.doc_id is not None:
            grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
            on = {i + k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(5)}
            assert (got[d.doc_id].n_words, got[d.doc_id].n_repeat_words) == (len(w), len(on)), d.doc_id
    assert quality.judged(empty).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _row(row, i, x, b)
    return row[-1]


def _row(before, i, x, b):
    now = [i]
    for j, y in enumerate(b, 1):
        now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
    return now


def test_automata_equal_edit_distance():
    words, rng = ["idiot", "trash", "disgusting", "bad"], random.Random(2)
    lexicon = toxicity.Lexicon(words, ["stem"])
    for _ in range(3000):
        w = list(rng.choice(words))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randrange(2)] = rng.choice(["", "x", "i", "st"])
        w = "".join(w)
        near = [d for t in words if (d := edits(w, t)) <= toxicity.edits_allowed(len(t))]
        assert lexicon.distance(w) == min(near, default=-1), w
    assert [lexicon.kind(t) for t in ("trash!", "trsh", "stemming", "plain")] == [1, 2, 3, 0]


def test_stem_families_allow_edits_and_keep_their_words(spark):
    lexicon = toxicity.Lexicon(["achlichen"], ["achlich"], frozenset(["aklich"]))
    # exact word, exact stem, an edit in the word, an edit in the stem before a new ending, two edits there, a harmless near word
    assert [lexicon.kind(t) for t in ("achlichen", "achlichung", "axhlichen", "axhlichung", "axhxichung", "aklich")] == [1, 3, 2, 2, 0, 0]
    rng, stem = random.Random(4), "bomen"
    lexicon = toxicity.Lexicon([], [stem])
    for _ in range(1000):
        w = list(stem + rng.choice(["", "tera", "s", "nt"]))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randrange(2)] = rng.choice(["", "x", "o", "en"])
        w = "".join(w)
        d = min(edits(w[:n], stem) for n in range(len(w) + 1))
        assert lexicon.match(w) == (-1, d if d <= toxicity.edits_allowed(len(stem)) else -1), w
    counts = spark.createDataFrame(
        [("achlich", True, 40.0, 0.0), ("achlichen", False, 20.0, 0.0), ("achlicher", False, 20.0, 0.0), ("fine", False, 50.0, 900.0)],
        "term string, stem boolean, pos double, neg double")
    lexicon = toxicity._lexicon(counts, 100.0, 1000.0)
    assert sorted(lexicon.words) == ["achlichen", "achlicher"] and lexicon.stems == ["achlich"]
    assert [lexicon.kind(t) for t in ("aohlichen", "aohlichst", "fine")] == [2, 2, 0]


def test_rare_terms_enter_the_lexicon_of_a_large_corpus(spark, monkeypatch):
    rows = [("moron", False, 900.0, 0.0), ("rareword", False, 5.0, 0.0), ("chance", False, 2.0, 0.0), ("thin", False, 40.0, 60.0)]
    many = [(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}xyzv", False, 30.0, 0.0) for i in range(400)]
    counts = spark.createDataFrame([*rows, *many, (None, False, 1000.0, 9000.0)], "term string, stem boolean, pos double, neg double")
    assert set(toxicity._lexicon(counts, 1000.0, 9000.0).words) == {"moron", "rareword", *(t for t, *_ in many)}
    # a term is counted in all labelled rows, though the regression sees a few
    docs = spark.createDataFrame([(i, f"{prose(i, 20)} {'' if i % 3 else 'moron' if i > 60 else 'rareword'}", None, None, None, None, None, None)
                                  for i in range(1500)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(1500)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, per_class=20)
    assert {"moron", "rareword"} <= set(model.lexicon.words)


def test_toxicity_context_and_model(spark, odd, empty):
    lexicon = toxicity.Lexicon(["idiot"], [])
    you, said, plain = (toxicity.features(t, lexicon) for t in ("you are an idiot", 'he wrote "idiot" here', "an idiot of sorts"))
    assert (you[1] > 0, said[2] > 0, plain[0] > 0) == (True, True, True)
    rows = [(i, f"{prose(i, 30)} {'moron scum moron' if i % 3 == 0 else 'fine day'}", None, None, None, None, None, None) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(docs, model).collect()
    assert all(r.predicted == (r.doc_id % 3 == 0) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert toxicity.scored(odd, model).count() == odd.count() and toxicity.scored(empty, model).count() == 0
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 200
    assert toxicity.fit(empty, labels.limit(0)).score(["x"]).tolist() == [0.5]


def test_packing_is_whole_and_tight(spark, odd, empty):
    packed = packing.pack(packing.pieces(odd)).collect()
    made = rows_of(packing.pieces(odd))
    assert sorted((tuple(r)[:5] for r in packed), key=repr) == made
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= packing.CAPACITY
    assert len(by) <= -(-sum(r.length for r in packed) // packing.CAPACITY) + 1
    assert packing.pack(packing.pieces(empty)).count() == 0
    ids = packing.pieces(odd, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4")) == r.ids_crc32 for r in ids)


def test_two_documents_replace_the_smallest():
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = [1, 1, 2]
    plan = packing.bins(counts, 10)
    assert plan[0] == (1, [(6, 1), (2, 2)])  # greedy takes 6 + 3; two of 2 fill the gap better
    for seed in range(20):
        counts = np.random.default_rng(seed).integers(0, 9, 101)
        counts[0] = 0
        left = counts.copy()
        for times, own in packing.bins(counts, 100):
            assert sum(x * k for x, k in own) <= 100
            for x, k in own:
                left[x] -= times * k
        assert (left == 0).all()


def test_pipeline_stages_on_odd_and_empty_input(spark, odd, empty, tmp_path):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, prose(3, 20))], "item_id long, text string")
    for name, df in (("labels", labels), ("benchmark", items)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    for i, docs in enumerate((odd, empty)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = f"{tmp_path}/{name}-{i}"
            stage(spark, docs, str(tmp_path)).write.parquet(out)
            docs = spark.read.parquet(out)
            assert k == 4 or docs.columns == odd.columns
