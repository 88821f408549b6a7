"""Names, repeated ids, misspellings, word runs, rank/select over shards, small shards."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopscope.llm import contain, langid, lengths, simhash, suffixes, toxicity, wavelet
from shopscope.llm.common import documents, table
from tests.conftest import SF_SMALL
from tests.llm.test_corpus import prose


def test_wavelet_operators_count_and_locate_over_shards(spark):
    docs = documents(spark, SF_SMALL)
    folder = f"{wavelet.shared_uri(spark)}/wavelet-test"
    files = wavelet.write(docs, folder, file_tokens=20_000).count()
    assert files > 1
    force = {r.doc_id: np.frombuffer(r.ids, "<u2").astype(int) for r in wavelet.encoded(docs).collect()}
    ids = [2, 0, 267, 539, 49407, 70_000, -1]
    got = {r.id: (r.n, r.n_docs) for r in wavelet.counts(spark, folder, ids).collect()}
    assert got == {i: (sum(int((v == i).sum()) for v in force.values()), sum(bool((v == i).any()) for v in force.values())) for i in ids}
    found = sorted((r.id, r.doc_id, r.place) for r in wavelet.located(spark, folder, [267, 2, 70_000]).collect())
    assert found == sorted((i, d, int(p)) for d, v in force.items() for i in (267, 2) for p in np.flatnonzero(v == i))


def test_hot_ids_are_spread_and_read_back(spark):
    rows = [(None if i % 2 else 7, prose(i % 9, 5 + i % 30)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = wavelet.written_and_read(docs).orderBy("start").collect()
    assert len(got) == 400 and [r.doc_id for r in got] == [None] * 200 + [7] * 200
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()


@pytest.mark.parametrize("segments", [3, 50, 10_000])
def test_shards_of_any_size_find_the_same(spark, monkeypatch, segments):
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(97, 101, 6)).decode() for _ in range(40)]
    shared = " ".join(rng.choice(words, 30))
    docs = spark.createDataFrame(
        [(i, " ".join(rng.choice(words, 20)) + (shared if i % 2 else "") + " ".join(rng.choice(words, 8))) for i in range(60)], "doc_id long, text string")
    monkeypatch.setattr(suffixes, "SEGMENTS", 10_000)
    want = sorted(map(tuple, suffixes.report(docs, 60).collect()))
    monkeypatch.setattr(suffixes, "SEGMENTS", segments)
    assert sorted(map(tuple, suffixes.report(docs, 60).collect())) == want and sum(r[2] for r in want) > 0


def test_learning_does_not_depend_on_the_partitioning(spark):
    rows, labels = [], []
    for i in range(120):
        for copy in range(2):  # every id has two texts and two labels
            rows.append((i, prose(2 * i + copy, 20) + (" you grotzel grotzels" if copy else "")))
            labels.append((i, (i + copy) % 2))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scores = []
    for n in (1, 3, 7):
        model = toxicity.fit(docs.repartition(n), marks.repartition(n))
        scores.append((model.score(["you grotzel", "calm words"]).tolist(), model.weights.tolist()))
    assert scores[0] == scores[1] == scores[2]
    langs = spark.createDataFrame([(i % 30, t, "ab"[i % 2]) for i, (_, t) in enumerate(rows)], "doc_id long, text string, lang string")
    weights = [langid.fit(langs.repartition(n)).weights.sum() for n in (1, 5)]
    assert weights[0] == weights[1]


def test_misspelled_hits_are_caught(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.01"), table(spark, "/root/testdata/sf0.01", "labels")
    model = toxicity.fit(docs, labels)
    held = docs.join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).select("text", "toxic").collect()
    toxic, clean = ([r.text for r in held if r.toxic == y] for y in (1, 0))
    edited = [" ".join(
        t[:len(t) // 2] + ("z" if t[len(t) // 2] != "z" else "y") + t[len(t) // 2 + 1:] if k else t
        for t, k in ((t, model.lexicon.kind(t)) for t in (x or "").lower().split())) for x in toxic]  # another rule than the fit's copies
    plain, changed = (model.score(x) >= 0.5 for x in (toxic, edited))
    assert changed.sum() >= 0.8 * plain.sum() > 0
    assert (model.score(clean) >= 0.5).mean() <= 0.04


def test_language_runs_follow_the_words(spark):
    train = [(i, prose(i, 40), "en") for i in range(40)] + [(100 + i, " ".join(w[::-1] + "oz" for w in prose(i, 40).split()), "zz") for i in range(40)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    other = " ".join(w[::-1] + "oz" for w in prose(3, 12).split())
    mixed = spark.createDataFrame([(1, f"{prose(70, 12)} {other}"), (2, None), (3, "12 --"), (None, f"... {other}")], "doc_id long, text string")
    rows = sorted(langid.runs(mixed, model).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.run))
    p, letters, counts = model.words(pa.array([r.text for r in mixed.orderBy(F.asc_nulls_last("doc_id")).collect()], pa.string()))
    best = np.array(model.languages)[p.argmax(axis=1)]
    labels = [{i: best[s + i] for i in range(n) if letters[s + i]} for s, n in zip(np.cumsum(counts) - counts, counts)]
    for doc, want in ((1, labels[0]), (None, labels[3])):
        own = [r for r in rows if r.doc_id == doc]
        assert [r.run for r in own] == list(range(len(own)))
        assert {i: r.lang for r in own for i in range(r.first_word, r.last_word + 1) if i in want} == want
        assert all(a.lang != b.lang and a.last_word < b.first_word for a, b in zip(own, own[1:]))
    assert {r.doc_id for r in rows} == {1, None} and len({r.lang for r in rows if r.doc_id == 1}) == 2


def test_encoding_runs_once_for_the_histogram(spark):
    plan = lengths.histogram(lengths.token_lengths(documents(spark, SF_SMALL)))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan  # the counts were written


CLASHING = ("_row_key", "_spans", "_spans_of", "_bit_of", "_bad", "weight", "name", "key", "h", "n", "group_fp", "doc", "item", "TEXT_", "_x")


def test_stages_keep_every_column_and_the_rows_of_plain_python(spark, tmp_path):
    """Odd rows with clashing columns through each stage, held against plain versions of the stages."""
    long = prose(9, 400)
    passage = prose(11, 90)
    texts = [None, "", "a b", long, long, long + " end", passage + " one " + prose(12, 60), prose(13, 70) + " " + passage, prose(14, 30), "x" * 900]
    rows = [(i if i % 4 else None, t, "en", "s", len(t or ""), *[f"c{i}{k}" for k in range(len(CLASHING))]) for i, t in enumerate(texts)]
    rows += [rows[2], rows[8]]
    schema = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long",
                        *(f"`{c}` string" for c in CLASHING)])
    docs = spark.createDataFrame(rows, schema)
    key = lambda df: sorted(map(repr, map(tuple, df.collect())))

    one = simhash.keep_one(docs)
    assert one.columns == docs.columns
    prints = {t: simhash.fingerprint((t or "").encode(), 3) for t in texts}
    groups: list[set] = []
    for t in texts:
        near = [g for g in groups if any(bin(prints[t] ^ prints[u]).count("1") <= 3 for u in g)]
        groups = [g for g in groups if g not in near] + [set().union({t}, *near)]
    kept = [r for r in one.collect()]
    assert sorted(len([r for r in kept if r.text in g]) for g in groups) == [1] * len(groups)
    assert all(tuple(r) in set(rows) for r in kept)

    cut = suffixes.without_repeats(docs)
    assert cut.columns == docs.columns
    got = {tuple(r)[5]: r for r in cut.collect()}
    data = [(t or "").encode() for t in (r[1] for r in rows)]
    starts: dict[bytes, int] = {}
    for d in data:
        for s in range(len(d) - 399):
            starts[d[s:s + 400]] = starts.get(d[s:s + 400], 0) + 1
    for r, d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - 399):
            if starts[d[s:s + 400]] > 1:
                gone[s:s + 400] = True
        left = np.frombuffer(d, np.uint8)[~gone].tobytes().decode()
        assert got[r[5]].text == (None if r[1] is None else left) and got[r[5]].n_chars == (len(left) if gone.any() else r[4])

    items = spark.createDataFrame([(1, " ".join(passage.split()[5:25]))], "item_id long, text string")
    clean = contain.without_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert key(clean) == sorted(repr(r) for r in rows if passage not in (r[1] or ""))

    model = toxicity.Model(toxicity.Lexicon(["grotzel"], []), np.ones(toxicity.FEATURES) * 9, -5.0)
    marked = docs.withColumn("text", F.when(F.col("text") == "a b", "you grotzel").otherwise(F.col("text")))
    mild = toxicity.without_toxic(marked, model)
    assert mild.columns == docs.columns and key(mild) == sorted(repr(r) for r in rows if r[1] != "a b")

    packed = corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in packed if r.piece == 0) == sorted((r[0] is None, r[0] or 0) for r in rows)


ODD_PAGES = [
    "<title>A &amp; B &lt;x&gt;</title>a < b and c > d<p>1 <2 <!-- gone --> &notit; &amp;amp; &#0; &#x80; &#150; &#xD800; &#1114112; &#99999999999;",
    "<html lang=fr><a href=/x?a=1&amp;b=2>l</a><a class=k href='/y?q=&quot;z&quot;'>m</a> &copy &copycat; &hellip;&nbsp;&#160;. &CounterClockwiseContourIntegral;",
    "&", "&&amp;;&#;&#x;&#x1F600;&zwj;", "a\t\tb  c \n\n d\r\ne", "", None, "<script>x<y</script>t<style>", "&NotEqualTilde; &ampx &lt5 &#38;#38; &eacute&Eacute;   <3 </3> <?php x ?>"]


def test_warc_equals_its_sql_on_odd_pages(spark):
    import duckdb

    from shopscope.llm import warc

    rows = [(i if i % 3 else None, f"http://h/{i}", h) for i, h in enumerate(ODD_PAGES)]
    got = warc.derivatives(warc.responses(spark.createDataFrame(rows, "page_id long, url string, html string"))).toPandas()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = con.sql(warc.ORACLE).df()
    columns = sorted(got.columns)
    a, b = (sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False))) for df in (got, want))
    assert [x.replace(".0,", ",") for x in a] == [x.replace(".0,", ",") for x in b]
    texts = {r.target_uri: r.content for r in got[got.record_type == "conversion"].itertuples()}
    assert texts["http://h/0"].startswith("a < b and c > d\n1 <2") and "&amp;" in texts["http://h/0"]
    fields = {r.target_uri: r.content for r in got[got.record_type == "metadata"].itertuples()}
    assert "title: A & B <x>" in fields["http://h/0"] and "outlink: /x?a=1&b=2\r\n" in fields["http://h/1"] and 'outlink: /y?q="z"' in fields["http://h/1"]
