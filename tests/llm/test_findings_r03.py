"""Round 3's findings: word features of many tokens at once, shard files, tails of chunks."""

import numpy as np
import pyarrow as pa

from shopscope.llm import langid, wavelet
from shopscope.llm.encode import Encoder

TOKENS = ["the", "The", "the,", "Straße!", "ÉTÉ", "été", "l'été", "İ", "ΑΣ.", "a", "xy", "日本語", "𝒳y", "ﬁ", "Ⅷ", "a1b", "1a", "x-y", "é",
          "123", "", "__", "%%%", "the"]


def test_features_of_many_tokens_equal_those_of_each():
    lexicon = frozenset({"the", "été", "日本語"})
    flat, size = langid.features([langid.core(t) for t in TOKENS], lexicon)
    each = [langid.word_features(t, lexicon) for t in TOKENS]
    assert size.tolist() == list(map(len, each)) and flat.tolist() == [f for found in each for f in found]
    assert langid.features([], lexicon)[0].tolist() == [] and langid.features(["", "1"], lexicon)[1].tolist() == [0, 0]


def test_tokens_of_one_word_are_weighed_once():
    model = langid.train(["the cat and the dog", "le chat et le chien"] * 3, ["en", "fr"] * 3)
    model.__post_init__()
    texts = pa.array(["The cat, the CAT; 12 %%% (the)", None, "le chien!"])
    names, score = model.predict(texts)
    assert names == ["en", "und", "fr"] and (score[[0, 2]] > 0.5).all() and score[1] == 0
    assert model._used == 5  # the, cat, none, le, chien
    again = model.predict(texts)
    assert model._used == 5 and again[0] == names and (again[1] == score).all()


def test_marks_after_words_are_encoded_once_and_as_in_whole_texts():
    made = Encoder()
    asked = []

    class Counting:
        def encode_batch_fast(self, chunks, **how):
            asked.extend(chunks)
            return tokenizer.encode_batch_fast(chunks, **how)

    tokenizer, made._tokenizer = made._tokenizer, Counting()
    texts = ["The cat,%%% sat*** THE!! cat.### (x) don't' it's- a_b été%%% Été,### é$$$ İ... ß! ''s 's <|endoftext|> x<|endoftext|>,", "%%% ,%%%  ", None, "cat*** $$$"]
    for _ in range(2):
        ids, n = made.flat(pa.array(texts))
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert n.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    made.flat(pa.array([f"{w}{m}" for w in ("dog", "bird", "fish", "Été") for m in (",%%%", "***", "!!", "$$$", ".###")]))
    assert len(asked) == len(set(asked)) and not any(c.startswith(("dog", "bird", "fish", "Été")) for c in asked)


def test_planes_of_many_and_few_bits_give_the_ids_back():
    rng = np.random.default_rng(3)
    for top, levels in ((2, 1), (49_408, 16), (1 << 20, 20)):
        ids = rng.integers(0, top, 5000).astype(np.uint16 if levels <= 16 else np.uint32)
        back = wavelet.WaveletMatrix.build(ids, levels).all()
        assert back.dtype == np.uint32 and (back == ids).all()


def test_table_of_pieces_holds_words_and_marks_but_no_whole_chunks():
    made = Encoder()
    made.flat(pa.array(["dog, Dog. DOG! dog;; Été,", "(dog) été dog1,"]))
    assert set(made._known) == {"dog", "été", ",", ".", "!", ";;", "(dog)", "dog1,"}
    ids, n = made.flat(pa.array(["DOG;;,", "Dog!"]))
    assert set(made._known) >= {";;,"} and "dog!" not in made._known
    assert ids.tolist() == [i for t in ("DOG;;,", "Dog!") for i in made._tokenizer.encode(t, add_special_tokens=False).ids] and n.sum() == len(ids)


def test_chunks_taken_apart_by_columns_encode_as_whole_texts():
    made = Encoder()
    rng = np.random.default_rng(7)
    signs = list("abzAZéÉßİıŉǅȺ́­ ªµΣσς日ﬁ019.,!'_-<|>*\\^]\t\r\n  ") + ["<|endoftext|>", "'s", "the ", "𝒳"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(3000)] + [None, "", " ", "\n", "!!", "a!"]
    for part in (pa.array(texts[:1000]), pa.array(texts)[997:], pa.array(texts), pa.array(["", None]), pa.array([], pa.string())):
        ids, n = made.flat(part)
        want = [made._tokenizer.encode(t or "", add_special_tokens=False).ids for t in part.to_pylist()]
        assert n.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
