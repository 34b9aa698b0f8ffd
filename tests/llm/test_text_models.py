"""SentencePiece, language ID and the quality classifier."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import sentencepiece

from quarry.llm import langid, quality_gbt, sentencepiece_bpe
from quarry.llm.queries import PIECE_MODEL

ODD = [None, "", " ", "   ", "  a  b ", "\ta\nb  c", "é́ ﬁ Ａ", "▁x", "a▁b", "日本\x00語😀", " " * 37,
       "a" * 40, "banana" * 300, "the" * 500, "<s></s><unk><0x41>", "=-" * 400, "\n\n\n  \n", "nnnnnn  mmmm ll"]


def _texts():
    rng = random.Random(1)
    return ODD + ["".join(rng.choice("ab ▁ntheix.é=-—\n😀1") for _ in range(rng.randrange(1, 60))) for _ in range(400)]


def test_encoding_and_decoding_as_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: sp.encode(t or "") for i, t in enumerate(texts)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in sentencepiece_bpe.digests(df, PIECE_MODEL).collect()}
    assert got == {i: (len(x), sha(",".join(map(str, x))), sha(sp.decode(x))) for i, x in want.items()}
    # clashing names are replaced, other columns stay
    extra = df.selectExpr("doc_id", "text", "'x' as ids", "7 as other")
    both = sentencepiece_bpe.decode(sentencepiece_bpe.encode(extra, PIECE_MODEL), PIECE_MODEL)
    assert both.columns == ["doc_id", "text", "other", "ids", "n_tokens", "decoded"]
    for r in both.collect():
        assert (r.ids, r.n_tokens, r.decoded) == (want[r.doc_id], len(want[r.doc_id]), sp.decode(want[r.doc_id]))
    assert sentencepiece_bpe.digests(df.limit(0), PIECE_MODEL).collect() == []
    assert sentencepiece_bpe.encode(df.limit(0), PIECE_MODEL).collect() == []


def test_decoding_any_ids():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    m, rng = sentencepiece_bpe.model(PIECE_MODEL), random.Random(2)
    pool = [259, 3, 200, 220, 250, 2, 1, 0, 300, 28705, *range(3, 259)]
    for _ in range(500):
        ids = [rng.choice(pool) for _ in range(rng.randrange(9))]
        assert m.decode(ids) == sp.decode(ids)


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "CACHE_WORDS", 10)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    enc = sentencepiece_bpe.Encoder(PIECE_MODEL)
    for t in ("one two three four", "five six seven eight nine", "one two " * 3, " ".join(map(str, range(40)))):
        assert enc.encode(t) == sp.encode(t)


def _sum_over_cuts(v, p, word):
    """Likelihood of a word by enumerating its cuts."""
    number = {s: i for i, s in enumerate(v.pieces)}
    if not word:
        return np.ones(p.shape[1])
    out = np.zeros(p.shape[1])
    for n in range(1, len(word) + 1):
        piece = word[:n]
        if piece in number:
            out = out + p[number[piece]] * _sum_over_cuts(v, p, word[n:])
        elif n == 1:
            out = out + langid.UNSEEN * _sum_over_cuts(v, p, word[1:])
    return out


def test_forward_sums_all_segmentations():
    v = langid.vocabulary(PIECE_MODEL)
    rng = np.random.default_rng(0)
    p = rng.random((v.size + 1, 3)) * 1e-3
    p[v.size] = 0
    m = langid.Model(PIECE_MODEL, ["a", "b", "c"], p)
    words = ["▁the", "▁nation", "▁x€y", "▁", "▁ings", "▁ༀe"]
    assert np.allclose(m.log_likelihood(words), [np.log(_sum_over_cuts(v, p, w)) for w in words])
    # expected counts of one word: pieces' characters add up to the word's
    counts = np.zeros_like(p)
    table = langid._piece_table(v, ["▁nation"])
    langid._expected(table, p, np.array([[1.0, 0, 2.0]]), counts)
    length = np.array([*map(len, v.pieces), 0])
    assert np.allclose(counts.T @ length, [7, 0, 14])
    long = langid.split("x" * 1000 + " y")
    assert max(map(len, long)) == langid.LONGEST and np.isfinite(m.log_likelihood(long)).all()


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(90001, None, "en"), (90002, "", "de"), (90003, "12 -- 7", "fr"), (90004, "the of and", None)],
                                "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(odd)
    m = langid.train(both, PIECE_MODEL, rounds=1)
    assert m.langs == ["de", "en", "es", "fr"]
    got = {r.doc_id: r for r in langid.predictions(both, m).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (90001, 90002, 90003))
    held = [(r.lang, got[r.doc_id].lang_pred) for r in docs.collect() if got[r.doc_id].held_out]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.train(both.limit(0), PIECE_MODEL)
    assert {r.lang_pred for r in langid.predictions(both, nothing).collect()} == {"und"}


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = quality_gbt.fit(x, y)
    z = rng.random((500, 4))
    s = trees.score(z)
    assert ((s > 0.5) == ((z[:, 0] > 0.5) ^ (z[:, 2] > 0.3))).mean() > 0.95

    def walk(row):        # one row at a time, by the arrays' meaning
        total = trees.base
        for node in trees.roots:
            while not trees.leaf[node]:
                node = trees.left[node] + (row[trees.feature[node]] > trees.cut[node])
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(s, [walk(r) for r in z])
    assert quality_gbt.fit(x, np.ones(3000)).score(z).min() > 0.9
    assert quality_gbt.fit(x[:0], y[:0]).score(z).tolist() == [0.5] * 500


def test_statistics_of_odd_texts():
    texts = [b"", b"a", b"\n\n", "é AB!! ab ab ab\nx\nx\n".encode()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    s = quality_gbt.statistics(data, np.r_[0, np.cumsum([len(t) for t in texts])])
    assert s.shape == (4, len(quality_gbt.FEATURES)) and np.isfinite(s).all()
    at = quality_gbt.FEATURES.index
    assert np.isclose(s[3, at("distinct_words")], 4 / 7)       # é AB!! ab x
    assert s[3, at("log_lines")] == np.log1p(3)


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    odd = docs.limit(1).selectExpr("-1L as doc_id", "cast(null as string) as text", "lang", "source", "n_chars")
    got = {r.doc_id: r for r in quality_gbt.predictions(docs.unionByName(odd), labels).collect()}
    assert 0 <= got[-1].score <= 1
    pairs = [(r.quality, got[r.doc_id].score) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for q, s in pairs if q == 1], [s for q, s in pairs if q == 0]
    assert good and bad and np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    clash = docs.selectExpr("doc_id", "text", "lang as score")
    kept = quality_gbt.accepted(clash, labels)
    assert kept.columns == ["doc_id", "text", "score"] and kept.first().score in ("en", "de", "fr", "es")
    empty = quality_gbt.predictions(docs.limit(0), labels.limit(0))
    assert empty.collect() == []


def test_long_words_as_the_library_in_near_linear_time():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    m, rng = sentencepiece_bpe.model(PIECE_MODEL), random.Random(5)
    words = ["".join(rng.choice(a) for _ in range(n)) for a, n in
             [("abcdefghijklmnopqrstuvwxyz", 5000), ("ab", 4000), ("the", 3000), ("日本語é😀x", 2000), ("=-_", 3000), ("a", 2049),
              ("aaab", 1500), ("nm", 1025)]]
    got = m.encode_words([sentencepiece_bpe.MARK + w for w in words + ["short"]])
    assert got == [sp.encode(w) for w in words + ["short"]]
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    start = time.process_time()
    got = m.encode_words([sentencepiece_bpe.MARK + word])[0]
    assert time.process_time() - start < 20          # about 2 s; a scan a round takes a minute
    assert got == sp.encode(word)


def test_language_of_a_long_word_sums_all_segmentations():
    v = langid.vocabulary(PIECE_MODEL)
    rng = np.random.default_rng(3)
    p = rng.random((v.size + 1, 2)) ** 8
    p /= p.sum(axis=0)
    p[v.size] = 0
    m = langid.Model(PIECE_MODEL, ["a", "b"], p)
    letters = random.Random(4)
    for n in (3, 200, langid.LONGEST - 1, langid.LONGEST + 40, langid.STRIP - 1, langid.STRIP + 300):
        word = langid.MARK + "".join(letters.choice("abcdethx\x01é") for _ in range(n))
        # a language at a time: with a common scale the unlikelier one of a long word comes to zero
        whole = [langid._forward(langid._piece_table(v, [word]), p[:, [k]])[0][0, 0] for k in range(2)]
        assert np.allclose(langid._long_word(v, word, p), whole, rtol=1e-9)
        assert np.allclose(m.log_likelihood([word, "x", word])[[0, 2]], whole, rtol=1e-9)
    start = time.process_time()
    m.log_likelihood([langid.MARK + "abcde" * 20_000])
    assert time.process_time() - start < 20
    assert "".join(langid.split("ab" * 700)) == langid.MARK + "ab" * 700
    assert len(langid.words_of_text("ab" * 700)) == 1
