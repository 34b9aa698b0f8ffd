"""Every stage carries the caller's columns whatever their names, and defines
what it does with nulls, empty and very long texts, repeated rows and empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import langid, minmax_dedup, ngram_ratio, poisson_mix, quality_gbt, sentencepiece_bpe, suffix_dedup
from quarry.llm.queries import PIECE_MODEL
from quarry.llm.shingles import shingle_sets

CLASH = ["name", "cdf", "_name", "_n", "_text", "_own_score", "score", "_tid", "_size", "_begins", "_ends", "rate", "copy", "mix_key",
         "id", "tid", "row", "rep", "ids_", "word", "f0", "good", "key"]
PASSAGE = "A passage of many words that stands in several texts and is long enough to be found there. " * 3
LONG = "word " * 60_000


def _docs(spark):
    texts = [None, "", "   \n", LONG, PASSAGE + "first", PASSAGE + "first", "Other text. " + PASSAGE, "a b c d e f g h i j", "ÄÖÜ é 日本"]
    rows = [(i, t, "en" if i % 2 else "de", "s" if i % 3 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(4, "The same id, but quite another text of its own kind.", "en", "s", 1), (None, "no id here", "en", "s", 1), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.concat(F.lit(c + "="), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASH])


def _own(df):
    return sorted(tuple(str(r[c]) for c in ["doc_id", *CLASH]) for r in df.collect())


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, i % 2, 0) for i in range(9)] + [(None, 1, 0), (3, 1, 0)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_clashing_columns(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = _docs(spark)
    out = stage(spark, docs, sf_dir)
    want = [c for c in docs.columns]
    assert out.columns[:len(want)] == want or set(want) <= set(out.columns)
    every, got = _own(docs), _own(out.select(*docs.columns))
    assert set(got) <= set(every)
    if name in ("repeat_dedup", "tokens"):
        assert got == every
    assert stage(spark, docs.limit(0), sf_dir).collect() == []


def test_rows_that_repeat_an_id_are_vertices_of_their_own(spark):
    texts = [(1, "one two three four five six seven"), (1, "quite another text that shares no word with it"), (2, "and the third unrelated text of all"),
             (3, "quite another text that shares no word with it"), (1, "one two three four five six seven"), (None, "x"), (4, ""), (4, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("name", F.lit(1))
    kept = sorted(((r.doc_id, r.text) for r in minmax_dedup.deduplicated(df).collect()), key=str)
    assert kept == sorted([texts[0], texts[1], texts[2], texts[5], texts[6], texts[7]], key=str)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minmax_dedup.near_duplicates(df, 3, 85, 100).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (1, 1, True), (2, 2, True), (3, 1, False), (4, 4, True), (4, 4, True), (None, None, True)], key=str)
    negative = spark.createDataFrame([(-5, "a b c"), (3, "a b c"), (-7, "a b c"), (2 ** 62, "a b c")], "doc_id long, text string")
    assert {r.component_id for r in minmax_dedup.near_duplicates(negative, 3, 85, 100).collect()} == {-7}
    named = spark.createDataFrame([("b", "a b c"), ("a", "a b c"), ("ab", "d e f")], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in minmax_dedup.near_duplicates(named, 3, 85, 100).collect()} == {"a": "a", "b": "a", "ab": "ab"}


def test_words_of_a_regular_build_have_hashes_of_their_own(spark):
    """The Thue-Morse word and its complement differ in every letter."""
    for n in range(3, 15):
        bits = [bin(i).count("1") % 2 for i in range(2 ** n)]
        one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
        data = np.frombuffer((one + two + one.upper()).encode(), np.uint8)
        a, b, c = shingle_sets(data, np.array([0, len(one), 2 * len(one), 3 * len(one)]), 1)
        assert a[0] != b[0] and a[0] == c[0]
    df = spark.createDataFrame([(1, one), (2, two), (3, one.upper())], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minmax_dedup.near_duplicates(df, 3, 85, 100).collect()} == {1: 1, 2: 2, 3: 1}
    words = [bytes([97 + i % 26]) * (i // 26 + 1) for i in range(2000)] + [b"a" * 8 + b"b", b"b" + b"a" * 8, b"a" * 16, b"a" * 17]
    data = np.frombuffer(b"".join(words), np.uint8)
    sets = shingle_sets(data, np.r_[0, np.cumsum([len(w) for w in words])], 1)
    assert len({s[0] for s in sets}) == len(set(words))


def test_numerals_are_no_letters(spark):
    docs = spark.createDataFrame([(i, "der die das und" if i % 2 else "the and of to", "de" if i % 2 else "en") for i in range(60)],
                                 "doc_id long, text string, lang string")
    model = langid.train(docs, PIECE_MODEL)
    odd = spark.createDataFrame([(0, "½ ²"), (1, "Ⅷ ①"), (2, "_ 12 !"), (3, None), (4, "der"), (5, "ª")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.predictions(odd, model).collect()}
    assert [got[i] for i in range(4)] == ["und"] * 4 and got[4] == "de" and got[5] != "und"


def test_trusted_ids_move_and_texts_stay(spark):
    """The counting plan joins no text: the good ids are a constant of it."""
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('word', id, ' of ', id % 7) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").unionByName(
        spark.createDataFrame([(10 ** 9, 1), (None, 1), (4, None)], "doc_id long, quality int"))
    w = ngram_ratio.weights(docs, labels).first()["weights"]
    good = labels.where("quality = 1").select("doc_id").distinct().withColumn("good", F.lit(True))
    joined = docs.join(good, "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    counts = {r.bucket: (r.raw, r.trusted) for r in ngram_ratio._counts(joined).collect()}
    nr, nt = (sum(c[i] for c in counts.values()) for i in (0, 1))
    one = ngram_ratio.SMOOTH * ngram_ratio.BUCKETS
    for b in range(0, ngram_ratio.BUCKETS, 37):
        raw, trusted = counts.get(b, (0, 0))
        want = np.log((trusted + ngram_ratio.SMOOTH) / (nt + one)) - np.log((raw + ngram_ratio.SMOOTH) / (nr + one))
        assert abs(w[b] - want) < 1e-9


def test_operators_with_clashing_columns(spark, sf_dir):
    docs = _docs(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert quality_gbt.predictions(docs, labels).count() == docs.count()
    assert poisson_mix.mix(docs).select("_n", "_name", "name", "cdf").columns == ["_n", "_name", "name", "cdf"]
    assert all(r._n.startswith("_n=") and r.name.startswith("name=") for r in poisson_mix.mix(docs).collect())
    assert _own(sentencepiece_bpe.encode(docs, PIECE_MODEL)) == _own(docs)
    assert _own(suffix_dedup.without_repeats(docs)) == _own(docs)
