"""Pairs of common words: phrases find the same with and without them, and read less."""

import random

import pytest

from quarry import Index, Phrase, Schema, Searcher
from quarry.functions.text import Analyzer
from quarry.operators import analysis
from quarry.operators.predicates import _pair_cover
from tests.test_index import _rows_read

SCHEMA = Schema().add_text_field("text", stored=True).add_text_field("title")
COMMON, RARE = "of the in and".split(), [f"w{i}" for i in range(300)]
PHRASES = ["of the", "the of", "the the", "of the in", "of the in and", "the w1", "w1 of the", "of the w1 in and", "the the the",
           "of w1 the", "w1 w2", "nowhere the", "of the nowhere"]


def _docs(n, first=0, common=COMMON, seed=1):
    rng = random.Random(seed)
    return [(first + i, " ".join(rng.choice(common if rng.random() < .8 else RARE[:40 if common else 300]) for _ in range(rng.randrange(1, 60))),
             rng.choice(["the of", "", None, "in the"])) for i in range(n)]


def _found(index, phrase, field="text"):
    hits = Searcher(index).hits(Phrase(field, phrase.split())).collect()
    return {r.doc_id: round(r.score, 9) for r in hits}


def _brute(docs, phrase, column=1):
    w = phrase.split()
    return {d[0] for d in docs if any((d[column] or "").split()[i:i + len(w)] == w for i in range(len((d[column] or "").split())))}


def _frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string, title string")


@pytest.fixture(scope="module")
def indexes(spark, tmp_path_factory):
    """Three commits: of common words; of rare ones only; of two common words. With and without pairs."""
    parts = [_docs(400), _docs(150, 1000, RARE, 2) + [(1990, "of the in and of the w1 in and", "the of")], _docs(300, 2000, ["of", "the"], 3)]
    out = []
    for pairs in (True, False):
        idx = Index.build(_frame(spark, parts[0]), SCHEMA, path=str(tmp_path_factory.mktemp("pairs") / "ix"), pairs=pairs)
        out.append(idx.append(_frame(spark, parts[1]), 1).append(_frame(spark, parts[2]), 2).append(_frame(spark, []), 3))
    return parts, *out


def test_cover():
    words = "a b c x a b".split()
    assert _pair_cover(words, {"a", "b", "c"}) == [(0, ("a", "b")), (1, ("b", "c")), (3, ("x",)), (4, ("a", "b"))]
    assert _pair_cover(words, set()) == [(i, (w,)) for i, w in enumerate(words)]
    assert _pair_cover(["a"], {"a"}) == [(0, ("a",))]


@pytest.mark.parametrize("phrase", PHRASES)
def test_phrases_with_and_without_pairs(indexes, phrase):
    parts, paired, plain = indexes
    got = _found(paired, phrase)
    assert got == _found(plain, phrase)
    assert set(got) == _brute(sum(parts, []), phrase)


def test_snapshots_and_other_fields(indexes):
    parts, paired, plain = indexes
    for c in (0, 1, 2):
        for phrase in ("of the", "of the in", "w1 of the"):
            got = _found(paired.as_of(c), phrase)
            assert got == _found(plain.as_of(c), phrase)
            assert set(got) == _brute(sum(parts[:c + 1], []), phrase)
    assert set(_found(paired, "the of", "title")) == _brute(sum(parts, []), "the of", 2)
    assert plain.pairs is None and plain.paired("text", ["of", "the"]) == (set(), [])


def test_pairs_are_of_common_words_and_read_alone(indexes):
    parts, paired, _ = indexes
    words, commits = paired.paired("text", ["of", "the", "w1"])
    assert words == {"of", "the"} and commits == [0, 2]
    rows = paired.pairs.where("field = 'text' and commit_id = 0").collect()
    assert {w for r in rows for w in (r.w1, r.w2)} == set(COMMON)
    texts = {d[0]: d[1].split() for d in parts[0]}
    for r in rows:
        w = texts[r.doc_id]
        assert r.positions == [i for i in range(len(w) - 1) if (w[i], w[i + 1]) == (r.w1, r.w2)] and r.dl == len(w)
    # two common words: the few pages of their pair are read, and no list of a word
    first = paired.as_of(0)
    hits = Searcher(first).hits(Phrase("text", ["of", "in"]))
    assert len(_found(first, "of in")) <= _rows_read(hits) < first.pairs.count() / 4
    assert all("/pairs/" in f for f in hits.inputFiles())


def test_more_common_words_than_are_broadcast(spark, monkeypatch, tmp_path, indexes):
    monkeypatch.setattr(analysis, "BROADCAST_WORDS", 1)
    idx = Index.build(_frame(spark, indexes[0][0]), SCHEMA, path=str(tmp_path / "ix"), pairs=True)
    assert idx.pairs.count() == indexes[1].as_of(0).pairs.count()


def test_gaps_of_an_analyzer_part_words(spark, tmp_path):
    schema = Schema().add_text_field("text", analyzer=Analyzer(stop=["and"]))
    docs = [(i, "of and the in", None) for i in range(200)]
    idx = Index.build(_frame(spark, docs).drop("title"), schema, path=str(tmp_path / "ix"), pairs=True)
    plain = Index.build(_frame(spark, docs).drop("title"), schema, path=str(tmp_path / "iy"))
    for phrase in ("of the", "the in", "of in"):
        assert _found(idx, phrase) == _found(plain, phrase)
