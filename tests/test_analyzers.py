"""Declared analyzers: the same chain for texts and queries, kept with the index."""

import pytest

from quarry import Analyzer, Index, Phrase, Schema, Searcher, SearchError, Term, parse
from quarry.query import Bool, Nothing, match_field
from quarry.schema import Field

SCHEMA = (Schema().add_text_field("title", stored=True, analyzer=Analyzer(grams=3)).add_text_field("code", analyzer=Analyzer("spaces"))
          .add_text_field("tag", analyzer=Analyzer("whole")).add_text_field("body", analyzer=Analyzer(stop=("the", "of"))).add_text_field("plain"))
DOCS = [("Elixir phoenix", "C++ a-b", "New York", "the state of the art", "the x"), ("xabc bcdy ab", "c#", "new york city", "of the", "of"),
        ("abcdé", "a b", "", "art of state", None), ("", None, None, None, "")]


def _ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_chains(spark, tmp_path):
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(DOCS)], "doc_id long, title string, code string, tag string, body string, plain string")
    path = str(tmp_path / "ix")
    Index.build(df, SCHEMA, path=path)
    for idx in (Index.open(spark, path), Index.from_corpus(df, SCHEMA)):       # the chains are stored with the index
        assert idx.schema.fields == SCHEMA.fields
        s = Searcher(idx)
        find = lambda text: _ids(s.hits(parse(idx.schema, ["title"], text)))
        # inner strings of three characters or more, within one word
        assert find("hoe") == [0] and find("LIXI") == [0] and find("abcd") == [2] and find("bcdé") == [2] and find("abc") == [1, 2]
        assert find("ab") == [1] and find("lixi hoen") == [0] and find('"lixi hoen"') == [0] and find('"lixi bcdy"') == [] and find("cbc") == []
        assert find("code:C++") == [0] and find("code:c#") == [1] and find("code:a") == [2]
        assert _ids(s.hits(s.match("tag", "NEW york"))) == [0] and _ids(s.hits(s.match("tag", "york"))) == []
        assert find('body:"state art"') == [0] and find('body:"art state"') == [2] and find("body:the") == [] and find("plain:the") == [0]
        assert idx.terms.where("term = ''").count() == 0
        dl = {r["doc_id"]: r["dl"] for r in idx.terms.where("field = 'title'").collect()}
        assert dl == {0: 4 + 5, 1: 2 + 2 + 1, 2: 3}


def test_queries_by_the_field():
    title, body = SCHEMA.field("title"), SCHEMA.field("body")
    assert match_field(title, "Phoenix") == Phrase("title", ["pho", "hoe", "oen", "eni", "nix"]) and match_field(title, "ab") == Term("title", "ab")
    assert match_field(title, "abc defg") == Bool(must=[Term("title", "abc"), Phrase("title", ["def", "efg"])])
    assert match_field(body, "the of") == Nothing() and match_field(body, "state of") == Term("body", "state")
    assert Schema.from_json(SCHEMA.to_json()).fields == SCHEMA.fields


def test_refused():
    for bad in (dict(split="nosuch"), dict(grams=0), dict(grams="3")):
        with pytest.raises(ValueError):
            Analyzer(**bad)
    with pytest.raises(SearchError, match="Only text fields"):
        Field("n", "u64", analyzer=Analyzer(grams=2))
