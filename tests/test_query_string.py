"""Query strings against the documented forms."""

import pytest

from quarry import Bool, Equals, Nothing, Phrase, Range, Schema, Searcher, SearchError, Term, boolean, parse

TEXTS = (Schema().add_text_field("title", stored=True).add_text_field("content", stored=True)
         .add_text_field("tags", stored=True).add_u64_field("views", stored=True)
         .add_f64_field("price", stored=True).add_i64_field("delta").add_bool_field("live"))

DOCS = [
    {"title": "elixir web guide", "content": "phoenix framework tutorial", "tags": "beginner published",
     "views": 100, "price": 9.5, "delta": -4, "live": True},
    {"title": "elixir concurrency", "content": "otp genserver", "tags": "advanced published",
     "views": 1000, "price": 50.0, "delta": 0, "live": False},
    {"title": "elixir web advanced", "content": "phoenix internals", "tags": "advanced draft",
     "views": 5000, "price": 120.0, "delta": 9, "live": True},
    {"title": "Rust web", "content": "functional programming is great", "tags": "draft"},
    {"title": "other", "content": "programming with functional style elixir", "tags": "published"},
]

CASES = [
    ("title:elixir", {0, 1, 2}),
    ("elixir", {0, 1, 2, 4}),
    ("ELIXIR", {0, 1, 2, 4}),
    ("title:phoenix", set()),
    ("elixir AND phoenix", {0, 2}),
    ("title:elixir AND content:phoenix", {0, 2}),
    ("elixir AND nonexistent", set()),
    ("otp OR rust", {1, 3}),
    ("otp rust", {1, 3}),
    ("otp OR nonexistent", {1}),
    ('"functional programming"', {3}),
    ('title:"web guide"', {0}),
    ('content:"web guide"', set()),
    ("+elixir phoenix", {0, 1, 2, 4}),
    ("elixir -draft", {0, 1, 4}),
    ("+elixir +web -draft", {0}),
    ("elixir AND (web OR otp)", {0, 1, 2}),
    ("title:elixir AND (content:phoenix OR content:otp) AND tags:published", {0, 1}),
    ('"functional programming" AND rust', {3}),
    ("title:(rust OR guide)", {0, 3}),
    ("otp OR phoenix AND internals", {1, 2}),
    ("elixir AND -draft", {0, 1, 4}),
    ("views:[100 TO 1000]", {0, 1}),
    ("views:{100 TO 1000]", {1}),
    ("views:[100 TO 1000}", {0}),
    ("price:[50.0 TO *]", {1, 2}),
    ("price:{* TO 50.0}", {0}),
    ("delta:[-4 TO 0]", {0, 1}),
    ("elixir AND views:[1000 TO *]", {1, 2}),
    ("live:true AND views:5000", {2}),
    ("title:well--known", set()),
    ("", set()),
    ("  ", set()),
    ("--", None),
]


@pytest.fixture(scope="module")
def searcher(spark):
    from quarry import Index
    rows = [tuple([i] + [d.get(f.name) for f in TEXTS.fields]) for i, d in enumerate(DOCS)]
    df = spark.createDataFrame(rows, "doc_id long, title string, content string, tags string, views long, "
                                     "price double, delta long, live boolean")
    return Searcher(Index.from_corpus(df, TEXTS))


@pytest.mark.parametrize("text,want", [c for c in CASES if c[1] is not None])
def test_forms(searcher, text, want):
    got = searcher.search_query(text, ["title", "content", "tags"], 10).collect()
    assert {r["doc_id"] for r in got} == want


@pytest.mark.parametrize("text", ['"unclosed', "(a OR b", "a OR", "AND a", "a AND OR b", "a)", "()", "-a", "nofield:x",
                                  "views:[1 TO", "views:[a TO 3]", "views:abc", "title:[a TO b]", "a^2", "ab*", "+ a", "live:yes"])
def test_malformed(text):
    with pytest.raises(SearchError, match="Failed to parse query"):
        parse(TEXTS, ["title"], text)


def test_values():
    assert parse(TEXTS, ["title"], "") == Nothing()
    assert parse(TEXTS, ["title"], "Ab") == Term("title", "ab")
    assert parse(TEXTS, ["title"], "ab-cd") == Phrase("title", ["ab", "cd"])
    assert parse(TEXTS, ["title"], "views:{1 TO *]") == Range("views", 1, None, "upper")
    assert parse(TEXTS, ["title"], "live:false") == Equals("live", False)
    assert parse(TEXTS, ["title"], "+a b -c") == Bool(
        [Term("title", "a")], [Term("title", "b")], [Term("title", "c")])
    assert parse(TEXTS, ["title", "tags"], "a") == Bool(should=[Term("title", "a"), Term("tags", "a")])


def test_default_fields(searcher):
    with pytest.raises(SearchError, match="not found in schema"):
        searcher.search_query("test", ["nonexistent_field"])
    with pytest.raises(SearchError, match="At least one default field"):
        searcher.search_query("test", [])
    assert {r["doc_id"] for r in searcher.search_query("phoenix", ["title"]).collect()} == set()
    snip = searcher.search_with_snippets("otp", ["content"], default_fields=["content"]).collect()
    assert [r["snippets"]["content"] for r in snip] == ["<b>otp</b> genserver"]


def test_not_excludes_the_next_clause():
    t, term = Schema().add_text_field("t").add_i64_field("n").add_f64_field("f"), lambda w: Term("t", w)
    def q(text):
        return parse(t, ["t"], text)
    assert q("elixir NOT rust") == q("elixir -rust") == boolean(should=[term("elixir")], must_not=[term("rust")])
    assert q("elixir AND NOT rust") == q("elixir AND -rust") == boolean(must=[term("elixir")], must_not=[term("rust")])
    assert q("NOT rust +elixir web") == boolean(must=[term("elixir")], should=[term("web")], must_not=[term("rust")])
    assert q("a NOT (b c)") == boolean(should=[term("a")], must_not=[boolean(should=[term("b"), term("c")])])
    assert q("t:(a NOT b)") == boolean(should=[term("a")], must_not=[term("b")])
    # quoted or after a field it is a word, in lower case too
    assert q('"NOT" a') == boolean(should=[term("not"), term("a")]) and q("t:NOT") == term("not") and q("not") == term("not")
    for bad in ("NOT rust", "a NOT", "a NOT NOT b", "NOT -a b", "a NOT OR b", "a (NOT b)", "- a"):
        with pytest.raises(SearchError, match="Failed to parse"):
            q(bad)


def test_signed_values_after_a_field():
    s = Schema().add_text_field("t").add_i64_field("temp").add_f64_field("f").add_u64_field("u")
    assert parse(s, ["t"], "temp:-5") == Equals("temp", -5) and parse(s, ["t"], "temp:+5") == Equals("temp", 5)
    assert parse(s, ["t"], "f:-2.5 AND temp:[-9 TO -1}") == boolean(must=[Equals("f", -2.5), Range("temp", -9, -1, "lower")])
    assert parse(s, ["t"], "a -5") == boolean(should=[Term("t", "a")], must_not=[Term("t", "5")])
    assert parse(s, ["t"], "t:-5") == Term("t", "5")
    for bad in ("temp:-x", "temp: -5", "t:-x", "temp:--5"):
        with pytest.raises(SearchError):
            parse(s, ["t"], bad)
