import pytest

from quarry import (Equals, Fuzzy, Phrase, Prefix, Range, Schema, SearchError, Searcher, Term,
                    all_of, any_of, any_words, boolean, match)
from conftest import ids

TITLE = Schema().add_text_field("title", stored=True)
CONTENT = Schema().add_text_field("content", stored=True)
ARTICLES = Schema().add_text_field("title", stored=True).add_text_field("content", stored=True)


def hits(idx, q):
    return ids(Searcher(idx).hits(q))


def test_term_match_and_case(make_index):
    idx = make_index(TITLE, [{"title": "hello world"}, {"title": "goodbye world"},
                             {"title": "hello universe"}])
    assert hits(idx, Term("title", "hello")) == [0, 2]
    assert make_index(TITLE, [{"title": "HELLO WORLD"}]) and \
        hits(make_index(TITLE, [{"title": "HELLO WORLD"}]), Term("title", "hello")) == [0]
    # term values are not analysed
    assert hits(idx, Term("title", "Hello")) == []
    assert hits(idx, Term("title", "")) == []


def test_split_on_punctuation(make_index):
    idx = make_index(Schema().add_text_field("text"), [{"text": "hello-world test@example.com"}])
    assert hits(idx, Term("text", "hello")) == [0]
    assert hits(idx, Term("text", "example")) == [0]


def test_scores_descend_with_frequency(make_index):
    idx = make_index(TITLE, [{"title": "programming"}, {"title": "programming programming"},
                             {"title": "programming programming programming"}])
    r = Searcher(idx).search(Term("title", "programming"), 10).collect()
    assert len(r) == 3 and all(x["score"] > 0 for x in r)
    assert [x["score"] for x in r] == sorted([x["score"] for x in r], reverse=True)


def test_limits(make_index):
    idx = make_index(Schema().add_text_field("text"),
                     [{"text": f"item {i} searchterm"} for i in range(10)])
    s = Searcher(idx)
    assert [s.search(Term("text", "searchterm"), k).count() for k in (5, 3, 100)] == [5, 3, 10]
    idx2 = make_index(Schema().add_text_field("text"), [{"text": f"doc {i} word"} for i in range(20)])
    assert Searcher(idx2).search(Term("text", "word")).count() == 10
    t = Searcher(idx2).total_hits(Term("text", "word")).collect()[0]
    assert (t["total_hits"], t["total_matches"]) == (10, 20)


def test_stored_and_hidden_fields(make_index):
    schema = (Schema().add_text_field("title", stored=True).add_text_field("secret")
              .add_u64_field("year", stored=True, indexed=False))
    idx = make_index(schema, [{"title": "public doc", "secret": "classified", "year": 1999}])
    r = Searcher(idx).search(Term("secret", "classified")).collect()
    assert len(r) == 1 and "secret" not in r[0].asDict() and r[0]["year"] == 1999
    assert hits(idx, Range("year", 0, 3000)) == []     # stored only: not searchable


def test_field_and_boolean_forms(make_index):
    idx = make_index(ARTICLES, [{"title": "elixir guide", "content": "rust is fast"},
                                {"title": "rust guide", "content": "elixir is functional"}])
    assert hits(idx, match("title", "ELIXIR")) == [0]
    assert hits(idx, any_words(["title", "content"], "elixir")) == [0, 1]
    c = make_index(CONTENT, [{"content": "elixir is great"}, {"content": "phoenix is great"},
                             {"content": "elixir phoenix framework"}])
    assert hits(c, all_of(Term("content", "elixir"), Term("content", "phoenix"))) == [2]
    c2 = make_index(CONTENT, [{"content": "elixir programming"}, {"content": "rust programming"},
                              {"content": "java programming"}])
    assert hits(c2, any_of(Term("content", "elixir"), Term("content", "rust"))) == [0, 1]
    c3 = make_index(CONTENT, [{"content": "elixir phoenix"}, {"content": "elixir ecto"},
                              {"content": "phoenix framework"}])
    assert hits(c3, boolean(must=[Term("content", "elixir")], should=[Term("content", "phoenix")])) == [0, 1]
    c4 = make_index(CONTENT, [{"content": "elixir web draft"}, {"content": "elixir web published"},
                              {"content": "elixir language"}])
    q = boolean(must=[Term("content", "elixir"), Term("content", "web")],
                must_not=[Term("content", "draft")])
    assert hits(c4, q) == [1]
    c5 = make_index(CONTENT, [{"content": "elixir web"}, {"content": "elixir concurrent"},
                              {"content": "elixir desktop"}, {"content": "rust web"}])
    q = all_of(Term("content", "elixir"), any_of(Term("content", "web"), Term("content", "concurrent")))
    assert hits(c5, q) == [0, 1]


def test_should_adds_score_only(make_index):
    c = make_index(CONTENT, [{"content": "elixir phoenix"}, {"content": "elixir ecto"}])
    r = {x["doc_id"]: x["score"] for x in Searcher(c).hits(
        boolean(must=[Term("content", "elixir")], should=[Term("content", "phoenix")])).collect()}
    assert r[0] > r[1]


def test_phrase(make_index):
    c = make_index(CONTENT, [{"content": "functional programming is great"},
                             {"content": "programming with functional style"},
                             {"content": "functional and programming"}])
    assert hits(c, Phrase("content", ["functional", "programming"])) == [0]
    assert hits(c, match("content", "Functional Programming")) == [0]
    # phrase hits are a subset of the AND of their words
    both = hits(c, all_of(Term("content", "functional"), Term("content", "programming")))
    assert set(hits(c, Phrase("content", ["functional", "programming"]))) <= set(both)


def test_repeated_phrase_words(make_index):
    c = make_index(CONTENT, [{"content": "a b a c"}, {"content": "a b c a"}])
    assert hits(c, Phrase("content", ["a", "b", "a"])) == [0]


def test_ranges(make_index):
    s = Schema().add_u64_field("count", stored=True)
    idx = make_index(s, [{"count": v} for v in (50, 100, 500, 1000, 5000)])
    assert len(hits(idx, Range("count", 100, 1000))) == 3
    v = make_index(Schema().add_u64_field("value"), [{"value": x} for x in (10, 50, 100)])
    got = [len(hits(v, Range("value", 10, 100, inc))) for inc in ("both", "lower", "upper", "neither")]
    assert got == [3, 2, 2, 1]
    o = make_index(Schema().add_i64_field("offset"), [{"offset": x} for x in (-100, -50, 0, 50, 100)])
    assert len(hits(o, Range("offset", -60, 60, kind="i64"))) == 3
    r = make_index(Schema().add_f64_field("rating"), [{"rating": x} for x in (2.5, 3.7, 4.2, 4.8)])
    assert len(hits(r, Range("rating", 4.0, 5.0, kind="f64"))) == 2
    w = make_index(Schema().add_u64_field("views"), [{"views": x} for x in (100, 500, 5000)])
    assert len(hits(w, Range("views", 1000, None))) == 1
    # `both` = `neither` + the bounds
    assert set(hits(v, Range("value", 10, 100))) == set(hits(v, Range("value", 10, 100, "neither"))) | {0, 2}


def test_text_and_range(make_index):
    s = Schema().add_text_field("category").add_f64_field("price")
    idx = make_index(s, [{"category": "electronics", "price": 99.99},
                         {"category": "books", "price": 19.99},
                         {"category": "electronics", "price": 499.99}])
    assert hits(idx, all_of(Term("category", "electronics"), Range("price", 50.0, 200.0))) == [0]


def test_bool_equality(make_index):
    s = Schema().add_text_field("title").add_bool_field("published")
    idx = make_index(s, [{"title": "a", "published": True}, {"title": "b", "published": False}])
    assert hits(idx, Equals("published", True)) == [0]


def test_prefix(make_index):
    idx = make_index(TITLE, [{"title": t} for t in ("Phoenix Framework", "Phone Book", "Photography Tips",
                                                    "Elixir Programming", "Photoshop Tutorial")])
    assert hits(idx, Prefix("title", "PHO")) == [0, 1, 2, 4]
    cafe = make_index(TITLE, [{"title": "café"}, {"title": "cafe"}, {"title": "caf"}])
    assert hits(cafe, Prefix("title", "caf")) == [1, 2]      # tail must be [a-z0-9]*


def test_fuzzy(make_index):
    w = make_index(Schema().add_text_field("word"), [{"word": "phoenix"}])
    assert hits(w, Fuzzy("word", "phonix", 1)) == [0]
    assert hits(w, Fuzzy("word", "phnix", 1)) == []
    assert hits(w, Fuzzy("word", "phnix", 2)) == [0]
    a = make_index(Schema().add_text_field("word"), [{"word": "abcd"}])
    assert hits(a, Fuzzy("word", "acbd", 1, True)) == [0]
    assert hits(a, Fuzzy("word", "acbd", 1, False)) == []
    words = ["function", "variable", "programming", "database", "algorithm"]
    typos = ["fucntion", "varaible", "progarmming", "databse", "algoritm"]
    t = make_index(Schema().add_text_field("term"), [{"term": x} for x in words])
    for i, typo in enumerate(typos):
        assert i in hits(t, Fuzzy("term", typo, 2))
    j = make_index(Schema().add_text_field("author"), [{"author": "José Valim"}])
    assert hits(j, Fuzzy("author", "jose", 1)) == [0]        # characters, not bytes
    assert hits(w, Fuzzy("word", "phoenix", 0)) == hits(w, Term("word", "phoenix"))


def test_fuzzy_prefix(make_index):
    idx = make_index(Schema().add_text_field("name"), [{"name": "Phoenix Framework"},
                                                      {"name": "Photography Tips"},
                                                      {"name": "Elixir Guide"}])
    assert hits(idx, Fuzzy("name", "pho", 0, prefix=True)) == [0, 1]
    assert hits(idx, Fuzzy("name", "phx", 1, prefix=True)) == [0, 1]   # "pho" is one edit away
    assert hits(idx, Fuzzy("name", "eli", 0, prefix=True)) == [2]


def test_errors(make_index):
    s = Schema().add_text_field("title").add_u64_field("views").add_i64_field("temp")
    idx = make_index(s, [{"title": "x", "views": 1, "temp": 1}])
    sr = Searcher(idx)
    with pytest.raises(SearchError, match="Field 'nope' not found in schema"):
        sr.hits(Term("nope", "x"))
    with pytest.raises(SearchError, match="is not a text field"):
        sr.hits(Term("views", "1"))
    with pytest.raises(SearchError, match="must be a text field"):
        sr.hits(Fuzzy("views", "1"))
    with pytest.raises(SearchError, match="Distance must be between 0 and 2"):
        Fuzzy("title", "x", 3)
    with pytest.raises(SearchError, match="Prefix cannot be empty"):
        Prefix("title", "")
    with pytest.raises(SearchError, match="At least one default field"):
        any_words([], "x")
    with pytest.raises(SearchError, match="inclusive"):
        Range("views", 1, 2, "sideways")
    with pytest.raises(SearchError, match="is not a u64 field"):
        sr.hits(Range("temp", 1, 2, kind="u64"))
    with pytest.raises(SearchError, match="Snippet field 'zz' not found in schema"):
        sr.search_with_snippets(Term("title", "x"), ["zz"])
    with pytest.raises(SearchError):
        boolean(must_not=[Term("title", "x")])


def test_snapshot(spark, tmp_path):
    from quarry.plans.index import Index
    s = Schema().add_text_field("text", stored=True)
    first = spark.createDataFrame([(1, "first")], "doc_id long, text string")
    idx = Index.build(first, s, path=str(tmp_path / "ix"))
    old = Searcher(idx)
    idx2 = idx.append(spark.createDataFrame([(2, "first second")], "doc_id long, text string"), 1)
    assert ids(Searcher(idx2.as_of(0)).hits(Term("text", "first"))) == [1]
    assert ids(Searcher(idx2).hits(Term("text", "first"))) == [1, 2]
    assert old.index.commit is None
    with pytest.raises(SearchError, match="already exists"):
        Index.build(first, s, path=str(tmp_path / "ix"))


def test_fuzzy_containment(make_index):
    """fuzzy(k=0) = term; plain(k) ⊆ swaps(k) ⊆ swaps(k+1), for whole words and prefixes."""
    words = ["phoenix", "phonix", "pheonix", "phoenxi", "photo", "hpoenix", "phoenixes", "elixir",
             "xphoenix", "phx", "pheo"]
    idx = make_index(Schema().add_text_field("w"), [{"w": x} for x in words])
    assert hits(idx, Fuzzy("w", "phoenix", 0)) == hits(idx, Term("w", "phoenix"))
    for pre in (False, True):
        for q in ("phoenix", "pheo"):
            prev = None
            for k in (0, 1, 2):
                plain = set(hits(idx, Fuzzy("w", q, k, False, prefix=pre)))
                swaps = set(hits(idx, Fuzzy("w", q, k, True, prefix=pre)))
                assert plain <= swaps
                if prev is not None:
                    assert prev <= swaps
                prev = swaps


def test_entry_point_forms(make_index):
    """The reference's search calls and the function-style constructors."""
    from quarry import equals, fuzzy, fuzzy_prefix, phrase, prefix, range_, term
    s = (Schema().add_text_field("title", stored=True).add_text_field("body", stored=True)
         .add_u64_field("views", stored=True).add_bool_field("published", stored=True))
    idx = make_index(s, [
        {"title": "Elixir Guide", "body": "functional programming in elixir", "views": 10, "published": True},
        {"title": "Rust Book", "body": "systems programming", "views": 500, "published": False},
        {"title": "Phoenix Tips", "body": "web framework for elixir", "views": 50, "published": True}])
    sr = Searcher(idx)
    assert ids(sr.search_query("elixir", ["title", "body"])) == [0, 2]
    assert ids(sr.search_term("title", "rust")) == [1]
    assert ids(sr.search_prefix("title", "PHO")) == [2]
    assert ids(sr.search_range_u64("views", 10, 50)) == [0, 2]
    assert ids(sr.search_fuzzy("title", "elixr")) == [0]
    assert ids(sr.search_fuzzy_prefix("title", "phx")) == [2]
    assert hits(idx, phrase("body", "Functional Programming")) == [0]
    assert hits(idx, term("title", "guide")) == [0]
    assert hits(idx, prefix("body", "prog")) == [0, 1]
    assert hits(idx, fuzzy("body", "framwork", 1)) == [2]
    assert hits(idx, fuzzy_prefix("body", "framw", 1)) == [2]
    assert hits(idx, range_("views", 100, None)) == [1]
    assert hits(idx, equals("published", False)) == [1]
    r = sr.search_query("elixir", ["title"]).collect()[0]
    assert set(r.asDict()) == {"doc_id", "score", "title", "body", "views", "published"}


def test_boolean_algebra_matches_set_logic(make_index):
    """AND / OR / NOT / must-should / nesting equal set operations on which
    documents hold each word; scores add up over the matched clauses."""
    import random
    rnd = random.Random(11)
    vocab = ["ant", "bee", "cat", "dog", "eel"]
    docs = [" ".join(rnd.choices(vocab, k=rnd.randint(1, 6))) for _ in range(60)]
    idx = make_index(CONTENT, [{"content": d} for d in docs])
    has = {w: {i for i, d in enumerate(docs) if w in d.split()} for w in vocab}
    a, b, c = (Term("content", w) for w in ("ant", "bee", "cat"))
    assert set(hits(idx, all_of(a, b))) == has["ant"] & has["bee"]
    assert set(hits(idx, any_of(a, b))) == has["ant"] | has["bee"]
    assert set(hits(idx, boolean(must=[a], must_not=[b]))) == has["ant"] - has["bee"]
    assert set(hits(idx, boolean(must=[a], should=[b]))) == has["ant"]
    assert set(hits(idx, all_of(a, any_of(b, c)))) == has["ant"] & (has["bee"] | has["cat"])
    assert set(hits(idx, any_of(all_of(a, b), boolean(must=[c], must_not=[a])))) == \
        (has["ant"] & has["bee"]) | (has["cat"] - has["ant"])
    s = Searcher(idx)
    single = {w: {r["doc_id"]: r["score"] for r in s.hits(Term("content", w)).collect()} for w in vocab}
    combo = {r["doc_id"]: r["score"] for r in s.hits(boolean(must=[a], should=[b, c])).collect()}
    for d, sc in combo.items():
        want = single["ant"][d] + single["bee"].get(d, 0.0) + single["cat"].get(d, 0.0)
        assert abs(sc - want) < 1e-9
