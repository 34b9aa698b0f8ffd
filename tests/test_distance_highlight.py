from hypothesis import given, settings
from hypothesis import strategies as st

from quarry import Schema, Searcher, Term, any_words
from quarry.functions.distance import edit_distance, prefix_distance_to_literal


def osa(a, b, swaps=True):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        d[i][0] = i
    for j in range(len(b) + 1):
        d[0][j] = j
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            c = 0 if a[i - 1] == b[j - 1] else 1
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + c)
            if swaps and i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[len(a)][len(b)]


def test_distance_pairs(spark):
    pairs = [("ca", "abc"), ("acbd", "abcd"), ("jose", "josé"), ("", "abc"), ("abc", ""),
             ("elixer", "elixir"), ("elixr", "elixir"), ("phoneix", "phoenix")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [(r["s"], r["p"]) for r in df.select(edit_distance("a", "b", True).alias("s"),
                                                edit_distance("a", "b", False).alias("p")).collect()]
    assert got == [(osa(a, b), osa(a, b, False)) for a, b in pairs]
    assert got[0][0] == 3 and got[1][0] == 1 and got[2][0] == 1 and got[7][0] == 1


@settings(max_examples=1, deadline=None)
@given(st.randoms(use_true_random=False))
def test_distance_matches_brute_force(spark, rnd):
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(0, 6))) for _ in range(300)]
    pairs = list(zip(words[::2], words[1::2]))
    df = spark.createDataFrame(pairs, "a string, b string")
    r = df.select(edit_distance("a", "b", True).alias("s"), edit_distance("a", "b", False).alias("p"),
                  prefix_distance_to_literal("b", "abc", 2, True).alias("q")).collect()
    for (a, b), x in zip(pairs, r):
        assert x["s"] == osa(a, b) and x["p"] == osa(a, b, False)
        best = min(osa("abc", b[:n]) for n in range(len(b) + 1))
        assert (x["q"] <= 2) == (best <= 2)


def test_snippet_escaping_and_marks(make_index):
    s = Schema().add_text_field("content", stored=True)
    idx = make_index(s, [{"content": "a & b <c> Elixir \"q\" it's"}])
    r = Searcher(idx).search_with_snippets(Term("content", "elixir"), ["content"]).collect()
    assert r[0]["snippets"]["content"] == "a &amp; b &lt;c&gt; <b>Elixir</b> &quot;q&quot; it&#x27;s"


def test_snippet_fragment_choice(make_index):
    s = Schema().add_text_field("content", stored=True)
    text = ("filler " * 40) + "elixir phoenix " + ("filler " * 40)
    idx = make_index(s, [{"content": text}])
    r = Searcher(idx).search_with_snippets(any_words(["content"], "elixir phoenix"),
                                           ["content"], 30).collect()
    snip = r[0]["snippets"]["content"]
    assert "<b>elixir</b> <b>phoenix</b>" in snip and len(snip.replace("<b>", "").replace("</b>", "")) <= 30
    none = Searcher(idx).search_with_snippets(Term("content", "filler"), ["content"], 20).collect()
    assert none[0]["snippets"]["content"].startswith("<b>filler</b>")


def test_fuzzy_snippet_marks_variant(make_index):
    s = Schema().add_text_field("content", stored=True)
    idx = make_index(s, [{"content": "the phoenix framework"}])
    r = Searcher(idx).search_fuzzy_with_snippets("content", "phonix", ["content"]).collect()
    assert "<b>phoenix</b>" in r[0]["snippets"]["content"]


def test_snippet_on_unstored_field(make_index):
    s = Schema().add_text_field("title", stored=True).add_text_field("body")   # body not stored
    idx = make_index(s, [{"title": "a", "body": "the phoenix framework"},
                         {"title": "b", "body": "nothing here"}])
    r = Searcher(idx).search_with_snippets(Term("body", "phoenix"), ["body", "title"]).collect()
    assert len(r) == 1 and "body" not in r[0].asDict()
    assert r[0]["snippets"]["body"] == "the <b>phoenix</b> framework"
    assert r[0]["snippets"]["title"] == ""


def test_the_cheap_filter_loses_no_near_word(spark):
    """`within_of_literal` holds for all words (and prefixes) the exact table accepts, and for few others."""
    import random

    from quarry.functions.distance import edit_distance_to_literal, swapped_forms, within_of_literal
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("mntaé") for _ in range(rng.randint(1, 7))) for _ in range(1500)})
    df = spark.createDataFrame([(w,) for w in words], "w string").localCheckpoint()
    assert swapped_forms("abcd", 2) == {"abcd": 0, "bacd": 1, "acbd": 1, "abdc": 1, "badc": 2}
    for q in ("mnt", "m", "mnéat", "tn" * 60):
        for k in (1, 2):
            for swaps in (True, False):
                r = df.select(within_of_literal("w", q, k, swaps).alias("a"), (edit_distance_to_literal("w", q, swaps) <= k).alias("b"),
                              within_of_literal("w", q, k, swaps, prefix=True).alias("c"),
                              (prefix_distance_to_literal("w", q, k, swaps) <= k).alias("d")).collect()
                assert not [x for x in r if (x["b"] and not x["a"]) or (x["d"] and not x["c"])], (q, k, swaps)
    kept = df.where(within_of_literal("w", "mnt", 1, True, prefix=True)).count()
    assert kept == df.where(prefix_distance_to_literal("w", "mnt", 1, True) <= 1).count()
