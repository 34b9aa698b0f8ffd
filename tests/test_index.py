"""Commits, types and sizes of a written index."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry import (Equals, Fuzzy, Index, Nothing, Phrase, Prefix, Range, Schema, Searcher, SearchError, Term, all_of, any_of,
                    boolean, match)
from quarry.operators.predicates import value_ranges

TEXT = Schema().add_text_field("text", stored=True)


def _ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def _docs(spark, rows, ddl="doc_id long, text string"):
    return spark.createDataFrame(rows, ddl)


def test_open_by_path_alone(spark, tmp_path):
    s = TEXT.add_u64_field("n", stored=True).add_bool_field("b")
    Index.build(_docs(spark, [(1, "one", 5, True)], "doc_id long, text string, n long, b boolean"), s, path=str(tmp_path / "ix"))
    idx = Index.open(spark, str(tmp_path / "ix"))
    assert idx.schema.fields == s.fields and idx.id_col == "doc_id"
    assert _ids(Searcher(idx).hits(Term("text", "one"))) == [1]


def test_a_commit_id_is_used_once(spark, tmp_path):
    idx = Index.build(_docs(spark, [(1, "elixir")]), TEXT, path=str(tmp_path / "ix"))
    idx = idx.append(_docs(spark, [(2, "elixir"), (9, "elixir")]), 1)
    with pytest.raises(SearchError, match="Commit 1 already exists"):
        idx.append(_docs(spark, [(3, "elixir")]), 1)
    again = Index.open(spark, idx.path)
    assert {r["term"]: r["df"] for r in again.vocabulary().collect()} == {"elixir": 3}
    assert _ids(Searcher(again).hits(Term("text", "elixir"))) == [1, 2, 9]


def test_a_half_written_commit_is_not_seen(spark, tmp_path, monkeypatch):
    idx = Index.build(_docs(spark, [(1, "elixir")]), TEXT, path=str(tmp_path / "ix"))
    from quarry.operators import analysis
    monkeypatch.setattr(analysis, "commit_stats", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        idx.append(_docs(spark, [(2, "elixir")]), 1)
    monkeypatch.undo()
    seen = Index.open(spark, idx.path)
    assert _ids(seen.corpus) == [1] and seen.terms.count() == 1
    # its id can be written again; nothing of the first try is left
    idx = seen.append(_docs(spark, [(3, "rust")]), 1)
    assert _ids(idx.corpus) == [1, 3] and sorted(r["term"] for r in idx.terms.collect()) == ["elixir", "rust"]


def test_a_reader_keeps_its_commits(spark, tmp_path):
    idx = Index.build(_docs(spark, [(1, "elixir")]), TEXT, path=str(tmp_path / "ix"))
    idx.append(_docs(spark, [(2, "elixir")]), 1)
    assert _ids(Searcher(idx).hits(Term("text", "elixir"))) == [1]


def test_rewritten_sources_are_indexed_anew(spark, tmp_path):
    from quarry.plans import catalog
    sf = str(tmp_path)
    for word, ids in (("alpha", [1, 2]), ("beta", [3])):
        _docs(spark, [(i, word, "en", "s", 5) for i in ids], "doc_id long, text string, lang string, source string, n_chars long") \
            .write.mode("overwrite").parquet(sf + "/documents.parquet")
        _docs(spark, [(1, 1, 0)], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(sf + "/labels.parquet")
        idx = catalog.docs_index(spark, sf)
        assert _ids(Searcher(idx).hits(Term("text", word))) == ids


def test_ids_are_unique(spark, tmp_path):
    with pytest.raises(SearchError, match="unique"):
        Index.build(_docs(spark, [(1, "a"), (1, "b")]), TEXT, path=str(tmp_path / "a"))
    with pytest.raises(SearchError, match="unique"):
        Index.build(_docs(spark, [(None, "a")]), TEXT, path=str(tmp_path / "b"))
    idx = Index.build(_docs(spark, [(1, "a")]), TEXT, path=str(tmp_path / "c"))
    with pytest.raises(SearchError, match="indexed already"):
        idx.append(_docs(spark, [(1, "b")]), 1)


def test_unsigned_values(spark, tmp_path):
    s = TEXT.add_u64_field("n", stored=True)
    idx = Index.build(_docs(spark, [(1, "a", 5), (2, "a", -5)], "doc_id long, text string, n long"), s, path=str(tmp_path / "ix"))
    big = [(3, "a", Decimal(2 ** 63)), (4, "a", Decimal(2 ** 64 - 1))]
    idx = idx.append(_docs(spark, big, "doc_id long, text string, n decimal(20,0)"), 1)
    sr = Searcher(idx)
    assert _ids(sr.hits(Range("n", 2 ** 63, None))) == [3, 4]
    assert _ids(sr.hits(Range("n", 0, 2 ** 64 - 1))) == [1, 3, 4]
    assert _ids(sr.hits(Range("n", 2 ** 63, 2 ** 64 - 1, "neither"))) == []
    assert _ids(sr.hits(Range("n", None, 2 ** 70))) == [1, 3, 4] and _ids(sr.hits(Range("n", 2 ** 64, None))) == []
    assert _ids(sr.hits(Equals("n", 2 ** 64 - 1))) == [4]
    assert {r["doc_id"]: r["n"] for r in sr.search(Term("text", "a")).collect()} == {
        1: 5, 2: None, 3: 2 ** 63, 4: 2 ** 64 - 1}


def test_string_ids_and_clashing_fields(spark, tmp_path):
    s = (Schema().add_text_field("text", stored=True).add_f64_field("score", stored=True)
         .add_u64_field("hidden", indexed=False))
    df = _docs(spark, [("x", "one two", 7.5, 1), ("y", "two", 1.0, 2)], "key string, text string, score double, hidden long")
    sr = Searcher(Index.build(df, s, id_col="key", path=str(tmp_path / "ix")))
    r = sr.search(Term("text", "one")).collect()
    assert [(x["doc_id"], x["stored_score"], x["text"]) for x in r] == [("x", 7.5, "one two")] and r[0]["score"] > 0
    assert sr.hits(any_of(Term("text", "one"), Range("hidden", 0, 5))).collect()[0]["doc_id"] == "x"
    assert [x["doc_id"] for x in sr.hits(all_of(Term("text", "two"), Range("score", 5.0, None))).collect()] == ["x"]
    snip = sr.search_with_snippets(Term("text", "two"), ["text"]).collect()
    assert {x["doc_id"]: x["snippets"]["text"] for x in snip} == {"x": "one <b>two</b>", "y": "<b>two</b>"}


def test_long_words_and_empty_clauses(make_index):
    long = "x" * 45
    idx = make_index(TEXT, [{"text": f"alpha {long} beta"}, {"text": "alpha beta"}])
    s = Searcher(idx)
    assert _ids(s.hits(match("text", f"alpha {long.upper()} beta"))) == [0]
    assert _ids(s.hits(Phrase("text", ["alpha", "beta"]))) == [1]
    assert _ids(s.hits(Term("text", long))) == [0]
    assert match("text", "--") == Nothing()
    assert _ids(s.hits(all_of(Term("text", "alpha"), match("text", "--")))) == []
    assert _ids(s.hits(any_of(Term("text", "alpha"), match("text", "--")))) == [0, 1]
    assert _ids(s.hits(boolean(must=[Term("text", "alpha")], must_not=[match("text", "--")]))) == [0, 1]


def test_repeated_words_in_a_phrase(make_index):
    idx = make_index(TEXT, [{"text": "a b a b a"}, {"text": "a a b"}, {"text": "b a"}])
    got = {r["doc_id"] for r in Searcher(idx).hits(Phrase("text", ["a", "b", "a"])).collect()}
    assert got == {0}


def test_fuzzy_marks_with_thousands_of_variants(spark, make_index):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["abc"] + [f"{x}bc{y}" for x in letters for y in letters] + [f"a{x}{y}c" for x in letters for y in letters] \
        + [f"{x}{y}c" for x in letters for y in letters] + [f"a{x}{y}" for x in letters for y in letters] \
        + [f"{x}b{y}c" for x in letters for y in letters] + [f"ab{x}{y}" for x in letters for y in letters] \
        + [f"{x}{y}bc" for x in letters for y in letters] + [f"{x}b{y}" for x in letters for y in letters]
    words = sorted(set(words))
    assert len(words) > 4096
    docs = [{"text": "see abc here"}] + [{"text": " ".join(words[i:i + 50])} for i in range(0, len(words), 50)]
    r = Searcher(make_index(TEXT, docs)).search_fuzzy_with_snippets("text", "abc", ["text"], 2, True, 60, 200).collect()
    by = {x["doc_id"]: x["snippets"]["text"] for x in r}
    assert len(by) == len(docs) and by[0] == "see <b>abc</b> here" and all("<b>" in v for v in by.values())


def _rows_read(df):
    """Rows that the scan of a plan of one scan hands on, by its metric."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        plan.execute().count()
        return plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_pushed_ranges(spark, tmp_path):
    """40 scattered values read a small part of a sorted table; a plain IN reads it all."""
    path = str(tmp_path / "t")
    spark.range(400_000).select(F.format_string("t%06d", "id").alias("term")).coalesce(1) \
        .write.option("parquet.block.size", 64 * 1024).option("parquet.page.size", 8 * 1024).parquet(path)
    wanted = [f"t{i:06d}" for i in range(5000, 400_000, 10_000)]
    table = spark.read.parquet(path)
    plain = table.where(F.col("term").isin(wanted))
    ranged = table.where(value_ranges("term", wanted) & F.col("term").isin(wanted))
    assert plain.count() == ranged.count() == 40
    assert _rows_read(plain) > 350_000
    assert _rows_read(ranged) < 60_000


def test_partitions_grow_with_the_input(spark):
    from quarry.plans.index import TARGET_PARTITION_BYTES, _write_partitions

    class Fake:
        def __init__(self, size):
            self.size = size

        def __getattr__(self, name):
            return lambda *a: self

        def iterator(self):
            self.left = [1]
            return self

        def hasNext(self):
            return bool(self.left)

        def next(self):
            self.left.pop()
            return self

        def sizeInBytes(self):
            return self.size

    class Frame:
        def __init__(self, size):
            self._jdf = Fake(size)

    assert _write_partitions(spark, Frame(10 ** 14)) >= 10 ** 14 // TARGET_PARTITION_BYTES


def test_prefix_and_fuzzy_over_commits(spark, tmp_path):
    idx = Index.build(_docs(spark, [(1, "phoenix web")]), TEXT, path=str(tmp_path / "ix"))
    idx = idx.append(_docs(spark, [(2, "phonix"), (3, "other")]), 1).append(_docs(spark, []), 2)
    s = Searcher(idx)
    assert _ids(s.hits(Prefix("text", "pho"))) == [1, 2]
    assert _ids(s.hits(Fuzzy("text", "phoenix", 1))) == [1, 2]
    assert idx.commits == (0, 1, 2)
