import pytest

from quarry import Schema, SearchError
from quarry.sources.corpus import ingest


def test_schema_validation():
    with pytest.raises(SearchError, match="no_fields"):
        Schema().validate()
    with pytest.raises(SearchError, match="duplicate_field_names"):
        Schema().add_text_field("a").add_u64_field("a").validate()
    f = Schema().add_text_field("title").fields[0]
    assert (f.stored, f.indexed) == (False, True)


def test_field_names_with_symbols(spark, make_index):
    name = "a_b-c1" + "x" * 94
    s = Schema().add_text_field(name, stored=True)
    idx = make_index(s, [{name: "hello"}])
    from quarry import Searcher, Term
    assert Searcher(idx).hits(Term(name, "hello")).count() == 1


def test_typed_ingest_coercion(spark):
    df = spark.createDataFrame(
        [(1, "t", -1, 5, "x", True, 7), (2, None, 3, 2 ** 30, "y", False, None)],
        "doc_id long, title string, views long, n int, name string, flag boolean, extra long")
    schema = (Schema().add_text_field("title").add_u64_field("views").add_f64_field("n")
              .add_u64_field("name").add_bool_field("flag").add_i64_field("missing"))
    rows = {r["doc_id"]: r for r in ingest(df, schema).collect()}
    assert "extra" not in ingest(df, schema).columns           # unknown dropped
    assert rows[1]["views"] is None and rows[2]["views"] == 3   # negative u64 dropped
    assert rows[2]["n"] == float(2 ** 30)                        # integer widened
    assert rows[1]["name"] is None                               # string in numeric
    assert rows[1]["missing"] is None                            # missing field
    assert rows[2]["flag"] is False


def test_unsigned_decimal_source(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(1, Decimal(18446744073709551615)), (2, Decimal(-3))],
                               "doc_id long, big decimal(20,0)")
    r = {x["doc_id"]: x["big"] for x in ingest(df, Schema().add_u64_field("big")).collect()}
    assert int(r[1]) == 18446744073709551615 and r[2] is None


def test_missing_index_is_error(spark, tmp_path):
    from quarry import Index
    with pytest.raises(SearchError, match="not found"):
        Index.open(spark, str(tmp_path / "none"))


def test_schema_round_trip():
    s = Schema().add_text_field("t", stored=True).add_u64_field("n", indexed=False).add_bool_field("b")
    assert Schema.from_json(s.to_json()).fields == s.fields
