from quarry import Schema, Searcher, Term
from quarry.plans.index import Index
from quarry.streaming import ingest_stream


def test_stream_equals_batch(spark, tmp_path):
    """Two files arrive as two micro-batches = two commits; the searchable
    result equals building the same rows in one batch."""
    src = tmp_path / "in"
    rows = [(i, f"doc {i} " + ("elixir web" if i % 2 else "rust systems")) for i in range(40)]
    schema = "doc_id long, text string"
    spark.createDataFrame(rows[:20], schema).coalesce(1).write.parquet(str(src / "a"))
    spark.createDataFrame(rows[20:], schema).coalesce(1).write.parquet(str(src / "b"))
    sdf = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", "true").parquet(str(src)))
    s = Schema().add_text_field("text", stored=True)
    out = str(tmp_path / "ix")
    ingest_stream(spark, sdf, s, out)
    streamed = Index.open(spark, out)
    commits = sorted(r[0] for r in streamed.corpus.select("commit_id").distinct().collect())
    assert commits == [0, 1]
    batch = Index.from_corpus(spark.createDataFrame(rows, schema), s)
    key = ["doc_id", "field", "term", "tf"]
    assert sorted(streamed.terms.select(*key).collect()) == sorted(batch.terms.select(*key).collect())
    a = {(r["doc_id"], round(r["score"], 9)) for r in Searcher(streamed).hits(Term("text", "elixir")).collect()}
    b = {(r["doc_id"], round(r["score"], 9)) for r in Searcher(batch).hits(Term("text", "elixir")).collect()}
    assert a == b and len(a) == 20
