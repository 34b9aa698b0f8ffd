"""What is dealt by the chunk: the rows of the plain grouping, few of them through the exchange."""

import random
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry import Index, Schema
from quarry.functions.distance import neighbourhood, neighbourhood_keys
from quarry.functions.text import Analyzer
from quarry.operators import analysis, chunks
from quarry.sources.corpus import COMMIT_COL


def _rows(df, *cols):
    return sorted(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.select(*cols).collect())


def test_chunks_unroll_to_the_plain_rows(spark, tmp_path, monkeypatch):
    """Word ids, null and empty texts, gaps of n-grams, words in more documents than a chunk takes."""
    monkeypatch.setattr(chunks, "CHUNK_DOCS", 7)
    rng = random.Random(3)
    words = ["the", "of", "and", "Été", "x1", "longword", "rare"]
    rows = [(f"d{i:04d}", None if i % 50 == 3 else " ".join(rng.choices(words, [9, 8, 7, 3, 2, 2, 1], k=rng.randrange(0, 12))),
             rng.choice(["en", "fr", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    schema = Schema().add_text_field("text", analyzer=Analyzer(grams=3)).add_text_field("lang")
    idx = Index.build(df, schema, path=str(tmp_path / "ix"), partitions=5, pairs=True)
    cols = ("field", "term", "doc_id", "dl", "tf", "positions")
    assert _rows(idx.terms, *cols) == _rows(Index.from_corpus(df, schema).terms, *cols)
    place = idx._corpus.select("doc_id", analysis.BLOCK_COL)
    assert idx._terms.join(place, ["doc_id", analysis.BLOCK_COL], "left_anti").count() == 0
    # pairs: by brute force over the tokens of the common words
    common = {r["term"] for r in idx._common(idx._vocab, idx._stats).where("field = 'text'").collect()}
    toks = analysis._token_arrays(df, ["text"], "doc_id", None, schema.analyzers())[1].collect()
    want = {}
    for r in toks:
        for p, (a, b) in enumerate(zip(r["toks"] or [], (r["toks"] or [])[1:])):
            if a in common and b in common:
                want.setdefault((a, b, r["doc_id"], r["dl"]), []).append(p)
    got = _rows(idx.pairs.where("field = 'text'"), "w1", "w2", "doc_id", "dl", "positions")
    assert common and got == sorted((*k, tuple(v)) for k, v in want.items())


def test_few_rows_are_dealt(spark):
    """A word of two thousand documents is a few rows of the exchange, not two thousand, and its chunks do not overlap."""
    docs = spark.range(2_000).coalesce(1).select(F.col("id").alias("doc_id"), F.lit("same words here").alias("text"), F.lit(0).cast("long").alias(COMMIT_COL),
                                                 F.floor(F.col("id") / analysis.BLOCK_DOCS).alias(analysis.BLOCK_COL)).drop(COMMIT_COL)
    toks = analysis._token_arrays(docs, ["text"], "doc_id", None, None)[1].withColumnRenamed(analysis.BLOCK_COL, "block")
    rows = chunks._chunked(toks, analysis.RUN_BLOCKS, False, None, None).select("term", F.array_min("doc_id").alias("lo"), F.array_max("doc_id").alias("hi")).collect()
    assert len(rows) == 3 * -(-2_000 // chunks.CHUNK_DOCS)
    spans = sorted((r["lo"], r["hi"]) for r in rows if r["term"] == "same")
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_pieces_hold_every_row(monkeypatch):
    rng = random.Random(1)
    for most in (1, 3, 10, 100):
        monkeypatch.setattr(chunks, "PIECE_TOKENS", most)
        batches = [pa.RecordBatch.from_arrays([pa.array(range(k), pa.int64()), pa.array(
            [None if rng.random() < .2 else ["x"] * rng.randrange(6) for _ in range(k)], pa.list_(pa.string()))], ["id", "toks"])
            for k in rng.choices(range(6), k=8)]
        out = list(chunks._pieces(iter(batches)))
        assert [r for b, _ in out for r in b.to_pylist()] == [r for b in batches for r in b.to_pylist()]
        assert all(n.sum() <= most or (n > 0).sum() == 1 for _, n in out)


def test_a_terms_keys_are_the_same_in_both_forms(spark):
    rng = random.Random(2)
    terms = ["a", "é", "\U0001f600b"] + ["".join(rng.choice("abé\U0001f600") for _ in range(n)) for n in range(1, 40) for _ in range(4)]
    for r in spark.createDataFrame([(t,) for t in terms], "term string").select("term", neighbourhood_keys("term").alias("keys")).collect():
        assert set(r["keys"]) == neighbourhood(r["term"])


def test_the_keys_of_many_terms_at_once():
    rng = random.Random(4)
    terms = ["", "a", "é", "\U0001f600b"] + ["".join(rng.choice("abé\U0001f600") for _ in range(n)) for n in range(1, 17) for _ in range(20)] + ["x" * 17]
    found = {}
    for i, key in zip(*[x.tolist() for x in chunks.neighbourhoods(terms)]):
        found.setdefault(i, []).append(key)
    assert {i: sorted(k) for i, k in found.items()} == {i: sorted(neighbourhood(t)) for i, t in enumerate(terms[:-1])}


def test_one_message_a_part():
    """What a task sends to a partition is one compressed row, and comes out as it went in."""
    rows = [(rng_part, f"word{i}", [i, i + 1]) for i, rng_part in enumerate([2, 0, 2, 5, 0] * 400)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.list_(pa.int32())))], ["part", "term", "doc_id"])
    sent = chunks._messages(batch)
    assert sent.column("part").to_pylist() == [0, 2, 5] and sent.nbytes < batch.nbytes / 2
    out = [r for b in chunks._unpacked([sent]) for r in b.to_pylist()]
    assert out == [{"term": t, "doc_id": d} for p in (0, 2, 5) for q, t, d in rows if q == p]


def test_orders_are_stable():
    rng = np.random.default_rng(5)
    for most in (1, 10, 1 << 40, 1 << 62):
        key = rng.integers(0, most, 5_000) // max(1, most // 50)
        key[:2] = most - 1
        assert (chunks._order(key) == np.argsort(key, kind="stable")).all()
    assert not len(chunks._order(np.zeros(0, np.int64)))


def test_terms_of_any_letters_are_dealt_to_their_part():
    """Keys with NULs, long terms and cuts longer than a key, as a plain search of the cuts places them."""
    words = ["a\0", "ab\0c", "abcdefgh", "hijklmnopq", "x" * 40, "zz", "é" * 5]
    cuts = [("lang", "q"), ("text", "ab"), ("text", "abcdefghijklmnop"), ("text", "z")]
    rows = [r for b in chunks._near(cuts)([pa.RecordBatch.from_arrays([pa.array(["text"] * 7 + ["zfield"]), pa.array([*words, "w"])], ["field", "term"])])
            for part, m in zip(b.column("part").to_pylist(), [chunks._unpacked([b.slice(i, 1)]) for i in range(b.num_rows)])
            for batch in m for r in [{**x, "part": part} for x in batch.to_pylist()]]
    got = sorted((r["part"], r["field"], r["term"], k) for r in rows for k in r["keys"])
    assert got == sorted((bisect_right(cuts, (f, k)), f, t, k) for f, t in [*[("text", w) for w in words], ("zfield", "w")] for k in neighbourhood(t))
