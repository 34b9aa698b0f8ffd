from quarry import Schema, Searcher, Term, any_words
from quarry.operators import batch


def test_batch_equals_loop(spark, make_index):
    s = Schema().add_text_field("text", stored=True)
    docs = ["elixir phoenix web", "rust systems web", "elixir otp", "web web web design",
            "phoenix framework for elixir", "nothing here"]
    idx = make_index(s, [{"text": t} for t in docs])
    qs = spark.createDataFrame([(1, "elixir web"), (2, "web web rust"), (3, "absent")],
                               "query_id long, text string")
    got = {(r["query_id"], r["doc_id"]): round(r["score"], 9)
           for r in batch.batch_search(idx, qs, "text", 3).collect()}
    want = {}
    for qid, text in [(1, "elixir web"), (2, "web web rust"), (3, "absent")]:
        for r in Searcher(idx).search(any_words(["text"], text), 3, stored=False).collect():
            want[(qid, r["doc_id"])] = round(r["score"], 9)
    assert got == want


def test_batch_fuzzy_equals_brute_force(spark, make_index):
    from test_distance_highlight import osa
    s = Schema().add_text_field("text")
    vocab = ["phoenix", "phonix", "elixir", "elixer", "abcd", "acbd", "ab", "a", "josé"]
    idx = make_index(s, [{"text": " ".join(vocab)}])
    words = ["phoneix", "elixr", "abdc", "b", "jose", "zzz"]
    w = spark.createDataFrame([(x,) for x in words], "word string")
    for k in (1, 2):
        got = {(r["word"], r["term"]) for r in batch.batch_fuzzy(idx, w, "text", k).collect()}
        want = {(a, b) for a in words for b in vocab if osa(a, b) <= k}
        assert got == want


def test_pruned_batch_equals_unpruned(spark, make_index):
    """MaxScore pruning is exact: same top k as scoring every match."""
    import random
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(60)]
    weights = [1.0 / (i + 1) for i in range(60)]          # Zipf-like: w0 is a hot word
    docs = [" ".join(rnd.choices(vocab, weights, k=rnd.randint(3, 30))) for _ in range(300)]
    idx = make_index(Schema().add_text_field("text"), [{"text": t} for t in docs])
    qs = spark.createDataFrame(
        [(q, " ".join(rnd.choices(vocab, weights, k=rnd.randint(2, 12)))) for q in range(25)],
        "query_id long, text string")
    # every match scored: the sum of its words' single-term scores
    words = {w: {r["doc_id"]: r["score"] for r in Searcher(idx).hits(Term("text", w)).collect()} for w in vocab}
    every = {}
    for r in qs.collect():
        total = {}
        for w in r["text"].split():
            for d, s in words[w].items():
                total[d] = total.get(d, 0.0) + s
        every[r["query_id"]] = sorted(total.items(), key=lambda x: (-round(x[1], 9), x[0]))
    for k in (1, 5, 20):
        pruned = {(r["query_id"], r["rank"], r["doc_id"], round(r["score"], 9))
                  for r in batch.batch_search(idx, qs, "text", k).collect()}
        want = {(q, n + 1, d, round(s, 9)) for q, hits in every.items() for n, (d, s) in enumerate(hits[:k])}
        assert pruned == want


def test_searcher_batch_methods(spark, make_index):
    s = Schema().add_text_field("text")
    idx = make_index(s, [{"text": "phoenix web"}, {"text": "elixir web"}])
    sr = Searcher(idx)
    qs = spark.createDataFrame([(1, "web phoenix")], "query_id long, text string")
    assert [r["doc_id"] for r in sr.batch_search(qs, "text", 1).collect()] == [0]
    w = spark.createDataFrame([("phonix",)], "word string")
    assert [(r["term"], r["distance"]) for r in sr.correct_words(w, "text").collect()] == [("phoenix", 1)]


def _ranking(docs: dict, queries: dict, k: int) -> set:
    """(query, rank, id, score) by BM25 over every document."""
    from collections import Counter
    from math import log
    bags = {d: Counter(t.split()) for d, t in docs.items()}
    n, mean = len(bags), sum(map(Counter.total, bags.values())) / len(bags)
    df = Counter(w for b in bags.values() for w in b)
    out = set()
    for q, text in queries.items():
        words = Counter(w for w in text.split() if w in df)
        scores = {d: sum(c * log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * 2.2 * b[w] / (b[w] + 1.2 * (0.25 + 0.75 * b.total() / mean))
                         for w, c in words.items() if w in b) for d, b in bags.items()}
        best = sorted((x for x in scores.items() if x[1] > 0), key=lambda x: (-round(x[1], 9), x[0]))[:k]
        out |= {(q, i, d, round(s, 7)) for i, (d, s) in enumerate(best, 1)}
    return out


def test_blocks_of_documents_and_chunks_of_queries(spark, monkeypatch):
    """Whatever the blocks and chunks, every document is scored whole; copies go by their ids, here strings."""
    import random
    from quarry import Index
    from quarry.operators import batch_blocks
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(50)]
    weights = [1.0 / (i + 1) for i in range(50)]
    texts = [" ".join(rnd.choices(vocab, weights, k=rnd.randint(1, 25))) for _ in range(120)]
    docs = {f"d{i}": texts[i % 120 if i % 4 else 7] for i in range(400)}        # a hundred copies of one
    queries = {q: " ".join(rnd.choices(vocab, weights, k=rnd.randint(1, 9))) for q in range(20)} | {20: texts[7], 21: "absent", 22: None, 23: ""}
    idx = Index.from_corpus(spark.createDataFrame(sorted(docs.items()), "doc_id string, text string"), Schema().add_text_field("text"))
    qs = spark.createDataFrame(sorted(queries.items()), "query_id int, text string")
    for rows, words, k in ((1 << 19, 1 << 16, 4), (150, 1 << 16, 4), (150, 15, 4), (40, 30, 130)):
        monkeypatch.setattr(batch_blocks, "BLOCK_ROWS", rows)
        monkeypatch.setattr(batch_blocks, "QUERY_WORDS", words)
        got = [(r["query_id"], r["rank"], r["doc_id"], round(r["score"], 7)) for r in batch.batch_search(idx, qs, "text", k).collect()]
        assert len(got) == len(set(got)) and set(got) == _ranking(docs, {q: t or "" for q, t in queries.items()}, k)
    assert batch.batch_search(idx, qs.limit(0), "text", 4).count() == 0
    assert batch.batch_search(idx, qs.where("query_id > 20"), "text", 4).count() == 0


def test_pairs_of_query_and_document_are_not_dealt(spark, make_index):
    """A block gives each query's best documents on, not all that hold one of its words."""
    idx = make_index(Schema().add_text_field("text"), [{"text": "the of " + "and " * (i % 7) + f"w{i % 40}"} for i in range(400)])
    qs = spark.createDataFrame([(q, f"the of and w{q}") for q in range(10)], "query_id long, text string")
    hits = batch.batch_hits(idx, batch.query_terms(qs), "text", 3)
    assert hits.count() <= 10 * 3 * 7        # of the best score's copies three, at most, for each of seven lengths
    assert hits.groupBy("query_id").count().where("count >= 3").count() == 10
