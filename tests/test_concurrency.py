from concurrent.futures import ThreadPoolExecutor

from quarry import Schema, Searcher, Term, any_words


def test_concurrent_searches_agree(make_index):
    """Searches from several threads share one index and give the same
    answers as one after another (the reference's concurrent-search test)."""
    s = Schema().add_text_field("text", stored=True)
    docs = [f"doc {i} " + " ".join(["elixir", "web", "rust", "otp"][j] for j in range(i % 4 + 1))
            for i in range(40)]
    sr = Searcher(make_index(s, [{"text": t} for t in docs]))
    queries = [Term("text", "elixir"), Term("text", "rust"), any_words(["text"], "web otp"),
               Term("text", "otp")]

    def run(q):
        return [(r["doc_id"], round(r["score"], 9)) for r in sr.search(q, 5).collect()]

    serial = [run(q) for q in queries]
    with ThreadPoolExecutor(4) as pool:
        parallel = list(pool.map(run, queries))
    assert parallel == serial
