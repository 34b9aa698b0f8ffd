"""Searcher: the reference's search calls as DataFrame plans over an Index.

Every method returns a DataFrame and runs nothing until an action, except
where a bounded set (the top-k ids, a fuzzy expansion) is collected to
plan a pushed-down lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import ranking
from quarry.operators.boolean import evaluate
from quarry.operators.bounded import bounded_hits
from quarry.query import Fuzzy, Prefix, Query, Range, Term, match_field
from quarry.querystring import parse
from quarry.schema import F64, I64, U64, SearchError


class Searcher:
    def __init__(self, index):
        self.index = index

    # ------------------------------------------------------------ matching
    def match(self, field: str, text: str) -> Query:
        """The query for a text on a field, by the field's own analyzer."""
        return match_field(self.index.schema.require_text(field), text)

    def hits(self, query: Query) -> DataFrame:
        """Every matching document with its score: (doc_id, score)."""
        return evaluate(self.index, query)

    def search(self, query: Query, limit: int = ranking.DEFAULT_LIMIT,
               stored: bool = True) -> DataFrame:
        """Top `limit` hits, best first, with their stored fields."""
        if not isinstance(limit, int) or limit < 1:
            raise SearchError("limit must be a positive integer")
        hits = bounded_hits(self.index, query, limit)
        top = ranking.top_k(self.hits(query) if hits is None else hits, limit)
        if stored:
            top = ranking.stored_fields(self.index, top, limit=limit)
        return top.orderBy(*ranking.rank_order())

    def total_hits(self, query: Query, limit: int = ranking.DEFAULT_LIMIT) -> DataFrame:
        """(total_hits, total_matches): hits returned (capped by the limit,
        as the reference reports) and the uncapped number of matches."""
        hits = self.hits(query)
        return hits.agg(F.least(F.count(F.lit(1)), F.lit(limit)).alias("total_hits"),
                        F.count(F.lit(1)).alias("total_matches"))

    def facets(self, query: Query, by: list, limit: int | None = None) -> DataFrame:
        """(facet, value, count): hits (the best `limit` of them, or all) by the
        values of stored fields, or by (field, edges) in numeric buckets."""
        from quarry.operators.facets import facets
        hits = self.hits(query)
        return facets(self.index, ranking.top_k(hits, limit) if limit else hits, by)

    def search_sorted(self, query: Query, field: str, descending: bool = False, limit: int = ranking.DEFAULT_LIMIT,
                      after: tuple | None = None, stored: bool = True) -> DataFrame:
        """Hits in the order of (field, doc_id), with the field's `value`:
        the first `limit`, or those after the row (value, doc_id)."""
        from quarry.operators.facets import sorted_page
        if not isinstance(limit, int) or limit < 1:
            raise SearchError("limit must be a positive integer")
        page = sorted_page(self.index, self.hits(query), field, descending, limit, after)
        if stored:
            page = ranking.stored_fields(self.index, page, limit=limit)
        return page.orderBy(F.desc("value") if descending else F.asc("value"), F.asc("doc_id"))

    @staticmethod
    def cursor(page: DataFrame) -> tuple | None:
        """What to continue a sorted page after: its last row; None if it is empty."""
        last = page.select("value", "doc_id").tail(1)
        return tuple(last[0]) if last else None

    # -------------------------------------------- the reference's entry points
    def search_term(self, field: str, value: str, limit: int = 10) -> DataFrame:
        return self.search(Term(field, value), limit)

    def parsed(self, query: Query | str, default_fields) -> Query:
        """A query string over the default fields as a query value."""
        if not default_fields:
            raise SearchError("At least one default field must be provided")
        for f in default_fields:
            self.index.schema.field(f)
        return parse(self.index.schema, default_fields, query) if isinstance(query, str) else query

    def search_query(self, query: Query | str, default_fields, limit: int = 10) -> DataFrame:
        return self.search(self.parsed(query, default_fields), limit)

    def search_prefix(self, field: str, prefix: str, limit: int = 10) -> DataFrame:
        return self.search(Prefix(field, prefix), limit)

    def search_range_u64(self, field, lower, upper, inclusive="both", limit=10):
        return self.search(Range(field, lower, upper, inclusive, U64), limit)

    def search_range_i64(self, field, lower, upper, inclusive="both", limit=10):
        return self.search(Range(field, lower, upper, inclusive, I64), limit)

    def search_range_f64(self, field, lower, upper, inclusive="both", limit=10):
        return self.search(Range(field, lower, upper, inclusive, F64), limit)

    def search_fuzzy(self, field, term, distance=1, transposition=True, limit=10):
        return self.search(Fuzzy(field, term, distance, transposition), limit)

    def search_fuzzy_prefix(self, field, prefix, distance=1, transposition=True, limit=10):
        return self.search(Fuzzy(field, prefix, distance, transposition, prefix=True), limit)

    def batch_search(self, queries: DataFrame, field: str, limit: int = 10,
                     text_col: str = "text", key: str = "query_id") -> DataFrame:
        """Top `limit` documents for every row of a query table (G1)."""
        from quarry.operators.batch import batch_search
        return batch_search(self.index, queries, field, limit, text_col, key)

    def batch_query_strings(self, queries: DataFrame, default_fields, limit: int | None = 10,
                            text_col: str = "text", key: str = "query_id") -> DataFrame:
        """Top `limit` documents for every query string of a table, in any form."""
        from quarry.operators.batch_queries import batch_query_strings
        return batch_query_strings(self.index, queries, default_fields, limit, text_col, key)

    def batch_queries(self, queries: dict[int, Query], limit: int | None = 10) -> DataFrame:
        """The same for query values, prefix and fuzzy leaves among them."""
        from quarry.operators.batch_queries import batch_queries
        return batch_queries(self.index, queries, limit)

    def correct_words(self, words: DataFrame, field: str, distance: int = 1,
                      transposition: bool = True, word_col: str = "word") -> DataFrame:
        """(word, term, distance) for the vocabulary terms near each word (G2)."""
        from quarry.operators.batch import batch_fuzzy
        return batch_fuzzy(self.index, words, field, distance, transposition, word_col)

    def search_with_snippets(self, query: Query | str, snippet_fields, max_snippet_chars: int = 150,
                             limit: int = 10, default_fields=()) -> DataFrame:
        from quarry.operators.highlight import attach_snippets
        if isinstance(query, str):
            query = self.parsed(query, default_fields)
        return attach_snippets(self.index, self.search(query, limit), query, snippet_fields, max_snippet_chars, limit)

    def search_fuzzy_with_snippets(self, field, term, snippet_fields, distance=1,
                                   transposition=True, max_snippet_chars=150, limit=10):
        return self.search_with_snippets(Fuzzy(field, term, distance, transposition),
                                         snippet_fields, max_snippet_chars, limit)
