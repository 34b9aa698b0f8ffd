"""quarry: full-text search expressed as Spark DataFrame plans.

Documents live in a Spark table; analysis turns them into a term table
(one row per field, term and document, with positions); every search is a
DataFrame plan over those tables, so one job can serve one query or a
whole table of queries.
"""

from quarry.functions.text import Analyzer
from quarry.schema import Field, Schema, SearchError
from quarry.query import (
    Bool, Equals, Fuzzy, Nothing, Phrase, Prefix, Range, Term,
    all_of, any_of, any_words, boolean, equals, fuzzy, fuzzy_prefix, match, phrase, prefix,
    range_, term,
)
from quarry.querystring import parse
from quarry.plans.index import Index
from quarry.plans.searcher import Searcher

__all__ = [
    "Analyzer", "Field", "Schema", "SearchError", "Index", "Searcher",
    "Term", "Phrase", "Prefix", "Fuzzy", "Range", "Equals", "Bool", "Nothing", "parse",
    "all_of", "any_of", "any_words", "boolean", "match",
    "term", "phrase", "prefix", "fuzzy", "fuzzy_prefix", "range_", "equals",
]
