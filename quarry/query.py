"""Query values: small immutable objects compiled to one DataFrame plan.

Leaves are Term, Phrase, Prefix, Fuzzy, Range, Equals and Nothing; Bool
composes them with must / should / must_not semantics. `quarry.querystring`
turns a query string into these values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from quarry.functions.text import analyse, grams_of
from quarry.schema import SearchError

INCLUSIVE = ("both", "lower", "upper", "neither")


class Query:
    def leaves(self):
        yield self


@dataclass(frozen=True)
class Nothing(Query):
    """Matches no document (a clause whose text holds no token)."""


@dataclass(frozen=True)
class Term(Query):
    """Exact token. The value is not analysed: `Term("title", "Hello")` only
    matches a token spelt `Hello`, which the analyser never produces."""
    field: str
    value: str


@dataclass(frozen=True)
class Phrase(Query):
    """Tokens side by side, in order."""
    field: str
    terms: tuple

    def __post_init__(self):
        object.__setattr__(self, "terms", tuple(self.terms))


@dataclass(frozen=True)
class Prefix(Query):
    """Tokens starting with the (lower-cased) prefix; the rest of the token
    must be ASCII letters and digits only."""
    field: str
    prefix: str

    def __post_init__(self):
        if not self.prefix:
            raise SearchError("Prefix cannot be empty")


@dataclass(frozen=True)
class Fuzzy(Query):
    """Tokens within `distance` edits of `term` (or, with prefix=True, tokens
    with a prefix within that distance). The term is not lower-cased."""
    field: str
    term: str
    distance: int = 1
    transposition: bool = True
    prefix: bool = False

    def __post_init__(self):
        if not isinstance(self.distance, int) or not 0 <= self.distance <= 2:
            raise SearchError("Distance must be between 0 and 2")


@dataclass(frozen=True)
class Range(Query):
    """Numeric value between bounds; `None` leaves a side open."""
    field: str
    lower: object = None
    upper: object = None
    inclusive: str = "both"
    kind: str | None = None      # "u64" / "i64" / "f64" to insist on a type

    def __post_init__(self):
        if self.inclusive not in INCLUSIVE:
            raise SearchError(
                f"inclusive must be one of {', '.join(INCLUSIVE)}, got {self.inclusive!r}")


@dataclass(frozen=True)
class Equals(Query):
    """Equality on a boolean or numeric field (`published:true`)."""
    field: str
    value: object


@dataclass(frozen=True)
class Bool(Query):
    must: tuple = field(default=())
    should: tuple = field(default=())
    must_not: tuple = field(default=())

    def __post_init__(self):
        for name in ("must", "should", "must_not"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        if not self.must and not self.should:
            raise SearchError("A boolean query needs at least one must or should clause")

    def leaves(self):
        for q in self.must + self.should + self.must_not:
            yield from q.leaves()


def all_of(*qs: Query) -> Bool:
    """`a AND b`."""
    return Bool(must=qs)


def any_of(*qs: Query) -> Bool:
    """`a OR b` (also `f:(a OR b)` with leaves on one field)."""
    return Bool(should=qs)


def boolean(must=(), should=(), must_not=()) -> Bool:
    """`+a b -c`: must, optional (score only), excluded."""
    return Bool(must=must, should=should, must_not=must_not)


def match(fields, text: str) -> Query:
    """The query-string leaf `f:text`: analysed; several tokens are a phrase.
    With several default fields the leaf is an OR over them."""
    if isinstance(fields, str):
        fields = [fields]
    if not fields:
        raise SearchError("At least one default field must be provided")
    toks = analyse(text)
    if not toks:
        return Nothing()
    per_field = [Term(f, toks[0]) if len(toks) == 1 else Phrase(f, toks) for f in fields]
    return per_field[0] if len(per_field) == 1 else Bool(should=per_field)


def match_field(field, text: str) -> Query:
    """`match` on a field of a schema, by the field's own analyzer. A token
    that becomes several n-grams is a phrase of them: an inner string."""
    toks, n = analyse(text, field.analyzer), field.analyzer.grams
    if not n:
        leaf = [Term(field.name, toks[0])] if len(toks) == 1 else [Phrase(field.name, toks)] if toks else []
    else:
        leaf = [Term(field.name, g[0]) if len(g) == 1 else Phrase(field.name, g) for g in (grams_of(t, n) for t in toks)]
    return Nothing() if not leaf else leaf[0] if len(leaf) == 1 else Bool(must=leaf)


def any_words(fields, text: str) -> Query:
    """Bare words `a b` over default fields: an OR of the words, each an OR
    over the fields."""
    if isinstance(fields, str):
        fields = [fields]
    if not fields:
        raise SearchError("At least one default field must be provided")
    words = [match(fields, w) for w in analyse(text)]
    if not words:
        return Nothing()
    return words[0] if len(words) == 1 else Bool(should=words)


# Function-style constructors, one per leaf kind.
def term(field: str, value: str) -> Term:
    return Term(field, value)


def phrase(field: str, text) -> Phrase:
    """A phrase from a token list, or from text (analysed)."""
    return Phrase(field, analyse(text) if isinstance(text, str) else text)


def prefix(field: str, p: str) -> Prefix:
    return Prefix(field, p)


def fuzzy(field: str, t: str, distance: int = 1, transposition: bool = True) -> Fuzzy:
    return Fuzzy(field, t, distance, transposition)


def fuzzy_prefix(field: str, p: str, distance: int = 1, transposition: bool = True) -> Fuzzy:
    return Fuzzy(field, p, distance, transposition, prefix=True)


def range_(field: str, lower=None, upper=None, inclusive: str = "both") -> Range:
    return Range(field, lower, upper, inclusive)


def equals(field: str, value) -> Equals:
    return Equals(field, value)
