"""Query strings: the documented forms, turned into query values on the driver.

    word  "a phrase"  field:word  field:"a phrase"  field:(a OR b)
    a AND b   a OR b   a b (as OR)   +required  -excluded  NOT excluded  (grouping)
    field:[1 TO 5]  field:{1 TO 5}  field:[1 TO *]  field:true  field:-5

AND binds tighter than OR. NOT excludes the clause after it, as `-` does
(`a NOT b`, `a AND NOT b`); quoted or after `field:` it is a word. Anything else (an unclosed quote or bracket, an
unknown field, a dangling operator, only excluded clauses) is an error.
"""

from __future__ import annotations

import re

from quarry.query import Bool, Equals, Nothing, Query, Range, match_field
from quarry.schema import BOOL, F64, NUMERIC_TYPES, TEXT, Schema, SearchError

_TOKEN = re.compile(r"""
    \s*(?:
      (?P<open>\() | (?P<close>\)) | (?<=[^\s()":\[\]{}]:)(?P<signed>[+-]\d[^\s()":\[\]{}]*) | (?P<occur>[+-])(?=\S)
    | (?P<quote>"(?P<phrase>[^"]*)")
    | (?P<range>[\[{]\s*(?P<low>[^\s\]}]+)\s+TO\s+(?P<high>[^\s\]}]+)\s*[\]}])
    | (?P<field>[^\s()":\[\]{}+\-][^\s()":\[\]{}]*):(?=\S)
    | (?P<word>[^\s()":\[\]{}]+)
    )""", re.X)


class _Parser:
    def __init__(self, schema: Schema, default_fields: list[str], text: str):
        self.schema, self.default, self.text = schema, list(default_fields), text
        self.tokens, at, end = [], 0, len(text.rstrip())
        while at < end:
            m = _TOKEN.match(text, at)
            if not m:
                raise self.error(f"unexpected {text[at:].strip()[:1]!r}")
            self.tokens.append(m)
            at = m.end()
        self.at = 0

    def error(self, why: str) -> SearchError:
        return SearchError(f"Failed to parse query '{self.text}': {why}")

    def peek(self, kind: str, *values: str) -> bool:
        if self.at >= len(self.tokens):
            return False
        v = self.tokens[self.at].group(kind)
        return v is not None and (not values or v in values)

    def parse(self) -> Query:
        if not self.tokens:
            return Nothing()
        q = self.clauses(self.default)
        if self.at < len(self.tokens):
            raise self.error("unbalanced ')'")
        return q

    def clauses(self, fields: list[str]) -> Query:
        """Clauses up to a closing bracket or the end, with what joins them."""
        groups: list[list[tuple[str | None, Query]]] = []
        joined = None
        while self.at < len(self.tokens) and not self.peek("close"):
            if self.peek("word", "AND", "OR"):
                if joined or not groups:
                    raise self.error(f"misplaced {self.tokens[self.at].group('word')}")
                joined = self.tokens[self.at].group("word")
                self.at += 1
                continue
            occur = None
            if self.peek("occur"):
                occur = self.tokens[self.at].group("occur")
                self.at += 1
            elif self.peek("word", "NOT"):
                occur = "-"
                self.at += 1
            if occur and (self.peek("occur") or self.peek("word", "AND", "OR", "NOT")):
                raise self.error(f"misplaced {self.tokens[self.at].group().strip()}")
            clause = (occur, self.leaf(fields))
            if joined == "AND":
                groups[-1].append(clause)
            else:
                groups.append([clause])
            joined = None
        if joined:
            raise self.error(f"{joined} without a second clause")
        if not groups:
            raise self.error("empty group")
        return self.combine([(g[0][0], g[0][1]) if len(g) == 1 else (None, self.conjunction(g)) for g in groups])

    def conjunction(self, group) -> Query:
        return self.bool([q for o, q in group if o != "-"], [], [q for o, q in group if o == "-"])

    def combine(self, clauses) -> Query:
        if len(clauses) == 1 and clauses[0][0] != "-":
            return clauses[0][1]
        return self.bool(*([q for o, q in clauses if o == want] for want in ("+", None, "-")))

    def bool(self, must, should, must_not) -> Query:
        if not must and not should:
            raise self.error("only excluded clauses")
        return Bool(must, should, must_not)

    def leaf(self, fields: list[str]) -> Query:
        if self.at >= len(self.tokens):
            raise self.error("a clause is missing")
        m = self.tokens[self.at]
        self.at += 1
        if m.group("field"):
            name = m.group("field")
            if name not in self.schema.names:
                raise self.error(f"field '{name}' does not exist")
            return self.leaf([name])
        if m.group("open"):
            q = self.clauses(fields)
            if not self.peek("close"):
                raise self.error("unclosed '('")
            self.at += 1
            return q
        if m.group("quote"):
            return self.over(fields, lambda f: match_field(f, m.group("phrase")) if f.type == TEXT else None)
        if m.group("range"):
            return self.over(fields, lambda f: self.range(f, m))
        if m.group("signed"):
            return self.over(fields, lambda f: self.word(f, m.group("signed")))
        if m.group("word"):
            if re.search(r"[*^~]", m.group("word")) or m.group("word") in ("+", "-"):
                raise self.error(f"'{m.group('word')}' is not supported")
            return self.over(fields, lambda f: self.word(f, m.group("word")))
        raise self.error(f"unexpected '{m.group().strip()}'")

    def over(self, fields: list[str], leaf) -> Query:
        """The leaf on each field whose type takes it, as alternatives."""
        found = [q for q in (leaf(self.schema.field(f)) for f in fields) if q is not None]
        if not found:
            raise self.error(f"no value for field {', '.join(fields)}")
        return found[0] if len(found) == 1 else Bool(should=found)

    def number(self, f, text: str):
        try:
            return float(text) if f.type == F64 else int(text)
        except ValueError:
            return None

    def word(self, f, text: str) -> Query | None:
        if f.type == TEXT:
            return match_field(f, text)
        value = {"true": True, "false": False}.get(text) if f.type == BOOL else self.number(f, text)
        return None if value is None else Equals(f.name, value)

    def range(self, f, m) -> Query | None:
        if f.type not in NUMERIC_TYPES:
            return None
        bounds = []
        for side in ("low", "high"):
            text = m.group(side)
            value = None if text == "*" else self.number(f, text)
            if value is None and text != "*":
                raise self.error(f"'{text}' is not a bound for field '{f.name}'")
            bounds.append(value)
        shape = m.group("range")[0] + m.group("range")[-1]
        inclusive = {"[]": "both", "[}": "lower", "{]": "upper", "{}": "neither"}[shape]
        return Range(f.name, *bounds, inclusive)


def parse(schema: Schema, default_fields: list[str], text: str) -> Query:
    """The query a string stands for, over the default fields where it names none."""
    return _Parser(schema, default_fields, text).parse()
