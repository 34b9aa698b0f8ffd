"""Secret scan with multipart credential linking.

Base spans (kinds assign, access, hex) need no context. Weak candidates alone
mean little: a bare token that looks random, a labelled user or key name, an
endpoint. They are reported only where the parts of a credential come
together: an access identifier and a secret, within WINDOW code points of each
other in one scope (a paragraph: text without a blank line), of which at least
one is a base span or an endpoint lies as near. An endpoint is reported where
it lies near both an identifier and a secret.

The parts of all documents are rows, (row, scope, role, start, end, strong),
and meet in an interval join on Spark: each part is put into the bins of
WINDOW code points that it covers, a weak one asks the bins that it reaches,
and a pair is kept in the first bin the two have in common. Parts of a kind
do not overlap, so what a part can meet is bounded by the window, however many
parts a document or scope has; all pairs of a scope are never made. Only
documents with parts that could complement one another enter the join.

Null and empty texts have no spans. Repeated ids and rows are scanned each on
its own and come back as rows of their own; null ids too. An empty table gives
no rows. Texts are scanned whole, whatever their length. Spans are in code
points, end exclusive; equal spans of two kinds are both given. Only doc_id
and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

# The base patterns. A match that fails its rule is dropped after
# it was consumed, so that matches stay leftmost and apart.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# Own weak candidates: a labelled account or key name, a bare token, an endpoint.
IDENT = r"""(user|user_?name|login|account|client_?id|access_?key(_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]+)"""
BARE = r"[A-Za-z0-9+/_=-]+"
ENDPOINT = r"""[a-z][a-z0-9+.-]*://[^\x00-\x20"'<>]+"""
BLANK_LINE = r"\n[\x20\t\r]*\n"

ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST, IDENT_LEAST, BARE_LEAST = 6, 20, 24, 3, 24
# Code points between the parts of one credential.
WINDOW = 200

# kinds in the order in which equal starts are listed, and the part each can play
KINDS = ("assign", "access", "hex", "ident", "bare", "endpoint")
BASE = 3
SECRET, IDENTIFIER, PLACE = 0, 1, 2
ROLES = (SECRET, IDENTIFIER, SECRET, IDENTIFIER, SECRET, PLACE)

_ASSIGN = re.compile(ASSIGN, re.I | re.A)
_IDENT = re.compile(IDENT, re.I | re.A)
# a run is maximal, so asking for its least length drops the short ones alone
_ACCESS = re.compile(ACCESS[:-1] + "{%d,}" % (ACCESS_LEAST - 4))
_HEX = re.compile(HEX[:-1] + "{%d,}" % HEX_LEAST)
_BARE = re.compile(BARE[:-1] + "{%d,}" % BARE_LEAST)
_ENDPOINT = re.compile(ENDPOINT)
_BLANK = re.compile(BLANK_LINE)


def mixed(token: str) -> bool:
    """Looks random: a digit, a small and a capital letter."""
    return bool(re.search("[0-9]", token) and re.search("[a-z]", token) and re.search("[A-Z]", token))


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all candidates, kind by kind."""
    low = text.lower()
    out = []
    if any(w in low for w in ("password", "passwd", "secret", "token", "api")):
        out += [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [(2, m.start(), m.end()) for m in _HEX.finditer(text)]
    if any(w in low for w in ("user", "login", "account", "client", "access")):
        out += [(3, m.start(), m.end()) for m in _IDENT.finditer(text) if len(m[3]) >= IDENT_LEAST]
    out += [(4, m.start(), m.end()) for m in _BARE.finditer(text) if mixed(m[0])]
    if "://" in text:
        out += [(5, m.start(), m.end()) for m in _ENDPOINT.finditer(text)]
    return out


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("scope", pa.int32())])
_FOUND = "doc_id long, spans array<struct<start int, kind int, end int, scope int>>"


def _found(batches):
    for batch in batches:
        rows = []
        for t in batch.column("text"):
            text = t.as_py()
            spans = spans_of(text) if text else []
            scopes = iter(())
            if any(k >= BASE for k, _, _ in spans):
                scopes = (m.start() for m in _BLANK.finditer(text))
            at, scope, out = next(scopes, None), 0, []
            for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2])):
                while at is not None and at < a:
                    at, scope = next(scopes, None), scope + 1
                out.append({"start": a, "kind": k, "end": b, "scope": scope})
            rows.append(out)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(_SPAN))], ["doc_id", "spans"])


def linked(found: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the weak candidates whose complements co-occur,
    from (row, spans)."""
    roles = F.array(*[F.lit(r) for r in ROLES])

    def has(role):
        return F.exists("spans", lambda s: F.get(roles, s.kind) == role)

    can = F.exists("spans", lambda s: s.kind >= BASE) & has(SECRET) & has(IDENTIFIER)
    part = found.where(can).select("row", F.explode("spans").alias("s")).select(
        "row", "s.scope", "s.kind", F.col("s.start").alias("a"), F.col("s.end").alias("b"), F.get(roles, F.col("s.kind")).alias("role"))

    def bins(low, high):
        return F.sequence(F.floor(low / WINDOW), F.floor(high / WINDOW))

    asks = part.where(F.col("kind") >= BASE).withColumn("first", F.floor((F.col("a") - WINDOW) / WINDOW)).withColumn(
        "bin", F.explode(bins(F.col("a") - WINDOW, F.col("b") + WINDOW)))
    gives = part.select("row", "scope", F.col("role").alias("r"), F.col("kind").alias("k"), F.col("a").alias("c"), F.col("b").alias("d"),
                        F.floor(F.col("a") / WINDOW).alias("f")).withColumn("bin", F.explode(bins(F.col("c"), F.col("d") - 1)))
    near = (F.col("c") <= F.col("b") + WINDOW) & (F.col("d") >= F.col("a") - WINDOW) & (F.col("bin") == F.greatest("first", "f"))
    met = (asks.join(gives, ["row", "scope", "bin"]).where(near).groupBy("row", "kind", "role", "a", "b").agg(
        F.bool_or(F.col("r") == SECRET).alias("secret"), F.bool_or(F.col("r") == IDENTIFIER).alias("identifier"),
        F.bool_or((F.col("r") == PLACE) | (F.col("k") < BASE)).alias("anchored")))
    return met.where("secret and identifier and anchored").select("row", "kind", F.col("a").alias("start"), F.col("b").alias("end"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), a row a document."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_found, _FOUND)
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    extra = linked(found).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("extra"))
    base = F.transform(F.filter("spans", lambda s: s.kind < BASE), lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))
    rows = found.join(extra, "row", "left").select("doc_id", base.alias("base"), "extra")
    names = F.array(*[F.lit(k) for k in KINDS])

    def text(spans):
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
            ":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")

    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(text(F.col("base")), 256).alias("base_sha256"),
                       text(F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.concat("base", "extra"))).alias("spans"))


def _sql_kind(kind: int, pattern: str, keep: str) -> str:
    """(r, kind, a, b) of a pattern: its matches and the pieces between them give the places."""
    p = pattern.replace("'", "''")
    return f"""SELECT r, {kind} AS kind, a, a + length(m) AS b FROM (
      SELECT r, m, keep, sum(length(piece)) OVER w + coalesce(sum(length(m)) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
      FROM (SELECT r, unnest(ms) AS m, unnest(string_split_regex(text, '{p}')[:len(ms)]) AS piece, generate_subscripts(ms, 1) AS i,
                   unnest(list_transform(ms, lambda m: {keep})) AS keep
            FROM (SELECT r, text, regexp_extract_all(text, '{p}', 0) AS ms FROM t))
      WINDOW w AS (PARTITION BY r ORDER BY i)) WHERE keep"""


def _either_case(pattern: str, words: tuple[str, ...]) -> str:
    """ASCII letters of the label in either case, spelt out: SQL's own flag folds other letters too."""
    for w in words:
        pattern = pattern.replace(w, "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w))
    return pattern


_SQL_ASSIGN = _either_case(ASSIGN, ("password", "passwd", "secret", "token", "api_?key"))
_SQL_IDENT = _either_case(IDENT.replace("(_?id)?", "(_?[Ii][Dd])?"), ("user_?name", "user", "login", "account", "client_?id", "access_?key"))


def _group(pattern: str, n: int) -> str:
    return f"length(regexp_extract(m, '{pattern.replace(chr(39), chr(39) * 2)}', {n}))"


ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({_sql_kind(0, _SQL_ASSIGN, f"{_group(_SQL_ASSIGN, 2)} >= {ASSIGN_LEAST}")}
  UNION ALL {_sql_kind(1, ACCESS, f"length(m) >= {ACCESS_LEAST}")}
  UNION ALL {_sql_kind(2, HEX, f"length(m) >= {HEX_LEAST}")}
  UNION ALL {_sql_kind(3, _SQL_IDENT, f"{_group(_SQL_IDENT, 3)} >= {IDENT_LEAST}")}
  UNION ALL {_sql_kind(4, BARE, f"length(m) >= {BARE_LEAST} AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')")}
  UNION ALL {_sql_kind(5, ENDPOINT, "true")}),
x AS (SELECT s.*, ['secret', 'id', 'secret', 'id', 'secret', 'place'][kind + 1] AS role,
             len(regexp_extract_all(substring(text, 1, a::BIGINT), '{BLANK_LINE}')) AS scope FROM s JOIN t USING (r)),
e AS (SELECT p.r, p.kind, p.a, p.b FROM x p JOIN x q ON p.r = q.r AND p.scope = q.scope AND q.a <= p.b + {WINDOW} AND q.b >= p.a - {WINDOW}
      WHERE p.kind >= {BASE} GROUP BY ALL
      HAVING bool_or(q.role = 'secret') AND bool_or(q.role = 'id') AND bool_or(q.role = 'place' OR q.kind < {BASE})),
o AS (SELECT r, kind, a, b, ['{"', '".join(KINDS)}'][kind + 1] || ':' || a::BIGINT || ':' || b::BIGINT AS name FROM s WHERE kind < {BASE}
      UNION ALL SELECT r, kind, a, b, ['{"', '".join(KINDS)}'][kind + 1] || ':' || a::BIGINT || ':' || b::BIGINT FROM e)
SELECT doc_id, count(o.r) FILTER (kind = 0) AS n_assign, count(o.r) FILTER (kind = 1) AS n_access, count(o.r) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(name, ',' ORDER BY a, kind) FILTER (kind < {BASE}), '')) AS base_sha256,
       coalesce(string_agg(name, ',' ORDER BY a, kind), '') AS spans
FROM t LEFT JOIN o USING (r) GROUP BY t.r, doc_id
"""
