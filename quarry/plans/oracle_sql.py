"""DuckDB SQL for each registered query: an independent oracle.

Written by hand against the raw tables (never generated from the Spark
plans), so a planning bug cannot hide in both. Float constants are cast to
DOUBLE (DuckDB reads 0.75 as DECIMAL); integer outputs are BIGINT.
"""

from __future__ import annotations

TOK = r"[\p{L}\p{N}]+"
PIECES = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"
D = "::DOUBLE"


def _bm25(idf: str, tf: str, dl: str, avgdl: str) -> str:
    return (f"((({idf}) * 2.2{D} * {tf}) / ({tf} + 1.2{D} * "
            f"(0.25{D} + (0.75{D} * {dl}) / {avgdl})))")


def _idf(df: str, n: str) -> str:
    return f"ln(1.0{D} + (({n} - {df})::DOUBLE + 0.5{D}) / ({df}{D} + 0.5{D}))"


def _posts(table: str, id_col: str, fields: list[str], where: str = "") -> str:
    parts = []
    for f in fields:
        parts.append(f"""
      SELECT doc_id, '{f}' AS field, term, pos FROM (
        SELECT {id_col} AS doc_id, unnest(l) AS term, generate_subscripts(l, 1) - 1 AS pos
        FROM (SELECT {id_col}, regexp_extract_all(lower({f}), '{TOK}') AS l
              FROM {table} {where}))""")
    return " UNION ALL ".join(parts)


def _index(table: str, id_col: str, fields: list[str], where: str = "") -> str:
    """CTEs p (postings), tf, dl, dfs, st (per-field n, avgdl), sc (BM25 per term row)."""
    vals = ", ".join(f"('{f}')" for f in fields)
    return f"""
p AS ({_posts(table, id_col, fields, where)}),
tf AS (SELECT field, doc_id, term, count(*) AS tf FROM p GROUP BY field, doc_id, term),
dl AS (SELECT field, doc_id, count(*) AS dl FROM p GROUP BY field, doc_id),
dfs AS (SELECT field, term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY field, term),
nd AS (SELECT count(*) AS n FROM {table} {where}),
st AS (SELECT f.field, nd.n, coalesce(t.tot, 0)::BIGINT AS total_len,
              coalesce(t.tot, 0)::DOUBLE / greatest(nd.n, 1) AS avgdl
       FROM (VALUES {vals}) f(field) CROSS JOIN nd
       LEFT JOIN (SELECT field, count(*) AS tot FROM p GROUP BY field) t USING (field)),
sc AS (SELECT tf.field, tf.term, tf.doc_id, tf.tf, dl.dl, dfs.df,
              {_bm25(_idf('dfs.df', 'st.n'), 'tf.tf', 'dl.dl', 'st.avgdl')} AS score
       FROM tf JOIN dl USING (field, doc_id) JOIN dfs USING (field, term) JOIN st USING (field))"""


DOCS = "(SELECT d.*, l.quality, (l.toxic = 1) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
DOCS_IX = "WITH " + _index(DOCS + " dd", "doc_id", ["text"])
DOCS_FIELDS_IX = "WITH " + _index(DOCS + " dd", "doc_id", ["text", "lang", "source"])
PART_IX = "WITH " + _index("part", "p_partkey", ["p_name", "p_type"])


def _term(field: str, term: str) -> str:
    return f"SELECT doc_id, score FROM sc WHERE field = '{field}' AND term = '{term}'"


def _phrase(field: str, words: list[str]) -> str:
    """Docs with the words at consecutive positions; BM25 with the phrase count."""
    a = words
    joins = " ".join(
        f"JOIN p p{i} ON p{i}.doc_id = p0.doc_id AND p{i}.field = p0.field "
        f"AND p{i}.pos = p0.pos + {i} AND p{i}.term = '{a[i]}'" for i in range(1, len(a)))
    idf = " + ".join(
        f"(SELECT {_idf('df', '(SELECT n FROM st WHERE field = ' + repr(field) + ')')} "
        f"FROM dfs WHERE field = '{field}' AND term = '{t}')" for t in a)
    return f"""SELECT ph.doc_id,
        {_bm25(idf, 'ph.pf', 'dl.dl', 'st.avgdl')} AS score
      FROM (SELECT p0.doc_id, count(*) AS pf FROM p p0 {joins}
            WHERE p0.field = '{field}' AND p0.term = '{a[0]}' GROUP BY p0.doc_id) ph
      JOIN dl ON dl.doc_id = ph.doc_id AND dl.field = '{field}'
      JOIN st ON st.field = '{field}'"""


def _const(sql_where: str) -> str:
    return f"SELECT DISTINCT doc_id, 1.0{D} AS score FROM p WHERE {sql_where}"


ASCII1 = "regexp_replace(term, '[^\\x00-\\x7F]', chr(1), 'g')"


def _bool(leaves: list[str], matched: str, score: str, ix: str = DOCS_IX) -> str:
    """Leaves l1..ln as (doc_id, score) sets; `matched` / `score` over s1..sn."""
    ctes = ",\n".join(f"l{i + 1} AS ({q})" for i, q in enumerate(leaves))
    union = " UNION ALL ".join(f"SELECT {i + 1} AS leaf, doc_id, score FROM l{i + 1}"
                               for i in range(len(leaves)))
    cols = ", ".join(f"max(CASE WHEN leaf = {i + 1} THEN score END) AS s{i + 1}"
                     for i in range(len(leaves)))
    return f"""{ix},
{ctes},
g AS (SELECT doc_id, {cols} FROM ({union}) u GROUP BY doc_id)
SELECT doc_id, round({score}, 6) AS score FROM g WHERE {matched}"""


def _hits(leaf: str, ix: str = DOCS_IX) -> str:
    return f"{ix}, h AS ({leaf}) SELECT doc_id, round(score, 6) AS score FROM h"


def _m(i):   # matched leaf i
    return f"s{i} IS NOT NULL"


def _s(i):   # score of leaf i if matched
    return f"coalesce(s{i}, 0.0{D})"


BM25_WORDS = ["the", "language", "of", "data"]
_bm25_leaves = [_term("text", w) for w in BM25_WORDS]
_bm25_matched = " OR ".join(_m(i + 1) for i in range(4))
_bm25_score = "0.0::DOUBLE + " + " + ".join(_s(i + 1) for i in range(4))
BM25_ALL = _bool(_bm25_leaves, _bm25_matched, _bm25_score)


def _top(sql_all: str, k: int = 10) -> str:
    return f"SELECT * FROM ({sql_all}) ORDER BY round(score, 9) DESC, doc_id LIMIT {k}"


_BM25_TOP_RAW = _bool(_bm25_leaves, _bm25_matched, _bm25_score).replace(
    f"round({_bm25_score}, 6) AS score", f"{_bm25_score} AS score")


def _snippet_sql(hits_sql: str, weights_sql: str, max_chars: int = 150,
                 src: str = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Best fragment chosen by a constant-state list_reduce, then marked and escaped."""
    w = f"regexp_matches(x, '^[\\p{{L}}\\p{{N}}]')"
    wt = f"CASE WHEN {w} THEN coalesce(map_extract_value(m, lower(x)), 0.0{D}) ELSE 0.0{D} END"
    end = "(acc.off + length(x))"
    brk = f"({w} AND {end} - acc.fs > {max_chars})"
    better = f"({brk} AND acc.fsc > acc.bsc)"
    step = f"""lambda acc, x: struct_pack(
        off := {end}::BIGINT,
        fs := (CASE WHEN {brk} THEN acc.off ELSE acc.fs END)::BIGINT,
        fe := (CASE WHEN {w} THEN {end} ELSE acc.fe END)::BIGINT,
        fsc := (CASE WHEN {brk} THEN {wt} ELSE acc.fsc + {wt} END)::DOUBLE,
        bs := (CASE WHEN {better} THEN acc.fs ELSE acc.bs END)::BIGINT,
        be := (CASE WHEN {better} THEN acc.fe ELSE acc.be END)::BIGINT,
        bsc := (CASE WHEN {better} THEN acc.fsc ELSE acc.bsc END)::DOUBLE)"""
    init = ("struct_pack(off := 0::BIGINT, fs := 0::BIGINT, fe := 0::BIGINT, fsc := 0.0::DOUBLE,"
            " bs := 0::BIGINT, be := 0::BIGINT, bsc := 0.0::DOUBLE)")
    esc = ("replace(replace(replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),"
           " '\"', '&quot;'), '''', '&#x27;')")
    mark = (f"array_to_string(list_transform(regexp_extract_all(frag, '{PIECES}'), lambda x: "
            f"CASE WHEN {w} AND map_contains(m, lower(x)) THEN '<b>' || {esc} || '</b>' "
            f"ELSE {esc} END), '')")
    return f"""
wm AS (SELECT coalesce(map_from_entries(list(struct_pack(k := term, v := 1.0{D} / (1.0{D} + df)))),
                       MAP {{}}::MAP(VARCHAR, DOUBLE)) AS m FROM ({weights_sql})),
hs AS ({hits_sql}),
r AS (SELECT hs.doc_id, hs.score, dd.{text_col} AS text, wm.m,
             list_reduce(regexp_extract_all(dd.{text_col}, '{PIECES}'), {step}, {init}) AS st
      FROM hs JOIN {src or DOCS} dd ON dd.{id_col} = hs.doc_id CROSS JOIN wm),
b AS (SELECT doc_id, score, text, m,
             CASE WHEN st.fsc > st.bsc THEN st.fs ELSE st.bs END AS bs,
             CASE WHEN st.fsc > st.bsc THEN st.fe ELSE st.be END AS be,
             greatest(st.fsc, st.bsc) AS bsc FROM r),
f AS (SELECT *, substring(text, bs + 1, be - bs) AS frag FROM b)
SELECT doc_id, round(score, 6) AS score,
       CASE WHEN bsc > 0 THEN {mark} ELSE '' END AS snippet FROM f"""


def _osa(t: str, q: str) -> str:
    """Optimal-string-alignment distance between column `t` and literal `q`
    in characters: list_reduce over t's characters, each row built by a
    nested list_reduce over q's; every number BIGINT."""
    m = len(q)
    row = (f"list_reduce(range(1, {m} + 1), lambda r, j: list_append(r, least("
           f"acc.p[j + 1] + 1, r[j] + 1, acc.p[j] + (CASE WHEN substring({t}, i, 1) = "
           f"substring('{q}', j, 1) THEN 0 ELSE 1 END), "
           f"CASE WHEN i > 1 AND j > 1 AND substring({t}, i, 1) = substring('{q}', j - 1, 1) "
           f"AND substring({t}, i - 1, 1) = substring('{q}', j, 1) THEN acc.pp[j - 1] + 1 "
           f"ELSE 999 END)::BIGINT), [i::BIGINT])")
    init = f"struct_pack(pp := range(0, {m} + 1)::BIGINT[], p := range(0, {m} + 1)::BIGINT[])"
    return (f"(CASE WHEN length({t}) = 0 THEN {m} ELSE list_reduce(range(1, length({t}) + 1), "
            f"lambda acc, i: struct_pack(pp := acc.p, p := {row}), {init}).p[{m} + 1] END)")


_FUZZY_THIER = _const(f"field = 'text' AND abs(length(term) - 5) <= 1 "
                      f"AND damerau_levenshtein({ASCII1}, 'thier') <= 1")

# exact char-level "within one edit, a swap counting one" between word w and term t
_DEL = "list_transform(range(1, length({s}) + 1), lambda i: substring({s}, 1, i - 1) || substring({s}, i + 1))"
_OSA1 = f"""(w.word = v.term
   OR (length(v.term) = length(w.word) + 1 AND list_contains({_DEL.format(s='v.term')}, w.word))
   OR (length(w.word) = length(v.term) + 1 AND list_contains({_DEL.format(s='w.word')}, v.term))
   OR (length(w.word) = length(v.term) AND list_bool_or(list_transform(range(1, length(w.word) + 1),
        lambda i: substring(w.word, 1, i - 1) || substring(w.word, i + 1)
                = substring(v.term, 1, i - 1) || substring(v.term, i + 1))))
   OR (length(w.word) = length(v.term) AND list_bool_or(list_transform(range(1, length(w.word)),
        lambda i: substring(w.word, 1, i - 1) || substring(w.word, i + 1, 1) || substring(w.word, i, 1)
                  || substring(w.word, i + 2) = v.term))))"""

TURNS = "(SELECT conv_id || ':' || turn AS doc_id, role, text FROM conversations)"
TURNS_IX = "WITH " + _index(TURNS + " cc", "doc_id", ["role", "text"])
PAGES_IX = "WITH " + _index("pages", "page_id", ["html"])
HTML_WORDS = ["amp", "href", "nav"]
_html_leaves = [_term("html", w) for w in HTML_WORDS]
_html_matched = " OR ".join(_m(i + 1) for i in range(3))
_html_score = "0.0::DOUBLE + " + " + ".join(_s(i + 1) for i in range(3))
_HTML_TOP_RAW = _bool(_html_leaves, _html_matched, _html_score, PAGES_IX).replace(
    f"round({_html_score}, 6) AS score", f"{_html_score} AS score")

_LENGTH = ("CASE WHEN n_chars < 100 THEN '(*, 100)' WHEN n_chars < 1000 THEN '[100, 1000)' "
           "WHEN n_chars < 5000 THEN '[1000, 5000)' ELSE '[5000, *)' END")


def _facets(hits: str, toxic: bool) -> str:
    """Counts by value, one grouped query a facet."""
    d = f"(SELECT * FROM {DOCS} x WHERE doc_id IN (SELECT doc_id FROM hits))"
    parts = [f"SELECT 'lang' AS facet, lang AS value, count(*) AS count FROM {d} y WHERE lang IS NOT NULL GROUP BY lang",
             f"SELECT 'n_chars', {_LENGTH}, count(*) FROM {d} y WHERE n_chars >= 0 GROUP BY 2"]
    if toxic:
        parts.append(f"SELECT 'toxic', toxic::VARCHAR, count(*) FROM {d} y WHERE toxic IS NOT NULL GROUP BY toxic")
    return f"SELECT * FROM (WITH hits AS ({hits}) " + " UNION ALL ".join(parts) + ")"


ORACLES = {
    "ingest_typed": """
SELECT c_custkey AS doc_id, c_name, c_acctbal::DOUBLE AS c_acctbal,
       CASE WHEN c_nationkey >= 0 THEN c_nationkey::BIGINT END AS c_nationkey,
       floor(c_acctbal)::BIGINT AS balance_units,
       CASE WHEN floor(c_acctbal) >= 0 THEN floor(c_acctbal)::BIGINT END AS balance_u,
       NULL::BOOLEAN AS c_mktsegment, NULL::VARCHAR AS c_phone
FROM customer""",
    "corpus_scan": f"""
SELECT doc_id, text, lang, source, CASE WHEN n_chars >= 0 THEN n_chars END AS n_chars,
       CASE WHEN quality >= 0 THEN quality::BIGINT END AS quality, toxic FROM {DOCS}""",
    "append_commit": f"""
SELECT doc_id, lang, CASE WHEN n_chars >= 0 THEN n_chars END AS n_chars,
       (doc_id % 3)::BIGINT AS commit_id
FROM documents""",
    "snapshot_read": "WITH " + _index(DOCS + " dd", "doc_id", ["text"],
                                      "WHERE doc_id % 3 <= 1")
    + f", h AS ({_term('text', 'the')}) SELECT doc_id, round(score, 6) AS score FROM h",
    "stream_ingest": "WITH " + _index("documents", "doc_id", ["text"])
    + " SELECT doc_id, field, term, tf FROM tf",
    "tokenise": f"""
SELECT doc_id, len(l)::BIGINT AS n_tokens, array_to_string(l, ' ') AS tokens
FROM (SELECT doc_id, regexp_extract_all(lower(text), '{TOK}') AS l FROM documents)""",
    "postings": "WITH p AS (" + _posts("documents", "doc_id", ["text"])
    + ") SELECT doc_id, field, pos::BIGINT AS pos, term FROM p",
    "term_stats": DOCS_FIELDS_IX + f"""
SELECT field, term, doc_id, tf, dl, df, cf, round({_idf('df', 'n')}, 6) AS idf
FROM tf JOIN dl USING (field, doc_id) JOIN dfs USING (field, term) JOIN st USING (field)""",
    "vocabulary": DOCS_FIELDS_IX + " SELECT field, term, df, cf FROM dfs",
    "corpus_stats": DOCS_FIELDS_IX + " SELECT field, n AS n_docs, total_len, round(avgdl, 6) AS avgdl FROM st",
    "term_match": _hits(_term("text", "the")),
    "field_term": _hits(_term("p_name", "red"), PART_IX),
    "field_phrase": _hits(_phrase("text", ["in", "the"])),
    "prefix_match": _hits(_const("field = 'text' AND regexp_full_match(term, 'men[a-z0-9]*')")),
    "fuzzy_match": _hits(_FUZZY_THIER),
    "fuzzy_plain": _hits(_const(f"field = 'text' AND abs(length(term) - 8) <= 2 "
                                f"AND levenshtein({ASCII1}, 'oratnion') <= 2")),
    "fuzzy_swaps_k2": _hits(_const(
        f"field = 'text' AND abs(length(term) - 8) <= 2 AND levenshtein({ASCII1}, 'oratnion') <= 4 "
        f"AND {_osa('term', 'oratnion')} <= 2")),
    "fuzzy_prefix": _hits(_const(
        f"field = 'text' AND list_min(list_transform(range(0, least(length(term), 4) + 1), "
        f"lambda n: damerau_levenshtein(left({ASCII1}, n), 'mnt'))) <= 1")),
    "phrase_match": _hits(_phrase("text", ["of", "the"])),
    "range_u64": f"SELECT doc_id, 1.0{D} AS score FROM documents WHERE n_chars BETWEEN 100 AND 1000",
    "range_i64": f"""SELECT c_custkey AS doc_id, 1.0{D} AS score FROM customer
                     WHERE floor(c_acctbal) >= -500 AND floor(c_acctbal) < 500""",
    "range_f64": f"SELECT event_id AS doc_id, 1.0{D} AS score FROM events WHERE value > 10.0 AND value < 50.0",
    "range_u64_high": f"SELECT c_custkey AS doc_id, 1.0{D} AS score FROM customer WHERE c_custkey >= 100",
    "range_open": f"SELECT doc_id, 1.0{D} AS score FROM documents WHERE n_chars >= 1000",
    "field_equals": f"SELECT doc_id, 1.0{D} AS score FROM {DOCS} WHERE toxic",
    "bool_and": _bool([_term("text", "de"), _term("text", "la")],
                      f"{_m(1)} AND {_m(2)}", f"0.0{D} + {_s(1)} + {_s(2)}"),
    "bool_or": _bool([_term("text", "und"), _term("text", "y")],
                     f"{_m(1)} OR {_m(2)}", f"0.0{D} + {_s(1)} + {_s(2)}"),
    "bool_default_or": _bool([_term("text", w) for w in ("der", "die", "das")],
                             f"{_m(1)} OR {_m(2)} OR {_m(3)}",
                             f"0.0{D} + {_s(1)} + {_s(2)} + {_s(3)}"),
    "bool_must_should": _bool([_term("text", "the"), _term("text", "of")],
                              _m(1), f"0.0{D} + {_s(1)} + {_s(2)}"),
    "bool_must_not": _bool([_term("text", "the"), _term("text", "and")],
                           f"{_m(1)} AND NOT ({_m(2)})", f"0.0{D} + {_s(1)}"),
    "bool_nested": _bool([_term("text", "de"), _term("text", "la"), _term("text", "le")],
                         f"{_m(1)} AND ({_m(2)} OR {_m(3)})",
                         f"0.0{D} + {_s(1)} + (CASE WHEN {_m(2)} OR {_m(3)} "
                         f"THEN 0.0{D} + {_s(2)} + {_s(3)} ELSE 0.0{D} END)"),
    "field_group": _bool([_term("p_name", "red"), _term("p_name", "blue")],
                         f"{_m(1)} OR {_m(2)}", f"0.0{D} + {_s(1)} + {_s(2)}", PART_IX),
    "multi_field": _bool([_term("p_name", "small"), _term("p_type", "small"),
                          _term("p_name", "widget"), _term("p_type", "widget")],
                         f"{_m(1)} OR {_m(2)} OR {_m(3)} OR {_m(4)}",
                         f"0.0{D} + (CASE WHEN {_m(1)} OR {_m(2)} THEN 0.0{D} + {_s(1)} + {_s(2)} ELSE 0.0{D} END)"
                         f" + (CASE WHEN {_m(3)} OR {_m(4)} THEN 0.0{D} + {_s(3)} + {_s(4)} ELSE 0.0{D} END)",
                         PART_IX),
    "multi_field_turns": _bool([_term("role", "assistant"), _term("text", "assistant"),
                                _term("role", "la"), _term("text", "la")],
                               f"{_m(1)} OR {_m(2)} OR {_m(3)} OR {_m(4)}",
                               f"0.0{D} + (CASE WHEN {_m(1)} OR {_m(2)} THEN 0.0{D} + {_s(1)} + {_s(2)} ELSE 0.0{D} END)"
                               f" + (CASE WHEN {_m(3)} OR {_m(4)} THEN 0.0{D} + {_s(3)} + {_s(4)} ELSE 0.0{D} END)",
                               TURNS_IX),
    "text_and_range": _bool([_term("text", "the"),
                             f"SELECT doc_id, 1.0{D} AS score FROM documents "
                             f"WHERE n_chars BETWEEN 1000 AND 5000"],
                            f"{_m(1)} AND {_m(2)}", f"0.0{D} + {_s(1)} + {_s(2)}"),
    "phrase_and_term": _bool([_phrase("text", ["of", "the"]), _term("text", "and")],
                             f"{_m(1)} AND NOT ({_m(2)})", f"0.0{D} + {_s(1)}"),
    "query_string_nested": _bool([_term("text", "the"), _term("text", "of"), _phrase("text", ["in", "the"]),
                                  _term("text", "and")],
                                 f"{_m(1)} AND NOT ({_m(4)})", f"0.0{D} + {_s(1)} + {_s(2)} + {_s(3)}"),
    "query_string_range": _bool([_term("text", "the"),
                                 f"SELECT doc_id, 1.0{D} AS score FROM documents "
                                 f"WHERE n_chars >= 1000 AND n_chars < 5000",
                                 f"SELECT doc_id, 1.0{D} AS score FROM {DOCS} WHERE toxic"],
                                f"{_m(1)} AND ({_m(2)} OR {_m(3)})", f"0.0{D} + {_s(1)} + {_s(2)} + {_s(3)}"),
    # "the of AND NOT and NOT "in the"": the OR (of AND NOT and), without the phrase
    "query_string_not": _bool([_term("text", "the"), _term("text", "of"), _term("text", "and"), _phrase("text", ["in", "the"])],
                              f"({_m(1)} OR ({_m(2)} AND NOT ({_m(3)}))) AND NOT ({_m(4)})",
                              f"0.0{D} + {_s(1)} + (CASE WHEN {_m(2)} AND NOT ({_m(3)}) THEN {_s(2)} ELSE 0.0{D} END)"),
    "query_string_signed": f"""SELECT c_custkey AS doc_id, 1.0{D} AS score FROM customer
        WHERE floor(c_acctbal) IN (-5, 42) OR (floor(c_acctbal) >= -900 AND floor(c_acctbal) < -800)""",
    # p_type:SMALL is a stop word there, so only the inner string finds anything
    "analyzer_grams": f"""SELECT p_partkey AS doc_id FROM part
        WHERE list_bool_or(list_transform(regexp_extract_all(lower(p_name), '{TOK}'), lambda w: contains(w, 'idge')))""",
    "bm25_score": BM25_ALL,
    "constant_score": _bool([_const("field = 'text' AND regexp_full_match(term, 'lang[a-z0-9]*')"),
                             f"SELECT doc_id, 1.0{D} AS score FROM documents WHERE n_chars BETWEEN 0 AND 100"],
                            f"{_m(1)} OR {_m(2)}", f"0.0{D} + {_s(1)} + {_s(2)}"),
    "top_k": f"SELECT doc_id, round(score, 6) AS score FROM ({_top(_BM25_TOP_RAW)})",
    "total_hits": DOCS_IX + f", h AS ({_term('text', 'de')}) "
                  "SELECT least(count(*), 10) AS total_hits, count(*) AS total_matches FROM h",
    "stored_fields": f"""
SELECT t.doc_id, round(t.score, 6) AS score, dd.lang,
       CASE WHEN dd.n_chars >= 0 THEN dd.n_chars END AS n_chars,
       CASE WHEN dd.quality >= 0 THEN dd.quality::BIGINT END AS quality, dd.toxic, dd.text
FROM ({_top(_BM25_TOP_RAW)}) t JOIN {DOCS} dd USING (doc_id)""",
    "snippets": DOCS_IX + "," + _snippet_sql(
        _top(_BM25_TOP_RAW),
        "SELECT term, df FROM dfs WHERE field = 'text' AND term IN ('the', 'language', 'of', 'data')"),
    "fuzzy_snippets": DOCS_IX + "," + _snippet_sql(
        f"SELECT * FROM ({_FUZZY_THIER}) ORDER BY score DESC, doc_id LIMIT 10",
        f"SELECT term, df FROM dfs WHERE field = 'text' AND abs(length(term) - 5) <= 1 "
        f"AND damerau_levenshtein({ASCII1}, 'thier') <= 1"),
    "snippets_html": PAGES_IX + "," + _snippet_sql(
        _top(_HTML_TOP_RAW),
        "SELECT term, df FROM dfs WHERE field = 'html' AND term IN ('amp', 'href', 'nav')",
        150, "pages", "page_id", "html"),
    "batch_search": DOCS_IX + f""",
qt AS (SELECT query_id, term, count(*) AS qtf FROM (
         SELECT item_id AS query_id,
                unnest(regexp_extract_all(lower(text), '{TOK}')) AS term
         FROM benchmark) GROUP BY query_id, term),
h AS (SELECT qt.query_id, sc.doc_id, sum(qt.qtf * sc.score) AS score
      FROM qt JOIN sc ON sc.field = 'text' AND sc.term = qt.term GROUP BY qt.query_id, sc.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
      FROM h)
SELECT query_id, rank::BIGINT AS rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10""",
    "batch_fuzzy": DOCS_IX + f""",
w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{TOK}')) AS word FROM benchmark),
v AS (SELECT DISTINCT term FROM p WHERE field = 'text')
SELECT w.word, v.term, (CASE WHEN w.word = v.term THEN 0 ELSE 1 END)::BIGINT AS distance
FROM w JOIN v ON abs(length(w.word) - length(v.term)) <= 1 AND {_OSA1}""",
    "batch_query_strings": DOCS_IX + f""",
q AS (SELECT item_id AS query_id, item_id % 5 AS form, [coalesce(l[1], 'of'), coalesce(l[2], 'of'), coalesce(l[3], 'of'),
             coalesce(l[4], 'of'), coalesce(l[5], 'of'), coalesce(l[6], 'of')] AS w
      FROM (SELECT item_id, regexp_extract_all(lower(text), '{TOK}') AS l FROM benchmark)),
qw AS (SELECT query_id, form, unnest(CASE WHEN form = 4 THEN ['the'] ELSE w END) AS term, unnest(CASE WHEN form = 4 THEN [1] ELSE range(1, 7) END) AS i FROM q),
ws AS (SELECT qw.query_id, qw.form, qw.i, sc.doc_id, sc.score FROM qw JOIN sc ON sc.field = 'text' AND sc.term = qw.term),
ph AS (SELECT query_id, doc_id, {_bm25("(" + _idf('d1.df', 'st.n') + " + " + _idf('d2.df', 'st.n') + ")", 'pf', 'dl.dl', 'st.avgdl')} AS score
       FROM (SELECT q.query_id, q.w[1] AS w1, q.w[2] AS w2, a.doc_id, count(*) AS pf FROM q
             JOIN p a ON a.field = 'text' AND a.term = q.w[1] JOIN p b ON b.field = 'text' AND b.term = q.w[2] AND b.doc_id = a.doc_id AND b.pos = a.pos + 1
             WHERE q.form = 1 GROUP BY ALL)
       JOIN dl USING (doc_id) JOIN st ON st.field = 'text' AND dl.field = 'text'
       JOIN dfs d1 ON d1.field = 'text' AND d1.term = w1 JOIN dfs d2 ON d2.field = 'text' AND d2.term = w2),
u AS (SELECT query_id, form, i, doc_id, score FROM ws UNION ALL SELECT query_id, 1, 7, doc_id, score FROM ph),
g AS (SELECT query_id, form, doc_id, {", ".join(f"max(CASE WHEN i = {i} THEN score END) AS s{i}" for i in range(1, 8))}
      FROM u GROUP BY ALL),
h AS (SELECT query_id, doc_id, CASE form
        WHEN 1 THEN {_s(7)} + (CASE WHEN {_m(3)} AND {_m(4)} THEN s3 + s4 ELSE 0.0{D} END)
        WHEN 2 THEN s1 + {_s(2)}
        WHEN 3 THEN {_s(1)} + {_s(2)} + 1.0{D}
        WHEN 4 THEN s1
        ELSE {" + ".join(_s(i) for i in range(1, 7))} END AS score
      FROM g WHERE CASE form WHEN 0 THEN true WHEN 1 THEN {_m(7)} OR ({_m(3)} AND {_m(4)}) WHEN 2 THEN {_m(1)} AND s3 IS NULL
        WHEN 3 THEN ({_m(1)} OR {_m(2)}) AND doc_id IN (SELECT doc_id FROM documents WHERE n_chars BETWEEN 200 AND 3000) ELSE true END),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM h)
SELECT query_id, rank::BIGINT AS rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10""",
    "facets": _facets(BM25_ALL, True),
    "facets_top": _facets(f"SELECT doc_id FROM ({_top(_BM25_TOP_RAW, 100)})", False),
    "sorted_hits": _hits(f"SELECT sc.doc_id, dd.n_chars AS value, score FROM sc JOIN documents dd USING (doc_id) "
                         f"WHERE field = 'text' AND term = 'the' AND dd.n_chars >= 0 ORDER BY dd.n_chars DESC, sc.doc_id LIMIT 30").replace(
        "SELECT doc_id, round(score, 6) AS score FROM h", "SELECT doc_id, value::BIGINT AS value, round(score, 6) AS score FROM h"),
}
