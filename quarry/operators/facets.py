"""Facets: counts of hits by value, several in one pass; hits in the order of a
field, page after page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.analysis import VALUE_COLUMNS
from quarry.query import Query
from quarry.schema import BOOL, NUMERIC_TYPES, TEXT, U64, SearchError


def _number(edge, kind: str) -> Column:
    return F.lit(str(edge)).cast("decimal(20,0)") if kind == U64 else F.lit(edge)


def bucket(value: Column, edges: list, kind: str) -> Column:
    """The half-open bucket of a number, as text: `[10, 20)`; `*` for an open side."""
    names = ["*", *map(str, edges), "*"]
    labels = F.array(*[F.lit(f"{'(' if i == 0 else '['}{names[i]}, {names[i + 1]})") for i in range(len(edges) + 1)])
    at = sum((F.when(value >= _number(e, kind), 1).otherwise(0) for e in edges), F.lit(0))
    return F.when(value.isNotNull(), F.get(labels, at))


def facets(index, hits: DataFrame, by: list) -> DataFrame:
    """(facet, value, count) of the hits (doc_id, ...), for all facets in one
    grouping-sets pass: partial counts before the exchange, so a frequent
    value is no hot key. `by` names stored fields; (field, edges) counts a
    number by buckets between ascending edges. Hits without a value are not
    counted by that facet."""
    cols, names = [], []
    for f in by:
        name, edges = (f, None) if isinstance(f, str) else f
        fd = index.schema.field(name)
        if not fd.stored:
            raise SearchError(f"Facet field '{name}' is not stored")
        value = F.col(f"`{name}`")
        if edges is not None:
            if fd.type not in NUMERIC_TYPES:
                raise SearchError(f"Field '{name}' is not a numeric field")
            if not edges or list(edges) != sorted(set(edges)):
                raise SearchError(f"Facet edges of '{name}' must ascend")
            value = bucket(value, list(edges), fd.type)
        cols.append(value.cast("string").alias(f"f{len(cols)}"))
        names.append(name)
    if not cols:
        raise SearchError("At least one facet must be given")
    rows = index.corpus.join(hits.select(F.col("doc_id").alias(f"_{index.id_col}")),
                             F.col(f"`{index.id_col}`") == F.col(f"`_{index.id_col}`"), "left_semi").select(*cols)
    keys = [f"f{i}" for i in range(len(cols))]
    counted = rows.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("count"), *[F.grouping(k).alias(f"g{k}") for k in keys])
    facet, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, n in zip(reversed(keys), reversed(names)):
        facet = F.when(F.col(f"g{k}") == 0, F.lit(n)).otherwise(facet)
        value = F.when(F.col(f"g{k}") == 0, F.col(k)).otherwise(value)
    return counted.select(facet.alias("facet"), value.alias("value"), "count").where(F.col("value").isNotNull())


def sorted_page(index, hits: DataFrame, field: str, descending: bool, limit: int, after: tuple | None) -> DataFrame:
    """(doc_id, value, score): `limit` hits in the order of (field, doc_id),
    those after the row (value, doc_id) if one is given. The cursor is a range
    on the value table, which is clustered on (field, value), so a page reads
    what lies beyond it and no offset is counted. Hits without a value of the
    field have no place in the order."""
    fd = index.schema.field(field)
    if fd.type == TEXT:
        raise SearchError(f"Field '{field}' is a text field and has no order")
    if not fd.indexed:
        raise SearchError(f"Field '{field}' is not indexed")
    own = F.col(VALUE_COLUMNS[fd.type])
    rows = index.values.where((F.col("field") == field) & own.isNotNull())
    if after is not None:
        value, doc_id = after
        v = _number(value, fd.type) if fd.type != BOOL else F.lit(int(value))
        beyond, later = (own < v, own <= v) if descending else (own > v, own >= v)
        rows = rows.where(later & (beyond | (F.col("doc_id") > F.lit(doc_id))))
    order = [F.desc("value") if descending else F.asc("value"), F.asc("doc_id")]
    shown = own.cast("boolean") if fd.type == BOOL else own
    return (rows.select("doc_id", shown.alias("value")).join(hits, "doc_id")
                .select("doc_id", "value", "score").orderBy(*order).limit(limit))
