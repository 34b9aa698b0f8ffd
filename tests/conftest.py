import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session
    s = local_session("*", 8)
    yield s
    s.stop()


@pytest.fixture()
def make_index(spark):
    """Index over small literal documents (lazy: nothing is written)."""
    from quarry.plans.index import Index

    def build(schema, docs, id_col="doc_id"):
        rows = [dict(d, **{id_col: i}) if id_col not in d else d for i, d in enumerate(docs)]
        names = [id_col] + [f.name for f in schema.fields]
        types = {"text": "string", "u64": "long", "i64": "long", "f64": "double", "bool": "boolean"}
        ddl = ", ".join([f"{id_col} long"] + [f"`{f.name}` {types[f.type]}" for f in schema.fields])
        data = [tuple(r.get(n) for n in names) for r in rows]
        df = spark.createDataFrame(data, ddl)
        return Index.from_corpus(df, schema, id_col)
    return build


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())
