import random

from quarry.llm.components import components


def _brute(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_components_with_one_and_many_pieces(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(7, 7), (None, 3), (5, None), (2000, 2001), (2001, 2000)]
    df = spark.createDataFrame(edges, "a long, b long")
    for per_task in (20, 500_000):
        rows = components(df, per_task=per_task).collect()
        assert {r.id: r.component for r in rows} == _brute(edges)
        assert len(rows) == len({r.id for r in rows})


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
