import random

from docloom.functions.components import components


def test_components_against_union_find(spark):
    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(1000 + n, 1001 + n) for n in range(40)] + [(5, 5), (None, 4)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: top(x) for x in up}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
