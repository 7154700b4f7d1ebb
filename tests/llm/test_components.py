import random

from tallyfold.llm.components import components
from tallyfold.llm.scratch import Scratch


def test_components_equal_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in components(df, Scratch(spark, "t")).collect()} == want
