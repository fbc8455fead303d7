import random

import pytest

from sparkfolio.llm.components import components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b and a is not None and b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(99, i) for i in range(20, 25)], [(3, 3), (None, 4), (5, 6), (6, 5)],
    [(random.Random(1).randrange(60) + i % 7, random.Random(i).randrange(60)) for i in range(45)], []])
def test_equal_brute_force(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r["node"], r["root"]) for r in got) == sorted(brute(edges).items())
