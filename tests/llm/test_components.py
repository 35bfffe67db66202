"""Grid components against plain union-find, on many shapes and settings."""

import random

import pytest

from corvane.llm.components import connected_components


def plain(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def shapes():
    rng = random.Random(3)
    n = lambda i: f"n{i:04}"
    yield "random", [(n(rng.randrange(90)), n(rng.randrange(90))) for _ in range(70)]
    yield "chain", [(n(i), n(i + 1)) for i in range(130)]
    yield "hub", [("zz", n(i)) for i in range(120)]
    yield "alternating", [(n(i if k else i + 1), n(500 + i)) for i in range(60) for k in (0, 1)]
    yield "dirty", [("a", "b"), ("b", "a"), ("a", "a"), (None, "c"), ("c", None), ("é", "a"), ("", "x")]
    yield "empty", []


@pytest.mark.parametrize("name,edges", list(shapes()), ids=[k for k, _ in shapes()])
@pytest.mark.parametrize("cell,memory", [(500_000, 2_000_000), (5, 3)])
def test_against_union_find(spark, name, edges, cell, memory):
    df = spark.createDataFrame([(*e, "extra") for e in edges], "x string, y string, v string")
    out = connected_components(df, "x", "y", cell_edges=cell, memory_vertices=memory)
    assert {r.id: r.group_id for r in out.collect()} == plain(edges)
    assert out.count() == len(plain(edges))
