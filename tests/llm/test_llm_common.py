"""Shared inputs of the tests in this folder, and the helpers that several operators use."""

import random

import pandas as pd
import pytest

from shopflow.llm import components

EDGE_ROWS = [
    (1, "One  two\tthree\nfour five.", "en"), (2, None, None), (3, "", "en"), (4, "One two three four five.", "x"),
    (4, "One two three four five.", "x"), (None, "One two three four five.", "y"), (6, "   \n\t ", "z"),
    (7, "word " * 3000 + "end", "en"), (8, "x" * 20000, "en"), (9, "Ünï ñandú — “q” 日本語 <|endoftext|> 1,234.50", "de"),
    (10, "A b", "en"), (11, "A b", "fr"),
]


def edge_docs(spark):
    """Nulls, empty and white texts, a very long run, repeated rows, ties, and columns with clashing names."""
    rows = [(i, t, g, f"norm{k}", k, "locator", 0.5) for k, (i, t, g) in enumerate(EDGE_ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, norm string, key int, row string, score double")


def empty_docs(spark):
    return edge_docs(spark).limit(0)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "loops", "none"])
def test_components_equal_union_find(spark, shape):
    rnd = random.Random(4)
    edges = {"chain": [(i, i + 1) for i in range(300)], "star": [(0, i) for i in range(1, 200)] * 2,
             "random": [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(250)],
             "loops": [(5, 5), (6, 7), (7, 6)], "none": []}[shape]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).toPandas()
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[find(a)] = find(b)
    want = pd.Series({x: find(x) for x in parent}, dtype="int64")
    assert sorted(got["node"]) == sorted(want.index)
    if len(got):
        mine = got.set_index("node")["root"]
        assert (mine.groupby(mine).apply(lambda g: frozenset(g.index)).map(len).sum() == len(want))
        for _, members in mine.groupby(mine):
            assert want[members.index].nunique() == 1
        assert mine.nunique() == want.nunique() and set(mine) <= set(mine.index)
