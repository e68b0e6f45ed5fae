"""Connected components against union-find."""

import random

import pytest

from tarnbeck.llm.common import components

DICE = random.Random(3)
CASES = {
    "no edges": [],
    "a loop alone": [(5, 5)],
    "one edge": [(1, 2)],
    "a chain": [(i, i + 1) for i in range(60)],
    "hubs below and above": [(0, i) for i in range(1, 3000)] + [(i, 4000) for i in range(1, 50)],
    "repeated and negative": [(DICE.randrange(-50, 50), DICE.randrange(50)) for _ in range(60)],
}


def union_find(edges):
    low = {n: n for e in edges if e[0] != e[1] for n in e}

    def top(n):
        while low[n] != n:
            n = low[n]
        return n

    for a, b in edges:
        if a != b:
            a, b = sorted((top(a), top(b)))
            low[b] = a
    return {n: top(n) for n in low}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    rows = components(spark.createDataFrame(CASES[name], "src long, dst long")).collect()
    found = {r.node: r.component for r in rows}
    assert len(found) == len(rows) and found == union_find(CASES[name])
