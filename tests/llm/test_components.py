import random

from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm.components import components
from orderflow.llm.cuts import Cuts


def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def check(spark, links):
    found = components(Cuts(spark), spark.createDataFrame(links, "a bigint, b bigint"))
    got = {r["id"]: r["root"] for r in found.collect()}
    assert got == {x: r for x, r in brute(links).items() if x != r}


def test_chain_star_and_loops(spark):
    check(spark, [(k, k + 1) for k in range(40)])
    check(spark, [(0, k) for k in range(1, 200)] + [(5, 5), (300, 300)])
    check(spark, [])


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10**6))
def test_random(spark, seed):
    source = random.Random(seed)
    check(spark, [(source.randrange(60), source.randrange(60)) for _ in range(45)])
