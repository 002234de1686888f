import random

import numpy as np
from pyspark.sql import functions as F

from orderflow.llm import setjoin
from orderflow.llm.cuts import Cuts


def met(spark, sets):
    rows = spark.createDataFrame([(k, keys) for k, keys in sets.items()], "id bigint, keys array<bigint>")
    join = setjoin.SetJoin(Cuts(spark), rows, F.col("keys"), 1, None, 80, None, None)
    found = [tuple(r) for r in join._met().collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_keys_of_several_sets_in_one_shuffle(spark, monkeypatch):
    """Packed keys meet as grouped ones do, common keys by the other way."""
    source = random.Random(4)
    sets = {k: [source.randrange(-(1 << 63), 1 << 63), source.randrange(400), -7 - k % 3] for k in range(900)}
    members = {}
    for k, keys in sets.items():
        for key in keys:
            members.setdefault(key, []).append(k)
    wanted = {(key, k, min(ids)) for key, ids in members.items() if len(ids) > 1 for k in ids}
    assert met(spark, sets) == wanted  # -7 to -9 have 300 members each
    monkeypatch.setattr(setjoin, "COMMON", 1 << 40)
    assert met(spark, sets) == wanted
    monkeypatch.setattr(setjoin, "COMMON", 2)
    assert met(spark, sets) == wanted
    assert met(spark, {}) == set()


def rare_rows(source, sets):
    """(item, id, n, place, root, sketch): each set's first items out of few, in one order for all."""
    rows = []
    for k in range(sets):
        n = source.randrange(5, 60)
        items = sorted(source.sample(range(70), n))[: n - (80 * n + 99) // 100 + 1]
        rows += [(item, k, n, place, k % 9, source.getrandbits(62)) for place, item in enumerate(items)]
    return rows


def test_pairs_under_an_item_are_those_of_two_components_that_may_be_linked(spark, monkeypatch):
    rows, wanted = rare_rows(random.Random(6), 150), set()
    for item, a, n_a, place_a, root_a, sketch_a in rows:
        for other, b, n_b, place_b, root_b, sketch_b in rows:
            if item == other and root_a < root_b:
                most = min(n_a - place_a, n_b - place_b)
                differ = sketch_a ^ sketch_b
                places = (differ | differ >> 1) & setjoin._EVERY_OTHER
                if 100 * most >= 80 * (n_a + n_b - most) and places.bit_count() <= 24:
                    wanted.add((a, b))
    assert len(wanted) > 50
    rare = spark.createDataFrame(rows, "item bigint, id bigint, n bigint, place bigint, root bigint, sketch bigint")
    join = setjoin.SetJoin(Cuts(spark), rare, F.col("keys"), 1, 24, 80, None, None)
    assert {tuple(r) for r in join._sharing(rare, ["sketch"]).collect()} == wanted
    assert join._sharing(rare.limit(0), ["sketch"]).count() == 0
    # Items that go beyond an Arrow batch, a block and a round of candidates.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        monkeypatch.setattr(setjoin, "BLOCK", 20)
        monkeypatch.setattr(setjoin, "CANDIDATES", 5)
        assert {tuple(r) for r in join._sharing(rare, ["sketch"]).collect()} == wanted
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sets_of_one_component_or_of_other_sizes_are_not_held_against_each_other():
    """5,000 copies, one set like them and 5,000 far larger ones under one item: 25 million pairs before."""
    n = np.repeat([50, 51, 400], [5000, 1, 5000])
    block = {"item": np.ones(10001, np.int64), "root": np.repeat([1, 2, 3], [5000, 1, 5000]), "n": n,
             "size": np.floor(np.log(n) / np.log(1.251)).astype(np.int64), "place": np.zeros(10001, np.int64)}
    tried = sum(len(x) for x, _ in setjoin._across(block, 80))
    assert 5000 <= tried <= 10_000
