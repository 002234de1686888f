import random

import pytest
from pyspark.sql import functions as F

from orderflow.functions.scan import _cut_points, _in_ranges, numbered, percentiles, pick, previous, running, trailing

SIZES = [3, 10, 50, None]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    # Key 'hot' holds most rows; orders have gaps and are unique per key.
    out = [("hot", s, rnd.randint(0, 9)) for s in rnd.sample(range(200), 120)]
    return out + [("cold", s, rnd.randint(0, 9)) for s in rnd.sample(range(200), 9)]


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("parts", [1, 8])
def test_running(spark, rows, size, parts):
    df = spark.createDataFrame(rows, "k string, s bigint, v int").repartition(parts)
    got = running(
        df,
        ["k"],
        "s",
        rank="r",
        sums={"upto": F.col("v")},
        total="n",
        totals={"all": F.col("v")},
        rows=size,
    ).collect()
    want = set()
    for key in ("hot", "cold"):
        mine = sorted((s, v) for k, s, v in rows if k == key)
        acc = 0
        for i, (s, v) in enumerate(mine, 1):
            acc += v
            want.add((key, s, v, i, len(mine), acc, sum(x for _, x in mine)))
    assert {tuple(r) for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("size", SIZES)
def test_previous(spark, rows, size):
    df = spark.createDataFrame(rows, "k string, s bigint, v int")
    got = {(r.k, r.s): r.prev_v for r in previous(df, ["k"], "s", ["v"], rows=size).collect()}
    for key in ("hot", "cold"):
        last = None
        for s, v in sorted((s, v) for k, s, v in rows if k == key):
            assert got[key, s] == last
            last = v


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("span", [1, 5, 60])
def test_trailing(spark, rows, size, span):
    df = spark.createDataFrame(rows, "k string, s bigint, v int")
    got = trailing(df, ["k"], "s", span, {"t": F.sum("v")}, rows=size).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.t == sum(v for k, s, v in rows if k == r.k and r.s - span < s <= r.s)


@pytest.mark.parametrize("size", [20, None])
def test_percentiles(spark, rows, size):
    df = spark.createDataFrame(rows, "k string, s bigint, v int")
    got = percentiles(df, ["k"], "s", {"a": 0.9, "b": 0.5, "c": 1.0}, rows=size)
    want = df.groupBy("k").agg(
        F.percentile("s", F.lit(0.9)).alias("a"),
        F.percentile("s", F.lit(0.5)).alias("b"),
        F.percentile("s", F.lit(1.0)).alias("c"),
    )
    near = {r.k: [round(x, 9) for x in (r.a, r.b, r.c)] for r in want.collect()}
    assert {r.k: [round(x, 9) for x in (r.a, r.b, r.c)] for r in got.collect()} == near


def test_ties_nulls_and_decimals(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, 1]), rnd.choice([None, 5, 5, 7]), n, f"{rnd.randint(0, 99)}.50") for n in range(300)]
    df = spark.createDataFrame(rows, "k int, s int, t int, v string").withColumn("v", F.col("v").cast("decimal(8,2)"))
    for size in (20, None):
        got = running(df, ["k"], "s", ties=["t"], rank="r", sums={"upto": F.col("v")}, total="n", rows=size).collect()
        for key in (None, 1):
            acc, mine = 0, sorted((r for r in got if r.k == key), key=lambda r: (r.s is not None, r.s or 0, r.t))
            for at, r in enumerate(mine, 1):
                acc += r.v
                assert (r.r, r.n, r.upto) == (at, len(mine), acc)


def test_sparse_orders_of_one_key_stay_spread(spark):
    """Order values a billion apart, nine tenths of the rows in one key: no range is much larger."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("k"),
        (F.col("id") * 1_000_000_000).alias("s"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        cuts = _cut_points(df, ["k"], ["s"], 10_000)
        ranged = _in_ranges(df, ["k"], cuts, {"r": F.struct("s")})
        sizes = [r["count"] for r in ranged.filter("k = 'hot'").groupBy("r").count().collect()]
        assert len(sizes) > 10 and max(sizes) < 3 * 180_000 / len(sizes)
        got = running(df, ["k"], "s", rank="r", total="n", rows=10_000)
        wrong = got.filter("k = 'hot'").filter(
            "n <> 180000 or r <> s div 10000000000 * 9 + s div 1000000000 % 10"
        )
        assert wrong.count() == 0
        again = previous(df, ["k"], "s", ["s"], rows=10_000).filter("k = 'hot' and s - prev_s > 2000000000")
        assert again.count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("parts", [1, 7])
def test_numbers_without_a_key(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, s bigint, v int").repartition(parts)
    out = numbered(df, ["s", "k"], "nth")
    want = [(k, s, v, n) for n, (s, k, v) in enumerate(sorted((s, k, v) for k, s, v in rows), 1)]
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[3]) == want
    assert numbered(df.filter("s < 0"), ["s"], "nth").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


@pytest.mark.parametrize("size", SIZES)
def test_pick(spark, rows, size):
    df = spark.createDataFrame([*rows, *rows[:1], (None, 4, 1), (None, None, 2)], "k string, s bigint, v int")
    every = [*rows, rows[0], (None, 4, 1), (None, None, 2)]
    for position, nth in (("(size + 1) div 2", lambda n: (n + 1) // 2), ("size", lambda n: n), ("3", lambda n: 3)):
        want = []
        for key in ("hot", "cold", None):
            mine = sorted((r for r in every if r[0] == key), key=lambda r: (r[1] is not None, r[1:]))
            want += mine[nth(len(mine)) - 1 : nth(len(mine))]
        got = pick(df, ["k"], ["s", "v"], F.expr(position), rows=size).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert pick(df.limit(0), ["k"], ["s"], F.lit(1)).count() == 0
