"""Running totals, ranks, lags and percentiles that never put one key in one task.

A window over `partitionBy(key)` sorts the whole key in one task, which fails when a key holds a
large share of the rows. The functions here cut such keys into ranges of about equal numbers of rows:
the cut points are quantiles of a sample of (key, order), no more of them than there are shuffle
partitions. Keys without a cut point are small and lie in one range. The window runs inside a
range; what comes before it is carried over from the totals of the cut keys' ranges, a
table as long as there are ranges. How far the values of the order column lie apart does not matter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows of a range, unless that makes more ranges than shuffle partitions.
ROWS = 1 << 16

#: Sampled rows per range; a range's size is off by a fifth or so.
SAMPLED = 32

#: Parts a key's rows are spread over in a join.
COPIES = 32


def spread_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], by: str, copies: int = COPIES
) -> DataFrame:
    """Inner join to a table with one row per key, with each key of `big` spread over tasks.

    For joins on a coarse key that an aggregation on the same key follows: the aggregation would
    otherwise take over the join's partitioning, and with it one task per key. The small rows are
    copied for each part; where they fit a broadcast they are still broadcast.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    copied = small.withColumn("__part", parts)
    return (
        big.withColumn("__part", F.pmod(F.hash(by), F.lit(copies)))
        .join(copied, [*keys, "__part"])
        .drop("__part")
    )


def _cut_points(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int | None
) -> DataFrame | None:
    """(keys, __cuts): for each key that spans several ranges the places at which they begin.

    One row per cut key and no more cut points than ranges, so the table is as short as the list of
    tasks. None if no key is large enough to be cut.
    """
    spark = df.sparkSession
    size = df.count()
    ranges = min(size // (rows or ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    if ranges < 2:
        return None
    share = min(1.0, SAMPLED * ranges / size)
    places: dict[tuple, list] = {}
    for row in df.select(*keys, F.struct(*order).alias("__place")).sample(share, 7).collect():
        places.setdefault(tuple(row)[:-1], []).append(tuple(row["__place"]))
    found = []
    step = max(2, int(share * size) // ranges)
    for key, mine in places.items():
        mine.sort(key=lambda place: [(v is not None, v) for v in place])
        cuts = mine[step - 1 :: step] if len(mine) > step else []
        if cuts:
            found.append((*key, list(dict.fromkeys(cuts))))
    if not found:
        return None
    kinds = df.select(*keys, F.array(F.struct(*order)).alias("__cuts")).schema
    return F.broadcast(spark.createDataFrame(found, kinds))


def _in_ranges(
    df: DataFrame, keys: Sequence[str], cuts: DataFrame | None, at: Mapping[str, Column]
) -> DataFrame:
    """Add the number of the range that each place of `at` falls into, and whether the key is cut."""
    if cuts is None:
        return df.select("*", *[F.lit(0).alias(n) for n in at], F.lit(False).alias("__cut"))
    if keys:
        renamed = cuts.select(*[F.col(k).alias(f"__key_{k}") for k in keys], "__cuts")
        same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
        joined = df.join(renamed, same, "left")
    else:
        # One row: the whole table is the key.
        points = cuts.head()["__cuts"]
        kind = cuts.schema["__cuts"].dataType
        literal = F.array(*[F.struct(*[F.lit(v).alias(f.name) for v, f in zip(p, kind.elementType)]) for p in points])
        joined = df.withColumn("__cuts", literal.cast(kind))
    return joined.select(
        *df.columns,
        *[F.when(F.col("__cuts").isNull(), 0).otherwise(_range_of(place)).alias(n) for n, place in at.items()],
        F.col("__cuts").isNotNull().alias("__cut"),
    )


def _range_of(place: Column) -> Column:
    """How many cut points lie at or before `place`, by halving."""

    def step(pos: Column, half: Column) -> Column:
        ahead = (pos + half <= F.size("__cuts")) & (F.get("__cuts", pos + half - 1) <= place)
        return F.when(ahead, pos + half).otherwise(pos)

    # Halves from the largest power of two that any list of cut points may need.
    halves = F.array(*[F.lit(1 << k) for k in range(16, -1, -1)])
    return F.aggregate(halves, F.lit(0), step)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    rank: str | None = None,
    sums: Mapping[str, Column] | None = None,
    total: str | None = None,
    totals: Mapping[str, Column] | None = None,
    ties: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Add a rank, inclusive running sums, the group's row count and group sums, per key by `order`.

    `ties` settles rows with equal values of `order`. `rows` are those of a range. `df` is read
    three times, so it should be a table or a short plan on one.
    """
    measures: dict[str, Column] = dict(sums or {})
    whole: dict[str, Column] = dict(totals or {})
    keys, place = list(keys), [order, *ties]
    cuts = _cut_points(df, keys, place, rows)
    ranged = _in_ranges(df, keys, cuts, {"__range": F.struct(*place)})
    group = Window.partitionBy(*keys, "__range")
    so_far = group.orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
    added = {f"__sum_{n}": v for n, v in {**measures, **whole}.items()}
    local = ranged.select(
        *ranged.columns,
        F.row_number().over(group.orderBy(*place)).alias("__local_rows"),
        *([F.count(F.lit(1)).over(group).alias("__own_rows")] if total else []),
        *[F.sum(v).over(so_far).alias(f"__local_{n}") for n, v in measures.items()],
        *[F.sum(v).over(group).alias(f"__own_{n}") for n, v in whole.items()],
    )
    rank_of, rows_of = F.col("__local_rows"), F.col("__own_rows")
    upto = {n: F.col(f"__local_{n}") for n in measures}
    all_of = {n: F.col(f"__own_{n}") for n in whole}
    if cuts is not None:
        # Only cut keys: as many rows as there are ranges.
        partial = ranged.filter("__cut").groupBy(*keys, "__range").agg(
            F.count(F.lit(1)).alias("__rows"), *[F.sum(v).alias(n) for n, v in added.items()]
        )
        before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy(*keys)
        carried = partial.select(
            *[F.col(k).alias(f"__key_{k}") for k in keys],
            F.col("__range").alias("__of"),
            F.sum("__rows").over(before).alias("__before_rows"),
            F.sum("__rows").over(every).alias("__total"),
            *[F.sum(f"__sum_{n}").over(before).alias(f"__before_{n}") for n in measures],
            *[F.sum(f"__sum_{n}").over(every).alias(f"__whole_{n}") for n in whole],
        )
        same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
        local = local.join(F.broadcast(carried), [*same, F.col("__range") == F.col("__of")], "left")
        rank_of = rank_of + F.coalesce("__before_rows", F.lit(0))
        rows_of = F.coalesce("__total", rows_of)
        upto = {n: F.coalesce(F.col(f"__before_{n}") + v, v, F.col(f"__before_{n}")) for n, v in upto.items()}
        all_of = {n: F.when(F.col("__cut"), F.col(f"__whole_{n}")).otherwise(v) for n, v in all_of.items()}
    out = [F.col(c) for c in df.columns]
    if rank:
        out.append(rank_of.cast("bigint").alias(rank))
    if total:
        out.append(rows_of.cast("bigint").alias(total))
    out += [v.alias(n) for n, v in {**upto, **all_of}.items()]
    return local.select(*out)


def previous(
    df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], *, rows: int | None = None
) -> DataFrame:
    """Add `prev_<col>` from the row before, per key by `order` (null on the first row)."""
    keys = list(keys)
    cuts = _cut_points(df, keys, [order], rows)
    ranged = _in_ranges(df, keys, cuts, {"__range": F.struct(order)})
    row = F.struct(*cols)
    local = ranged.withColumn("__found", F.lag(row).over(Window.partitionBy(*keys, "__range").orderBy(order)))
    if cuts is not None:
        last = ranged.filter("__cut").groupBy(*keys, "__range").agg(F.max_by(row, order).alias("__last"))
        carried = last.select(
            *[F.col(k).alias(f"__key_{k}") for k in keys],
            F.col("__range").alias("__of"),
            F.lag("__last").over(Window.partitionBy(*keys).orderBy("__range")).alias("__carried"),
        )
        same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
        local = local.join(F.broadcast(carried), [*same, F.col("__range") == F.col("__of")], "left")
        local = local.withColumn("__found", F.coalesce("__found", "__carried"))
    return local.select(*df.columns, *[F.col(f"__found.{c}").alias(f"prev_{c}") for c in cols])


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    span: int,
    aggs: Mapping[str, Column],
    *,
    by_rows: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Add aggregates over the last `span` units of `order` (or, with `by_rows`, the last rows).

    Each range also gets copies of the rows that reach into it from those before. With `by_rows`,
    `order` must be a gap-free rank.
    """
    keys = list(keys)
    cuts = _cut_points(df, keys, [order], rows)
    reach = (F.col(order) + (span - 1)).cast(df.schema[order].dataType)
    ranged = _in_ranges(df, keys, cuts, {"__own": F.struct(order), "__upto": F.struct(reach.alias(order))})
    if cuts is not None:
        ranged = ranged.withColumn("__range", F.explode(F.sequence("__own", "__upto")))
    else:
        ranged = ranged.withColumn("__range", F.col("__own"))
    base = Window.partitionBy(*keys, "__range").orderBy(order)
    frame = base.rowsBetween(-(span - 1), 0) if by_rows else base.rangeBetween(-(span - 1), 0)
    framed = ranged.select(
        *df.columns, "__own", "__range", *[a.over(frame).alias(n) for n, a in aggs.items()]
    )
    return framed.filter(F.col("__own") == F.col("__range")).drop("__own", "__range")


def pick(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], position: Column, *, rows: int | None = None
) -> DataFrame:
    """Of each key the row at `position` by `order`; `position` is an expression of the row count `size`.

    Positions count from 1; one outside the group gives no row. The sizes of a key's ranges tell in
    which one the row lies, and nothing but that range is sorted. `df` is read three times, so it
    should be a table or a short plan on one.
    """
    keys = list(keys)
    ranged = _in_ranges(df, keys, _cut_points(df, keys, order, rows), {"__range": F.struct(*order)})
    sizes = ranged.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"))
    every = Window.partitionBy(*keys)
    before = F.sum("__n").over(every.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    held = sizes.select(
        *keys, "__range", "__n", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(every).alias("size")
    ).withColumn("__nth", position.cast("bigint") - F.col("__before"))
    held = held.filter(F.col("__nth").between(1, F.col("__n"))).select(
        *[F.col(k).alias(f"__key_{k}") for k in keys], F.col("__range").alias("__of"), "__nth"
    )
    same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    at = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(*order))
    return (
        ranged.join(held, [*same, F.col("__range") == F.col("__of")])
        .withColumn("__at", at)
        .filter(F.col("__at") == F.col("__nth"))
        .select(*df.columns)
    )


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add consecutive numbers from 1 by `order` over the whole table, without a window.

    The rows are dealt into sorted ranges and written with their place in the range; the ranges'
    sizes, a row per task, then tell where each begins. Written once, since the ranges of
    another run would be cut elsewhere.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The upper bits are the number of the range, the lower 33 the place in it.
    placed = cut_lineage(dealt.withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    begin, begins = 0, []
    for row in sorted(sizes):
        begins.append((row["part"], begin))
        begin += row["n"]
    table = F.broadcast(spark.createDataFrame(begins, "__part bigint, __begin bigint"))
    joined = placed.join(table, part == F.col("__part"))
    return joined.select(*df.columns, (F.col("__begin") + place + 1).alias(name))


def percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], *, rows: int | None = None
) -> DataFrame:
    """Exact percentiles of an integer column per key, interpolating between neighbours.

    Works on the histogram of the values, so that nothing but distinct values is ever sorted.
    """
    keys = list(keys)
    hist = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("__n")
    )
    both = running(
        hist,
        keys,
        value,
        sums={"__upto": F.col("__n")},
        totals={"__size": F.col("__n")},
        rows=rows,
    )
    aggs = []
    for name, p in probs.items():
        at = (F.col("__size") - 1) * F.lit(float(p))
        for side, pos in (("lo", F.floor(at) + 1), ("hi", F.ceil(at) + 1)):
            aggs.append(
                F.min(F.when(F.col("__upto") >= pos, F.col(value))).alias(f"__{name}_{side}")
            )
    found = both.groupBy(*keys).agg(F.max("__size").alias("__size"), *aggs)
    out = []
    for name, p in probs.items():
        at = (F.col("__size") - 1) * F.lit(float(p))
        lo, hi = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        out.append((lo + (hi - lo) * (at - F.floor(at))).cast("double").alias(name))
    return found.select(*keys, *out)
