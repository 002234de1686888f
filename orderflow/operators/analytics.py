"""Throughput, latency and machine load from a run's logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import percentiles, previous, running, spread_join, trailing

# Bucket widths in seconds, transaction types, their latency limits in seconds, the
# greatest number of buckets and the theoretical maximum of new orders per warehouse and minute.
BUCKETS = [1, 2, 5, 10, 20, 60, 120, 300, 600]
MOST_BUCKETS = 1000
BACKGROUND = "DELIVERY_BG"
LIMITS = {
    "NEW_ORDER": "5.0",
    "PAYMENT": "5.0",
    "ORDER_STATUS": "5.0",
    "STOCK_LEVEL": "20.0",
    "DELIVERY": "5.0",
    "DELIVERY_BG": "80.0",
}
FOREGROUND = [t for t in LIMITS if t != BACKGROUND]
MAX_PER_WAREHOUSE = 12.86

#: Seconds the recent throughput looks back on.
RECENT_SECONDS = 5


# --- buckets -----------------------------------------------------------------------------------


def bucket_seconds(run_mins: Column) -> Column:
    """The narrowest bucket that cuts the run into no more than 1000 of them."""
    width = None
    for b in BUCKETS[:-1]:
        fits = run_mins * 60 <= MOST_BUCKETS * b
        width = F.when(fits, b) if width is None else width.when(fits, b)
    return width.otherwise(BUCKETS[-1])


def bucketed(log: DataFrame, run_info: DataFrame) -> DataFrame:
    """Add the run's bucket width in seconds and the row's bucket start in milliseconds."""
    widths = run_info.select("run", bucket_seconds(F.col("runMins")).alias("interval"))
    return spread_join(log, widths, ["run"], "elapsed").withColumn(
        "bucket", F.expr("elapsed div (interval * 1000) * (interval * 1000)")
    )


def _per_minute(log: DataFrame, run_info: DataFrame, name: str) -> DataFrame:
    counted = bucketed(log, run_info).groupBy("run", "bucket", "interval").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(
        "run", F.col("bucket").alias("elapsed"), (F.col("n") * 60.0 / F.col("interval")).alias(name)
    )


def tpm_total(result: DataFrame, run_info: DataFrame) -> DataFrame:
    return _per_minute(result.filter(F.col("ttype") != BACKGROUND), run_info, "tpm_total")


def tpm_new_order(result: DataFrame, run_info: DataFrame) -> DataFrame:
    return _per_minute(result.filter(F.col("ttype") == "NEW_ORDER"), run_info, "tpm_c")


def latency_series(result: DataFrame, run_info: DataFrame) -> DataFrame:
    """Mean latency per bucket and foreground type."""
    front = result.filter(F.col("ttype").isin(FOREGROUND))
    return (
        bucketed(front, run_info)
        .groupBy("run", F.col("bucket").alias("elapsed"), "ttype")
        .agg(F.avg("latency").alias("latency"))
    )


def latency_p98(result: DataFrame) -> DataFrame:
    front = result.filter(F.col("ttype") != BACKGROUND)
    return percentiles(front, ["run"], "latency", {"p98": 0.98})


# --- summaries ---------------------------------------------------------------------------------


def _fixed(x: Column, places: int, unit: str) -> Column:
    return F.concat(x.cast(f"decimal(20,{places})").cast("string"), F.lit(unit))


def _totals(result: DataFrame, run_info: DataFrame) -> DataFrame:
    """Per run the foreground and new-order counts, with run length and warehouses."""
    counts = result.groupBy("run").agg(
        F.count_if(F.col("ttype") != BACKGROUND).alias("total"),
        F.count_if(F.col("ttype") == "NEW_ORDER").alias("orders"),
    )
    return run_info.select("run", "runMins", "runWarehouses").join(counts, "run", "left").na.fill(
        0, ["total", "orders"]
    )


def tpm_rows(result: DataFrame, run_info: DataFrame) -> DataFrame:
    """New orders and all foreground transactions per minute, the former also as a share of the
    theoretical maximum."""
    c = F.col("orders") / F.col("runMins")
    share = c / F.col("runWarehouses") / F.lit(MAX_PER_WAREHOUSE / 100)
    lines = F.array(
        F.struct(
            F.lit("tpmC").alias("tx_name"),
            _fixed(c, 2, "").alias("tx_count"),
            _fixed(share, 3, "%").alias("tx_percent"),
        ),
        F.struct(
            F.lit("tpmTotal").alias("tx_name"),
            _fixed(F.col("total") / F.col("runMins"), 2, "").alias("tx_count"),
            F.lit(None).cast("string").alias("tx_percent"),
        ),
    )
    return _totals(result, run_info).select("run", F.inline(lines))


def tx_summary(result: DataFrame, run_info: DataFrame) -> DataFrame:
    """The transaction summary: a row per type, then tpmC and tpmTotal."""
    by = ["run", "ttype"]
    counts = result.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("latency").alias("longest"),
        F.sum("rbk").alias("rbk"),
        F.sum("error").alias("errors"),
        F.sum("dskipped").alias("skipped"),
    )
    p90 = percentiles(result, by, "latency", {"p90": 0.90})
    kinds = F.array(
        *[
            F.struct(F.lit(i).alias("pos"), F.lit(t).alias("ttype"), F.lit(limit).alias("tx_limit"))
            for i, (t, limit) in enumerate(LIMITS.items(), 1)
        ]
    )
    rows = (
        _totals(result, run_info)
        .select("run", "total", F.inline(kinds))
        .join(counts, by, "left")
        .join(p90, by, "left")
        .na.fill(0, ["n", "errors", "skipped"])
    )
    back = F.col("ttype") == BACKGROUND
    per_type = rows.select(
        "run",
        "pos",
        F.col("ttype").alias("tx_name"),
        F.col("n").cast("string").alias("tx_count"),
        F.when(~back, _fixed(F.try_divide(F.col("n") * 100.0, "total"), 3, "%")).alias("tx_percent"),
        _fixed(F.col("p90") / 1000.0, 3, "s").alias("tx_90th"),
        _fixed(F.col("longest") / 1000.0, 3, "s").alias("tx_max"),
        "tx_limit",
        F.when(
            F.col("ttype") == "NEW_ORDER",
            _fixed(F.try_divide(F.col("rbk") * 100.0, F.col("n")), 3, "%"),
        ).alias("tx_rbk"),
        F.col("errors").cast("string").alias("tx_error"),
        F.when(back, F.col("skipped").cast("string")).alias("tx_dskipped"),
    )
    rates = tpm_rows(result, run_info).withColumn(
        "pos", F.when(F.col("tx_name") == "tpmC", 7).otherwise(8)
    )
    return per_type.unionByName(rates, allowMissingColumns=True)


def session_summary(
    result: DataFrame, errors: DataFrame, elapsed_ms: int | None = None
) -> DataFrame:
    """Per run: transactions, errors and new orders, and each per minute cut to two decimals.

    Failed transactions are in `errors` only and count as transactions. Without `elapsed_ms` the
    session lasts to its last logged transaction.
    """
    done = result.filter(F.col("ttype") != BACKGROUND).groupBy("run").agg(
        F.count(F.lit(1)).alias("done"),
        F.count_if(F.col("ttype") == "NEW_ORDER").alias("new_orders"),
        F.max("elapsed").alias("last"),
    )
    failed = errors.groupBy("run").agg(F.count(F.lit(1)).alias("errors"))
    both = done.join(failed, "run", "full").na.fill(0, ["done", "new_orders", "errors"])
    span = F.col("last") if elapsed_ms is None else F.lit(elapsed_ms)
    counted = both.select(
        "run",
        (F.col("done") + F.col("errors")).alias("transactions"),
        "errors",
        "new_orders",
        span.cast("bigint").alias("span"),
    )
    return counted.select(
        "run",
        F.expr("(6000000 * new_orders) div span / 100.0D").alias("tpm_c"),
        F.expr("(6000000 * transactions) div span / 100.0D").alias("tpm_total"),
        F.expr("(6000000 * errors) div span / 100.0D").alias("tpm_e"),
        "transactions",
        "errors",
        "new_orders",
    )


def per_second(result: DataFrame) -> DataFrame:
    """Foreground transactions and new orders per run and second; also over a stream."""
    return (
        result.filter(F.col("ttype") != BACKGROUND)
        .groupBy("run", F.expr("elapsed div 1000").alias("second"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("ttype") == "NEW_ORDER").alias("c"),
        )
    )


def running_tpm(
    result: DataFrame, recent: int = RECENT_SECONDS, rows: int | None = None
) -> DataFrame:
    """For each second with transactions: throughput so far and over the last seconds."""
    return rates(per_second(result), recent, rows)


def rates(seconds: DataFrame, recent: int = RECENT_SECONDS, rows: int | None = None) -> DataFrame:
    """The same from counts per second."""
    so_far = running(
        seconds,
        ["run"],
        "second",
        sums={"all_n": F.col("n"), "all_c": F.col("c")},
        rows=rows,
    )
    with_recent = trailing(
        so_far,
        ["run"],
        "second",
        recent,
        {"recent_n": F.sum("n"), "recent_c": F.sum("c")},
        rows=rows,
    )
    ms = "((second + 1) * 1000)"
    return with_recent.select(
        "run",
        "second",
        F.expr(f"(6000000 * all_n) div {ms} / 100.0D").alias("tpm_total"),
        F.expr(f"(6000000 * all_c) div {ms} / 100.0D").alias("tpm_c"),
        F.expr(f"recent_n * 60 div {recent}").alias("recent_tpm_total"),
        F.expr(f"recent_c * 60 div {recent}").alias("recent_tpm_c"),
    )


def result_rows(txn: DataFrame) -> DataFrame:
    """The result log from start, due and end times in milliseconds.

    `txn`: run, session_start, due (null: due when started), started, ended, ttype, rbk, skipped,
    failed.
    """
    return txn.select(
        "run",
        (F.col("ended") - F.col("session_start")).alias("elapsed"),
        (F.col("ended") - F.coalesce("due", "started")).alias("latency"),
        (F.col("ended") - F.col("started")).alias("dblatency"),
        "ttype",
        F.col("rbk").cast("int").alias("rbk"),
        F.when(F.col("ttype") == BACKGROUND, F.col("skipped")).otherwise(0).cast("int").alias("dskipped"),
        F.col("failed").cast("int").alias("error"),
    )


# --- machine load ------------------------------------------------------------------------------

# Counters of the three machine logs, with what a unit of each counts for.
CPU = [
    "cpu_user",
    "cpu_nice",
    "cpu_system",
    "cpu_idle",
    "cpu_iowait",
    "cpu_irq",
    "cpu_softirq",
    "cpu_steal",
    "cpu_guest",
    "cpu_guest_nice",
]
BLOCK = {
    "rdiops": ("reads", 1.0),
    "rdmerges": ("read_merges", 1.0),
    "rdkbps": ("read_sectors", 0.5),
    "wriops": ("writes", 1.0),
    "wrmerges": ("write_merges", 1.0),
    "wrkbps": ("write_sectors", 0.5),
}
NET = {
    "rxpktsps": ("rx_packets", 1.0),
    "rxkbps": ("rx_bytes", 1.0 / 1024.0),
    "txpktsps": ("tx_packets", 1.0),
    "txkbps": ("tx_bytes", 1.0 / 1024.0),
}


def _means(log: DataFrame, run_info: DataFrame, cols: list[str], per: list[str]) -> DataFrame:
    return (
        bucketed(log, run_info)
        .groupBy("run", *per, F.col("bucket").alias("elapsed"))
        .agg(*[F.avg(c).alias(c) for c in cols])
    )


def cpu_utilization(sys_info: DataFrame, run_info: DataFrame) -> DataFrame:
    """Mean user, system and wait shares per bucket, and their stacked sums in percent."""
    means = _means(sys_info, run_info, ["cpu_user", "cpu_system", "cpu_iowait"], [])
    user, system, wait = F.col("cpu_user"), F.col("cpu_system"), F.col("cpu_iowait")
    return means.withColumns(
        {
            "user_pct": user * 100.0,
            "user_system_pct": (user + system) * 100.0,
            "user_system_wait_pct": (user + system + wait) * 100.0,
        }
    )


def dirty_buffers(sys_info: DataFrame, run_info: DataFrame) -> DataFrame:
    return _means(sys_info, run_info, ["vm_nr_dirty"], [])


def blk_iops(blk: DataFrame, run_info: DataFrame) -> DataFrame:
    return _means(blk, run_info, ["rdiops", "wriops"], ["device"])


def blk_kbps(blk: DataFrame, run_info: DataFrame) -> DataFrame:
    return _means(blk, run_info, ["rdkbps", "wrkbps"], ["device"])


def net_pps(net: DataFrame, run_info: DataFrame) -> DataFrame:
    return _means(net, run_info, ["rxpktsps", "txpktsps"], ["device"])


def net_kbps(net: DataFrame, run_info: DataFrame) -> DataFrame:
    return _means(net, run_info, ["rxkbps", "txkbps"], ["device"])


def cpu_fractions(raw: DataFrame, mode: str = "since_start", rows: int | None = None) -> DataFrame:
    """Counters to shares of all processor time; the run's first sample is only the baseline.

    `since_start` compares each sample with the first, `interval` with the one before. Where no
    time passed all shares are 0.
    """
    if mode == "since_start":
        first = raw.groupBy("run").agg(
            F.min_by(F.struct(*CPU), "elapsed").alias("__first"), F.min("elapsed").alias("__from")
        )
        based = (
            spread_join(raw, first, ["run"], "elapsed")
            .filter(F.col("elapsed") > F.col("__from"))
            .select(*raw.columns, *[F.col(f"__first.{c}").alias(f"prev_{c}") for c in CPU])
        )
    elif mode == "interval":
        based = previous(raw, ["run"], "elapsed", CPU, rows=rows).filter(
            F.col(f"prev_{CPU[0]}").isNotNull()
        )
    else:
        raise ValueError(f"mode {mode!r} is neither since_start nor interval")
    passed = sum((F.col(c) - F.col(f"prev_{c}") for c in CPU), F.lit(0))
    share = [
        F.coalesce(F.try_divide((F.col(c) - F.col(f"prev_{c}")).cast("double"), passed.cast("double")), F.lit(0.0)).alias(c)
        for c in CPU
    ]
    rest = [c for c in raw.columns if c not in CPU and c not in ("run", "elapsed")]
    return based.select("run", "elapsed", *share, *rest)


def _rates(raw: DataFrame, spec: dict, interval: float, rows: int | None) -> DataFrame:
    counters = [c for c, _ in spec.values()]
    based = previous(raw, ["run", "device"], "elapsed", counters, rows=rows).filter(
        F.col(f"prev_{counters[0]}").isNotNull()
    )
    return based.select(
        "run",
        "elapsed",
        "device",
        *[
            ((F.col(c) - F.col(f"prev_{c}")).cast("double") * m / F.lit(float(interval))).alias(n)
            for n, (c, m) in spec.items()
        ],
    )


def blk_rates(raw: DataFrame, interval: float = 1.0, rows: int | None = None) -> DataFrame:
    """Block device counters to operations, merges and KB per second."""
    return _rates(raw, BLOCK, interval, rows)


def net_rates(raw: DataFrame, interval: float = 1.0, rows: int | None = None) -> DataFrame:
    """Network counters to packets and KB per second."""
    return _rates(raw, NET, interval, rows)
