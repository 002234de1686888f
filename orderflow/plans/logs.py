"""Registered queries over the run logs and machine counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics
from .base_sql import CPU
from .catalog import register

# The given events span 30 days, so that every bucket is ten minutes wide.
_PER_MINUTE = "count(*) * 60.0 / 600"


@register(
    "tpm_total",
    "run:i elapsed:i tpm_total:f",
    f"select 1 as run, bucket as elapsed, {_PER_MINUTE} as tpm_total from front group by bucket",
)
def _(b):
    return analytics.tpm_total(b.result(), b.run_info())


@register(
    "tpm_new_order",
    "run:i elapsed:i tpm_c:f",
    f"select 1 as run, bucket as elapsed, {_PER_MINUTE} as tpm_c from front where ttype = 'NEW_ORDER' "
    "group by bucket",
)
def _(b):
    return analytics.tpm_new_order(b.result(), b.run_info())


@register(
    "latency_series",
    "run:i elapsed:i ttype:s latency:r",
    "select 1 as run, bucket as elapsed, ttype, avg(latency) as latency from front group by bucket, ttype",
)
def _(b):
    return analytics.latency_series(b.result(), b.run_info())


@register("latency_p98", "run:i p98:r", "select 1 as run, quantile_cont(latency, 0.98) as p98 from front")
def _(b):
    return analytics.latency_p98(b.result())


_FIX = "cast(cast({x} as decimal(20,{p})) as varchar)"


def _fix(x: str, p: int, unit: str) -> str:
    return f"{_FIX.format(x=x, p=p)} || '{unit}'"


_RATES = (
    "select 1 as run, case when k = 1 then 'tpmC' else 'tpmTotal' end as tx_name, case when k = 1 then "
    f"{_fix('c / 43200.0', 2, '')} else {_fix('t / 43200.0', 2, '')} end as tx_count, case when k = 1 then "
    f"{_fix('c / 43200.0 / w / 0.1286', 3, '%')} end as tx_percent from (select cast(count(*) as double) "
    "as t, cast(count(*) filter (ttype = 'NEW_ORDER') as double) as c, (select count(*) from region) as w "
    "from front), (values (1), (2)) n(k)"
)


@register("tpm_rows", "run:i tx_name:s tx_count:s tx_percent:s", _RATES)
def _(b):
    return analytics.tpm_rows(b.result(), b.run_info())


@register(
    "tx_summary",
    "run:i tx_name:s tx_count:s tx_percent:s tx_90th:s tx_max:s tx_limit:s tx_rbk:s tx_error:s tx_dskipped:s",
    "select 1 as run, ttype as tx_name, cast(count(*) as varchar) as tx_count, "
    "case when ttype <> 'DELIVERY_BG' then "
    f"{_fix('count(*) * 100.0 / (select count(*) from front)', 3, '%')} end as tx_percent, "
    f"{_fix('quantile_cont(latency, 0.9) / 1000.0', 3, 's')} as tx_90th, "
    f"{_fix('max(latency) / 1000.0', 3, 's')} as tx_max, "
    "case ttype when 'STOCK_LEVEL' then '20.0' when 'DELIVERY_BG' then '80.0' else '5.0' end as tx_limit, "
    f"case when ttype = 'NEW_ORDER' then {_fix('sum(rbk) * 100.0 / count(*)', 3, '%')} end as tx_rbk, "
    "cast(sum(error) as varchar) as tx_error, "
    "case when ttype = 'DELIVERY_BG' then cast(sum(dskipped) as varchar) end as tx_dskipped "
    "from result group by ttype union all select run, tx_name, tx_count, tx_percent, null, null, null, "
    f"null, null, null from ({_RATES})",
)
def _(b):
    return analytics.tx_summary(b.result(), b.run_info())


@register(
    "session_summary",
    "run:i tpm_c:f tpm_total:f tpm_e:f transactions:i errors:i new_orders:i",
    "select 1 as run, 6000000 * c // s / 100.0 as tpm_c, 6000000 * t // s / 100.0 as tpm_total, "
    "6000000 * e // s / 100.0 as tpm_e, t as transactions, e as errors, c as new_orders from "
    "(select count(*) as t, count(*) filter (error = 1) as e, count(*) filter (ttype = 'NEW_ORDER' and "
    "error = 0) as c, max(elapsed) filter (error = 0) as s from front)",
)
def _(b):
    failed = b.result().filter((F.col("error") == 1) & (F.col("ttype") != analytics.BACKGROUND))
    return analytics.session_summary(b.result().filter(F.col("error") == 0), failed)


@register(
    "running_tpm",
    "run:i second:i tpm_total:f tpm_c:f recent_tpm_total:i recent_tpm_c:i",
    "select 1 as run, second, 6000000 * (sum(n) over a) // ((second + 1) * 1000) / 100.0 as tpm_total, "
    "6000000 * (sum(c) over a) // ((second + 1) * 1000) / 100.0 as tpm_c, (sum(n) over r) * 60 // 5 as "
    "recent_tpm_total, (sum(c) over r) * 60 // 5 as recent_tpm_c from (select elapsed // 1000 as second, "
    "count(*) as n, count(*) filter (ttype = 'NEW_ORDER') as c from front group by 1) "
    "window a as (order by second rows between unbounded preceding and current row), "
    "r as (order by second range between 4 preceding and current row)",
)
def _(b):
    return analytics.running_tpm(b.result())


@register(
    "result_rows",
    "run:i elapsed:i latency:i dblatency:i ttype:s rbk:i dskipped:i error:i",
    "select 1 as run, elapsed, case when ttype = 'DELIVERY_BG' then latency + 250 else latency end as "
    "latency, dblatency, ttype, rbk, dskipped, error from result",
)
def _(b):
    r = b.result()
    start = 1704067200000
    ended = F.col("elapsed") + start
    begun = ended - F.col("dblatency")
    txn = r.select(
        "run",
        F.lit(start).alias("session_start"),
        F.when(F.col("ttype") == analytics.BACKGROUND, begun - 250).alias("due"),
        begun.alias("started"),
        ended.alias("ended"),
        "ttype",
        (F.col("rbk") == 1).alias("rbk"),
        F.col("dskipped").alias("skipped"),
        (F.col("error") == 1).alias("failed"),
    )
    return analytics.result_rows(txn)


_SHARES = " ".join(f"{c}:r" for c in CPU)


@register(
    "cpu_fractions",
    f"run:i elapsed:i {_SHARES} vm_nr_dirty:i",
    "select 1 as run, * from sys_info",
)
def _(b):
    return analytics.cpu_fractions(b.raw_cpu())


_STEP = " + ".join(CPU)


@register(
    "cpu_fractions_interval",
    f"run:i elapsed:i {_SHARES} vm_nr_dirty:i",
    "select 1 as run, elapsed, vm_nr_dirty, "
    + ", ".join(f"case when {_STEP} = 0 then 0.0 else {c} / cast(({_STEP}) as double) end as {c}" for c in CPU)
    + " from cpu_step where cpu_user is not null",
)
def _(b):
    return analytics.cpu_fractions(b.raw_cpu(), "interval")


@register(
    "blk_rates",
    "run:i elapsed:i device:s rdiops:r rdmerges:r rdkbps:r wriops:r wrmerges:r wrkbps:r",
    "select 1 as run, * from blk",
)
def _(b):
    return analytics.blk_rates(b.raw_blk())


@register(
    "net_rates",
    "run:i elapsed:i device:s rxpktsps:f rxkbps:f txpktsps:f txkbps:f",
    "select 1 as run, * from net",
)
def _(b):
    return analytics.net_rates(b.raw_net())


# The counters are sampled once a minute, so that a bucket holds ten of them.
_BUCKET = "elapsed // 600000 * 600000"


def _avg(*cols: str) -> str:
    return ", ".join(f"avg({c}) as {c}" for c in cols)


@register(
    "cpu_utilization",
    "run:i elapsed:i cpu_user:r cpu_system:r cpu_iowait:r user_pct:r user_system_pct:r user_system_wait_pct:r",
    "select 1 as run, elapsed, cpu_user, cpu_system, cpu_iowait, cpu_user * 100 as user_pct, "
    "(cpu_user + cpu_system) * 100 as user_system_pct, (cpu_user + cpu_system + cpu_iowait) * 100 as "
    f"user_system_wait_pct from (select {_BUCKET} as elapsed, {_avg('cpu_user', 'cpu_system', 'cpu_iowait')} "
    "from sys_info group by 1)",
)
def _(b):
    return analytics.cpu_utilization(analytics.cpu_fractions(b.raw_cpu()), b.run_info())


@register(
    "dirty_buffers",
    "run:i elapsed:i vm_nr_dirty:r",
    f"select 1 as run, {_BUCKET} as elapsed, {_avg('vm_nr_dirty')} from sys_info group by 2",
)
def _(b):
    return analytics.dirty_buffers(analytics.cpu_fractions(b.raw_cpu()), b.run_info())


def _device(name: str, source: str, first: str, second: str, build) -> None:
    register(
        name,
        f"run:i device:s elapsed:i {first}:f {second}:f",
        f"select 1 as run, device, {_BUCKET} as elapsed, {_avg(first, second)} from {source} group by 2, 3",
    )(build)


_device(
    "blk_iops",
    "blk",
    "rdiops",
    "wriops",
    lambda b: analytics.blk_iops(analytics.blk_rates(b.raw_blk()), b.run_info()),
)
_device(
    "blk_kbps",
    "blk",
    "rdkbps",
    "wrkbps",
    lambda b: analytics.blk_kbps(analytics.blk_rates(b.raw_blk()), b.run_info()),
)
_device(
    "net_pps",
    "net",
    "rxpktsps",
    "txpktsps",
    lambda b: analytics.net_pps(analytics.net_rates(b.raw_net()), b.run_info()),
)
_device(
    "net_kbps",
    "net",
    "rxkbps",
    "txkbps",
    lambda b: analytics.net_kbps(analytics.net_rates(b.raw_net()), b.run_info()),
)
