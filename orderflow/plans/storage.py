"""Registered queries over sources, sinks and streams: what comes back must equal the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import analytics, config, new_order, stock_level
from ..session import checkpoint_root, cut_lineage
from ..sources import csvfiles, layout, logs, schemas
from ..sources.partitioned import PartitionedTables
from ..sources.schemas import log_schema
from ..sources.versions import TableVersions
from ..streaming import apply, feed, live, watch
from .catalog import REGISTRY, register
from .transactions import AT, _AT


def scratch(spark) -> str:
    """A fresh place in the shared folder."""
    return f"{checkpoint_root(spark)}/run-{uuid.uuid4().hex}"


def _csv(name: str, columns: str) -> None:
    @register(f"io_csv_{name}", columns, f"select * from t_{name}")
    def _(b):
        folder = scratch(b.spark)
        csvfiles.write_csv(b.tables(name), folder)
        return csvfiles.load_csv(b.spark, folder, [name])[name]


_csv(
    "customer",
    "c_w_id:i c_d_id:i c_id:i c_discount:f c_credit:s c_last:s c_first:s c_balance:f c_since:t c_data:s",
)
_csv(
    "oorder",
    "o_w_id:i o_d_id:i o_id:i o_c_id:i o_carrier_id:i o_ol_cnt:i o_all_local:i o_entry_d:t",
)
_csv(
    "order_line",
    "ol_w_id:i ol_d_id:i ol_o_id:i ol_number:i ol_i_id:i ol_delivery_d:t ol_amount:f "
    "ol_supply_w_id:i ol_quantity:i ol_dist_info:s",
)
_csv(
    "warehouse",
    "w_id:i w_ytd:f w_tax:f w_name:s w_street_1:s w_street_2:s w_city:s w_state:s w_zip:s",
)
_csv(
    "district",
    "d_w_id:i d_id:i d_ytd:f d_tax:f d_next_o_id:i d_name:s d_street_1:s d_street_2:s d_city:s "
    "d_state:s d_zip:s",
)
_csv(
    "history",
    "hist_id:i h_c_id:i h_c_d_id:i h_c_w_id:i h_d_id:i h_w_id:i h_date:t h_amount:f h_data:s",
)
_csv(
    "new_order",
    "no_w_id:i no_d_id:i no_o_id:i",
)
_csv(
    "item",
    "i_id:i i_name:s i_price:f i_data:s i_im_id:i",
)
_csv(
    "stock",
    "s_w_id:i s_i_id:i s_quantity:i s_ytd:i s_order_cnt:i s_remote_cnt:i s_data:s s_dist_01:s "
    "s_dist_02:s s_dist_03:s s_dist_04:s s_dist_05:s s_dist_06:s s_dist_07:s s_dist_08:s s_dist_09:s "
    "s_dist_10:s",
)


@register(
    "io_clustered",
    "c_w_id:i c_d_id:i c_last:s n:i first_id:i",
    "select c_w_id, c_d_id, c_last, count(*) as n, min(c_id) as first_id from t_customer "
    "where c_last < 'C' group by all",
)
def _(b):
    path = scratch(b.spark)
    layout.write_clustered(b.customer(), path, layout.BY_NAME)
    named = b.spark.read.parquet(path).filter(F.col("c_last") < "C")
    return named.groupBy("c_w_id", "c_d_id", "c_last").agg(
        F.count(F.lit(1)).alias("n"), F.min("c_id").alias("first_id")
    )


def _laid_out(b, *names: str) -> dict:
    db, b = f"layout_{uuid.uuid4().hex}", b.written()
    layout.save_layout(b.tables(*names), db, scratch(b.spark))
    return layout.open_layout(b.spark, db, names)


@register(
    "io_bucketed_lookup",
    "req_seq:i ol_number:i s_data:s ol_dist_info:s",
    REGISTRY["no_stock_lookup"].sql,
)
def _(b):
    """Order lines joined with the stock rows of a saved table, which stay where they are."""
    return new_order.lookup_stock(new_order.sequence_lines(b.new_order_req()), _laid_out(b, "stock")["stock"])


@register(
    "io_layout_stock_level",
    "req_seq:i w_id:i d_id:i threshold:i low_stock:i",
    REGISTRY["stock_level"].sql,
)
def _(b):
    """Stock level on saved tables: files without recent lines are skipped, stock is not shuffled."""
    return stock_level.stock_level(_laid_out(b, "district", "order_line", "stock"), b.stock_level_req())


@register(
    "io_result_log",
    "run:i elapsed:i latency:i dblatency:i ttype:s rbk:i dskipped:i error:i",
    "select * from result",
)
def _(b):
    path = scratch(b.spark)
    logs.write_log(b.result(), "result", path)
    return logs.read_result(b.spark, path)


@register(
    "io_os_metrics",
    "run:i elapsed:i device:s rdiops:r rdmerges:r rdkbps:r wriops:r wrmerges:r wrkbps:r",
    "select 1 as run, * from blk",
)
def _(b):
    path = scratch(b.spark)
    rates = analytics.blk_rates(b.raw_blk())
    cols = [c for c in rates.columns if c != "device"]
    logs.write_os_metrics(rates.select(*cols, "device"), path)
    schema = "run int, elapsed bigint, " + ", ".join(f"{c} double" for c in cols[2:])
    return b.spark.read.schema(schema + ", device string").option("header", "true").csv(path)


def _feed(b, kind: str):
    """The three machine logs as one feed of two drops, split by a stream; the log of one kind."""
    path = scratch(b.spark)
    # Counters are read several times to become rates, and rates once per drop: both are written once.
    made = {
        "sys_info": cut_lineage(analytics.cpu_fractions(cut_lineage(b.raw_cpu()))),
        "blk": cut_lineage(analytics.blk_rates(cut_lineage(b.raw_blk()))),
        "net": cut_lineage(analytics.net_rates(cut_lineage(b.raw_net()))),
    }
    for drop in range(2):
        for name, rows in made.items():
            now = rows.filter(F.expr("elapsed div 60000 % 2") == drop)
            logs.feed_lines(now, name).write.mode("append").text(f"{path}/in")
        feed.stream_os_feed(b.spark, f"{path}/in", f"{path}/out", f"{path}/cp", interval=None).awaitTermination()
    return logs.read_os_metrics(b.spark, f"{path}/out/{kind}", kind)


@register(
    "io_os_feed",
    "run:i elapsed:i device:s rxpktsps:r rxkbps:r txpktsps:r txkbps:r",
    "select 1 as run, * from net",
)
def _(b):
    return _feed(b, "net")


@register("io_os_feed_cpu", REGISTRY["cpu_fractions"].columns, REGISTRY["cpu_fractions"].sql)
def _(b):
    return _feed(b, "sys_info")


@register("io_run_info", "run:i db:s sessionStart:t runMins:i runWarehouses:i thinkTimeMultiplier:f", (
    "select 1 as run, 'spark, \"local\"' as db, timestamp '2024-01-01 00:00:00' as sessionStart, 43200 as runMins, "
    "(select count(*) from region) as runWarehouses, null as thinkTimeMultiplier"
))
def _(b):
    """The settings of a run, with a text that needs quotes and columns left empty."""
    path = scratch(b.spark)
    info = b.run_info().withColumns(
        {
            "db": F.lit('spark, "local"'),
            "sessionStart": F.lit("2024-01-01").cast("timestamp"),
            **{c: F.lit(None) for c in log_schema("run_info").names if c not in ("run", "db", "sessionStart", "runMins", "runWarehouses")},
        }
    )
    logs.write_log(info, "run_info", path)
    return logs.read_run_info(b.spark, path)


_TWO_SUMMARIES = (
    f"select * from ({REGISTRY['tx_summary'].sql}) union all select 2 as run, x.* exclude (run) from "
    f"({REGISTRY['tx_summary'].sql}) x"
)


@register("io_tx_summary", REGISTRY["tx_summary"].columns, _TWO_SUMMARIES)
def _(b):
    """The summaries of two runs with the same log, a file for each."""
    path = scratch(b.spark)
    both = [df.withColumn("run", F.explode(F.array(F.lit(1), F.lit(2)))) for df in (b.result(), b.run_info())]
    logs.write_tx_summary(analytics.tx_summary(*both), path)
    return logs.read_tx_summary(b.spark, path)


@register(
    "io_tables",
    "name:s loaded:i truncated:i dropped:i",
    " union all ".join(
        f"select '{n}' as name, count(*) as loaded, {kept} as truncated, 0 as dropped from {source}"
        for n, kept, source in (("district", 0, "t_district"), ("item", 0, "t_item"), ("config", 4, "range(4)"))
    ),
)
def _(b):
    """Typed tables are made, filled, emptied but for the load parameters, and dropped."""
    db = f"made_{uuid.uuid4().hex}"
    schemas.create_tables(b.spark, db)
    rows = b.tables("district", "item")
    rows["config"] = config.config_rows(b.spark, rows["district"].select("d_w_id").distinct().count(), 1, 2, 3)
    csvfiles.insert_tables(rows, db)
    if config.get_config(b.spark.table(f"{db}.config"), "warehouses") != str(b.warehouse().count()):
        raise ValueError("the load parameter differs from the tables")
    counts = {n: [b.spark.table(f"{db}.{n}").count()] for n in rows}
    schemas.truncate_tables(b.spark, db)
    for name, row in counts.items():
        row.append(b.spark.table(f"{db}.{name}").count())
    schemas.drop_tables(b.spark, db)
    left = b.spark.sql(f"SHOW TABLES IN {db}").count()
    b.spark.sql(f"DROP DATABASE {db}")
    found = [(name, *row, left) for name, row in counts.items()]
    return b.spark.createDataFrame(found, "name string, loaded bigint, truncated bigint, dropped bigint")


@register(
    "io_session",
    "run:i db:s runMins:i runWarehouses:i TpmTOTAL:f TpmC:f TpmE:f",
    "select 1 as run, 'spark' as db, 43200 as runMins, (select count(*) from region) as runWarehouses, "
    "6000000 * count(*) // max(elapsed) / 100.0 as TpmTOTAL, 6000000 * count(*) filter (ttype = "
    "'NEW_ORDER') // max(elapsed) / 100.0 as TpmC, 0.0 as TpmE from front",
)
def _(b):
    path = scratch(b.spark)
    result = b.result()
    info = b.run_info().select(
        "*",
        F.lit("spark").alias("db"),
        F.lit("2024-01-01").cast("timestamp").alias("sessionStart"),
        F.col("runWarehouses").alias("loadWarehouses"),
        F.lit(10).alias("numSUTThreads"),
        F.lit(0).alias("limitTxnsPerMin"),
    )
    summary = analytics.session_summary(result, result.filter("false"))
    logs.write_session(logs.session_rows(info, summary), path)
    return logs.read_session(b.spark, path)


# --- streams -----------------------------------------------------------------------------------


@register(
    "stream_tpm",
    "run:i start:t n:i new_orders:i latency:r",
    "select 1 as run, time_bucket(interval '10 minutes', timestamp '2024-01-01 00:00:00' + to_milliseconds(elapsed)) "
    "as start, count(*) as n, count(*) filter (ttype = 'NEW_ORDER') as new_orders, avg(latency) as latency "
    "from front group by 2",
)
def _(b):
    """The result log written as files, read as a stream and totalled in complete mode."""
    path = scratch(b.spark)
    logs.write_log(b.result(), "result", f"{path}/in")
    timed = live.with_time(live.read_result_stream(b.spark, f"{path}/in"), "2024-01-01")
    query = live.run_available(live.stream_tpm(timed), f"{path}/out", f"{path}/cp", "complete")
    return live.last_batch(b.spark, f"{path}/out", query)


@register(
    "stream_rates",
    "run:i second:i tpm_total:f tpm_c:f recent_tpm_total:i recent_tpm_c:i",
    "select run, second, 6000000 * (sum(n) over a) // ((second + 1) * 1000) / 100.0 as tpm_total, "
    "6000000 * (sum(c) over a) // ((second + 1) * 1000) / 100.0 as tpm_c, (sum(n) over r) * 60 // 5 as "
    "recent_tpm_total, (sum(c) over r) * 60 // 5 as recent_tpm_c from (select run, elapsed // 1000 as second, "
    "count(*) as n, count(*) filter (ttype = 'NEW_ORDER') as c from (select 1 as run, elapsed, ttype from front "
    "union all select 2, elapsed, ttype from front where latency % 2 = 0) group by 1, 2) "
    "window a as (partition by run order by second rows between unbounded preceding and current row), "
    "r as (partition by run order by second range between 4 preceding and current row)",
)
def _(b):
    """The logs of two runs, which come in three drops with seconds in common, as live rates."""
    path = scratch(b.spark)
    two = b.result().unionByName(b.result().filter("latency % 2 = 0").withColumn("run", F.lit(2)))
    for at in range(3):
        logs.write_log(two.filter(F.col("elapsed") % 3 == at), "result", f"{path}/in")
        query = live.stream_rates(
            live.read_result_stream(b.spark, f"{path}/in"), f"{path}/out", f"{path}/cp", interval=None
        )
        query.awaitTermination()
    return live.last_batch(b.spark, f"{path}/out", query)


@register(
    "stream_delivery_queue",
    "req_seq:i w_id:i skipped:i due:t",
    "select req_seq, w_id, 10 - (select count(*) from dl_claims x where x.req_seq = r.req_seq) as skipped, "
    f"{_AT} as due from r_delivery r",
)
def _(b):
    path, b = scratch(b.spark), b.written()
    apply.start_tables(b.spark, path, b.tables("new_order", "oorder", "order_line", "customer"))
    apply.enqueue_deliveries(b.delivery_req(), f"{path}/queue", AT)
    apply.drain_deliveries(b.spark, f"{path}/queue", path, f"{path}/cp", AT).awaitTermination()
    return TableVersions(b.spark, f"{path}/batches").results("result_delivery")


#: Per table the warehouse and a number that every changed column goes into.
_TELLING = {
    "warehouse": ("w_id", "w_ytd"),
    "district": ("d_w_id", "d_ytd + 1000 * d_id * d_next_o_id"),
    "customer": ("c_w_id", "c_balance + 3 * c_ytd_payment + 7 * c_id * c_payment_cnt + 11 * c_id * c_delivery_cnt"),
    "history": ("h_w_id", "h_amount + h_c_id * (hist_id % 1000)"),
    "new_order": ("no_w_id", "no_o_id * no_d_id"),
    "oorder": ("o_w_id", "o_d_id * o_id * coalesce(o_carrier_id, 0) + o_c_id * o_ol_cnt"),
    "order_line": ("ol_w_id", "ol_amount + 5 * ol_o_id * ol_quantity + 3 * case when ol_delivery_d is null then 0 else ol_o_id end"),
    "item": ("0", "i_price"),
    "stock": ("s_w_id", "s_i_id * s_quantity + 3 * s_ytd + 7 * s_i_id * s_order_cnt + 11 * s_remote_cnt"),
}

# The tables after all deliveries, then all new orders, then all payments.
_AFTER = {
    "warehouse": REGISTRY["pay_warehouse_ytd"].sql,
    "district": (
        "select d_w_id, d.d_id, d_ytd + coalesce((select sum(h_amount) from pay p where p.w_id = d_w_id and "
        "p.d_id = d.d_id), 0) as d_ytd, d_next_o_id + (select count(*) from no_placed n where n.w_id = d_w_id "
        "and n.d_id = d.d_id) as d_next_o_id from t_district d"
    ),
    "customer": (
        "select c_w_id, c_d_id, c_id, x.c_balance + y.c_balance - t.c_balance as c_balance, x.c_ytd_payment, "
        f"x.c_payment_cnt, y.c_delivery_cnt from ({REGISTRY['pay_customer_after'].sql}) x join "
        f"({REGISTRY['dl_customer_after'].sql}) y using (c_w_id, c_d_id, c_id) join t_customer t using "
        "(c_w_id, c_d_id, c_id)"
    ),
    "history": REGISTRY["pay_history_after"].sql,
    "new_order": f"{REGISTRY['dl_new_order_after'].sql} union all select w_id, d_id, o_id from no_placed",
    "oorder": (
        f"select o_w_id, o_d_id, o_id, t.o_c_id, x.o_carrier_id, t.o_ol_cnt from ({REGISTRY['dl_oorder_after'].sql}) x "
        "join t_oorder t using (o_w_id, o_d_id, o_id) union all select w_id, d_id, o_id, c_id, null, o_ol_cnt from no_placed"
    ),
    "order_line": (
        "select t.ol_w_id, ol_o_id, t.ol_amount, t.ol_quantity, x.ol_delivery_d from "
        f"({REGISTRY['dl_order_line_after'].sql}) x join t_order_line t using (ol_w_id, ol_d_id, ol_o_id, ol_number) "
        "union all select p.w_id, o_id, ol_amount, ol_quantity, null from no_good join no_placed p using (req_seq)"
    ),
    "item": "select * from t_item",
    "stock": REGISTRY["no_stock_quantity"].sql,
}


@register(
    "stream_apply",
    "name:s w:i n:i total:r",
    " union all ".join(
        f"select '{n}' as name, {w} as w, count(*) as n, sum(cast({x} as double)) as total from ({_AFTER[n]}) group by all"
        for n, (w, x) in _TELLING.items()
    ),
)
def _(b):
    """Deliveries, new orders, then payments and reads as three micro-batches; all nine tables after."""
    path, b = scratch(b.spark), b.written()
    apply.start_tables(b.spark, path, b.tables(*apply.TABLES), parts=3)
    for at, kinds in enumerate((("DELIVERY",), ("NEW_ORDER",), ("PAYMENT", "ORDER_STATUS", "STOCK_LEVEL"))):
        asked = None
        for ttype in kinds:
            rows = apply.envelope(getattr(b, f"{ttype.lower()}_req")(), ttype)
            asked = rows if asked is None else asked.unionByName(rows)
        asked.write.parquet(f"{path}/requests/{at}")
        apply.stream_apply(
            b.spark, f"{path}/requests/{at}", path, f"{path}/cp{at}", AT, parts=3
        ).awaitTermination()
    out = None
    for name, df in PartitionedTables(b.spark, f"{path}/tables", 3).read(apply.TABLES).items():
        w, x = _TELLING[name]
        found = df.groupBy(F.expr(w).cast("bigint").alias("w")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.expr(f"cast({x} as double)")).alias("total")
        )
        found = found.select(F.lit(name).alias("name"), "w", "n", "total")
        out = found if out is None else out.unionByName(found)
    return out


_FAULTY_STOCK = " union all ".join(
    f"select {v} as version, 'dup_stock' as check_id, count(*) as n from "
    f"(select s_w_id, s_i_id from t_stock where s_i_id % {m} = 0 group by s_w_id, s_i_id)"
    for v, m in ((1, 7), (2, 11))
)


@register(
    "stream_checks", "version:i check_id:s n:i", f"select * from ({_FAULTY_STOCK}) where n > 0"
)
def _(b):
    """Three versions as a stream sees them: a sound one, and two with other stock rows doubled."""
    path, b = scratch(b.spark), b.written()
    versions = TableVersions(b.spark, f"{path}/tables")
    versions.write(0, b.tables(*watch.NEEDED))
    stock = versions.read(["stock"])["stock"]
    for version, each in ((1, 7), (2, 11)):
        versions.write(version, {"stock": stock.union(stock.filter(F.col("s_i_id") % each == 0))})
    watch.watch_checks(
        b.spark, f"{path}/tables", f"{path}/out", f"{path}/cp", interval=None
    ).awaitTermination()
    found = b.spark.read.schema("check_id string, violation string, version int").parquet(
        f"{path}/out"
    )
    return found.groupBy("version", "check_id").agg(F.count("violation").alias("n"))
