"""The given parquet tables shaped as order-entry tables, request tables and logs.

Ids and money are kept wider than in the table schemas, since at large scale factors the 25
districts of the given data outgrow 32 bits.
"""

from __future__ import annotations

from functools import cache, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scan import running
from ..session import cut_lineage
from ..operators.analytics import BLOCK, CPU, NET

PLACE = ["w", "d"]


def _cents(col: str) -> Column:
    return F.expr(f"cast(cast({col} as decimal(12,2)) * 100 as bigint)")


def _money(cents: Column, kind: str = "decimal(12,2)") -> Column:
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(kind)


def _address(prefix: str, key: str, *parts: Column) -> list[Column]:
    h = F.md5(F.concat_ws(":", F.lit(key), *[p.cast("string") for p in parts]))
    return [
        F.substring(h, 1, 12).alias(f"{prefix}_street_1"),
        F.substring(h, 5, 12).alias(f"{prefix}_street_2"),
        F.substring(h, 9, 12).alias(f"{prefix}_city"),
        F.upper(F.substring(h, 1, 2)).alias(f"{prefix}_state"),
        F.concat(F.substring(h, 21, 4), F.lit("11111")).alias(f"{prefix}_zip"),
    ]


# Columns of the given tables, declared so that no file is opened to find them out.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


class Bridge:
    """Lazy views over one folder of the given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @classmethod
    @lru_cache(maxsize=4)
    def of(cls, spark: SparkSession, folder: str) -> Bridge:
        """The views of a session, built once: they are plans and hold no data."""
        return cls(spark, folder)

    def written(self) -> Bridge:
        """The same views for one query that starts from orders or buyers several times: those are written once."""
        return Written(self.spark, self.folder)

    @cache
    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    # --- bases ---

    @cache
    def dist(self) -> DataFrame:
        """Nations as districts of their region's warehouse; 25 rows at any scale."""
        nth = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
        return self.raw("nation").select(
            "n_nationkey",
            "n_name",
            "n_regionkey",
            (F.col("n_regionkey") + 1).alias("w"),
            nth.alias("d"),
        )

    @cache
    def buyers(self) -> DataFrame:
        """Customers with their place."""
        at = self.dist().select("n_nationkey", "w", "d")
        c = self.raw("customer")
        return c.join(at, c.c_nationkey == at.n_nationkey).drop("n_nationkey")

    @cache
    def ranked_buyers(self) -> DataFrame:
        return running(
            self.buyers().select("w", "d", "c_custkey", "c_mktsegment"),
            PLACE,
            "c_custkey",
            rank="nth",
            total="n",
        )

    @cache
    def placed(self) -> DataFrame:
        """Orders with their buyer's place."""
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        return o.join(self.buyers().select(F.col("c_custkey").alias("o_custkey"), "w", "d"), "o_custkey")

    @cache
    def oo(self) -> DataFrame:
        """Orders with place, id in the place and whether still pending."""
        ranked = running(self.placed(), PLACE, "o_orderkey", rank="o_id", total="cnt")
        return ranked.select(
            F.col("o_orderkey").alias("ok"),
            "w",
            "d",
            "o_id",
            "o_custkey",
            _cents("o_totalprice").alias("cents"),
            F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
            (F.col("o_id") * 10 > F.col("cnt") * 7).alias("pending"),
        )

    # --- the ten tables ---

    @cache
    def history(self) -> DataFrame:
        names = self.dist().join(
            self.raw("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"),
            "n_regionkey",
        ).select("w", "d", "n_name", "r_name")
        return self.oo().join(names, PLACE).select(
            (F.col("ok") + 1).alias("hist_id"),
            F.col("o_custkey").alias("h_c_id"),
            F.col("d").alias("h_c_d_id"),
            F.col("w").alias("h_c_w_id"),
            F.col("d").alias("h_d_id"),
            F.col("w").alias("h_w_id"),
            F.col("o_orderdate").alias("h_date"),
            self._h_amount().alias("h_amount"),
            F.concat(
                F.substring("r_name", 1, 10), F.lit("    "), F.substring("n_name", 1, 10)
            ).alias("h_data"),
        )

    @staticmethod
    def _h_amount() -> Column:
        return _money(F.col("cents") % 499901 + 100, "decimal(6,2)")

    @cache
    def district(self) -> DataFrame:
        # Order ids of a place count from 1, so its last one is the number of its orders; none is ranked for it.
        paid = self.placed().select(*PLACE, _cents("o_totalprice").alias("cents"))
        by = paid.groupBy(*PLACE).agg(F.sum(self._h_amount()).alias("paid"), F.count(F.lit(1)).alias("last"))
        return self.dist().join(by, PLACE, "left").select(
            F.col("w").alias("d_w_id"),
            F.col("d").alias("d_id"),
            (F.lit(30000) + F.coalesce("paid", F.lit(0))).cast("decimal(20,2)").alias("d_ytd"),
            (F.col("n_nationkey") * 7 % 21 / F.lit(100)).cast("decimal(4,4)").alias("d_tax"),
            (F.coalesce("last", F.lit(0)) + 1).alias("d_next_o_id"),
            F.substring("n_name", 1, 10).alias("d_name"),
            *_address("d", "d", F.col("w"), F.col("d")),
        )

    @cache
    def warehouse(self) -> DataFrame:
        paid = self.district().groupBy(F.col("d_w_id").alias("w")).agg(F.sum("d_ytd").alias("paid"))
        r = self.raw("region").withColumn("w", F.col("r_regionkey") + 1)
        return r.join(paid, "w", "left").select(
            F.col("w").alias("w_id"),
            F.coalesce("paid", F.lit(0)).cast("decimal(20,2)").alias("w_ytd"),
            (F.col("r_regionkey") * 3 / F.lit(100)).cast("decimal(4,4)").alias("w_tax"),
            F.substring("r_name", 1, 10).alias("w_name"),
            *_address("w", "w", F.col("w")),
        )

    @cache
    def customer(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.buyers().select(
            F.col("w").alias("c_w_id"),
            F.col("d").alias("c_d_id"),
            k.alias("c_id"),
            (k % 51 / F.lit(100)).cast("decimal(4,4)").alias("c_discount"),
            F.when(k % 10 == 0, "BC").otherwise("GC").alias("c_credit"),
            F.col("c_mktsegment").alias("c_last"),
            F.substring("c_name", -16, 16).alias("c_first"),
            F.lit(50000).cast("decimal(12,2)").alias("c_credit_lim"),
            F.col("c_acctbal").cast("decimal(12,2)").cast("decimal(20,2)").alias("c_balance"),
            F.lit(10).cast("decimal(20,2)").alias("c_ytd_payment"),
            F.lit(1).cast("bigint").alias("c_payment_cnt"),
            F.lit(0).cast("bigint").alias("c_delivery_cnt"),
            *_address("c", "c", k),
            F.lpad(k.cast("string"), 16, "0").alias("c_phone"),
            F.lit("2024-01-01").cast("timestamp").alias("c_since"),
            F.lit("OE").alias("c_middle"),
            F.repeat(F.md5(k.cast("string")), 12).alias("c_data"),
        )

    def _line_supply(self) -> Column:
        return F.when(F.col("l_suppkey") % 100 == 7, F.col("w") % 5 + 1).otherwise(F.col("w"))

    @cache
    def oorder(self) -> DataFrame:
        per = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("ok")).agg(
            F.count(F.lit(1)).alias("lines"),
            F.max((F.col("l_suppkey") % 100 == 7).cast("int")).alias("remote"),
        )
        return self.oo().join(per, "ok", "left").select(
            F.col("w").alias("o_w_id"),
            F.col("d").alias("o_d_id"),
            "o_id",
            F.col("o_custkey").alias("o_c_id"),
            F.when(~F.col("pending"), F.col("ok") % 10 + 1).cast("int").alias("o_carrier_id"),
            F.coalesce("lines", F.lit(0)).alias("o_ol_cnt"),
            (1 - F.coalesce("remote", F.lit(0))).alias("o_all_local"),
            F.col("o_orderdate").alias("o_entry_d"),
        )

    @cache
    def order_line(self) -> DataFrame:
        order = [
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_shipdate",
        ]
        lines = self.raw("lineitem").select("l_orderkey", *order)
        at = self.oo().select(F.col("ok").alias("l_orderkey"), "w", "d", "o_id", "pending")
        # Lines of an order key that is there twice are told apart by nothing but the order's id.
        number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order, "o_id"))
        text = F.md5(F.concat_ws(":", F.lit("ol"), "l_orderkey", "l_partkey"))
        return lines.join(at, "l_orderkey").select(
            F.col("w").alias("ol_w_id"),
            F.col("d").alias("ol_d_id"),
            F.col("o_id").alias("ol_o_id"),
            number.alias("ol_number"),
            F.col("l_partkey").alias("ol_i_id"),
            F.when(~F.col("pending"), F.col("l_shipdate").cast("timestamp")).alias("ol_delivery_d"),
            _money(_cents("l_extendedprice") % 999999 + 1, "decimal(6,2)").alias("ol_amount"),
            self._line_supply().alias("ol_supply_w_id"),
            (F.col("l_quantity").cast("int") % 10 + 1).alias("ol_quantity"),
            F.substring(text, 1, 24).alias("ol_dist_info"),
        )

    @cache
    def new_order(self) -> DataFrame:
        return self.oo().filter("pending").select(
            F.col("w").alias("no_w_id"), F.col("d").alias("no_d_id"), F.col("o_id").alias("no_o_id")
        )

    @cache
    def item(self) -> DataFrame:
        mark = F.when(F.col("p_partkey") % 10 == 0, F.lit(" ORIGINAL")).otherwise(F.lit(""))
        return self.raw("part").select(
            F.col("p_partkey").alias("i_id"),
            F.col("p_name").alias("i_name"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("i_price"),
            F.concat("p_type", F.lit(" "), "p_brand", mark).alias("i_data"),
            F.col("p_size").alias("i_im_id"),
        )

    @cache
    def stock(self) -> DataFrame:
        """Every part in each of the five warehouses.

        The parts are a short file, so they are dealt out before the rows and their texts are made of them.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        p = self.raw("part").select("p_partkey").repartition(tasks, "p_partkey").select(
            "p_partkey", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("w")
        )

        def text(tag) -> Column:
            return F.md5(F.concat_ws(":", F.col("w"), F.col("p_partkey"), F.lit(tag)))

        return p.select(
            F.col("w").alias("s_w_id"),
            F.col("p_partkey").alias("s_i_id"),
            (10 + (F.col("p_partkey") * 7 + F.col("w") * 13) % 91).cast("int").alias("s_quantity"),
            F.lit(0).cast("bigint").alias("s_ytd"),
            F.lit(0).cast("bigint").alias("s_order_cnt"),
            F.lit(0).cast("bigint").alias("s_remote_cnt"),
            F.when(F.col("p_partkey") % 20 == 0, F.lit("ORIGINAL"))
            .otherwise(text("data"))
            .alias("s_data"),
            *[F.substring(text(f"{n:02d}"), 1, 24).alias(f"s_dist_{n:02d}") for n in range(1, 11)],
        )

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: getattr(self, n)() for n in names}

    # --- requests ---

    def _events(self, kind: str) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == kind).select(
            F.col("event_id").alias("req_seq"),
            (F.col("user_id") % 5 + 1).alias("w_id"),
            (F.col("event_id") % 5 + 1).alias("d_id"),
            "value",
            "user_id",
        )

    def _picked(self, req: DataFrame, w: str, d: str) -> DataFrame:
        """Add the customer the request picks among those of a place, with the last name."""
        sizes = self.buyers().groupBy(*PLACE).agg(F.count(F.lit(1)).alias("n"))
        sized = req.join(sizes.select(F.col("w").alias(w), F.col("d").alias(d), "n"), [w, d])
        sized = sized.withColumn("nth", F.col("req_seq") % F.col("n") + 1).drop("n")
        who = self.ranked_buyers().select(
            F.col("w").alias(w),
            F.col("d").alias(d),
            "nth",
            F.col("c_custkey").alias("c_id"),
            F.col("c_mktsegment").alias("c_last"),
        )
        return sized.join(who, [w, d, "nth"]).drop("nth")

    @cache
    def new_order_req(self) -> DataFrame:
        parts = self.raw("part").agg(F.count(F.lit(1)).alias("n")).scalar()
        # Requests are few bytes, which would leave all lines made of them to a task or two.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        req = self._picked(self._events("purchase"), "w_id", "d_id").repartition(tasks, "req_seq")
        e = F.col("req_seq")
        sized = req.withColumn("n", (e % 11 + 5).cast("int")).withColumn("parts", parts)

        def line(slot: Column) -> Column:
            wrong = (slot == F.col("n")) & (e % 50 == 0)
            return F.struct(
                slot.alias("slot"),
                ((e * 31 + slot * 97) % F.col("parts") + F.when(wrong, 1000000).otherwise(0)).alias(
                    "ol_i_id"
                ),
                F.when((e + slot) % 100 == 0, F.col("w_id") % 5 + 1)
                .otherwise(F.col("w_id"))
                .alias("ol_supply_w_id"),
                ((e + slot) % 10 + 1).cast("int").alias("ol_quantity"),
            )

        return sized.select(
            "req_seq",
            "w_id",
            "d_id",
            "c_id",
            F.transform(F.sequence(F.lit(1), F.col("n")), line).alias("lines"),
        )

    @cache
    def payment_req(self) -> DataFrame:
        e = F.col("req_seq")
        far = e % 20 < 3
        placed = self._events("click").select(
            "*",
            F.when(far, F.col("w_id") % 5 + 1).otherwise(F.col("w_id")).alias("c_w_id"),
            F.when(far, F.expr("req_seq div 5") % 5 + 1).otherwise(F.col("d_id")).alias("c_d_id"),
        )
        by_last = e % 7 < 4
        return self._picked(placed, "c_w_id", "c_d_id").select(
            "req_seq",
            "w_id",
            "d_id",
            "c_w_id",
            "c_d_id",
            F.when(~by_last, F.col("c_id")).alias("c_id"),
            F.when(by_last, F.col("c_last")).alias("c_last"),
            (F.col("value").cast("decimal(12,2)") + 1).cast("decimal(6,2)").alias("h_amount"),
        )

    @cache
    def order_status_req(self) -> DataFrame:
        by_last = F.col("req_seq") % 7 < 4
        return self._picked(self._events("error"), "w_id", "d_id").select(
            "req_seq",
            "w_id",
            "d_id",
            F.when(~by_last, F.col("c_id")).alias("c_id"),
            F.when(by_last, F.col("c_last")).alias("c_last"),
        )

    @cache
    def stock_level_req(self) -> DataFrame:
        return self._events("view").select(
            "req_seq", "w_id", "d_id", (F.col("req_seq") % 11 + 10).cast("int").alias("threshold")
        )

    @cache
    def delivery_req(self) -> DataFrame:
        return self._events("signup").select(
            "req_seq", "w_id", (F.col("req_seq") % 10 + 1).cast("int").alias("o_carrier_id")
        )

    def stray(self, req: DataFrame) -> DataFrame:
        """The same requests, a seventh of them sent to a warehouse or district that is not there."""
        gone = F.col("req_seq") % 7 == 3
        return req.withColumn("w_id", F.when(gone, F.col("w_id") + 90).otherwise(F.col("w_id")))

    # --- logs ---

    @cache
    def result(self) -> DataFrame:
        # Which event stands for which transaction.
        kinds = {
            "purchase": "NEW_ORDER",
            "click": "PAYMENT",
            "view": "STOCK_LEVEL",
            "error": "ORDER_STATUS",
            "signup": "DELIVERY",
        }
        kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("event_type")]
        e = F.col("event_id")
        base = self.raw("events").select(
            "event_id",
            self.elapsed().alias("elapsed"),
            _cents("value").alias("cents"),
            kind.alias("kind"),
        )
        types = F.when(
            F.col("kind") == "DELIVERY", F.array(F.lit("DELIVERY"), F.lit("DELIVERY_BG"))
        ).otherwise(F.array("kind"))
        back = F.col("ttype") == "DELIVERY_BG"
        latency = F.when(back, F.col("cents") * 3).otherwise(F.col("cents"))
        return base.withColumn("ttype", F.explode(types)).select(
            F.lit(1).alias("run"),
            "elapsed",
            latency.alias("latency"),
            latency.alias("dblatency"),
            "ttype",
            ((F.col("ttype") == "NEW_ORDER") & (e % 100 == 0)).cast("int").alias("rbk"),
            F.when(back, e % 3).otherwise(0).cast("int").alias("dskipped"),
            (e % 200 == 1).cast("int").alias("error"),
        )

    @staticmethod
    def elapsed() -> Column:
        start = F.lit("2024-01-01").cast("timestamp")
        return F.unix_millis(F.col("ts").cast("timestamp")) - F.unix_millis(start)

    @cache
    def run_info(self) -> DataFrame:
        """One row, with the number of regions as warehouses."""
        return self.raw("region").agg(F.count(F.lit(1)).cast("int").alias("runWarehouses")).select(
            F.lit(1).alias("run"), F.lit(43200).alias("runMins"), "runWarehouses"
        )

    def _counters(self, keys: list[str], cols: dict[str, Column]) -> DataFrame:
        """Cumulative counters sampled once a minute, event by event."""
        base = self.raw("events").select(
            F.lit(1).alias("run"),
            "event_id",
            F.concat(F.lit("dev_"), (F.col("user_id") % 3).cast("string")).alias("device"),
            _cents("value").alias("cents"),
        )
        return running(base, keys, "event_id", sums=cols)

    @cache
    def raw_cpu(self) -> DataFrame:
        c = F.col("cents")
        counted = self._counters(["run"], {n: c % (11 + i) for i, n in enumerate(CPU)})
        return counted.select(
            "run", (F.col("event_id") * 60000).alias("elapsed"), *CPU, (c % 1000).alias("vm_nr_dirty")
        )

    @cache
    def raw_blk(self) -> DataFrame:
        names = [c for c, _ in BLOCK.values()]
        c = F.col("cents")
        counted = self._counters(["run", "device"], {n: c % (101 + i) for i, n in enumerate(names)})
        return counted.select("run", (F.col("event_id") * 60000).alias("elapsed"), "device", *names)

    @cache
    def raw_net(self) -> DataFrame:
        names = [c for c, _ in NET.values()]
        c = F.col("cents")
        counted = self._counters(["run", "device"], {n: c % (1001 + i) for i, n in enumerate(names)})
        return counted.select("run", (F.col("event_id") * 60000).alias("elapsed"), "device", *names)


class Written(Bridge):
    """Views over places, order ids and new orders that are written when first asked for, for the length of one query."""

    @cache
    def ranked_buyers(self) -> DataFrame:
        return cut_lineage(super().ranked_buyers())

    @cache
    def placed(self) -> DataFrame:
        return cut_lineage(super().placed())

    @cache
    def oo(self) -> DataFrame:
        return cut_lineage(super().oo())

    @cache
    def district(self) -> DataFrame:
        return cut_lineage(super().district())

    @cache
    def new_order_req(self) -> DataFrame:
        return cut_lineage(super().new_order_req())
