"""Request tables drawn with the workload's mix and distributions; `req_seq` is the serial order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.scan import numbered
from .generate import DISTRICTS

# Default mix in percent.
DEFAULT_WEIGHTS = {"PAYMENT": 43, "STOCK_LEVEL": 4, "ORDER_STATUS": 4, "DELIVERY": 4}


def check_weights(weights: Mapping[str, int]) -> None:
    if any(w < 0 for w in weights.values()) or not any(weights.values()):
        raise ValueError("every weight must be 0 or more, and one of them above 0")
    if sum(weights.values()) > 100:
        raise ValueError("the weights add up to more than 100")


def gen_requests(
    ids: DataFrame,
    warehouses: int,
    weights: Mapping[str, int] | None = None,
    seed: int = 1,
    homes: DataFrame | None = None,
    terminals: int = 0,
) -> DataFrame:
    """One row per request: its type and home. What the named types leave of 100 is New-Order.

    `ids` holds `req_seq`. Without `homes` each request draws a home; with `homes` (from
    `gen_homes`) requests are dealt to the `terminals` terminals in turn.
    """
    weights = dict(DEFAULT_WEIGHTS if weights is None else weights)
    check_weights(weights)
    key = (seed, "mix", F.col("req_seq"))
    draw = V.uniform(1, 100, *key, "type")
    kind: Column | None = None
    upto = 0
    for name in ("PAYMENT", "STOCK_LEVEL", "ORDER_STATUS", "DELIVERY"):
        upto += weights.get(name, 0)
        kind = F.when(draw <= upto, name) if kind is None else kind.when(draw <= upto, name)
    typed = ids.select("req_seq", kind.otherwise("NEW_ORDER").alias("ttype"))
    if homes is None:
        return typed.select(
            "req_seq",
            "ttype",
            V.uniform(1, warehouses, *key, "w").cast("int").alias("w_id"),
            V.uniform(1, DISTRICTS, *key, "d").cast("int").alias("home_d_id"),
        )
    return (
        typed.withColumn("terminal", F.col("req_seq") % F.lit(terminals) + 1)
        .join(homes.withColumnRenamed("d_id", "home_d_id"), "terminal")
        .select("req_seq", "ttype", "w_id", "home_d_id")
    )


def gen_homes(places: DataFrame, terminals: int, seed: int = 1) -> DataFrame:
    """`terminals` different (w_id, d_id) places, drawn without replacement."""
    drawn = places.withColumn(
        "__draw",
        V.uniform(0, (1 << 32) - 1, seed, "home", F.col("w_id"), F.col("d_id")),
    )
    ranked = numbered(drawn, ["__draw", "w_id", "d_id"], "terminal")
    return ranked.filter(F.col("terminal") <= terminals).select("terminal", "w_id", "d_id")


def all_places(spark: SparkSession, warehouses: int) -> DataFrame:
    """Every (w_id, d_id)."""
    return spark.range(0, warehouses * DISTRICTS).select(
        (F.expr(f"id div {DISTRICTS}") + 1).cast("int").alias("w_id"),
        (F.col("id") % DISTRICTS + 1).cast("int").alias("d_id"),
    )


def gen_new_order_req(
    req: DataFrame, warehouses: int, c_customer: int = 0, c_item: int = 0, seed: int = 1
) -> DataFrame:
    """5 to 15 lines; one line in a hundred draws its supplier; one request in a hundred ends in
    an item that does not exist."""
    key = (seed, "no", F.col("req_seq"))
    sized = req.select(
        "req_seq",
        "w_id",
        V.uniform(1, DISTRICTS, *key, "d").cast("int").alias("d_id"),
        V.nurand_customer(c_customer, *key, "c").cast("int").alias("c_id"),
        V.uniform(5, 15, *key, "n").cast("int").alias("n"),
        (V.uniform(1, 100, *key, "bad") == 1).alias("bad"),
        (V.uniform(1, 9, *key, "by") * 1000000).alias("by"),
    )

    def line(slot: Column) -> Column:
        item = V.nurand_item(c_item, *key, slot, "item")
        wrong = F.col("bad") & (slot == F.col("n"))
        return F.struct(
            slot.alias("slot"),
            (item + F.when(wrong, F.col("by")).otherwise(F.lit(0))).cast("int").alias("ol_i_id"),
            F.when(V.uniform(1, 100, *key, slot, "home") <= 99, F.col("w_id"))
            .otherwise(V.uniform(1, warehouses, *key, slot, "w").cast("int"))
            .alias("ol_supply_w_id"),
            V.uniform(1, 10, *key, slot, "qty").cast("int").alias("ol_quantity"),
        )

    return sized.select(
        "req_seq",
        "w_id",
        "d_id",
        "c_id",
        F.transform(F.sequence(F.lit(1), F.col("n")), line).alias("lines"),
    )


def gen_payment_req(
    req: DataFrame, warehouses: int, c_customer: int = 0, c_last: int = 0, seed: int = 1
) -> DataFrame:
    """15 of 100 customers belong to another warehouse (never the home one, where there are
    others) and to any district; 60 of 100 are named by last name."""
    key = (seed, "pay", F.col("req_seq"))
    d = V.uniform(1, DISTRICTS, *key, "d")
    remote = V.uniform(1, 100, *key, "remote") > 85
    if warehouses > 1:
        shift = V.uniform(1, warehouses - 1, *key, "shift")
        other = (F.col("w_id") - 1 + shift) % warehouses + 1
    else:
        other = F.col("w_id")
    by_name = V.uniform(1, 100, *key, "by") <= 60
    return req.select(
        "req_seq",
        "w_id",
        d.cast("int").alias("d_id"),
        F.when(remote, other).otherwise(F.col("w_id")).cast("int").alias("c_w_id"),
        F.when(remote, V.uniform(1, DISTRICTS, *key, "cd")).otherwise(d).cast("int").alias("c_d_id"),
        F.when(~by_name, V.nurand_customer(c_customer, *key, "c")).cast("int").alias("c_id"),
        F.when(by_name, V.nurand_last(c_last, *key, "last")).alias("c_last"),
        (V.uniform(100, 500000, *key, "amount") / F.lit(100)).cast("decimal(6,2)").alias("h_amount"),
    )


def gen_order_status_req(
    req: DataFrame, c_customer: int = 0, c_last: int = 0, seed: int = 1
) -> DataFrame:
    key = (seed, "status", F.col("req_seq"))
    by_name = V.uniform(1, 100, *key, "by") <= 60
    return req.select(
        "req_seq",
        "w_id",
        V.uniform(1, DISTRICTS, *key, "d").cast("int").alias("d_id"),
        F.when(~by_name, V.nurand_customer(c_customer, *key, "c")).cast("int").alias("c_id"),
        F.when(by_name, V.nurand_last(c_last, *key, "last")).alias("c_last"),
    )


def gen_stock_level_req(req: DataFrame, seed: int = 1) -> DataFrame:
    key = (seed, "level", F.col("req_seq"))
    return req.select(
        "req_seq",
        "w_id",
        F.col("home_d_id").alias("d_id"),
        V.uniform(10, 20, *key, "threshold").cast("int").alias("threshold"),
    )


def gen_delivery_req(req: DataFrame, seed: int = 1) -> DataFrame:
    key = (seed, "delivery", F.col("req_seq"))
    return req.select(
        "req_seq", "w_id", V.uniform(1, 10, *key, "carrier").cast("int").alias("o_carrier_id")
    )
