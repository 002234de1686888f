"""The synthetic data set at any warehouse count.

`*_ids(spark, W)` give a table's row numbers from `spark.range`; `gen_*(ids, …)` turn row numbers
into rows by column expressions alone, with no shuffle, so generation scales with the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..sources.schemas import table_schema
from .config import config_rows

# Rows per parent and load state of the data set.
ITEMS = 100_000
DISTRICTS = 10
CUSTOMERS = 3_000
ORDERS = 3_000
FIRST_PENDING = 2_101
LOADED_AT = "2024-01-01 00:00:00"

_SIZES = {
    "item": lambda w: ITEMS,
    "warehouse": lambda w: w,
    "district": lambda w: w * DISTRICTS,
    "stock": lambda w: w * ITEMS,
    "customer": lambda w: w * DISTRICTS * CUSTOMERS,
    "history": lambda w: w * DISTRICTS * CUSTOMERS,
    "oorder": lambda w: w * DISTRICTS * ORDERS,
}


def row_ids(spark: SparkSession, table: str, warehouses: int) -> DataFrame:
    """Row numbers (from 0) of a table at `warehouses` warehouses."""
    return spark.range(0, _SIZES[table](warehouses))


def _div(n: int) -> Column:
    return F.expr(f"id div {n}")


def _cents(lo: int, hi: int, *key) -> Column:
    return (V.uniform(lo, hi, *key) / F.lit(100)).cast("decimal(12,2)")


def _tax(hi: int, *key) -> Column:
    return (V.uniform(0, hi, *key) / F.lit(10000)).cast("decimal(4,4)")


def _ordered(cols: dict[str, Column], table: str) -> list[Column]:
    return [cols[f.name].cast(f.dataType).alias(f.name) for f in table_schema(table)]


def _address(prefix: str, key) -> dict[str, Column]:
    return {
        f"{prefix}_street_1": V.a_string(10, 20, *key, "street_1"),
        f"{prefix}_street_2": V.a_string(10, 20, *key, "street_2"),
        f"{prefix}_city": V.a_string(10, 20, *key, "city"),
        f"{prefix}_state": V.state_code(*key, "state"),
        f"{prefix}_zip": V.zip_code(*key, "zip"),
    }


def gen_item(ids: DataFrame, seed: int = 1) -> DataFrame:
    key = (seed, "item", F.col("id"))
    cols = {
        "i_id": F.col("id") + 1,
        "i_name": V.a_string(14, 24, *key, "name"),
        "i_price": _cents(100, 10000, *key, "price"),
        "i_data": V.data_string(*key, "data"),
        "i_im_id": V.uniform(1, 10000, *key, "im"),
    }
    return ids.select(*_ordered(cols, "item"))


def gen_warehouse(ids: DataFrame, seed: int = 1) -> DataFrame:
    key = (seed, "warehouse", F.col("id"))
    cols = {
        "w_id": F.col("id") + 1,
        "w_ytd": F.lit(300000),
        "w_tax": _tax(2000, *key, "tax"),
        "w_name": V.a_string(6, 10, *key, "name"),
        **_address("w", key),
    }
    return ids.select(*_ordered(cols, "warehouse"))


def gen_district(ids: DataFrame, seed: int = 1) -> DataFrame:
    key = (seed, "district", F.col("id"))
    cols = {
        "d_w_id": _div(DISTRICTS) + 1,
        "d_id": F.col("id") % DISTRICTS + 1,
        "d_ytd": F.lit(30000),
        "d_tax": _tax(2000, *key, "tax"),
        "d_next_o_id": F.lit(ORDERS + 1),
        "d_name": V.a_string(6, 10, *key, "name"),
        **_address("d", key),
    }
    return ids.select(*_ordered(cols, "district"))


def gen_stock(ids: DataFrame, seed: int = 1) -> DataFrame:
    key = (seed, "stock", F.col("id"))
    cols = {
        "s_w_id": _div(ITEMS) + 1,
        "s_i_id": F.col("id") % ITEMS + 1,
        "s_quantity": V.uniform(10, 100, *key, "quantity"),
        "s_ytd": F.lit(0),
        "s_order_cnt": F.lit(0),
        "s_remote_cnt": F.lit(0),
        "s_data": V.data_string(*key, "data"),
        **{f"s_dist_{n:02d}": V.a_string(24, 24, *key, "dist", n) for n in range(1, 11)},
    }
    return ids.select(*_ordered(cols, "stock"))


def _customer_place() -> dict[str, Column]:
    return {
        "w": _div(DISTRICTS * CUSTOMERS) + 1,
        "d": _div(CUSTOMERS) % DISTRICTS + 1,
        "c": F.col("id") % CUSTOMERS + 1,
    }


def gen_customer(
    ids: DataFrame, seed: int = 1, c_last: int = 0, loaded_at: str = LOADED_AT
) -> DataFrame:
    """The first 1,000 customers of a district get the last names in turn, the others at random."""
    key = (seed, "customer", F.col("id"))
    at = _customer_place()
    cols = {
        "c_w_id": at["w"],
        "c_d_id": at["d"],
        "c_id": at["c"],
        "c_discount": _tax(5000, *key, "discount"),
        "c_credit": F.when(V.uniform(1, 100, *key, "credit") <= 90, "GC").otherwise("BC"),
        "c_last": F.when(at["c"] <= 1000, V.c_last(at["c"] - 1)).otherwise(
            V.nurand_last(c_last, *key, "last")
        ),
        "c_first": V.a_string(8, 16, *key, "first"),
        "c_credit_lim": F.lit(50000),
        "c_balance": F.lit(-10),
        "c_ytd_payment": F.lit(10),
        "c_payment_cnt": F.lit(1),
        "c_delivery_cnt": F.lit(0),
        **_address("c", key),
        "c_phone": V.n_string(16, 16, *key, "phone"),
        "c_since": F.lit(loaded_at).cast("timestamp"),
        "c_middle": F.lit("OE"),
        "c_data": V.a_string(300, 500, *key, "data"),
    }
    return ids.select(*_ordered(cols, "customer"))


def gen_history(ids: DataFrame, seed: int = 1, loaded_at: str = LOADED_AT) -> DataFrame:
    at = _customer_place()
    cols = {
        "hist_id": F.col("id") + 1,
        "h_c_id": at["c"],
        "h_c_d_id": at["d"],
        "h_c_w_id": at["w"],
        "h_d_id": at["d"],
        "h_w_id": at["w"],
        "h_date": F.lit(loaded_at).cast("timestamp"),
        "h_amount": F.lit(10),
        "h_data": V.a_string(12, 24, seed, "history", F.col("id")),
    }
    return ids.select(*_ordered(cols, "history"))


# 3,000 customers as a 40 x 75 grid, and the rounds of the shuffle over it.
GRID = (40, 75)
ROUNDS = 4


def customer_permutation(ids: DataFrame, seed: int = 1) -> DataFrame:
    """For each order place of each district, the customer who placed that order.

    Rounds that shift one grid coordinate by a hash of the other can each be undone, so different
    places get different customers, without sorting or joining the district. Each round is a
    column of its own, so that a hash is taken once.
    """
    n = DISTRICTS * ORDERS
    cur = ids.select(
        "id",
        (_div(n) + 1).cast("int").alias("w_id"),
        (_div(ORDERS) % DISTRICTS + 1).cast("int").alias("d_id"),
        (F.col("id") % ORDERS + 1).cast("int").alias("o_id"),
        (F.col("id") % ORDERS % GRID[0]).alias("x"),
        (F.col("id") % ORDERS).alias("p"),
    ).select("id", "w_id", "d_id", "o_id", "x", F.expr(f"p div {GRID[0]}").alias("y"))
    key = (seed, "perm", F.col("w_id"), F.col("d_id"))
    for r in range(ROUNDS):
        dx = V.uniform(0, GRID[0] - 1, *key, "x", r, F.col("y"))
        cur = cur.withColumn("x", (F.col("x") + dx) % GRID[0])
        dy = V.uniform(0, GRID[1] - 1, *key, "y", r, F.col("x"))
        cur = cur.withColumn("y", (F.col("y") + dy) % GRID[1])
    return cur.select(
        "id", "w_id", "d_id", "o_id", (F.col("y") * GRID[0] + F.col("x") + 1).cast("int").alias("c_id")
    )


def gen_oorder(ids: DataFrame, seed: int = 1, loaded_at: str = LOADED_AT) -> DataFrame:
    key = (seed, "oorder", F.col("id"))
    delivered = F.col("o_id") < FIRST_PENDING
    cols = {
        "o_w_id": F.col("w_id"),
        "o_d_id": F.col("d_id"),
        "o_id": F.col("o_id"),
        "o_c_id": F.col("c_id"),
        "o_carrier_id": F.when(delivered, V.uniform(1, 10, *key, "carrier")),
        "o_ol_cnt": V.uniform(5, 15, *key, "lines"),
        "o_all_local": F.lit(1),
        "o_entry_d": F.lit(loaded_at).cast("timestamp"),
    }
    return customer_permutation(ids, seed).select(*_ordered(cols, "oorder"))


def gen_order_line(oorder: DataFrame, seed: int = 1, loaded_at: str = LOADED_AT) -> DataFrame:
    key = (seed, "order_line", F.col("o_w_id"), F.col("o_d_id"), F.col("o_id"), F.col("n"))
    delivered = F.col("o_id") < FIRST_PENDING
    cols = {
        "ol_w_id": F.col("o_w_id"),
        "ol_d_id": F.col("o_d_id"),
        "ol_o_id": F.col("o_id"),
        "ol_number": F.col("n"),
        "ol_i_id": V.uniform(1, ITEMS, *key, "item"),
        "ol_delivery_d": F.when(delivered, F.lit(loaded_at).cast("timestamp")),
        "ol_amount": F.when(delivered, F.lit(0).cast("decimal(12,2)")).otherwise(
            _cents(1, 999999, *key, "amount")
        ),
        "ol_supply_w_id": F.col("o_w_id"),
        "ol_quantity": F.lit(5),
        "ol_dist_info": V.a_string(24, 24, *key, "dist"),
    }
    lines = oorder.select(
        "o_w_id", "o_d_id", "o_id", F.explode(F.sequence(F.lit(1), F.col("o_ol_cnt"))).alias("n")
    )
    return lines.select(*_ordered(cols, "order_line"))


def gen_new_order(oorder: DataFrame) -> DataFrame:
    return oorder.filter(F.col("o_id") >= FIRST_PENDING).select(
        F.col("o_w_id").alias("no_w_id"),
        F.col("o_d_id").alias("no_d_id"),
        F.col("o_id").alias("no_o_id"),
    )


def generate(
    spark: SparkSession,
    warehouses: int,
    seed: int = 1,
    c_last: int = 0,
    c_customer: int = 0,
    c_item: int = 0,
    loaded_at: str = LOADED_AT,
) -> dict[str, DataFrame]:
    """All ten tables."""
    oorder = gen_oorder(row_ids(spark, "oorder", warehouses), seed, loaded_at)
    return {
        "config": config_rows(spark, warehouses, c_last, c_customer, c_item),
        "item": gen_item(row_ids(spark, "item", warehouses), seed),
        "warehouse": gen_warehouse(row_ids(spark, "warehouse", warehouses), seed),
        "district": gen_district(row_ids(spark, "district", warehouses), seed),
        "stock": gen_stock(row_ids(spark, "stock", warehouses), seed),
        "customer": gen_customer(row_ids(spark, "customer", warehouses), seed, c_last, loaded_at),
        "history": gen_history(row_ids(spark, "history", warehouses), seed, loaded_at),
        "oorder": oorder,
        "order_line": gen_order_line(oorder, seed, loaded_at),
        "new_order": gen_new_order(oorder),
    }
