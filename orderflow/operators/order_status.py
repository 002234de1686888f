"""Order status: for each request the customer, its last order and that order's lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .customers import lookup_customer, resolve_customer
from .errors import ROW_NOT_FOUND, message

# Line slots of an order, and the carrier shown while there is none.
SLOTS = 15
NO_CARRIER = -1

ORDER = ["w_id", "d_id", "o_id"]
_LINE = ["ol_i_id", "ol_supply_w_id", "ol_quantity", "ol_amount", "ol_delivery_d"]


def order_status_customer(req: DataFrame, customer: DataFrame) -> DataFrame:
    """Add c_id where a last name was given, and the customer's names and balance."""
    asked = req.select(
        "*",
        F.col("w_id").alias("c_w_id"),
        F.col("d_id").alias("c_d_id"),
        F.col("c_last").alias("asked_last"),
    )
    resolved = resolve_customer(asked, customer).drop("c_last")
    cols = ["c_first", "c_middle", "c_last", "c_balance"]
    return lookup_customer(resolved, customer, cols)


def last_order(req: DataFrame, oorder: DataFrame) -> DataFrame:
    """Add o_id, entry time and carrier of the customer's newest order; carrier -1 while pending.

    The newest order of every customer is found before the join, so that the orders of a busy
    customer are reduced where they are read.
    """
    who = ["w_id", "d_id", "c_id"]
    placed = oorder.select(
        F.col("o_w_id").alias("w_id"),
        F.col("o_d_id").alias("d_id"),
        F.col("o_c_id").alias("c_id"),
        "o_id",
        "o_entry_d",
        "o_carrier_id",
    )
    newest = (
        placed.groupBy(*who)
        .agg(F.max(F.struct("o_id", "o_entry_d", "o_carrier_id")).alias("__last"))
        .select(
            *who,
            "__last.o_id",
            "__last.o_entry_d",
            F.coalesce("__last.o_carrier_id", F.lit(NO_CARRIER)).alias("o_carrier_id"),
        )
    )
    return req.join(newest, who, "left")


def order_lines(req: DataFrame, order_line: DataFrame) -> DataFrame:
    """Add the order's lines in line order, filled up to 15 slots, and `too_many` beyond 15.

    One row more than fits is enough to know there are too many, so the list stays short.
    """
    asked = req.select(*ORDER).filter(F.col("o_id").isNotNull()).distinct()
    number = F.row_number().over(Window.partitionBy(*ORDER).orderBy("ol_number"))
    listed = (
        order_line.select(
            F.col("ol_w_id").alias("w_id"),
            F.col("ol_d_id").alias("d_id"),
            F.col("ol_o_id").alias("o_id"),
            "ol_number",
            *_LINE,
        )
        .join(asked, ORDER, "left_semi")
        .withColumn("__n", number)
        .filter(F.col("__n") <= SLOTS + 1)
        .groupBy(*ORDER)
        .agg(
            F.array_sort(F.collect_list(F.struct("__n", *_LINE))).alias("__lines")
        )
    )
    # An unused slot holds zeros and no date.
    kinds = {c: order_line.schema[c].dataType for c in _LINE}
    empty = F.struct(
        *[
            F.lit(None if c == "ol_delivery_d" else 0).cast(k).alias(c)
            for c, k in kinds.items()
        ]
    )
    lines = F.transform(
        F.slice("__lines", 1, SLOTS), lambda x: F.struct(*[x[c].alias(c) for c in _LINE])
    )
    return (
        req.join(listed, ORDER, "left")
        .withColumn("too_many", F.coalesce(F.size("__lines"), F.lit(0)) > SLOTS)
        .withColumn(
            "lines",
            F.slice(
                F.concat(F.coalesce(lines, F.array()), F.array_repeat(empty, SLOTS)), 1, SLOTS
            ),
        )
        .drop("__lines")
    )


def order_status(
    tables: dict[str, DataFrame], req: DataFrame, *, cut: bool = True
) -> DataFrame:
    """The full answer per request; `code` and `message` are set where a row is missing.

    They are also set, and the lines are null, where an order has more lines than there are slots.

    With `cut`, the customers found and their orders are written once, since each is used both to
    narrow the next table and to join to it.
    """
    asked = order_status_customer(req, tables["customer"])
    if cut:
        asked = cut_lineage(asked)
    last = last_order(asked, tables["oorder"])
    if cut:
        last = cut_lineage(last)
    found = order_lines(last, tables["order_line"])
    by_last = message("customers_by_last", c_last=F.col("asked_last"))
    error = (
        F.when(F.col("asked_last").isNotNull() & F.col("c_id").isNull(), by_last)
        .when(F.col("c_found").isNull(), message("customer"))
        .when(F.col("o_id").isNull(), message("last_order"))
        .when(F.col("too_many"), message("too_many_lines"))
    )
    return (
        found.withColumn("message", error)
        .withColumn("code", F.when(F.col("message").isNotNull(), ROW_NOT_FOUND))
        .withColumn("lines", F.when(~F.col("too_many"), F.col("lines")))
        .drop("c_found", "asked_last", "c_w_id", "c_d_id")
    )
