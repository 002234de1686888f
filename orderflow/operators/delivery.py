"""Delivery: each request takes the oldest pending order of every district of its warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scan import running
from ..session import cut_lineage
from .errors import ROW_NOT_FOUND, message
from .generate import DISTRICTS
from .new_order import Applied

# The slot value of a district without a pending order and the queued status.
NONE_DELIVERED = -1
QUEUED = "Delivery has been queued"

ORDER = ["w_id", "d_id", "o_id"]


def claim_oldest(req: DataFrame, new_order: DataFrame, rows: int | None = None) -> DataFrame:
    """(req_seq, w_id, d_id, o_id, o_carrier_id, nth): the k-th request of a warehouse takes the
    k-th oldest pending order in each of its districts."""
    asked = running(
        req.select("req_seq", "w_id", "o_carrier_id"), ["w_id"], "req_seq", rank="nth", rows=rows
    )
    pending = running(
        new_order.select(
            F.col("no_w_id").alias("w_id"), F.col("no_d_id").alias("d_id"), F.col("no_o_id").alias("o_id")
        ),
        ["w_id", "d_id"],
        "o_id",
        rank="nth",
        rows=rows,
    )
    return asked.join(pending, ["w_id", "nth"]).select(
        "req_seq", "w_id", "d_id", "o_id", "o_carrier_id", "nth"
    )


def claim_customer(claims: DataFrame, oorder: DataFrame) -> DataFrame:
    """Add the customer of each claimed order (null where the order row is missing)."""
    who = oorder.select(
        F.col("o_w_id").alias("w_id"),
        F.col("o_d_id").alias("d_id"),
        "o_id",
        F.col("o_c_id").alias("c_id"),
        F.lit(True).alias("o_found"),
    )
    return claims.join(who, ORDER, "left")


def split_claims(claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Claims that go through, and for each stopped warehouse where and by which order.

    A claimed order whose row is missing undoes its whole request and stays the oldest, so every
    later request of the warehouse meets it again and fails as well.
    """
    stops = (
        claims.filter(F.col("o_found").isNull())
        .groupBy("w_id")
        .agg(F.min(F.struct("nth", "d_id", "o_id")).alias("s"))
        .select("w_id", F.col("s.nth").alias("stop"), F.col("s.d_id").alias("d_id"), F.col("s.o_id").alias("o_id"))
    )
    ok = claims.join(stops.select("w_id", "stop"), "w_id", "left").filter(
        F.col("stop").isNull() | (F.col("nth") < F.col("stop"))
    )
    return ok.drop("stop", "o_found"), stops


def claim_amount(claims: DataFrame, order_line: DataFrame) -> DataFrame:
    """Add the sum of the order's line amounts (0 where it has no lines)."""
    lines = order_line.select(
        F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"), F.col("ol_o_id").alias("o_id"), "ol_amount"
    )
    sums = (
        lines.join(claims.select(*ORDER), ORDER, "left_semi")
        .groupBy(*ORDER)
        .agg(F.sum("ol_amount").alias("__amount"))
    )
    return (
        claims.join(sums, ORDER, "left")
        .withColumn("amount", F.coalesce("__amount", F.lit(0).cast("decimal(16,2)")))
        .drop("__amount")
    )


def delete_claimed(new_order: DataFrame, claims: DataFrame) -> DataFrame:
    taken = claims.select(
        F.col("w_id").alias("no_w_id"), F.col("d_id").alias("no_d_id"), F.col("o_id").alias("no_o_id")
    )
    return new_order.join(taken, ["no_w_id", "no_d_id", "no_o_id"], "left_anti")


def apply_carrier(oorder: DataFrame, claims: DataFrame) -> DataFrame:
    by = claims.select(
        F.col("w_id").alias("o_w_id"),
        F.col("d_id").alias("o_d_id"),
        "o_id",
        F.col("o_carrier_id").alias("__carrier"),
    )
    return (
        oorder.join(by, ["o_w_id", "o_d_id", "o_id"], "left")
        .withColumn("o_carrier_id", F.coalesce("__carrier", "o_carrier_id"))
        .select(*oorder.columns)
    )


def apply_delivery_date(order_line: DataFrame, claims: DataFrame, as_of: str) -> DataFrame:
    by = claims.select(
        F.col("w_id").alias("ol_w_id"),
        F.col("d_id").alias("ol_d_id"),
        F.col("o_id").alias("ol_o_id"),
        F.lit(as_of).cast("timestamp").alias("__at"),
    )
    return (
        order_line.join(by, ["ol_w_id", "ol_d_id", "ol_o_id"], "left")
        .withColumn("ol_delivery_d", F.coalesce("__at", "ol_delivery_d"))
        .select(*order_line.columns)
    )


def apply_delivery_credit(customer: DataFrame, claims: DataFrame) -> DataFrame:
    """The order's amount is added to the customer's balance, and 1 to its deliveries."""
    by = claims.groupBy(
        F.col("w_id").alias("c_w_id"), F.col("d_id").alias("c_d_id"), "c_id"
    ).agg(F.sum("amount").alias("__amount"), F.count(F.lit(1)).alias("__times"))
    money = F.coalesce("__amount", F.lit(0).cast("decimal(16,2)"))
    kind = {c: customer.schema[c].dataType for c in customer.columns}
    return (
        customer.join(by, ["c_w_id", "c_d_id", "c_id"], "left")
        .withColumn("c_balance", (F.col("c_balance") + money).cast(kind["c_balance"]))
        .withColumn(
            "c_delivery_cnt",
            (F.col("c_delivery_cnt") + F.coalesce("__times", F.lit(0))).cast(kind["c_delivery_cnt"]),
        )
        .select(*customer.columns)
    )


def delivery_result(
    req: DataFrame, claims: DataFrame, districts: int = DISTRICTS
) -> DataFrame:
    """Per request the delivered order id of each district (-1 for none) and the number skipped.

    Slots go up to `districts`, or to the highest district delivered if there is one above; such a
    district's orders are reported too. Skipped are those of the first `districts` without an order.
    """
    taken = claims.groupBy("req_seq").agg(
        F.map_from_entries(F.collect_list(F.struct("d_id", "o_id"))).alias("__taken")
    )
    highest = F.coalesce(F.array_max(F.map_keys("__taken")).cast("int"), F.lit(0))
    slots = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(districts), highest)),
        lambda d: F.coalesce(F.col("__taken")[d], F.lit(NONE_DELIVERED)),
    )
    return (
        req.join(taken, "req_seq", "left")
        .withColumn("delivered_o_id", slots)
        .withColumn(
            "skipped",
            F.size(F.filter(F.slice("delivered_o_id", 1, districts), lambda o: o == NONE_DELIVERED)),
        )
        .drop("__taken")
    )


def delivery(
    tables: dict[str, DataFrame],
    req: DataFrame,
    as_of: str,
    *,
    districts: int = DISTRICTS,
    rows: int | None = None,
    cut: bool = True,
) -> Applied:
    """Apply all deliveries. With `cut`, the claims are written once for all outputs."""
    claims = claim_customer(claim_oldest(req, tables["new_order"], rows), tables["oorder"])
    if cut:
        claims = cut_lineage(claims)
    claims, stops = split_claims(claims)
    priced = claim_amount(claims, tables["order_line"])
    if cut:
        priced = cut_lineage(priced)
    numbered = running(
        req.select("req_seq", "w_id"), ["w_id"], "req_seq", rank="nth", rows=rows
    )
    errors = (
        numbered.join(stops, "w_id")
        .filter(F.col("nth") >= F.col("stop"))
        .select("req_seq", F.lit(ROW_NOT_FOUND).alias("code"), message("order").alias("message"))
    )
    after = {
        **tables,
        "new_order": delete_claimed(tables["new_order"], priced),
        "oorder": apply_carrier(tables["oorder"], priced),
        "order_line": apply_delivery_date(tables["order_line"], priced, as_of),
        "customer": apply_delivery_credit(tables["customer"], priced),
    }
    result = delivery_result(
        req.join(errors.select("req_seq"), "req_seq", "left_anti"), priced, districts
    )
    return Applied(after, result, errors)
