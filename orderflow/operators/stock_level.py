"""Stock level: how many recently ordered items of a district are low in stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scan import spread_join
from ..session import cut_lineage

#: Orders looked back on.
RECENT = 20


def recent_items(
    req: DataFrame, district: DataFrame, order_line: DataFrame, recent: int = RECENT
) -> DataFrame:
    """Distinct items in the last orders of each district asked for: (w_id, d_id, ol_i_id).

    The districts' bounds are few rows, used twice, and written once. The lowest order id any of the
    districts looks back to is a scalar bound on the scan, so that old lines are dropped before the
    shuffle, and files of old lines are skipped where the table is laid out by order id.
    """
    asked = req.select("w_id", "d_id").distinct()
    bounds = district.select(
        F.col("d_w_id").alias("w_id"), "d_id", "d_next_o_id"
    ).join(asked, ["w_id", "d_id"], "left_semi")
    bounds = cut_lineage(bounds)
    oldest = bounds.agg(F.min(F.col("d_next_o_id") - recent).alias("m")).scalar()
    lines = order_line.select(
        F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"), "ol_o_id", "ol_i_id"
    ).filter(F.col("ol_o_id") >= oldest)
    return (
        spread_join(lines, bounds, ["w_id", "d_id"], "ol_o_id")
        .filter(
            (F.col("ol_o_id") >= F.col("d_next_o_id") - recent)
            & (F.col("ol_o_id") < F.col("d_next_o_id"))
        )
        .select("w_id", "d_id", "ol_i_id")
        .distinct()
    )


def stock_level(
    tables: dict[str, DataFrame], req: DataFrame, recent: int = RECENT
) -> DataFrame:
    """Per request the number of recent items below its threshold: (…, low_stock).

    Requests of one district share its items, so a district's items are reduced once to counts per
    quantity and each request adds up the counts below its threshold.
    """
    items = recent_items(req, tables["district"], tables["order_line"], recent)
    held = tables["stock"].select(
        F.col("s_w_id").alias("w_id"), F.col("s_i_id").alias("ol_i_id"), "s_quantity"
    )
    # In the types of the stock key, so that a table bucketed by it stays in place.
    items = items.withColumns(
        {c: F.col(c).try_cast(held.schema[c].dataType) for c in ("w_id", "ol_i_id")}
    )
    counts = (
        items.join(held.hint("merge"), ["w_id", "ol_i_id"])
        .groupBy("w_id", "d_id", "s_quantity")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("w_id", "d_id")
        .agg(F.collect_list(F.struct("s_quantity", "n")).alias("__counts"))
    )
    low = F.aggregate(
        "__counts",
        F.lit(0).cast("bigint"),
        lambda a, x: a + F.when(x["s_quantity"] < F.col("threshold"), x["n"]).otherwise(0),
    )
    return (
        req.join(counts, ["w_id", "d_id"], "left")
        .withColumn("low_stock", F.coalesce(low, F.lit(0)))
        .drop("__counts")
    )
