"""Finding customers: by id, or the middle one of those who share a last name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scan import pick
from ..session import cut_lineage

PLACE = ["c_w_id", "c_d_id"]
NAME = [*PLACE, "c_last"]


def resolve_by_last_name(req: DataFrame, customer: DataFrame, rows: int | None = None) -> DataFrame:
    """(c_w_id, c_d_id, c_last, c_id): of n namesakes by first name, the one at (n + 1) div 2.

    `req` holds the names asked for; equal first names are settled by c_id, and missing ones come
    first. Namesakes are not sorted as a group: a name with very many bearers is cut into ranges of
    about `rows` rows at sampled (first name, id), and only the range in the middle is sorted.
    """
    names = req.filter(F.col("c_last").isNotNull()).select(*NAME).distinct()
    # Written right after the join, where a skewed partition may still be split.
    named = cut_lineage(customer.select(*NAME, "c_first", "c_id").join(names, NAME, "left_semi"))
    middle = pick(named, NAME, ["c_first", "c_id"], F.expr("(size + 1) div 2"), rows=rows)
    return middle.select(*NAME, "c_id")


def resolve_customer(req: DataFrame, customer: DataFrame) -> DataFrame:
    """`req` (c_w_id, c_d_id, c_id, c_last) with c_id filled in where a last name was given.

    A name nobody has leaves c_id null.
    """
    found = resolve_by_last_name(req, customer).withColumnRenamed("c_id", "__found")
    return (
        req.join(found, NAME, "left")
        .withColumn("c_id", F.when(F.col("c_last").isNull(), F.col("c_id")).otherwise(F.col("__found")))
        .drop("__found")
    )


def lookup_customer(req: DataFrame, customer: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add columns of the customer row (c_w_id, c_d_id, c_id) and `c_found`."""
    picked = customer.select(*PLACE, "c_id", *cols, F.lit(True).alias("c_found"))
    return req.join(picked, [*PLACE, "c_id"], "left")
