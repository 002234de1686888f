"""Requests that name a row that does not exist, error classes and the error log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The code of a missing row, the two classes and the log's tag pattern.
ROW_NOT_FOUND = 9999
EXPECTED = "EXPECTED"
UNEXPECTED = "UNEXPECTED"
LOG_TAG = r"\[(EXPECTED|UNEXPECTED)\]\[([^\]]+)\]\[([^\]]+)\]"
LOG_CODE = r"ErrorCode : (\d+)"

# Messages, with the columns that fill them.
MESSAGES: dict[str, tuple[str, tuple[str, ...]]] = {
    "district": ("District for W_ID = %d and D_ID = %d not found.", ("w_id", "d_id")),
    "warehouse": ("Warehouse for W_ID = %d not found.", ("w_id",)),
    "warehouse_or_customer": (
        "Warehouse or Customer for W_ID = %d and D_ID = %d and C_ID= %d not found.",
        ("w_id", "d_id", "c_id"),
    ),
    "customers_by_last": (
        "Customer(s) for C_W_ID = %d and C_D_ID = %d and C_LAST = %s not found.",
        ("c_w_id", "c_d_id", "c_last"),
    ),
    "customer": (
        "Customer for C_W_ID = %d and C_D_ID = %d and C_ID = %d not found.",
        ("c_w_id", "c_d_id", "c_id"),
    ),
    "item": ("Item for I_ID = %d not found.", ("ol_i_id",)),
    "stock": ("Stock for S_W_ID = %d and S_I_ID = %d not found.", ("ol_supply_w_id", "ol_i_id")),
    "last_order": (
        "Last Order for W_ID = %d and D_ID = %d and C_ID = %d not found.",
        ("w_id", "d_id", "c_id"),
    ),
    "too_many_lines": (
        "More lines than slots in the order W_ID = %d, D_ID = %d, O_ID = %d.",
        ("w_id", "d_id", "o_id"),
    ),
    "quantity": ("Quantity %d of I_ID = %d is not a number above 0.", ("ol_quantity", "ol_i_id")),
    "order": (
        "Order for O_W_ID = %d and O_D_ID = %d and O_ID = %d not found.",
        ("w_id", "d_id", "o_id"),
    ),
}


def message(kind: str, **cols: Column) -> Column:
    """The message of a missing row, filled from columns of the same name or those given."""
    text, names = MESSAGES[kind]
    return F.format_string(text, *[cols.get(n, F.col(n)) for n in names])


def missing_rows(req: DataFrame, dim: DataFrame, on: dict[str, str], kind: str) -> DataFrame:
    """An error row for each request without a match in `dim`; `on` maps request to table columns."""
    keys = dim.select(*[F.col(d).alias(r) for r, d in on.items()])
    return req.join(keys, list(on), "left_anti").select(
        "req_seq", F.lit(ROW_NOT_FOUND).alias("code"), message(kind).alias("message")
    )


def classify_errors(errors: DataFrame, expected: Sequence[int | str]) -> DataFrame:
    """Add `error_class`: EXPECTED for the listed codes. An empty list makes all UNEXPECTED."""
    if not expected:
        return errors.withColumn("error_class", F.lit(UNEXPECTED))
    listed = F.col("code").cast("string").isin([str(c) for c in expected])
    return errors.withColumn("error_class", F.when(listed, EXPECTED).otherwise(UNEXPECTED))


def log_lines(errors: DataFrame, ttype: str, stage: str = "EXECUTION") -> DataFrame:
    """Classified errors as log text."""
    return errors.select(
        F.format_string(
            "[%s][%s][%s] ErrorCode : %d, ErrorMessage : %s",
            F.col("error_class"),
            F.lit(ttype),
            F.lit(stage),
            F.col("code"),
            F.col("message"),
        ).alias("value")
    )


def summarize_log(lines: DataFrame) -> DataFrame:
    """Tagged lines of a log counted by class, transaction and stage."""
    tagged = lines.filter(F.col("value").rlike(LOG_TAG))
    return tagged.groupBy(
        F.regexp_extract("value", LOG_TAG, 1).alias("error_class"),
        F.regexp_extract("value", LOG_TAG, 2).alias("ttype"),
        F.regexp_extract("value", LOG_TAG, 3).alias("stage"),
    ).agg(F.count(F.lit(1)).alias("n"))


def verify_log(spark: SparkSession, path: str) -> bool:
    """False when the log holds an UNEXPECTED line."""
    lines = spark.read.text(path)
    return not lines.filter(F.col("value").contains(UNEXPECTED)).take(1)
