"""Payments: a table of requests applied as if one after another by `req_seq`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import numbered, running, trailing
from ..session import cut_lineage
from ..sources.schemas import conform_like
from .customers import PLACE, lookup_customer, resolve_customer
from .errors import ROW_NOT_FOUND, message
from .new_order import Applied

CUSTOMER = [*PLACE, "c_id"]

# The payment record kept for bad-credit customers and the length kept of it.
RECORD = "C_ID=%d C_D_ID=%d C_W_ID=%d D_ID=%d W_ID=%d H_AMOUNT=%s   "
KEPT = 500
GOOD_CREDIT = "GC"

#: The shortest record (one digit each, amount 0.00) is 55 characters, so that no more than this
#: many records can matter for the characters kept.
RECORDS = -(-KEPT // len("C_ID=1 C_D_ID=1 C_W_ID=1 D_ID=1 W_ID=1 H_AMOUNT=0.00   "))

_CUSTOMER_OUT = [
    "c_first",
    "c_middle",
    "c_last",
    "c_street_1",
    "c_street_2",
    "c_city",
    "c_state",
    "c_zip",
    "c_phone",
    "c_since",
    "c_credit",
    "c_credit_lim",
    "c_discount",
    "c_balance",
    "c_data",
]


def lookup_addresses(req: DataFrame, district: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Add name and address of the home district and warehouse (null where there is none)."""
    parts = ["name", "street_1", "street_2", "city", "state", "zip"]
    d = district.select(F.col("d_w_id").alias("w_id"), "d_id", *[f"d_{p}" for p in parts])
    w = warehouse.select("w_id", *[f"w_{p}" for p in parts])
    return req.join(d, ["w_id", "d_id"], "left").join(w, "w_id", "left")


def check_payments(tables: dict[str, DataFrame], req: DataFrame) -> DataFrame:
    """Requests with addresses, customer row and error; the first thing missing decides."""
    named = req.select("*", F.col("c_last").alias("asked_last"))
    resolved = resolve_customer(named, tables["customer"]).drop("c_last")
    full = lookup_customer(
        lookup_addresses(resolved, tables["district"], tables["warehouse"]),
        tables["customer"],
        _CUSTOMER_OUT,
    )
    by_last = message("customers_by_last", c_last=F.col("asked_last"))
    error = (
        F.when(F.col("d_name").isNull(), message("district"))
        .when(F.col("w_name").isNull(), message("warehouse"))
        .when(F.col("asked_last").isNotNull() & F.col("c_id").isNull(), by_last)
        .when(F.col("c_found").isNull(), message("customer"))
    )
    return (
        full.withColumn("message", error)
        .withColumn("code", F.when(F.col("message").isNotNull(), ROW_NOT_FOUND))
        .drop("c_found", "asked_last")
    )


def _add(table: DataFrame, keys: list[str], col: str, paid: DataFrame) -> DataFrame:
    kind = table.schema[col].dataType
    return (
        table.join(paid, keys, "left")
        .withColumn(col, (F.col(col) + F.coalesce("__paid", F.lit(0).cast(kind))).cast(kind))
        .select(*table.columns)
    )


def apply_district_ytd(district: DataFrame, paid: DataFrame) -> DataFrame:
    """District receipts go up by the payments made at home in it."""
    by = paid.groupBy(F.col("w_id").alias("d_w_id"), "d_id").agg(F.sum("h_amount").alias("__paid"))
    return _add(district, ["d_w_id", "d_id"], "d_ytd", by)


def apply_warehouse_ytd(warehouse: DataFrame, paid: DataFrame) -> DataFrame:
    by = paid.groupBy("w_id").agg(F.sum("h_amount").alias("__paid"))
    return _add(warehouse, ["w_id"], "w_ytd", by)


def payment_record() -> Column:
    """The text that is put in front of a bad-credit customer's data."""
    amount = F.col("h_amount").cast("decimal(6,2)").cast("string")
    return F.format_string(
        RECORD,
        *[F.col(c) for c in ("c_id", "c_d_id", "c_w_id", "d_id", "w_id")],
        amount,
    )


def apply_payments(customer: DataFrame, paid: DataFrame) -> DataFrame:
    """Balance, payments to date and payment count of the paying customers."""
    by = paid.groupBy(*CUSTOMER).agg(
        F.sum("h_amount").alias("__paid"), F.count(F.lit(1)).alias("__times")
    )
    money = F.coalesce("__paid", F.lit(0).cast("decimal(12,2)"))
    kind = {c: customer.schema[c].dataType for c in customer.columns}
    return (
        customer.join(by, CUSTOMER, "left")
        .withColumn("c_balance", (F.col("c_balance") - money).cast(kind["c_balance"]))
        .withColumn("c_ytd_payment", (F.col("c_ytd_payment") + money).cast(kind["c_ytd_payment"]))
        .withColumn(
            "c_payment_cnt",
            (F.col("c_payment_cnt") + F.coalesce("__times", F.lit(0))).cast(kind["c_payment_cnt"]),
        )
        .select(*customer.columns)
    )


def apply_bad_credit_data(customer: DataFrame, paid: DataFrame) -> DataFrame:
    """Put each payment of a bad-credit customer in front of its data, cut to the kept length.

    Putting in front and cutting can be done once at the end, and only the newest records fit, so
    that a customer with any number of payments needs no more than `RECORDS` of them.
    """
    newest = F.row_number().over(Window.partitionBy(*CUSTOMER).orderBy(F.desc("req_seq")))
    records = (
        paid.filter(F.col("c_credit") != GOOD_CREDIT)
        .select(*CUSTOMER, "req_seq", payment_record().alias("record"))
        .withColumn("__new", newest)
        .filter(F.col("__new") <= RECORDS)
        .groupBy(*CUSTOMER)
        .agg(F.array_sort(F.collect_list(F.struct("__new", "record"))).alias("__records"))
    )
    front = F.array_join(F.transform("__records", lambda r: r["record"]), "")
    return (
        customer.join(records, CUSTOMER, "left")
        .withColumn(
            "c_data",
            F.when(
                F.col("__records").isNotNull(),
                F.substring(F.concat(front, F.coalesce("c_data", F.lit(""))), 1, KEPT),
            ).otherwise(F.col("c_data")),
        )
        .select(*customer.columns)
    )


def history_rows(history: DataFrame, paid: DataFrame, as_of: str) -> DataFrame:
    """A history row per payment, numbered on from the last one by `req_seq`."""
    last = history.agg(F.coalesce(F.max("hist_id"), F.lit(0)).alias("m")).scalar()
    rows = numbered(
        paid.select("req_seq", *CUSTOMER, "d_id", "w_id", "h_amount", "w_name", "d_name"), ["req_seq"], "__nth"
    )
    return conform_like(
        rows.select(
            (last + F.col("__nth")).alias("hist_id"),
            F.col("c_id").alias("h_c_id"),
            F.col("c_d_id").alias("h_c_d_id"),
            F.col("c_w_id").alias("h_c_w_id"),
            F.col("d_id").alias("h_d_id"),
            F.col("w_id").alias("h_w_id"),
            F.lit(as_of).cast("timestamp").alias("h_date"),
            "h_amount",
            F.concat("w_name", F.lit("    "), "d_name").alias("h_data"),
        ),
        history,
    )


def append_history(history: DataFrame, paid: DataFrame, as_of: str) -> DataFrame:
    return history.unionByName(history_rows(history, paid, as_of))


def payment_results(checked: DataFrame, as_of: str, rows: int | None = None) -> DataFrame:
    """Per request: addresses and the customer as it stood right after that payment.

    Failed requests stay in, but add nothing to what the others see: they keep the number of the
    payment before them and carry neither an amount nor a record.
    """
    done = F.col("code").isNull()
    bad = done & (F.col("c_credit") != GOOD_CREDIT)
    kind = checked.schema["c_balance"].dataType
    owed = running(
        checked.withColumn("__who", F.coalesce("c_id", F.lit(-1))),
        [*PLACE, "__who"],
        "req_seq",
        sums={
            "__nth": done.cast("bigint"),
            "__paid": F.when(done, F.col("h_amount")).otherwise(F.lit(0).cast("decimal(6,2)")),
        },
        rows=rows,
    ).withColumn("c_balance", (F.col("c_balance") - F.col("__paid")).cast(kind))
    seen = trailing(
        owed.withColumn("__record", F.when(bad, payment_record())),
        [*PLACE, "__who"],
        "__nth",
        RECORDS,
        {"__records": F.collect_list(F.when(F.col("__record").isNotNull(), F.struct("__nth", "__record")))},
        rows=rows,
    )
    newest_first = F.array_join(
        F.transform(F.sort_array("__records", asc=False), lambda r: r["__record"]), ""
    )
    data = F.substring(F.concat(newest_first, F.coalesce("c_data", F.lit(""))), 1, KEPT)
    out = [c for c in checked.columns if c != "c_data"]
    return seen.select(
        *out,
        F.when(bad, data).when(done, F.lit("")).alias("c_data"),
        F.when(done, F.lit(as_of).cast("timestamp")).alias("h_date"),
    )


def payment(
    tables: dict[str, DataFrame],
    req: DataFrame,
    as_of: str,
    *,
    rows: int | None = None,
    cut: bool = True,
) -> Applied:
    """Apply all payments. With `cut`, the checked requests are written once for all outputs."""
    checked = check_payments(tables, req)
    if cut:
        checked = cut_lineage(checked)
    paid = checked.filter(F.col("code").isNull())
    after = {
        **tables,
        "district": apply_district_ytd(tables["district"], paid),
        "warehouse": apply_warehouse_ytd(tables["warehouse"], paid),
        "customer": apply_bad_credit_data(apply_payments(tables["customer"], paid), paid),
        "history": append_history(tables["history"], paid, as_of),
    }
    errors = checked.filter(F.col("code").isNotNull()).select("req_seq", "code", "message")
    return Applied(after, payment_results(checked, as_of, rows), errors)
