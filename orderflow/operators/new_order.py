"""New orders: a table of requests applied as if one after another by `req_seq`."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import running
from ..functions.values import MARK
from ..session import cut_lineage
from ..sources.schemas import conform_like
from .errors import ROW_NOT_FOUND, message

# Status texts, the highest item id a catalogue can hold and the stock rule's numbers.
PLACED = "Order placed"
REJECTED = "Item number is not valid"
MAX_ITEM = 100_000
RESERVE = 10
REFILL = 91

#: Steps of one stock row that are folded in one go; a list is copied once per step.
FAN = 128


# --- lookups -----------------------------------------------------------------------------------


def lookup_district(req: DataFrame, district: DataFrame) -> DataFrame:
    """Add the district's tax and next order id (null where there is no such district)."""
    cols = district.select(
        F.col("d_w_id").alias("w_id"), "d_id", "d_tax", "d_next_o_id"
    )
    return req.join(cols, ["w_id", "d_id"], "left")


def lookup_customer_tax(req: DataFrame, customer: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Add the customer's discount, name and credit and the warehouse's tax."""
    buyers = customer.select(
        F.col("c_w_id").alias("w_id"),
        F.col("c_d_id").alias("d_id"),
        "c_id",
        "c_discount",
        "c_last",
        "c_credit",
    )
    return req.join(buyers, ["w_id", "d_id", "c_id"], "left").join(
        warehouse.select("w_id", "w_tax"), "w_id", "left"
    )


# --- lines -------------------------------------------------------------------------------------


def sequence_lines(req: DataFrame) -> DataFrame:
    """A row per line, numbered by supplying warehouse, item and slot; sorted inside the request."""
    ordered = F.array_sort(
        F.transform(
            "lines",
            lambda x: F.struct(
                x["ol_supply_w_id"].alias("ol_supply_w_id"),
                x["ol_i_id"].alias("ol_i_id"),
                x["slot"].alias("slot"),
                x["ol_quantity"].alias("ol_quantity"),
            ),
        )
    )
    rest = [c for c in req.columns if c != "lines"]
    return req.select(*rest, F.posexplode_outer(ordered).alias("__pos", "__line")).select(
        *rest, (F.col("__pos") + 1).alias("ol_number"), "__line.*"
    )


def all_local(req: DataFrame) -> DataFrame:
    """Add the line count and 1 where every line is supplied by the request's own warehouse."""
    own = F.forall("lines", lambda x: x["ol_supply_w_id"] == F.col("w_id"))
    return req.withColumn("o_ol_cnt", F.size("lines")).withColumn("o_all_local", own.cast("int"))


def lookup_item(lines: DataFrame, item: DataFrame) -> DataFrame:
    """Add the item's price and texts. Merged, as the stock rows are (`lookup_stock`)."""
    cols = item.select(F.col("i_id").alias("ol_i_id"), "i_price", "i_name", "i_data")
    return lines.join(cols.hint("merge"), "ol_i_id", "left")


def lookup_stock(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """Add the stock row's text and the district text picked for the order's district.

    Merged: a file's size says little about how long its texts are in memory, and a stock table that
    looks small enough to be broadcast may not fit the driver.
    """
    dist = [f"s_dist_{n:02d}" for n in range(1, 11)]
    cols = stock.select(*STOCK, "s_data", *dist, F.lit(True).alias("s_found"))
    supplied = zip(("ol_supply_w_id", "ol_i_id"), STOCK)
    same = [F.col(line).try_cast(stock.schema[row].dataType) == F.col(row) for line, row in supplied]
    joined = lines.join(cols.hint("merge"), same, "left").drop(*STOCK)
    return joined.withColumn("ol_dist_info", pick_dist_info(F.col("d_id"))).drop(*dist)


def stock_keys_like(df: DataFrame, stock: DataFrame) -> DataFrame:
    """`df` with its stock key in the types of `stock`, so that a join leaves a bucketed table in place.

    A value that does not fit the type belongs to no row and becomes null.
    """
    return df.withColumns({k: F.col(k).try_cast(stock.schema[k].dataType) for k in STOCK})


def pick_dist_info(district: Column) -> Column:
    """The one of the ten district texts that belongs to the district."""
    # A case and no array, which would copy all ten texts for each line.
    picked = F.when(district == 1, F.col("s_dist_01"))
    for n in range(2, 11):
        picked = picked.when(district == n, F.col(f"s_dist_{n:02d}"))
    return picked


def price_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn(
        "ol_amount", (F.col("i_price") * F.col("ol_quantity")).cast("decimal(12,2)")
    )


def brand_generic(lines: DataFrame) -> DataFrame:
    """'B' where both the item's and the stock row's text hold the mark, else 'G'."""
    both = F.col("i_data").contains(MARK) & F.col("s_data").contains(MARK)
    return lines.withColumn("brand_generic", F.when(both, "B").otherwise("G"))


def order_total(amount: Column, discount: Column, w_tax: Column, d_tax: Column) -> Column:
    """Sum of line amounts less the discount plus both taxes, rounded once at the end."""
    one = F.lit(1).cast("decimal(5,4)")
    net = amount.cast("decimal(16,2)") * (one - discount)
    return F.round(net * (one + w_tax + d_tax), 2).cast("decimal(18,2)")


# --- checking whole requests --------------------------------------------------------------------


def check_requests(
    tables: dict[str, DataFrame], req: DataFrame, max_item: int = MAX_ITEM
) -> DataFrame:
    """One row per request (`req_seq`): its looked-up lines as an array, status, total and error.

    The first thing found missing decides, in the order district, customer and warehouse, then
    line by line item, stock and a quantity above 0. An item that cannot exist rejects the request; any other missing
    row is an error. The total of a rejected request covers the lines before the bad one.
    """
    head = lookup_customer_tax(
        lookup_district(all_local(req), tables["district"]), tables["customer"], tables["warehouse"]
    )
    # Lines travel with their request's number only; the head joins again when they are gathered.
    asked = head.select("req_seq", "d_id", "lines")
    lines = brand_generic(
        price_lines(
            lookup_stock(lookup_item(sequence_lines(asked), tables["item"]), tables["stock"])
        )
    )
    line_cols = [
        "ol_number",
        "ol_supply_w_id",
        "ol_i_id",
        "slot",
        "ol_quantity",
        "i_name",
        "i_price",
        "ol_amount",
        "brand_generic",
        "ol_dist_info",
        "s_found",
    ]
    wrong = F.col("i_price").isNull() | F.col("s_found").isNull() | F.coalesce(F.col("ol_quantity") < 1, F.lit(True))
    wrong &= F.col("ol_number").isNotNull()
    # The first bad line is found apart, so that who asks for no lines carries none of their texts.
    gathered = lines.groupBy("req_seq").agg(
        F.array_sort(
            F.collect_list(F.when(F.col("ol_number").isNotNull(), F.struct(*line_cols)))
        ).alias("lines"),
        F.min(F.when(wrong, F.struct(*line_cols[:7], "s_found"))).alias("bad"),
    )
    whole = head.drop("lines").join(gathered, "req_seq", "left")
    no_item = F.col("bad.ol_number").isNotNull() & F.col("bad.i_price").isNull()
    no_stock = F.col("bad.ol_number").isNotNull() & F.col("bad.i_price").isNotNull()
    no_stock &= F.col("bad.s_found").isNull()
    no_quantity = F.col("bad.ol_number").isNotNull() & ~no_item & ~no_stock
    impossible = (F.col("bad.ol_i_id") < 1) | (F.col("bad.ol_i_id") > max_item)
    line = {"ol_quantity": F.col("bad.ol_quantity"), "ol_i_id": F.col("bad.ol_i_id"), "ol_supply_w_id": F.col("bad.ol_supply_w_id")}
    error = (
        F.when(F.col("d_next_o_id").isNull(), message("district"))
        .when(
            F.col("c_discount").isNull() | F.col("w_tax").isNull(), message("warehouse_or_customer")
        )
        .when(no_item & ~impossible, message("item", **line))
        .when(no_stock, message("stock", **line))
        .when(no_quantity, message("quantity", **line))
    )
    before = F.filter(
        "lines", lambda x: F.col("bad.ol_number").isNull() | (x["ol_number"] < F.col("bad.ol_number"))
    )
    amount = F.aggregate(
        before, F.lit(0).cast("decimal(16,2)"), lambda a, x: (a + x["ol_amount"]).cast("decimal(16,2)")
    )
    return (
        whole.withColumn("message", error)
        .withColumn("code", F.when(F.col("message").isNotNull(), ROW_NOT_FOUND))
        .withColumn(
            "status", F.when(F.col("message").isNull(), F.when(no_item, REJECTED).otherwise(PLACED))
        )
        .withColumn(
            "total_amount",
            F.when(
                F.col("status").isNotNull(),
                order_total(amount, F.col("c_discount"), F.col("w_tax"), F.col("d_tax")),
            ),
        )
        .drop("bad")
    )


def placed_requests(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("status") == PLACED)


def failed_requests(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("code").isNotNull()).select("req_seq", "code", "message")


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Requests that are placed, those rejected for their item, and errors."""
    rejected = checked.filter(F.col("status") == REJECTED)
    return placed_requests(checked), rejected, failed_requests(checked)


def allocate_order_ids(placed: DataFrame, rows: int | None = None) -> DataFrame:
    """Add o_id: the n-th placed request of a district gets its next order id + n - 1."""
    ranked = running(placed, ["w_id", "d_id"], "req_seq", rank="__nth", rows=rows)
    kind = placed.schema["d_next_o_id"].dataType
    return ranked.withColumn(
        "o_id", (F.col("d_next_o_id") + F.col("__nth") - 1).cast(kind)
    ).drop("__nth")


def advance_next_order_id(district: DataFrame, placed: DataFrame) -> DataFrame:
    taken = placed.groupBy(F.col("w_id").alias("d_w_id"), "d_id").agg(
        F.count(F.lit(1)).alias("__taken")
    )
    kind = district.schema["d_next_o_id"].dataType
    return (
        district.join(taken, ["d_w_id", "d_id"], "left")
        .withColumn(
            "d_next_o_id",
            (F.col("d_next_o_id") + F.coalesce("__taken", F.lit(0))).cast(kind),
        )
        .select(*district.columns)
    )


def placed_lines(placed: DataFrame) -> DataFrame:
    return placed.select("req_seq", "w_id", "d_id", F.explode("lines").alias("x")).select(
        "req_seq", "w_id", "d_id", "x.*"
    )


# --- stock -------------------------------------------------------------------------------------

STOCK = ["s_w_id", "s_i_id"]
_TRAIL = "array<struct<req_seq:bigint,seen:int,after:int>>"


def stock_rule(quantity: Column, ordered: Column) -> Column:
    """The quantity left: the order is taken off while the reserve remains, else stock is refilled
    by a fixed amount (the ordered quantity is then not taken off)."""
    return F.when(quantity >= ordered + RESERVE, quantity - ordered).otherwise(quantity + REFILL)


def stock_steps(placed: DataFrame) -> DataFrame:
    """(s_w_id, s_i_id, req_seq, qty): what each request does to a stock row's quantity.

    The stock updates of one request are written together at its end, so all its lines see the
    quantity from before the request and the last line for a stock row is the one that counts.
    Lines are sorted by stock row, so it is the one not followed by another of the same row.
    """

    def last_of_row(x: Column, i: Column) -> Column:
        after = F.get("lines", i + 1)
        same = (after["ol_supply_w_id"] == x["ol_supply_w_id"]) & (after["ol_i_id"] == x["ol_i_id"])
        return ~F.coalesce(same, F.lit(False))

    kept = placed.select("req_seq", F.explode(F.filter("lines", last_of_row)).alias("x"))
    return kept.select(
        F.col("x.ol_supply_w_id").alias("s_w_id"),
        F.col("x.ol_i_id").alias("s_i_id"),
        F.col("req_seq").cast("bigint").alias("req_seq"),
        F.col("x.ol_quantity").cast("int").alias("qty"),
    )


def _walk(steps: Column, start: Column) -> Column:
    """Each step of a short ordered list with the quantity before and after it."""
    zero = F.struct(start.cast("int").alias("q"), F.array().cast(_TRAIL).alias("out"))

    def take(a: Column, s: Column) -> Column:
        after = stock_rule(a["q"], s["qty"]).cast("int")
        row = F.struct(s["req_seq"].alias("req_seq"), a["q"].alias("seen"), after.alias("after"))
        return F.struct(after.alias("q"), F.concat(a["out"], F.array(row)).alias("out"))

    return F.aggregate(steps, zero, take, lambda a: a["out"])


def _starts(parts: Column, part: str, start: Column, low: Column) -> Column:
    """For an ordered list of parts, each with its outcome per starting quantity, where each starts."""
    kind = "array<struct<part:bigint,start:int>>"
    zero = F.struct(start.cast("int").alias("q"), F.array().cast(kind).alias("out"))

    def take(a: Column, s: Column) -> Column:
        row = F.struct(s[part].cast("bigint").alias("part"), a["q"].alias("start"))
        return F.struct(
            F.get(s["outcome"], a["q"] - low).alias("q"),
            F.concat(a["out"], F.array(row)).alias("out"),
        )

    return F.aggregate(parts, zero, take, lambda a: a["out"])


def scan_stock(steps: DataFrame, stock: DataFrame, fan: int = FAN, rows: int | None = None) -> DataFrame:
    """Every step with the quantity it saw and left: (s_w_id, s_i_id, req_seq, seen, after).

    `steps` is read several times, so it should be a table or a short plan on one.

    The rule is not a sum, but it is composed of two that are. From a large quantity a row's orders
    are taken off until their running sum has used it up; from one under the reserve, every order
    refills. Either way the quantity of those first steps follows from running totals alone. What is
    left of the row then never leaves the range from the reserve to a refill on top of the largest
    order, and only those steps are cut into lists of `fan`. A list is reduced to its outcome for
    every quantity of that short range, outcomes are chained in groups of `fan` to find where each
    list starts, and the lists are then walked, each on its own.
    """
    wanted = stock_keys_like(steps.select(*STOCK).distinct(), stock)
    # Written, so that the rows asked for tell their size: few are then broadcast, many are merged.
    held = cut_lineage(stock.select(*STOCK, F.col("s_quantity").alias("q0")).hint("merge").join(wanted, STOCK))
    ranked = running(steps, STOCK, "req_seq", rank="__r", sums={"__upto": F.col("qty")}, rows=rows)
    started = stock_keys_like(ranked, stock).join(held, STOCK)
    refills = F.expr(f"({RESERVE + REFILL - 1} - q0) div {REFILL}")
    rising = (F.col("q0") < RESERVE) & (F.col("__r") <= refills)
    falling = F.col("q0") >= F.col("__upto") + RESERVE
    started = cut_lineage(
        started.withColumn(
            "seen",
            F.when(rising, F.col("q0") + (F.col("__r") - 1) * REFILL)
            .when(falling, F.col("q0") - F.col("__upto") + F.col("qty"))
            .cast("int"),
        )
    )
    first = started.filter(F.col("seen").isNotNull()).select(
        *STOCK, "req_seq", "seen", stock_rule(F.col("seen"), F.col("qty")).cast("int").alias("after")
    )
    rest = F.col("seen").isNull()
    # A row's last step by running totals has the largest number among them.
    spans = started.groupBy(*STOCK).agg(
        F.count_if(~rest).alias("__first"),
        F.count_if(rest).alias("__n"),
        F.max(F.when(rest, F.col("qty"))).alias("__most"),
        F.coalesce(
            F.max_by(F.when(~rest, stock_rule(F.col("seen"), F.col("qty"))), F.when(~rest, F.col("__r"))),
            F.first("q0"),
        ).cast("int").alias("q1"),
    )
    spans = spans.filter(F.col("__n") > 0).withColumn("high", F.col("__most") + (RESERVE + REFILL - 1))
    place = F.col("__r") - F.col("__first") - 1
    lists = cut_lineage(
        started.filter(rest)
        .drop("seen", "q0")
        .join(spans, STOCK)
        .withColumn("__at", place)
        .withColumn("list", F.expr(f"__at div {fan}"))
        .withColumn("group", F.expr(f"__at div {fan * fan}"))
        # Else the gathering would take over the join's partitions, and with them a task per row.
        .repartition(*STOCK, "list")
        .groupBy(*STOCK, "__n", "q1", "high", "group", "list")
        .agg(F.array_sort(F.collect_list(F.struct("req_seq", "qty"))).alias("steps"))
    )
    return first.unionByName(_walk_lists(lists, fan))


def _walk_lists(lists: DataFrame, fan: int) -> DataFrame:
    """The steps of all lists, each list started from the outcome of those before it."""
    low = F.lit(RESERVE)
    outcomes = lists.filter(F.col("__n") > fan).select(
        *STOCK,
        "q1",
        "high",
        "group",
        "list",
        F.aggregate(
            "steps",
            F.sequence(low, F.col("high")),
            lambda acc, s: F.transform(acc, lambda q: stock_rule(q, s["qty"]).cast("int")),
        ).alias("outcome"),
    )
    groups = cut_lineage(
        outcomes.groupBy(*STOCK, "q1", "high", "group").agg(
            F.array_sort(F.collect_list(F.struct("list", "outcome"))).alias("parts")
        )
    )
    group_starts = (
        groups.select(
            *STOCK,
            "q1",
            F.struct(
                "group",
                F.aggregate(
                    "parts",
                    F.sequence(low, F.col("high")),
                    lambda acc, s: F.transform(acc, lambda q: F.get(s["outcome"], q - low)),
                ).alias("outcome"),
            ).alias("whole"),
        )
        .groupBy(*STOCK, "q1")
        .agg(F.array_sort(F.collect_list("whole")).alias("wholes"))
        .select(*STOCK, F.inline(_starts(F.col("wholes"), "group", F.col("q1"), low)))
        .withColumnRenamed("part", "group")
    )
    list_starts = (
        groups.join(group_starts, [*STOCK, "group"])
        .select(*STOCK, F.inline(_starts(F.col("parts"), "list", F.col("start"), low)))
        .withColumnRenamed("part", "list")
    )
    started = lists.join(list_starts, [*STOCK, "list"], "left")
    # A row with one list starts from its quantity; a later list without a start is a fault.
    lost = F.raise_error(F.lit("a list of stock steps has no start")).cast("int")
    start = F.when(F.col("__n") <= fan, F.col("q1")).otherwise(F.coalesce("start", lost))
    return started.select(*STOCK, F.inline(_walk(F.col("steps"), start)))


def apply_stock_quantity(
    stock: DataFrame, placed: DataFrame, fan: int = FAN, rows: int | None = None
) -> DataFrame:
    """Stock with each row's quantity after all requests."""
    return leave_stock(stock, scan_stock(stock_steps(placed), stock, fan, rows))


def leave_stock(stock: DataFrame, scanned: DataFrame) -> DataFrame:
    """Stock with the quantity that the last step of each row left."""
    last = scanned.groupBy(*STOCK).agg(F.max_by("after", "req_seq").alias("__left"))
    return (
        stock.join(stock_keys_like(last, stock), STOCK, "left")
        .withColumn("s_quantity", F.coalesce("__left", "s_quantity"))
        .select(*stock.columns)
    )


def apply_stock_counters(stock: DataFrame, placed: DataFrame) -> DataFrame:
    """Stock with the ordered quantity, order count and remote order count added."""
    added = (
        placed_lines(placed)
        .groupBy(F.col("ol_supply_w_id").alias("s_w_id"), F.col("ol_i_id").alias("s_i_id"))
        .agg(
            F.sum("ol_quantity").alias("__qty"),
            F.count(F.lit(1)).alias("__orders"),
            F.sum((F.col("ol_supply_w_id") != F.col("w_id")).cast("int")).alias("__remote"),
        )
    )

    def plus(col: str, by: str) -> Column:
        return (F.col(col) + F.coalesce(by, F.lit(0))).cast(stock.schema[col].dataType)

    return (
        stock.join(stock_keys_like(added, stock), STOCK, "left")
        .withColumn("s_ytd", plus("s_ytd", "__qty"))
        .withColumn("s_order_cnt", plus("s_order_cnt", "__orders"))
        .withColumn("s_remote_cnt", plus("s_remote_cnt", "__remote"))
        .select(*stock.columns)
    )


# --- the whole transaction ----------------------------------------------------------------------


@dataclass
class Applied:
    """Tables after a batch (unchanged ones included), its results and its errors."""

    tables: dict[str, DataFrame]
    result: DataFrame
    errors: DataFrame


def order_rows(placed: DataFrame, as_of: str) -> DataFrame:
    return placed.select(
        F.col("w_id").alias("o_w_id"),
        F.col("d_id").alias("o_d_id"),
        "o_id",
        F.col("c_id").alias("o_c_id"),
        F.lit(None).cast("int").alias("o_carrier_id"),
        "o_ol_cnt",
        "o_all_local",
        F.lit(as_of).cast("timestamp").alias("o_entry_d"),
    )


def new_order_rows(placed: DataFrame) -> DataFrame:
    return placed.select(
        F.col("w_id").alias("no_w_id"),
        F.col("d_id").alias("no_d_id"),
        F.col("o_id").alias("no_o_id"),
    )


def order_line_rows(placed: DataFrame) -> DataFrame:
    lines = placed.select("w_id", "d_id", "o_id", F.explode("lines").alias("x"))
    return lines.select(
        F.col("w_id").alias("ol_w_id"),
        F.col("d_id").alias("ol_d_id"),
        F.col("o_id").alias("ol_o_id"),
        "x.ol_number",
        "x.ol_i_id",
        F.lit(None).cast("timestamp").alias("ol_delivery_d"),
        "x.ol_amount",
        "x.ol_supply_w_id",
        "x.ol_quantity",
        "x.ol_dist_info",
    )


def append_orders(
    tables: dict[str, DataFrame], placed: DataFrame, as_of: str
) -> dict[str, DataFrame]:
    """Those of oorder, new_order and order_line given, with the placed orders added, not yet delivered."""
    added = {
        "oorder": lambda: order_rows(placed, as_of),
        "new_order": lambda: new_order_rows(placed),
        "order_line": lambda: order_line_rows(placed),
    }
    return {
        name: tables[name].unionByName(conform_like(rows(), tables[name]))
        for name, rows in added.items()
        if name in tables
    }


def order_results(checked: DataFrame, numbered: DataFrame, scanned: DataFrame) -> DataFrame:
    """Per request: status, order id, total and, for placed orders, each line with what it saw.

    Lines are taken from `checked`, so `numbered` may come without them.
    """
    seen = scanned.select(
        F.col("s_w_id").alias("ol_supply_w_id"),
        F.col("s_i_id").alias("ol_i_id"),
        "req_seq",
        F.col("seen").alias("s_quantity"),
    )
    cols = [
        "ol_number",
        "slot",
        "ol_supply_w_id",
        "ol_i_id",
        "i_name",
        "ol_quantity",
        "s_quantity",
        "brand_generic",
        "i_price",
        "ol_amount",
    ]
    lines = (
        placed_lines(placed_requests(checked))
        .join(seen, ["req_seq", "ol_supply_w_id", "ol_i_id"], "left")
        .groupBy("req_seq")
        .agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("lines"))
    )
    head = ["req_seq", "w_id", "d_id", "c_id", "c_last", "c_credit", "c_discount", "w_tax", "d_tax"]
    head += ["o_ol_cnt", "status", "total_amount", "code", "message"]
    done = numbered.select(*head, "o_id").join(lines, "req_seq", "left")
    other = checked.filter(
        F.col("status").isNull() | (F.col("status") != PLACED)
    ).select(
        *head,
        F.lit(None).cast(done.schema["o_id"].dataType).alias("o_id"),
        F.lit(None).cast(done.schema["lines"].dataType).alias("lines"),
    )
    return done.unionByName(other)


def new_order(
    tables: dict[str, DataFrame],
    req: DataFrame,
    as_of: str,
    *,
    max_item: int = MAX_ITEM,
    fan: int = FAN,
    rows: int | None = None,
    cut: bool = True,
) -> Applied:
    """Apply all requests. With `cut`, the checked requests are written once for all outputs."""
    checked = check_requests(tables, req, max_item)
    if cut:
        checked = cut_lineage(checked.withColumn("__row", F.monotonically_increasing_id()))
    placed = placed_requests(checked)
    if cut:
        # Ranked without their lines, which whoever reads them finds again by the written row's number.
        narrow = [c for c in placed.columns if c != "lines"]
        heads = cut_lineage(allocate_order_ids(placed.select(*narrow), rows))
        numbered = heads.join(placed.select("__row", "lines"), "__row").drop("__row")
    else:
        heads = numbered = allocate_order_ids(placed, rows)
    steps = stock_steps(placed)
    scanned = scan_stock(cut_lineage(steps) if cut else steps, tables["stock"], fan, rows)
    if cut:
        scanned = cut_lineage(scanned)
    stock = apply_stock_counters(leave_stock(tables["stock"], scanned), placed)
    after = {
        **tables,
        "district": advance_next_order_id(tables["district"], placed),
        "stock": stock,
        **append_orders(tables, numbered, as_of),
    }
    result = order_results(checked, heads, scanned)
    return Applied(after, result, failed_requests(checked))
