from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.functions.scan import _cut_points, _in_ranges
from orderflow.operators import payment as p
from orderflow.operators.customers import NAME, resolve_by_last_name
from tests import small as S

AT = "2024-02-01 00:00:00"


@pytest.mark.parametrize("n,position", [(1, 1), (2, 1), (3, 2), (4, 2), (5, 3)])
def test_middle_namesake(spark, n, position):
    people = S.rows(spark, "customer", *[S.customer(100 - i, c_first=f"F{i}") for i in range(1, n + 1)])
    asked = S.requests(
        spark, "payment", {"req_seq": 1, "c_w_id": 1, "c_d_id": 1, "c_last": "BARBARBAR", "h_amount": "1.00"}
    )
    (found,) = resolve_by_last_name(asked, people).collect()
    assert found.c_id == 100 - position


def test_middle_of_many_equal_first_names(spark):
    # One name with 200,001 bearers, most of them with one first name, over several spans of ids.
    people = spark.range(200_001).select(
        F.lit(1).alias("c_w_id"),
        F.lit(1).alias("c_d_id"),
        (F.col("id") * 3).alias("c_id"),
        F.lit("ABLE").alias("c_last"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("A"), "id")).otherwise("MARY").alias("c_first"),
    )
    asked = people.select("c_w_id", "c_d_id", "c_last").limit(1)
    (found,) = resolve_by_last_name(asked, people).collect()
    names = sorted((f"A{i}" if i % 10 == 0 else "MARY", i * 3) for i in range(200_001))
    assert found.c_id == names[100_000][1]


def test_namesakes_of_one_beginning_are_spread(spark):
    # A million bearers of one name whose first names share ten letters.
    people = spark.range(1_000_000).select(
        F.lit(1).alias("c_w_id"),
        F.lit(1).alias("c_d_id"),
        F.col("id").alias("c_id"),
        F.lit("ABLE").alias("c_last"),
        F.concat(F.lit("MARIANNEXX"), F.lpad(F.pmod(F.col("id") * 7919, 1_000_003).cast("string"), 7, "0")).alias("c_first"),
    )
    asked = people.select("c_w_id", "c_d_id", "c_last").limit(1)
    (found,) = resolve_by_last_name(asked, people).collect()
    assert found.c_id == sorted(range(1_000_000), key=lambda i: i * 7919 % 1_000_003)[499_999]
    order = ["c_first", "c_id"]
    cuts = _cut_points(people, NAME, order, None)
    sizes = _in_ranges(people, NAME, cuts, {"at": F.struct(*order)}).groupBy("at").count().collect()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(sizes) >= parts and max(r["count"] for r in sizes) < 2 * 1_000_000 / parts


def serial(people, pays):
    """One payment after another, on dicts."""
    seen = {}
    for r in sorted(pays, key=lambda r: r["req_seq"]):
        c = people[r["c_id"]]
        amount = Decimal(r["h_amount"])
        c["c_balance"] -= amount
        c["c_ytd_payment"] += amount
        c["c_payment_cnt"] += 1
        if c["c_credit"] == "BC":
            text = (
                f"C_ID={r['c_id']} C_D_ID={r['c_d_id']} C_W_ID={r['c_w_id']} D_ID={r['d_id']} "
                f"W_ID={r['w_id']} H_AMOUNT={amount:.2f}   "
            )
            c["c_data"] = (text + c["c_data"])[:500]
        seen[r["req_seq"]] = (c["c_balance"], c["c_data"] if c["c_credit"] == "BC" else "")
    return seen


@pytest.mark.parametrize("size", [4, None])
def test_payments_in_turn(spark, size):
    raw = [
        S.customer(1, c_credit="BC", c_data="z" * 480),
        S.customer(2, c_credit="BC", c_data=""),
        S.customer(3),
        S.customer(4, c_last="ABLEABLEABLE"),
    ]
    people = {
        c["c_id"]: {
            **c,
            "c_balance": Decimal(c["c_balance"]),
            "c_ytd_payment": Decimal(c["c_ytd_payment"]),
        }
        for c in raw
    }
    tables = {
        "district": S.rows(spark, "district", S.district(1), S.district(2)),
        "warehouse": S.rows(spark, "warehouse", S.warehouse(1)),
        "customer": S.rows(spark, "customer", *raw),
        "history": S.rows(
            spark, "history", {"hist_id": 7, "h_date": "2024-01-01 00:00:00", "h_amount": "1.00"}
        ),
    }
    base = {"w_id": 1, "d_id": 2, "c_w_id": 1, "c_d_id": 1}
    good = [
        {**base, "req_seq": 3 * n, "c_id": 1 + (n % 5 == 1) + 2 * (n % 7 == 3 and n % 5 != 1), "h_amount": f"{n + 1}.25"}
        for n in range(40)
    ]
    bad = [
        # Paid in a district that is not there, by the busy customer.
        {**base, "req_seq": 3 * n + 1, "c_id": 1, "d_id": 9, "h_amount": "5.00"}
        for n in range(40)
    ] + [
        {**base, "req_seq": 500, "c_last": "NOBODY", "h_amount": "5.00"},
        {**base, "req_seq": 501, "c_id": 99, "h_amount": "5.00"},
    ]
    named = {**base, "req_seq": 502, "c_last": "ABLEABLEABLE", "h_amount": "8.00"}
    req = S.requests(spark, "payment", *good, *bad, named)
    done = p.payment(tables, req, AT, rows=size)
    seen = serial(people, [*good, {**named, "c_id": 4}])
    got = {r.req_seq: r for r in done.result.collect()}
    assert {s: (r.c_balance, r.c_data) for s, r in got.items() if r.code is None} == seen
    after = {r.c_id: r for r in done.tables["customer"].collect()}
    for c_id, c in people.items():
        r = after[c_id]
        assert (r.c_balance, r.c_ytd_payment, r.c_payment_cnt, r.c_data) == (
            c["c_balance"],
            c["c_ytd_payment"],
            c["c_payment_cnt"],
            c["c_data"],
        )
    total = sum(Decimal(r["h_amount"]) for r in [*good, named])
    assert {r.d_id: r.d_ytd for r in done.tables["district"].collect()} == {1: 0, 2: total}
    assert done.tables["warehouse"].first().w_ytd == total
    history = done.tables["history"].orderBy("hist_id").collect()
    assert [r.hist_id for r in history] == list(range(7, 7 + 42))
    assert history[1].h_data == "W1    D2"
    errors = {r.req_seq: r.message for r in done.errors.collect()}
    assert len(errors) == 42
    assert errors[1] == "District for W_ID = 1 and D_ID = 9 not found."
    assert errors[500] == "Customer(s) for C_W_ID = 1 and C_D_ID = 1 and C_LAST = NOBODY not found."
    assert errors[501] == "Customer for C_W_ID = 1 and C_D_ID = 1 and C_ID = 99 not found."
