from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.operators import delivery, order_status, stock_level
from tests import small as S

AT = "2024-02-01 00:00:00"


def orders(spark):
    rows = [
        {"o_w_id": 1, "o_d_id": d, "o_id": o, "o_c_id": 1 + o % 2, "o_ol_cnt": 2, "o_all_local": 1,
         "o_entry_d": "2024-01-01 00:00:00", "o_carrier_id": 5 if o < 7 else None}
        for d in (1, 2)
        for o in range(1, 10)
    ]
    lines = [
        {"ol_w_id": 1, "ol_d_id": d, "ol_o_id": o, "ol_number": n, "ol_i_id": o, "ol_supply_w_id": 1,
         "ol_quantity": 5, "ol_amount": f"{o}.00", "ol_delivery_d": "2024-01-02 00:00:00" if o < 7 else None}
        for d in (1, 2)
        for o in range(1, 10)
        for n in range(1, 18 if o == 8 else 3)
    ]
    pending = [{"no_w_id": 1, "no_d_id": 1, "no_o_id": o} for o in (7, 8)] + [
        {"no_w_id": 1, "no_d_id": 2, "no_o_id": o} for o in (7, 8, 9)
    ]
    return {
        "oorder": S.rows(spark, "oorder", *rows),
        "order_line": S.rows(spark, "order_line", *lines),
        "new_order": S.rows(spark, "new_order", *pending),
        "customer": S.rows(
            spark, "customer", *[S.customer(c, c_d_id=d) for d in (1, 2) for c in (1, 2, 3)]
        ),
    }


def req(spark, n):
    return S.requests(spark, "delivery", *[{"req_seq": 10 * i, "w_id": 1, "o_carrier_id": i} for i in range(1, n + 1)])


@pytest.mark.parametrize("size", [2, None])
def test_delivery_runs_out(spark, size):
    t = orders(spark)
    done = delivery.delivery(t, req(spark, 4), AT, rows=size)
    got = {r.req_seq: r for r in done.result.collect()}
    assert [got[10 * i].delivered_o_id[:3] for i in (1, 2, 3, 4)] == [
        [7, 7, -1],
        [8, 8, -1],
        [-1, 9, -1],
        [-1, -1, -1],
    ]
    assert [got[10 * i].skipped for i in (1, 2, 3, 4)] == [8, 8, 9, 10]
    assert done.tables["new_order"].count() == 0
    carrier = {(r.o_d_id, r.o_id): r.o_carrier_id for r in done.tables["oorder"].collect()}
    assert (carrier[1, 7], carrier[1, 8], carrier[1, 9], carrier[2, 9], carrier[1, 1]) == (1, 2, None, 3, 5)
    dated = done.tables["order_line"].filter("ol_delivery_d is null").select("ol_d_id", "ol_o_id").distinct()
    assert [tuple(r) for r in dated.collect()] == [(1, 9)]
    paid = {(r.c_d_id, r.c_id): (r.c_balance, r.c_delivery_cnt) for r in done.tables["customer"].collect()}
    # Customer 2 has orders 7 and 9, customer 1 order 8 with its 17 lines.
    assert paid[1, 2] == (Decimal("4.00"), 1) and paid[2, 2] == (Decimal("22.00"), 2)
    assert paid[1, 1] == (Decimal("126.00"), 1) and paid[1, 3] == (Decimal("-10.00"), 0)
    assert done.errors.count() == 0


def test_missing_order_stops_its_warehouse(spark):
    t = orders(spark)
    t["oorder"] = t["oorder"].filter("not (o_d_id = 2 and o_id = 8)")
    done = delivery.delivery(t, req(spark, 3), AT)
    assert [r.req_seq for r in done.result.collect()] == [10]
    text = "Order for O_W_ID = 1 and O_D_ID = 2 and O_ID = 8 not found."
    assert {(r.req_seq, r.message) for r in done.errors.collect()} == {(20, text), (30, text)}
    left = {(r.no_d_id, r.no_o_id) for r in done.tables["new_order"].collect()}
    assert left == {(1, 8), (2, 8), (2, 9)}


def test_order_status(spark):
    asked = [
        {"req_seq": 1, "w_id": 1, "d_id": 1, "c_id": 2},
        {"req_seq": 2, "w_id": 1, "d_id": 1, "c_id": 1},
        {"req_seq": 3, "w_id": 1, "d_id": 1, "c_id": 3},
        {"req_seq": 4, "w_id": 1, "d_id": 2, "c_last": "BARBARBAR"},
        {"req_seq": 5, "w_id": 1, "d_id": 2, "c_last": "NOBODY"},
    ]
    found = order_status.order_status(orders(spark), S.requests(spark, "order_status", *asked))
    got = {r.req_seq: r for r in found.collect()}
    assert (got[1].o_id, got[1].o_carrier_id, got[1].too_many) == (9, -1, False)
    assert {k: len(r.lines or []) for k, r in got.items()} == {1: 15, 2: 0, 3: 15, 4: 15, 5: 15}
    assert [x.ol_quantity for x in got[1].lines] == [5, 5] + [0] * 13
    assert (got[2].o_id, got[2].too_many) == (8, True)
    assert got[3].message == "Last Order for W_ID = 1 and D_ID = 1 and C_ID = 3 not found."
    assert (got[4].c_id, got[4].o_id) == (2, 9)
    assert got[5].message.startswith("Customer(s) for") and got[5].code == 9999


def test_stock_level(spark):
    t = {
        "district": S.rows(spark, "district", S.district(1), S.district(2, d_next_o_id=1)),
        "order_line": orders(spark)["order_line"],
        "stock": S.rows(spark, "stock", *[S.stock(i, q=10 + i) for i in range(1, 10)]),
    }
    asked = [
        {"req_seq": n, "w_id": 1, "d_id": d, "threshold": th}
        for n, (d, th) in enumerate([(1, 11), (1, 12), (1, 15), (1, 99), (2, 99), (3, 99)])
    ]
    level = stock_level.stock_level(t, S.requests(spark, "stock_level", *asked), recent=4)
    # The next id is 10, so that orders 6 to 9 count: quantities 16 to 19.
    assert [r.low_stock for r in level.orderBy("req_seq").collect()] == [0, 0, 0, 4, 0, 0]
    level = stock_level.stock_level(t, S.requests(spark, "stock_level", *asked))
    assert [r.low_stock for r in level.orderBy("req_seq").collect()] == [0, 1, 4, 9, 0, 0]


def test_districts_above_ten_are_reported(spark):
    t = orders(spark)
    far = {"oorder": "o_d_id", "order_line": "ol_d_id", "new_order": "no_d_id", "customer": "c_d_id"}
    t = {n: df.withColumn(far[n], F.when(F.col(far[n]) == 2, 12).otherwise(F.col(far[n]))) for n, df in t.items()}
    got = {r.req_seq: r for r in delivery.delivery(t, req(spark, 2), AT).result.collect()}
    first = got[min(got)]
    assert len(first.delivered_o_id) == 12 and first.delivered_o_id[0] == 7 and first.delivered_o_id[11] == 7
    assert first.skipped == 9
