import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.operators import new_order as no
from tests import small as S

AT = "2024-02-01 00:00:00"


def serial_stock(start, orders):
    """One order after another: all lines of an order see the stock from before it."""
    held, seen = dict(start), {}
    for seq, lines in orders:
        before = dict(held)
        for i, q in lines:
            n = before[i]
            seen[seq, i] = n
            held[i] = n - q if n >= q + 10 else n + 91
    return held, seen


@pytest.mark.parametrize("fan,size", [(2, 5), (64, None), (1024, 7)])
@pytest.mark.parametrize("start", [50, 5, 1000, 1_000_000, -400])
def test_stock_scan(spark, fan, size, start):
    rnd = random.Random(fan * 1000 + start)
    stock = {1: start, 2: start + 1, 3: start + 2}
    # Item 1 is in nearly every order.
    orders = [
        (seq, [(i, rnd.randint(1, 40)) for i in stock if i == 1 or rnd.random() < 0.1])
        for seq in rnd.sample(range(500), 70)
    ]
    orders = sorted((s, ls) for s, ls in orders if ls)
    steps = spark.createDataFrame(
        [(1, i, s, q) for s, ls in orders for i, q in ls],
        "s_w_id int, s_i_id int, req_seq bigint, qty int",
    )
    table = S.rows(spark, "stock", *[S.stock(i, q=q) for i, q in stock.items()])
    held, seen = serial_stock(stock, orders)
    got = no.scan_stock(steps, table, fan, size).collect()
    assert {(r.req_seq, r.s_i_id): r.seen for r in got} == seen and len(got) == len(seen)
    last = {}
    for r in sorted(got, key=lambda r: r.req_seq):
        last[r.s_i_id] = r.after
    assert last == {i: q for i, q in held.items() if i in last}


def tables(spark):
    return {
        "district": S.rows(spark, "district", S.district(1), S.district(2, d_next_o_id=40)),
        "warehouse": S.rows(spark, "warehouse", S.warehouse(1), S.warehouse(2)),
        "customer": S.rows(spark, "customer", S.customer(1), S.customer(2), S.customer(1, c_d_id=2)),
        "item": S.rows(
            spark, "item", *[S.item(i, i_data="an ORIGINAL" if i == 2 else "x") for i in range(1, 6)]
        ),
        "stock": S.rows(
            spark,
            "stock",
            *[S.stock(i, w, q=20, s_data="ORIGINAL" if i == 2 else "y") for i in range(1, 5) for w in (1, 2)],
        ),
        "oorder": S.rows(spark, "oorder"),
        "new_order": S.rows(spark, "new_order"),
        "order_line": S.rows(spark, "order_line"),
    }


def test_whole_batch(spark):
    req = S.requests(
        spark,
        "new_order",
        S.order(1, (3, 1, 4), (2, 1, 2), (3, 1, 7)),  # the same item twice
        S.order(2, (1, 2, 5), (2, 1, 1)),  # a remote line
        S.order(3, (1, 1, 1), (1000001, 1, 1)),  # no such item can exist
        S.order(4, (3, 1, 3)),
        S.order(5, (4, 1, 3)),
        S.order(6, (5, 1, 3)),  # item without stock
        S.order(7, (77, 1, 3)),  # item missing from the catalogue
        S.order(8, (1, 1, 1), d=9),
        S.order(9, (1, 1, 1), c=99),
        S.order(10, (1, 1, 1), d=2),
    )
    done = no.new_order(tables(spark), req, AT, fan=2, rows=2)
    result = {r.req_seq: r for r in done.result.collect()}
    assert [result[i].status for i in (1, 2, 3, 4, 5, 10)] == [
        no.PLACED,
        no.PLACED,
        no.REJECTED,
        no.PLACED,
        no.PLACED,
        no.PLACED,
    ]
    # Ids run on without the rejected request.
    assert [result[i].o_id for i in (1, 2, 3, 4, 5, 10)] == [10, 11, None, 12, 13, 40]
    assert {r.d_id: r.d_next_o_id for r in done.tables["district"].collect()} == {1: 14, 2: 41}
    # Lines go by supplier, item, slot; both lines of item 3 saw 20 and the last one counted.
    lines = [(x.ol_number, x.ol_i_id, x.ol_quantity, x.s_quantity, x.brand_generic) for x in result[1].lines]
    assert lines == [(1, 2, 2, 20, "B"), (2, 3, 4, 20, "G"), (3, 3, 7, 20, "G")]
    assert [x.s_quantity for x in result[4].lines] == [13]
    after = {(r.s_w_id, r.s_i_id): r for r in done.tables["stock"].collect()}
    assert (after[1, 3].s_quantity, after[1, 3].s_ytd, after[1, 3].s_order_cnt) == (10, 14, 3)
    assert (after[2, 1].s_quantity, after[2, 1].s_remote_cnt) == (15, 1)
    assert (after[1, 4].s_quantity, after[2, 4].s_quantity) == (17, 20)
    # 13 pieces at 2.50, less 20 %, plus 15 % taxes; the rejected one counts its first line.
    assert result[1].total_amount == Decimal("29.90")
    assert result[3].total_amount == Decimal("2.30")
    orders = {r.o_id: r for r in done.tables["oorder"].filter("o_d_id = 1").collect()}
    assert [orders[i].o_all_local for i in (10, 11)] == [1, 0]
    assert orders[10].o_carrier_id is None and orders[10].o_ol_cnt == 3
    assert done.tables["new_order"].count() == 5
    kept = done.tables["order_line"].filter("ol_o_id = 10").orderBy("ol_number").collect()
    assert [(r.ol_i_id, r.ol_dist_info, r.ol_delivery_d) for r in kept] == [
        (2, "w1i2d1", None),
        (3, "w1i3d1", None),
        (3, "w1i3d1", None),
    ]
    errors = {r.req_seq: (r.code, r.message) for r in done.errors.collect()}
    assert errors == {
        6: (9999, "Stock for S_W_ID = 1 and S_I_ID = 5 not found."),
        7: (9999, "Item for I_ID = 77 not found."),
        8: (9999, "District for W_ID = 1 and D_ID = 9 not found."),
        9: (9999, "Warehouse or Customer for W_ID = 1 and D_ID = 1 and C_ID= 99 not found."),
    }


def test_same_result_on_one_partition(spark):
    req = S.requests(
        spark, "new_order", *[S.order(n, (1 + n % 4, 1, 1 + n % 9), (1, 2, 3)) for n in range(30)]
    )

    def answer(parts):
        done = no.new_order(tables(spark), req.repartition(parts), AT, fan=3, rows=4)
        return sorted(done.result.select("req_seq", "o_id", F.to_json("lines")).collect())

    assert answer(1) == answer(8)


def test_catalogue_and_stock_are_not_broadcast(spark, capsys):
    """Tables that look small as files are joined by merging, whatever their rows take in memory."""
    t = tables(spark)
    lines = spark.createDataFrame([(1, 1, 1, 1, 2)], "req_seq int, d_id int, ol_supply_w_id int, ol_i_id int, ol_quantity int")
    no.brand_generic(no.price_lines(no.lookup_stock(no.lookup_item(lines, t["item"]), t["stock"]))).explain()
    plan = capsys.readouterr().out
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan


def test_a_verdict_carries_no_texts(spark, capsys):
    req = S.requests(spark, "new_order", S.order(1, (1, 1, 2), (9, 1, 2)), S.order(2, (1, 1, 2)))
    checked = no.check_requests(tables(spark), req)
    narrow = checked.select("req_seq", "status", "message")
    narrow.explain()
    plan = capsys.readouterr().out
    assert "ol_dist_info" not in plan and "brand_generic" not in plan
    assert narrow.collect() == checked.select("req_seq", "status", "message", "lines").drop("lines").collect()


def test_stock_is_scanned_once_for_tables_and_results(spark, monkeypatch):
    calls, scan = [], no.scan_stock
    monkeypatch.setattr(no, "scan_stock", lambda *a, **k: calls.append(1) or scan(*a, **k))
    req = S.requests(spark, "new_order", S.order(1, (1, 1, 2)))
    no.new_order(tables(spark), req, AT)
    assert len(calls) == 1


def test_orders_are_ranked_without_their_lines(spark, monkeypatch):
    """Also where a request number comes twice, the order lines are those of the orders."""
    ranked, allocate = [], no.allocate_order_ids
    monkeypatch.setattr(no, "allocate_order_ids", lambda df, *a: ranked.append(df.columns) or allocate(df, *a))
    orders = [S.order(1, (1, 1, 2), (2, 1, 3)), S.order(2, (3, 1, 1), d=2), S.order(2, (4, 1, 1)), S.order(3, (9, 1, 2))]
    req = S.requests(spark, "new_order", *orders)
    t = tables(spark) | {n: S.rows(spark, n) for n in ("oorder", "new_order", "order_line")}
    got, plain = (no.new_order(t, req, AT, cut=cut) for cut in (True, False))
    assert "lines" not in ranked[0]
    for name in ("oorder", "new_order", "order_line"):
        assert got.tables[name].columns == plain.tables[name].columns
        assert sorted(map(str, got.tables[name].collect())) == sorted(map(str, plain.tables[name].collect()))
    assert got.tables["order_line"].count() > 0
    assert got.result.columns == plain.result.columns
    assert sorted(map(str, got.result.collect())) == sorted(map(str, plain.result.collect()))


def test_a_result_numbers_no_old_order(spark, monkeypatch, tmp_path):
    from orderflow.plans import REGISTRY
    from orderflow.sources.bridge import Bridge

    given = {
        "nation": [(0, "N", 0)],
        "region": [(0, "R")],
        "customer": [(k, f"C{k}", 0, 1.0, "M") for k in range(3)],
        "part": [(k, f"p{k}", "b", "t", 1, 2.5) for k in range(4)],
        "orders": [(k, k % 3, "O", 10.0, None, "1") for k in range(5)],
        "lineitem": [],
        "events": [(5 * k, None, 5, "purchase", 1.0, "") for k in range(4)],
    }
    from orderflow.sources.bridge import GIVEN

    for name, some in given.items():
        spark.createDataFrame(some, GIVEN[name]).write.parquet(str(tmp_path / f"{name}.parquet"))

    def ranks(self):
        raise AssertionError("old orders are ranked")

    monkeypatch.setattr(Bridge, "oo", ranks)
    found = REGISTRY["no_result"].run(spark, str(tmp_path)).collect()
    assert {r["o_id"] for r in found if r["status"] == no.PLACED} == {6, 7, 8}
