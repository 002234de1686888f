"""Registered queries over the generators, with as many rows as the given tables have."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import generate, requests
from ..sources.schemas import TABLE_COLUMNS
from . import value_sql as D
from .catalog import register
from .value_sql import q

AT = "timestamp '2024-01-01 00:00:00'"
C_LAST, C_CUSTOMER, C_ITEM = 123, 77, 4242
W = 100
KEYS = {
    "orders": "o_orderkey",
    "customer": "c_custkey",
    "part": "p_partkey",
    "supplier": "s_suppkey",
    "events": "event_id",
}


def _ids(b, table: str):
    """The table's own key column as row numbers; spread, since a row costs far more than its number."""
    ids = b.raw(table).select(F.col(KEYS[table]).cast("bigint").alias("id"))
    return ids.repartition(int(b.spark.conf.get("spark.sql.shuffle.partitions")))


def _columns(table: str) -> str:
    """The table's columns with their output kinds, from the DDL text."""
    kinds = {"int": "i", "bigint": "i", "varchar": "s", "char": "s", "timestamp": "t", "decimal": "f"}
    named = re.findall(r"(\w+) ([a-z]+)(?:\([\d,]+\))?(?:, |$)", TABLE_COLUMNS[table])
    return " ".join(f"{name}:{kinds[kind]}" for name, kind in named)


def _tax(hi: int, *k) -> str:
    return f"cast({D.uniform(0, hi, *k)} / 10000.0 as decimal(4,4))"


def _cents(lo: int, hi: int, *k) -> str:
    return f"cast({D.uniform(lo, hi, *k)} / 100.0 as decimal(12,2))"


_K = ("1", q("vals"), "id")
_VALUES = (
    f"select id, {D.uniform(5, 5000, *_K, q('u'))} as u, {D.a_string(0, 30, *_K, q('a'))} as a, "
    f"{D.n_string(16, *_K, q('n'))} as n, {D.state_code(*_K, q('s'))} as st, "
    f"{D.nurand_item(C_ITEM, *_K)} as item, {D.nurand_customer(C_CUSTOMER, *_K)} as cust, "
    f"{D.c_last('id % 1000')} as last, {D.nurand_last(C_LAST, *_K)} as odd_last, "
    f"{D.data_string(*_K, q('d'))} as data from (select o_orderkey as id from orders)"
)


@register(
    "gen_values", "id:i u:i a:s n:s st:s item:i cust:i last:s odd_last:s data:s", _VALUES
)
def _(b):
    k = (1, "vals", F.col("id"))
    return _ids(b, "orders").select(
        "id",
        V.uniform(5, 5000, *k, "u").alias("u"),
        V.a_string(0, 30, *k, "a").alias("a"),
        V.n_string(16, 16, *k, "n").alias("n"),
        V.state_code(*k, "s").alias("st"),
        V.nurand_item(C_ITEM, *k).alias("item"),
        V.nurand_customer(C_CUSTOMER, *k).alias("cust"),
        V.c_last(F.col("id") % 1000).alias("last"),
        V.nurand_last(C_LAST, *k).alias("odd_last"),
        V.data_string(*k, "d").alias("data"),
    )


_I = ("1", q("item"), "id")


@register(
    "gen_item",
    _columns("item"),
    f"select id + 1 as i_id, {D.a_string(14, 24, *_I, q('name'))} as i_name, "
    f"{_cents(100, 10000, *_I, q('price'))} as i_price, {D.data_string(*_I, q('data'))} as i_data, "
    f"{D.uniform(1, 10000, *_I, q('im'))} as i_im_id from (select p_partkey as id from part)",
)
def _(b):
    return generate.gen_item(_ids(b, "part"))


_WK = ("1", q("warehouse"), "id")


@register(
    "gen_warehouse",
    _columns("warehouse"),
    f"select id + 1 as w_id, 300000 as w_ytd, {_tax(2000, *_WK, q('tax'))} as w_tax, "
    f"{D.a_string(6, 10, *_WK, q('name'))} as w_name, {D.address('w', *_WK)} from "
    "(select s_suppkey as id from supplier)",
)
def _(b):
    return generate.gen_warehouse(_ids(b, "supplier"))


_DK = ("1", q("district"), "id")


@register(
    "gen_district",
    _columns("district"),
    f"select id // 10 + 1 as d_w_id, id % 10 + 1 as d_id, 30000 as d_ytd, "
    f"{_tax(2000, *_DK, q('tax'))} as d_tax, 3001 as d_next_o_id, "
    f"{D.a_string(6, 10, *_DK, q('name'))} as d_name, {D.address('d', *_DK)} from "
    "(select c_custkey as id from customer)",
)
def _(b):
    return generate.gen_district(_ids(b, "customer"))


_SK = ("1", q("stock"), "id")


@register(
    "gen_stock",
    _columns("stock"),
    f"select id // 100000 + 1 as s_w_id, id % 100000 + 1 as s_i_id, "
    f"{D.uniform(10, 100, *_SK, q('quantity'))} as s_quantity, 0 as s_ytd, 0 as s_order_cnt, "
    f"0 as s_remote_cnt, {D.data_string(*_SK, q('data'))} as s_data, "
    + ", ".join(f"{D.a_string(24, 24, *_SK, q('dist'), n)} as s_dist_{n:02d}" for n in range(1, 11))
    + " from (select o_orderkey as id from orders)",
)
def _(b):
    return generate.gen_stock(_ids(b, "orders"))


_CK = ("1", q("customer"), "id")


@register(
    "gen_customer",
    _columns("customer"),
    "select id // 30000 + 1 as c_w_id, id // 3000 % 10 + 1 as c_d_id, id % 3000 + 1 as c_id, "
    f"{_tax(5000, *_CK, q('discount'))} as c_discount, case when {D.uniform(1, 100, *_CK, q('credit'))} "
    f"<= 90 then 'GC' else 'BC' end as c_credit, case when id % 3000 < 1000 then {D.c_last('id % 3000')} "
    f"else {D.nurand_last(C_LAST, *_CK, q('last'))} end as c_last, "
    f"{D.a_string(8, 16, *_CK, q('first'))} as c_first, 50000 as c_credit_lim, -10 as c_balance, "
    f"10 as c_ytd_payment, 1 as c_payment_cnt, 0 as c_delivery_cnt, {D.address('c', *_CK)}, "
    f"{D.n_string(16, *_CK, q('phone'))} as c_phone, {AT} as c_since, 'OE' as c_middle, "
    f"{D.a_string(300, 500, *_CK, q('data'))} as c_data from (select o_orderkey as id from orders)",
)
def _(b):
    return generate.gen_customer(_ids(b, "orders"), c_last=C_LAST)


@register(
    "gen_history",
    _columns("history"),
    "select id + 1 as hist_id, id % 3000 + 1 as h_c_id, id // 3000 % 10 + 1 as h_c_d_id, id // 30000 + 1 "
    f"as h_c_w_id, id // 3000 % 10 + 1 as h_d_id, id // 30000 + 1 as h_w_id, {AT} as h_date, 10 as "
    f"h_amount, {D.a_string(12, 24, '1', q('history'), 'id')} as h_data from "
    "(select o_orderkey as id from orders)",
)
def _(b):
    return generate.gen_history(_ids(b, "orders"))


def _permutation() -> str:
    """Each round in a subquery of its own."""
    k = ("1", q("perm"), "w_id", "d_id")
    sql = (
        "select id, id // 30000 + 1 as w_id, id // 3000 % 10 + 1 as d_id, id % 3000 + 1 as o_id, "
        "id % 3000 % 40 as x, id % 3000 // 40 as y from (select o_orderkey as id from orders)"
    )
    for r in range(generate.ROUNDS):
        sql = f"select * replace ((x + {D.uniform(0, 39, *k, q('x'), r, 'y')}) % 40 as x) from ({sql})"
        sql = f"select * replace ((y + {D.uniform(0, 74, *k, q('y'), r, 'x')}) % 75 as y) from ({sql})"
    return f"select id, w_id, d_id, o_id, y * 40 + x + 1 as c_id from ({sql})"


@register("gen_permutation", "w_id:i d_id:i o_id:i c_id:i", _permutation())
def _(b):
    return generate.customer_permutation(_ids(b, "orders"))


_OK = ("1", q("oorder"), "id")
_OORDER = (
    "select w_id as o_w_id, d_id as o_d_id, o_id, c_id as o_c_id, case when o_id < 2101 then "
    f"{D.uniform(1, 10, *_OK, q('carrier'))} end as o_carrier_id, {D.uniform(5, 15, *_OK, q('lines'))} "
    f"as o_ol_cnt, 1 as o_all_local, {AT} as o_entry_d from ({_permutation()})"
)


@register("gen_oorder", _columns("oorder"), _OORDER)
def _(b):
    return generate.gen_oorder(_ids(b, "orders"))


_LK = ("1", q("order_line"), "o_w_id", "o_d_id", "o_id", "n")


@register(
    "gen_order_line",
    _columns("order_line"),
    "select o_w_id as ol_w_id, o_d_id as ol_d_id, o_id as ol_o_id, n as ol_number, "
    f"{D.uniform(1, 100000, *_LK, q('item'))} as ol_i_id, case when o_id < 2101 then {AT} end as "
    f"ol_delivery_d, case when o_id < 2101 then 0 else {_cents(1, 999999, *_LK, q('amount'))} end as "
    f"ol_amount, o_w_id as ol_supply_w_id, 5 as ol_quantity, {D.a_string(24, 24, *_LK, q('dist'))} as "
    f"ol_dist_info from (select *, unnest(range(1, o_ol_cnt + 1)) as n from ({_OORDER}))",
)
def _(b):
    return generate.gen_order_line(generate.gen_oorder(_ids(b, "orders")))


@register(
    "gen_new_order",
    _columns("new_order"),
    f"select o_w_id as no_w_id, o_d_id as no_d_id, o_id as no_o_id from ({_OORDER}) where o_id >= 2101",
)
def _(b):
    return generate.gen_new_order(generate.gen_oorder(_ids(b, "orders")))


# --- requests ----------------------------------------------------------------------------------


def _mix(b):
    return requests.gen_requests(_ids(b, "events").withColumnRenamed("id", "req_seq"), W)


_MK = ("1", q("mix"), "req_seq")
_MIX = (
    f"select req_seq, case when t <= 43 then 'PAYMENT' when t <= 47 then 'STOCK_LEVEL' when t <= 51 "
    "then 'ORDER_STATUS' when t <= 55 then 'DELIVERY' else 'NEW_ORDER' end as ttype, w_id, home_d_id "
    f"from (select event_id as req_seq from events) e, lateral (select {D.uniform(1, 100, *_MK, q('type'))} "
    f"as t, {D.uniform(1, W, *_MK, q('w'))} as w_id, {D.uniform(1, 10, *_MK, q('d'))} as home_d_id)"
)


@register("gen_requests", "req_seq:i ttype:s w_id:i home_d_id:i", _MIX)
def _(b):
    return _mix(b)


@register(
    "gen_homes",
    "terminal:i w_id:i d_id:i",
    "select row_number() over (order by draw, w_id, d_id) as terminal, w_id, d_id from (select *, "
    f"{D.uniform(0, 4294967295, '1', q('home'), 'w_id', 'd_id')} as draw from (select s_suppkey + 1 as "
    "w_id, unnest(range(1, 11)) as d_id from supplier)) qualify terminal <= 64",
)
def _(b):
    places = b.raw("supplier").select(
        (F.col("s_suppkey") + 1).alias("w_id"),
        F.explode(F.sequence(F.lit(1), F.lit(10))).alias("d_id"),
    )
    return requests.gen_homes(places, 64)


_NK = ("1", q("no"), "req_seq")
_NO = (
    f"select req_seq, w_id, {D.uniform(1, 10, *_NK, q('d'))} as d_id, "
    f"{D.nurand_customer(C_CUSTOMER, *_NK, q('c'))} as c_id, {D.uniform(5, 15, *_NK, q('n'))} as n, "
    f"{D.uniform(1, 100, *_NK, q('bad'))} = 1 as bad, {D.uniform(1, 9, *_NK, q('by'))} * 1000000 as by_n "
    f"from ({_MIX})"
)


@register(
    "gen_new_order_req",
    "req_seq:i w_id:i d_id:i c_id:i slot:i ol_i_id:i ol_supply_w_id:i ol_quantity:i",
    f"select req_seq, w_id, d_id, c_id, slot, {D.nurand_item(C_ITEM, *_NK, 'slot', q('item'))} + "
    f"case when bad and slot = n then by_n else 0 end as ol_i_id, case when "
    f"{D.uniform(1, 100, *_NK, 'slot', q('home'))} <= 99 then w_id else "
    f"{D.uniform(1, W, *_NK, 'slot', q('w'))} end as ol_supply_w_id, "
    f"{D.uniform(1, 10, *_NK, 'slot', q('qty'))} as ol_quantity from (select *, unnest(range(1, n + 1)) "
    f"as slot from ({_NO}))",
)
def _(b):
    req = requests.gen_new_order_req(_mix(b), W, C_CUSTOMER, C_ITEM)
    return req.select("*", F.inline("lines")).drop("lines")


_PK = ("1", q("pay"), "req_seq")


@register(
    "gen_payment_req",
    "req_seq:i w_id:i d_id:i c_w_id:i c_d_id:i c_id:i c_last:s h_amount:f",
    "select req_seq, w_id, d_id, case when far > 85 then (w_id - 1 + shift) % 100 + 1 else w_id end as "
    "c_w_id, case when far > 85 then cd else d_id end as c_d_id, case when by_n > 60 then c end as c_id, "
    f"case when by_n <= 60 then last end as c_last, h_amount from ({_MIX}), lateral (select "
    f"{D.uniform(1, 10, *_PK, q('d'))} as d_id, {D.uniform(1, 100, *_PK, q('remote'))} as far, "
    f"{D.uniform(1, W - 1, *_PK, q('shift'))} as shift, {D.uniform(1, 10, *_PK, q('cd'))} as cd, "
    f"{D.uniform(1, 100, *_PK, q('by'))} as by_n, {D.nurand_customer(C_CUSTOMER, *_PK, q('c'))} as c, "
    f"{D.nurand_last(C_LAST, *_PK, q('last'))} as last, {_cents(100, 500000, *_PK, q('amount'))} as h_amount)",
)
def _(b):
    return requests.gen_payment_req(_mix(b), W, C_CUSTOMER, C_LAST)


_TK = ("1", q("status"), "req_seq")


@register(
    "gen_order_status_req",
    "req_seq:i w_id:i d_id:i c_id:i c_last:s",
    "select req_seq, w_id, d_id, case when by_n > 60 then c end as c_id, case when by_n <= 60 then last "
    f"end as c_last from ({_MIX}), lateral (select {D.uniform(1, 10, *_TK, q('d'))} as d_id, "
    f"{D.uniform(1, 100, *_TK, q('by'))} as by_n, {D.nurand_customer(C_CUSTOMER, *_TK, q('c'))} as c, "
    f"{D.nurand_last(C_LAST, *_TK, q('last'))} as last)",
)
def _(b):
    return requests.gen_order_status_req(_mix(b), C_CUSTOMER, C_LAST)


@register(
    "gen_stock_level_req",
    "req_seq:i w_id:i d_id:i threshold:i",
    "select req_seq, w_id, home_d_id as d_id, "
    f"{D.uniform(10, 20, '1', q('level'), 'req_seq', q('threshold'))} as threshold from ({_MIX})",
)
def _(b):
    return requests.gen_stock_level_req(_mix(b))


@register(
    "gen_delivery_req",
    "req_seq:i w_id:i o_carrier_id:i",
    f"select req_seq, w_id, {D.uniform(1, 10, '1', q('delivery'), 'req_seq', q('carrier'))} as "
    f"o_carrier_id from ({_MIX})",
)
def _(b):
    return requests.gen_delivery_req(_mix(b))
