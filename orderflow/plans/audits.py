"""Registered queries over the consistency checks, on sound tables and on tables with faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit
from .catalog import register


def _twice(df, condition):
    return df.unionByName(df.filter(condition))


def faulty(b, *names):
    """The bridged tables with planted faults."""
    made = {
        "warehouse": lambda: b.warehouse().withColumn(
            "w_ytd", F.col("w_ytd") + F.when(F.col("w_id") % 2 == 0, 1).otherwise(0)
        ),
        "district": lambda: b.district().withColumn(
            "d_next_o_id", F.col("d_next_o_id") + F.when(F.col("d_id") == 3, 1).otherwise(0)
        ),
        "new_order": lambda: b.new_order()
        .filter(F.col("no_o_id") % 101 != 0)
        .unionByName(b.new_order().filter(F.col("no_o_id") % 97 == 0)),
        "customer": lambda: _twice(b.customer(), F.col("c_id") % 211 == 0),
        "oorder": lambda: _twice(b.oorder(), F.col("o_id") % 211 == 0),
        "stock": lambda: _twice(b.stock(), F.col("s_i_id") % 211 == 0),
        "order_line": lambda: _twice(b.order_line(), F.col("ol_i_id") % 211 == 0),
    }
    return {n: made[n]() for n in names}


_YTD = "select d_w_id, sum(d_ytd) from f_district group by d_w_id"
_DUP = "select {k}, count(*) as n from f_{t} group by {k} having count(*) > 1"

SQL = {
    "ytd_forward": f"select w_id, w_ytd from f_warehouse except ({_YTD})",
    "next_id_orders": (
        "select d_w_id as w_id, d_id, d_next_o_id - 1 as last_id from f_district except "
        "(select o_w_id, o_d_id, max(o_id) from f_oorder group by o_w_id, o_d_id)"
    ),
    "next_id_new_orders": (
        "select d_w_id as w_id, d_id, d_next_o_id - 1 as last_id from f_district except "
        "(select no_w_id, no_d_id, max(no_o_id) from f_new_order group by no_w_id, no_d_id)"
    ),
    "no_gaps": (
        "select * from (select no_w_id, no_d_id, count(no_o_id) - (max(no_o_id) - min(no_o_id) + 1) as diff from "
        "f_new_order group by no_w_id, no_d_id) where diff <> 0"
    ),
    "line_counts": (
        "select o_w_id, o_d_id, sum(o_ol_cnt) as n from f_oorder group by o_w_id, o_d_id except "
        "(select ol_w_id, ol_d_id, count(ol_o_id) from f_order_line group by ol_w_id, ol_d_id)"
    ),
    "ytd_reverse": (
        "select d_w_id as w_id, sum(d_ytd) as w_ytd from f_district group by d_w_id except "
        "(select w_id, w_ytd from f_warehouse)"
    ),
    "dup_customer": _DUP.format(t="customer", k="c_w_id, c_d_id, c_id"),
    "dup_new_order": _DUP.format(t="new_order", k="no_w_id, no_d_id, no_o_id"),
    "dup_oorder": _DUP.format(t="oorder", k="o_w_id, o_d_id, o_id"),
    "dup_stock": _DUP.format(t="stock", k="s_w_id, s_i_id"),
    "dup_order_line": _DUP.format(t="order_line", k="ol_w_id, ol_d_id, ol_o_id, ol_number"),
}

SPEC = {
    "ytd_forward": ("w_id:i w_ytd:f", ["warehouse", "district"]),
    "next_id_orders": ("w_id:i d_id:i last_id:i", ["district", "oorder"]),
    "next_id_new_orders": ("w_id:i d_id:i last_id:i", ["district", "new_order"]),
    "no_gaps": ("no_w_id:i no_d_id:i diff:i", ["new_order"]),
    "line_counts": ("o_w_id:i o_d_id:i n:i", ["oorder", "order_line"]),
    "ytd_reverse": ("w_id:i w_ytd:f", ["warehouse", "district"]),
    "dup_customer": ("c_w_id:i c_d_id:i c_id:i n:i", ["customer"]),
    "dup_new_order": ("no_w_id:i no_d_id:i no_o_id:i n:i", ["new_order"]),
    "dup_oorder": ("o_w_id:i o_d_id:i o_id:i n:i", ["oorder"]),
    "dup_stock": ("s_w_id:i s_i_id:i n:i", ["stock"]),
    "dup_order_line": ("ol_w_id:i ol_d_id:i ol_o_id:i ol_number:i n:i", ["order_line"]),
}

def _register(name: str) -> None:
    columns, needed = SPEC[name]

    @register(f"check_{name}", columns, SQL[name])
    def _(b):
        return audit.run_check(name, faulty(b, *needed))


for _name in SPEC:
    _register(_name)

_COUNTS = " union all ".join(
    f"select '{n}' as check_id, count(*) as n from ({SQL[n]}) having count(*) > 0" for n in SPEC
)
_EVERY = ["warehouse", "district", "new_order", "customer", "oorder", "stock", "order_line"]


@register("check_all_faulty", "check_id:s n:i", _COUNTS)
def _(b):
    found = audit.run_checks(faulty(b, *_EVERY), optional=True)
    return found.groupBy("check_id").agg(F.count("violation").alias("n"))


@register(
    "check_all_sound",
    "check_id:s n:i",
    _COUNTS.replace("f_", "t_"),
)
def _(b):
    found = audit.run_checks(b.tables(*_EVERY), optional=True)
    return found.groupBy("check_id").agg(F.count("violation").alias("n"))
