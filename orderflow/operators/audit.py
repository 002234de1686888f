"""Consistency checks: each returns the rows that break a rule, so an empty result is a pass.

Every table is read once, into its facts: totals per district together with the keys that occur more
than once, from one aggregation over grouping sets. The checks compare facts with facts, which are as
small as the list of districts; an audit writes them once, and a later one needs to read only the
tables that have changed since.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

Tables = dict[str, DataFrame]


def _totals_and_repeats(df: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """Per district its totals, and per key that occurs more than once its count, in one pass.

    `whole` tells the districts' rows from those of keys. Both carry `n`, the number of rows.
    """
    place = keys[:2]
    both = df.groupingSets([place, keys], *keys).agg(
        F.grouping(keys[-1]).cast("boolean").alias("whole"),
        F.count(F.lit(1)).alias("n"),
        *[v.alias(n) for n, v in totals.items()],
    )
    return both.filter("whole or n > 1")


def _repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


KEYS = {
    "customer": ["c_w_id", "c_d_id", "c_id"],
    "new_order": ["no_w_id", "no_d_id", "no_o_id"],
    "oorder": ["o_w_id", "o_d_id", "o_id"],
    "stock": ["s_w_id", "s_i_id"],
    "order_line": ["ol_w_id", "ol_d_id", "ol_o_id", "ol_number"],
}

#: What the checks need of each table.
FACTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "warehouse": lambda df: df.select("w_id", "w_ytd"),
    "district": lambda df: df.select("d_w_id", "d_id", "d_ytd", "d_next_o_id"),
    "customer": lambda df: _repeats(df, KEYS["customer"]),
    "stock": lambda df: _repeats(df, KEYS["stock"]),
    "new_order": lambda df: _totals_and_repeats(
        df,
        KEYS["new_order"],
        {"ids": F.count("no_o_id"), "lowest": F.min("no_o_id"), "highest": F.max("no_o_id")},
    ),
    "oorder": lambda df: _totals_and_repeats(
        df, KEYS["oorder"], {"highest": F.max("o_id"), "lines": F.sum("o_ol_cnt")}
    ),
    "order_line": lambda df: _totals_and_repeats(df, KEYS["order_line"], {"ids": F.count("ol_o_id")}),
}


def gather(t: Tables, cut: bool = False) -> Tables:
    """The facts of the tables given; with `cut`, written once for all checks."""
    found = {name: FACTS[name](df) for name, df in t.items() if name in FACTS}
    return {name: cut_lineage(df) for name, df in found.items()} if cut else found


# --- checks on facts -----------------------------------------------------------------------------


def _district_receipts(f: Tables) -> DataFrame:
    return f["district"].groupBy(F.col("d_w_id").alias("w_id")).agg(F.sum("d_ytd").alias("w_ytd"))


def _last_ids(f: Tables) -> DataFrame:
    return f["district"].select(
        F.col("d_w_id").alias("w_id"), "d_id", (F.col("d_next_o_id") - 1).alias("last_id")
    )


def ytd_forward(f: Tables) -> DataFrame:
    """Warehouse receipts that are not the sum of their districts'."""
    return f["warehouse"].select("w_id", "w_ytd").subtract(_district_receipts(f))


def ytd_reverse(f: Tables) -> DataFrame:
    """Sums of district receipts that are not the warehouse's."""
    return _district_receipts(f).subtract(f["warehouse"].select("w_id", "w_ytd"))


def next_id_orders(f: Tables) -> DataFrame:
    """Districts whose next order id does not follow their highest order."""
    return _last_ids(f).subtract(f["oorder"].filter("whole").select("o_w_id", "o_d_id", "highest"))


def next_id_new_orders(f: Tables) -> DataFrame:
    """The same against pending orders; a district with none pending is reported too."""
    return _last_ids(f).subtract(f["new_order"].filter("whole").select("no_w_id", "no_d_id", "highest"))


def no_gaps(f: Tables) -> DataFrame:
    """Districts whose pending order ids do not run without a gap."""
    diff = F.col("ids") - (F.col("highest") - F.col("lowest") + 1)
    return f["new_order"].filter("whole").select("no_w_id", "no_d_id", diff.alias("diff")).filter("diff <> 0")


def line_counts(f: Tables) -> DataFrame:
    """Districts whose orders' line counts do not add up to their order lines."""
    said = f["oorder"].filter("whole").select("o_w_id", "o_d_id", F.col("lines").alias("n"))
    return said.subtract(f["order_line"].filter("whole").select("ol_w_id", "ol_d_id", "ids"))


def _duplicates(table: str) -> Callable[[Tables], DataFrame]:
    def check(f: Tables) -> DataFrame:
        rows = f[table]
        rows = rows.filter("not whole") if "whole" in rows.columns else rows
        return rows.select(*KEYS[table], "n")

    check.__doc__ = f"The keys that occur more than once in {table}."
    return check


#: Check and the tables it needs.
CHECKS: dict[str, tuple[Callable[[Tables], DataFrame], list[str]]] = {
    "ytd_forward": (ytd_forward, ["warehouse", "district"]),
    "next_id_orders": (next_id_orders, ["district", "oorder"]),
    "next_id_new_orders": (next_id_new_orders, ["district", "new_order"]),
    "no_gaps": (no_gaps, ["new_order"]),
    "line_counts": (line_counts, ["oorder", "order_line"]),
    "ytd_reverse": (ytd_reverse, ["warehouse", "district"]),
    "dup_customer": (_duplicates("customer"), ["customer"]),
    "dup_new_order": (_duplicates("new_order"), ["new_order"]),
    "dup_oorder": (_duplicates("oorder"), ["oorder"]),
    "dup_stock": (_duplicates("stock"), ["stock"]),
}
OPTIONAL_CHECKS = {"dup_order_line": (_duplicates("order_line"), ["order_line"])}


def run_check(name: str, t: Tables) -> DataFrame:
    """The rows that break one rule."""
    judge, needed = {**CHECKS, **OPTIONAL_CHECKS}[name]
    return judge(gather({n: t[n] for n in needed}))


def judge_facts(f: Tables, optional: bool = False) -> DataFrame:
    """(check_id, violation): every offending row of every check, as JSON."""
    checks = {**CHECKS, **(OPTIONAL_CHECKS if optional else {})}
    found = None
    for name, (judge, _) in checks.items():
        bad = judge(f)
        rows = bad.select(F.lit(name).alias("check_id"), F.to_json(F.struct(*bad.columns)).alias("violation"))
        found = rows if found is None else found.unionByName(rows)
    return found


def run_checks(t: Tables, optional: bool = False) -> DataFrame:
    """(check_id, violation) of every check; each table is read once."""
    return judge_facts(gather(t, cut=True), optional)


def passed(t: Tables, optional: bool = False) -> bool:
    return not run_checks(t, optional).take(1)
