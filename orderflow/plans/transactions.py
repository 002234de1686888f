"""Registered queries over the business operators: orders, payments, status, stock, delivery."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import customers, delivery, errors, new_order, order_status, payment, stock_level
from ..session import cut_lineage
from .catalog import register

AT = "2024-02-01 00:00:00"
_AT = f"timestamp '{AT}'"

ADDRESS = (
    "w_name w_street_1 w_street_2 w_city w_state w_zip "
    "d_name d_street_1 d_street_2 d_city d_state d_zip"
).split()


# --- stock level -------------------------------------------------------------------------------

_LEVEL = (
    "select r.req_seq, r.w_id, r.d_id, r.threshold, (select count(*) from t_stock where s_w_id = "
    "r.w_id and s_quantity < r.threshold and s_i_id in (select ol_i_id from t_district join "
    "t_order_line on ol_w_id = d_w_id and ol_d_id = t_district.d_id and ol_o_id >= d_next_o_id - 20 "
    "and ol_o_id < d_next_o_id where d_w_id = r.w_id and t_district.d_id = r.d_id)) as low_stock "
    "from r_level r"
)


@register("stock_level", "req_seq:i w_id:i d_id:i threshold:i low_stock:i", _LEVEL)
def _(b):
    return stock_level.stock_level(b.tables("district", "order_line", "stock"), b.stock_level_req())


@register(
    "recent_items",
    "w_id:i d_id:i ol_i_id:i",
    "select distinct d_w_id as w_id, d.d_id, ol_i_id from t_district d join t_order_line on "
    "ol_w_id = d_w_id and ol_d_id = d.d_id and ol_o_id >= d_next_o_id - 20 and ol_o_id < d_next_o_id "
    "where exists (select 1 from r_level r where r.w_id = d_w_id and r.d_id = d.d_id)",
)
def _(b):
    return stock_level.recent_items(b.stock_level_req(), b.district(), b.order_line())


# --- order status ------------------------------------------------------------------------------


@register(
    "by_last_name",
    "c_w_id:i c_d_id:i c_last:s c_id:i",
    "select distinct b.* from by_last b join r_pay r on r.c_w_id = b.c_w_id and r.c_d_id = b.c_d_id "
    "and r.c_last = b.c_last",
)
def _(b):
    return customers.resolve_by_last_name(b.payment_req(), b.customer())


@register(
    "order_status_customer",
    "req_seq:i w_id:i d_id:i c_id:i c_first:s c_middle:s c_last:s c_balance:f",
    "select * from status",
)
def _(b):
    return order_status.order_status_customer(b.order_status_req(), b.customer())


@register(
    "last_order",
    "req_seq:i c_id:i o_id:i o_entry_d:t o_carrier_id:i",
    "select req_seq, c_id, o_id, o_entry_d, case when o_id is not null then o_carrier_id end "
    "as o_carrier_id from status_order",
)
def _(b):
    asked = order_status.order_status_customer(b.order_status_req(), b.customer())
    return order_status.last_order(asked, b.oorder())


_STATUS_LINES = (
    "select req_seq, s.o_id, ol_number, ol_i_id, ol_supply_w_id, ol_quantity, ol_amount, "
    "ol_delivery_d from status_order s join t_order_line on ol_w_id = w_id and ol_d_id = d_id and "
    "ol_o_id = s.o_id"
)


@register(
    "order_lines",
    "req_seq:i o_id:i ol_number:i ol_i_id:i ol_supply_w_id:i ol_quantity:i ol_amount:f ol_delivery_d:t",
    _STATUS_LINES,
)
def _(b):
    found = order_status.order_status(
        b.tables("customer", "oorder", "order_line"), b.order_status_req()
    )
    return (
        found.select("req_seq", "o_id", F.posexplode("lines").alias("p", "x"))
        .filter(F.col("x.ol_quantity") > 0)
        .select("req_seq", "o_id", (F.col("p") + 1).alias("ol_number"), "x.*")
    )


@register(
    "order_status",
    "req_seq:i c_id:i c_first:s c_middle:s c_last:s c_balance:f o_id:i o_entry_d:t o_carrier_id:i "
    "slots:i n_lines:i amount:f too_many:i code:i message:s",
    "select s.*, 15 as slots, coalesce(n, 0) as n_lines, coalesce(amount, 0) as amount, "
    "case when coalesce(n, 0) > 15 then 1 else 0 end as too_many, "
    "case when s.o_id is null then 9999 end as code, case when s.o_id is null then "
    "concat('Last Order for W_ID = ', w_id, ' and D_ID = ', d_id, ' and C_ID = ', c_id, "
    "' not found.') end as message from (select * exclude (o_carrier_id), "
    "case when o_id is not null then o_carrier_id end as o_carrier_id from status_order) s "
    "left join (select ol_w_id, ol_d_id, ol_o_id, count(*) as n, "
    "sum(ol_amount) as amount from t_order_line group by all) l on ol_w_id = w_id and ol_d_id = d_id "
    "and ol_o_id = s.o_id",
)
def _(b):
    found = order_status.order_status(
        b.tables("customer", "oorder", "order_line"), b.order_status_req()
    )
    used = F.filter("lines", lambda x: x["ol_quantity"] > 0)
    total = F.aggregate(
        "lines",
        F.lit(0).cast("decimal(20,2)"),
        lambda a, x: (a + x["ol_amount"]).cast("decimal(20,2)"),
    )
    return found.withColumns(
        {"slots": F.size("lines"), "n_lines": F.size(used), "amount": total}
    )


# --- new orders --------------------------------------------------------------------------------

NO_TABLES = ["district", "customer", "warehouse", "item", "stock"]


def _placed(b):
    checked = new_order.check_requests(b.tables(*NO_TABLES), b.new_order_req())
    return new_order.placed_requests(checked)


def _steps(b):
    """What requests do to stock, written once: the scan goes over it several times."""
    return cut_lineage(new_order.stock_steps(_placed(b)))


def _numbered(b, *extra: str):
    """Placed requests with their order ids; those checked are written once, since ranks read them several times."""
    cols = ["req_seq", "w_id", "d_id", "c_id", "d_next_o_id", "o_ol_cnt", "o_all_local", *extra]
    return new_order.allocate_order_ids(cut_lineage(_placed(b).select(*cols)))


@register(
    "no_district",
    "req_seq:i d_tax:f d_next_o_id:i",
    "select req_seq, d_tax, d_next_o_id from r_no r join t_district d on d_w_id = w_id and d.d_id = r.d_id",
)
def _(b):
    return new_order.lookup_district(b.new_order_req(), b.district())


@register(
    "no_customer_tax",
    "req_seq:i c_discount:f c_last:s c_credit:s w_tax:f",
    "select req_seq, c_discount, c_last, c_credit, w_tax from no_req",
)
def _(b):
    return new_order.lookup_customer_tax(b.new_order_req(), b.customer(), b.warehouse())


@register(
    "no_line_order",
    "req_seq:i ol_number:i slot:i ol_i_id:i ol_supply_w_id:i ol_quantity:i",
    "select * from no_numbered",
)
def _(b):
    return new_order.sequence_lines(b.new_order_req())


@register(
    "no_all_local", "req_seq:i o_ol_cnt:i o_all_local:i", "select req_seq, o_ol_cnt, o_all_local from no_req"
)
def _(b):
    return new_order.all_local(b.new_order_req())


@register(
    "no_status",
    "req_seq:i status:s total_amount:f",
    "select req_seq, status, total_amount from no_req",
)
def _(b):
    return new_order.check_requests(b.tables(*NO_TABLES), b.new_order_req())


@register("no_order_ids", "req_seq:i w_id:i d_id:i o_id:i", "select * from no_placed")
def _(b):
    return _numbered(b)


@register(
    "no_district_after",
    "d_w_id:i d_id:i d_next_o_id:i",
    "select d_w_id, d.d_id, d.d_next_o_id + count(p.req_seq) as d_next_o_id from t_district d left "
    "join no_placed p on p.w_id = d_w_id and p.d_id = d.d_id group by d_w_id, d.d_id, d.d_next_o_id",
)
def _(b):
    return new_order.advance_next_order_id(b.district(), _placed(b))


@register(
    "no_stock_lookup",
    "req_seq:i ol_number:i s_data:s ol_dist_info:s",
    "select req_seq, ol_number, s_data, ol_dist_info from no_lines",
)
def _(b):
    return new_order.lookup_stock(new_order.sequence_lines(b.new_order_req()), b.stock())


@register(
    "no_priced_lines",
    "req_seq:i ol_number:i i_name:s i_price:f ol_amount:f brand_generic:s",
    "select * from no_lines",
)
def _(b):
    lines = new_order.lookup_item(new_order.sequence_lines(b.new_order_req()), b.item())
    return new_order.brand_generic(new_order.price_lines(new_order.lookup_stock(lines, b.stock())))


@register(
    "no_stock_seen",
    "s_w_id:i s_i_id:i req_seq:i seen:i after:i",
    "select *, case when seen >= qty + 10 then seen - qty else seen + 91 end as after from no_seen",
)
def _(b):
    return new_order.scan_stock(_steps(b), b.stock())


@register(
    "no_stock_hot",
    "s_w_id:i s_i_id:i req_seq:i seen:i after:i",
    "select *, case when seen >= qty + 10 then seen - qty else seen + 91 end as after from (select h.s_w_id, "
    "h.s_i_id, req_seq, qty, list_reduce(coalesce(list(qty) over (partition by h.s_w_id, h.s_i_id order by "
    "req_seq rows between unbounded preceding and 1 preceding), []::bigint[]), lambda a, x: case when a >= x + "
    "10 then a - x else a + 91 end, t.s_quantity) as seen from (select s_w_id, s_i_id % 3 + 1 as s_i_id, "
    "req_seq, max(qty) as qty from no_steps group by all) h join t_stock t on t.s_w_id = h.s_w_id and "
    "t.s_i_id = h.s_i_id)",
)
def _(b):
    """All orders fall on three items, so that every stock row has more steps than one list holds."""
    item = (F.col("s_i_id") % 3 + 1).cast("int").alias("s_i_id")
    steps = _steps(b).groupBy("s_w_id", item, "req_seq").agg(F.max("qty").alias("qty"))
    return new_order.scan_stock(cut_lineage(steps), b.stock())


_STOCK_AFTER = (
    "select t.s_w_id, t.s_i_id, coalesce(l.s_quantity, t.s_quantity) as s_quantity, "
    "coalesce(c.s_ytd, 0) as s_ytd, coalesce(c.s_order_cnt, 0) as s_order_cnt, "
    "coalesce(c.s_remote_cnt, 0) as s_remote_cnt from t_stock t left join no_left l on "
    "l.s_w_id = t.s_w_id and l.s_i_id = t.s_i_id left join no_counts c on c.s_w_id = t.s_w_id and "
    "c.s_i_id = t.s_i_id"
)


@register("no_stock_quantity", "s_w_id:i s_i_id:i s_quantity:i", _STOCK_AFTER)
def _(b):
    return new_order.apply_stock_quantity(b.stock(), cut_lineage(_placed(b)))


@register(
    "no_stock_counters", "s_w_id:i s_i_id:i s_ytd:i s_order_cnt:i s_remote_cnt:i", _STOCK_AFTER
)
def _(b):
    return new_order.apply_stock_counters(b.stock(), _placed(b))


def _appended(b, name: str):
    b = b.written()
    numbered = _numbered(b, *(["lines"] if name == "order_line" else []))
    return new_order.append_orders(b.tables(name), numbered, AT)[name]


@register(
    "no_oorder_after",
    "o_w_id:i o_d_id:i o_id:i o_c_id:i o_carrier_id:i o_ol_cnt:i o_all_local:i o_entry_d:t",
    "select * from t_oorder union all select w_id, d_id, o_id, c_id, null, o_ol_cnt, o_all_local, "
    f"{_AT} from no_placed",
)
def _(b):
    return _appended(b, "oorder")


@register(
    "no_new_order_after",
    "no_w_id:i no_d_id:i no_o_id:i",
    "select * from t_new_order union all select w_id, d_id, o_id from no_placed",
)
def _(b):
    return _appended(b, "new_order")


@register(
    "no_order_line_after",
    "ol_w_id:i ol_d_id:i ol_o_id:i ol_number:i ol_i_id:i ol_delivery_d:t ol_amount:f "
    "ol_supply_w_id:i ol_quantity:i ol_dist_info:s",
    "select * from t_order_line union all select p.w_id, p.d_id, o_id, ol_number, ol_i_id, null, "
    "ol_amount, ol_supply_w_id, ol_quantity, ol_dist_info from no_good join no_placed p using (req_seq)",
)
def _(b):
    return _appended(b, "order_line")


@register(
    "no_result",
    "req_seq:i status:s o_id:i total_amount:f ol_number:i ol_i_id:i s_quantity:i brand_generic:s ol_amount:f",
    "select r.req_seq, r.status, p.o_id, r.total_amount, g.ol_number, g.ol_i_id, n.seen as s_quantity, "
    "g.brand_generic, g.ol_amount from no_req r left join no_placed p using (req_seq) left join "
    "no_good g using (req_seq) left join no_seen n on n.req_seq = r.req_seq and "
    "n.s_w_id = g.ol_supply_w_id and n.s_i_id = g.ol_i_id",
)
def _(b):
    b = b.written()
    # The result reads no orders, new orders or order lines, so no order is numbered for tables to add to.
    result = new_order.new_order(b.tables(*NO_TABLES), b.new_order_req(), AT).result
    return result.select("*", F.explode_outer("lines").alias("x")).select(
        "req_seq",
        "status",
        "o_id",
        "total_amount",
        "x.ol_number",
        "x.ol_i_id",
        "x.s_quantity",
        "x.brand_generic",
        "x.ol_amount",
    )


# --- payments ----------------------------------------------------------------------------------

PAY_TABLES = ["district", "warehouse", "customer"]


def _paid(b):
    """Payments that go through, written once: the tables they change start from it."""
    checked = payment.check_payments(b.tables(*PAY_TABLES), b.payment_req())
    return checked.filter(F.col("code").isNull())


@register(
    "pay_district_ytd",
    "d_w_id:i d_id:i d_ytd:f",
    "select d_w_id, d.d_id, d_ytd + coalesce((select sum(h_amount) from pay p where p.w_id = d_w_id "
    "and p.d_id = d.d_id), 0) as d_ytd from t_district d",
)
def _(b):
    return payment.apply_district_ytd(b.district(), _paid(b))


@register(
    "pay_warehouse_ytd",
    "w_id:i w_ytd:f",
    "select w.w_id, w_ytd + coalesce((select sum(h_amount) from pay p where p.w_id = w.w_id), 0) "
    "as w_ytd from t_warehouse w",
)
def _(b):
    return payment.apply_warehouse_ytd(b.warehouse(), _paid(b))


@register(
    "pay_addresses",
    "req_seq:i " + " ".join(f"{c}:s" for c in ADDRESS),
    f"select req_seq, {', '.join(ADDRESS)} from r_pay r join t_district d on d_w_id = r.w_id and "
    "d.d_id = r.d_id join t_warehouse w on w.w_id = r.w_id",
)
def _(b):
    return payment.lookup_addresses(b.payment_req(), b.district(), b.warehouse())


_DETAIL = (
    "c_first:s c_middle:s c_last:s c_street_1:s c_street_2:s c_city:s c_state:s c_zip:s c_phone:s "
    "c_since:t c_credit:s c_credit_lim:f c_discount:f"
)


@register("pay_customer", f"req_seq:i c_w_id:i c_d_id:i c_id:i {_DETAIL} c_balance:f", "select * from pay")
def _(b):
    return _paid(b)


@register(
    "pay_customer_after",
    "c_w_id:i c_d_id:i c_id:i c_balance:f c_ytd_payment:f c_payment_cnt:i",
    "select c.c_w_id, c.c_d_id, c.c_id, c_balance - coalesce(paid, 0) as c_balance, c_ytd_payment + "
    "coalesce(paid, 0) as c_ytd_payment, c_payment_cnt + coalesce(n, 0) as c_payment_cnt from "
    "t_customer c left join (select c_w_id, c_d_id, c_id, sum(h_amount) as paid, count(*) as n from "
    "pay group by all) using (c_w_id, c_d_id, c_id)",
)
def _(b):
    return payment.apply_payments(b.customer(), _paid(b))


@register(
    "pay_bad_credit",
    "c_w_id:i c_d_id:i c_id:i c_data:s",
    "select c_w_id, c_d_id, c_id, case when front is null then c_data else substr(front || c_data, 1, "
    "500) end as c_data from t_customer left join (select c_w_id, c_d_id, c_id, string_agg(record, '' "
    "order by req_seq desc) as front from pay_records where c_credit <> 'GC' group by all) "
    "using (c_w_id, c_d_id, c_id)",
)
def _(b):
    return payment.apply_bad_credit_data(b.customer(), _paid(b))


@register(
    "pay_history_after",
    "hist_id:i h_c_id:i h_c_d_id:i h_c_w_id:i h_d_id:i h_w_id:i h_date:t h_amount:f h_data:s",
    "select * from t_history union all select (select max(hist_id) from t_history) + row_number() "
    f"over (order by req_seq), c_id, c_d_id, c_w_id, p.d_id, p.w_id, {_AT}, h_amount, w_name || "
    "'    ' || d_name from pay p join t_district d on d_w_id = p.w_id and d.d_id = p.d_id "
    "join t_warehouse w on w.w_id = p.w_id",
)
def _(b):
    return payment.append_history(b.history(), _paid(b), AT)


@register(
    "pay_result",
    "req_seq:i w_name:s d_name:s c_id:i c_last:s c_credit:s c_balance:f c_data:s h_amount:f h_date:t",
    "select req_seq, w_name, d_name, c_id, c_last, c_credit, c_balance - sum(h_amount) over u as "
    "c_balance, case when c_credit = 'GC' then '' else substr(array_to_string(list_reverse(list(record) "
    f"over u), '') || c_data, 1, 500) end as c_data, h_amount, {_AT} as h_date from pay_records p join "
    "t_district d on d_w_id = p.w_id and d.d_id = p.d_id join t_warehouse w on w.w_id = p.w_id "
    "window u as (partition by c_w_id, c_d_id, c_id order by req_seq rows between unbounded preceding "
    "and current row)",
)
def _(b):
    tables = b.tables(*PAY_TABLES, "history")
    return payment.payment(tables, b.payment_req(), AT).result


# --- delivery ----------------------------------------------------------------------------------


def _claims(b):
    return delivery.claim_oldest(b.delivery_req(), b.new_order())


def _priced(b):
    found = cut_lineage(delivery.claim_customer(_claims(b), b.oorder()))
    return delivery.claim_amount(delivery.split_claims(found)[0], b.order_line())


@register(
    "dl_claims", "req_seq:i w_id:i d_id:i o_id:i o_carrier_id:i nth:i", "select * from dl_claims"
)
def _(b):
    return _claims(b)


@register(
    "dl_new_order_after",
    "no_w_id:i no_d_id:i no_o_id:i",
    "select * from t_new_order where (no_w_id, no_d_id, no_o_id) not in (select w_id, d_id, o_id from dl_claims)",
)
def _(b):
    return delivery.delete_claimed(b.new_order(), _claims(b))


@register(
    "dl_oorder_after",
    "o_w_id:i o_d_id:i o_id:i o_carrier_id:i",
    "select o_w_id, o_d_id, o.o_id, coalesce(c.o_carrier_id, o.o_carrier_id) as o_carrier_id from "
    "t_oorder o left join dl_claims c on w_id = o_w_id and d_id = o_d_id and c.o_id = o.o_id",
)
def _(b):
    return delivery.apply_carrier(b.oorder(), _claims(b))


@register("dl_customer", "req_seq:i d_id:i o_id:i c_id:i", "select * from dl_priced")
def _(b):
    return delivery.claim_customer(_claims(b), b.oorder())


@register(
    "dl_order_line_after",
    "ol_w_id:i ol_d_id:i ol_o_id:i ol_number:i ol_delivery_d:t",
    f"select ol_w_id, ol_d_id, ol_o_id, ol_number, case when req_seq is not null then {_AT} else "
    "ol_delivery_d end as ol_delivery_d from t_order_line left join dl_claims on w_id = ol_w_id and "
    "d_id = ol_d_id and o_id = ol_o_id",
)
def _(b):
    return delivery.apply_delivery_date(b.order_line(), _claims(b), AT)


@register("dl_amount", "req_seq:i d_id:i o_id:i amount:f", "select * from dl_priced")
def _(b):
    return _priced(b)


@register(
    "dl_customer_after",
    "c_w_id:i c_d_id:i c_id:i c_balance:f c_delivery_cnt:i",
    "select c.c_w_id, c.c_d_id, c.c_id, c_balance + coalesce(a, 0) as c_balance, coalesce(n, 0) as "
    "c_delivery_cnt from t_customer c left join (select w_id, d_id, c_id, sum(amount) as a, count(*) "
    "as n from dl_priced group by all) p on p.w_id = c_w_id and p.d_id = c_d_id and p.c_id = c.c_id",
)
def _(b):
    return delivery.apply_delivery_credit(b.customer(), _priced(b))


@register(
    "dl_result",
    "req_seq:i w_id:i d_id:i o_id:i skipped:i",
    "select r.req_seq, r.w_id, g.d_id, coalesce(c.o_id, -1) as o_id, 10 - (select count(*) from "
    "dl_claims x where x.req_seq = r.req_seq) as skipped from (select *, unnest(range(1, 11)) as d_id "
    "from r_delivery) g join r_delivery r using (req_seq) left join dl_claims c on c.req_seq = "
    "g.req_seq and c.d_id = g.d_id",
)
def _(b):
    tables = b.tables("new_order", "oorder", "order_line", "customer")
    result = delivery.delivery(tables, b.delivery_req(), AT).result
    return result.select(
        "req_seq", "w_id", "skipped", F.posexplode("delivered_o_id").alias("p", "o_id")
    ).withColumn("d_id", F.col("p") + 1)


# --- errors ------------------------------------------------------------------------------------

_GONE = "req_seq % 7 = 3"


@register(
    "err_missing",
    "req_seq:i code:i message:s",
    "select req_seq, 9999 as code, concat('District for W_ID = ', w_id + 90, ' and D_ID = ', d_id, "
    f"' not found.') as message from r_level where {_GONE}",
)
def _(b):
    req = b.stray(b.stock_level_req())
    return errors.missing_rows(req, b.district(), {"w_id": "d_w_id", "d_id": "d_id"}, "district")


@register(
    "err_new_order",
    "req_seq:i code:i message:s",
    "select req_seq, 9999 as code, concat('District for W_ID = ', w_id + 90, ' and D_ID = ', d_id, "
    f"' not found.') as message from r_no where {_GONE}",
)
def _(b):
    req = b.stray(b.new_order_req())
    checked = new_order.check_requests(b.tables(*NO_TABLES), req)
    return new_order.failed_requests(checked)


@register(
    "err_new_order_stock",
    "req_seq:i code:i message:s",
    "select req_seq, 9999 as code, concat('Stock for S_W_ID = ', ol_supply_w_id, ' and S_I_ID = ', "
    "ol_i_id, ' not found.') as message from (select *, row_number() over (partition by req_seq order "
    "by ol_number) as rn from no_lines where i_price is null or ol_i_id % 17 = 5) where rn = 1 and "
    "i_price is not null",
)
def _(b):
    tables = b.tables(*NO_TABLES)
    tables["stock"] = tables["stock"].filter(F.col("s_i_id") % 17 != 5)
    return new_order.failed_requests(new_order.check_requests(tables, b.new_order_req()))


@register(
    "err_payment",
    "req_seq:i code:i message:s",
    "select req_seq, 9999 as code, concat('District for W_ID = ', w_id + 90, ' and D_ID = ', d_id, "
    f"' not found.') as message from r_pay where {_GONE}",
)
def _(b):
    req = b.stray(b.payment_req())
    checked = payment.check_payments(b.tables(*PAY_TABLES), req)
    return checked.filter(F.col("code").isNotNull())


@register(
    "err_order_status",
    "req_seq:i code:i message:s",
    "select req_seq, 9999 as code, case when c_last is not null then concat('Customer(s) for C_W_ID = ', "
    "w_id + 90, ' and C_D_ID = ', d_id, ' and C_LAST = ', c_last, ' not found.') else "
    "concat('Customer for C_W_ID = ', w_id + 90, ' and C_D_ID = ', d_id, ' and C_ID = ', c_id, "
    f"' not found.') end as message from r_status where {_GONE}",
)
def _(b):
    found = order_status.order_status(
        b.tables("customer", "oorder", "order_line"), b.stray(b.order_status_req())
    )
    return found.filter(F.col("message").startswith("Customer"))


@register(
    "err_delivery",
    "req_seq:i code:i message:s",
    "select req_seq, 9999 as code, concat('Order for O_W_ID = ', w_id, ' and O_D_ID = ', d_id, "
    "' and O_ID = ', o_id, ' not found.') as message from dl_asked join (select w_id, min(nth) as stop, "
    "arg_min(d_id, (nth, d_id)) as d_id, arg_min(o_id, (nth, d_id)) as o_id from dl_claims "
    "where o_id % 50 = 7 group by w_id) using (w_id) where nth >= stop",
)
def _(b):
    tables = b.tables("new_order", "oorder", "order_line", "customer")
    tables["oorder"] = tables["oorder"].filter(F.col("o_id") % 50 != 7)
    return delivery.delivery(tables, b.delivery_req(), AT).errors


def _stray_errors(b):
    req = b.stray(b.payment_req())
    missing = errors.missing_rows(req, b.district(), {"w_id": "d_w_id", "d_id": "d_id"}, "district")
    odd = F.when(F.col("req_seq") % 2 == 0, 1062).otherwise(F.col("code"))
    return missing.withColumn("code", odd.cast("int"))


@register(
    "err_classes",
    "req_seq:i code:i error_class:s",
    "select req_seq, case when req_seq % 2 = 0 then 1062 else 9999 end as code, case when req_seq % 2 "
    f"= 0 then 'EXPECTED' else 'UNEXPECTED' end as error_class from r_pay where {_GONE}",
)
def _(b):
    return errors.classify_errors(_stray_errors(b), [1062])


@register(
    "err_log",
    "error_class:s ttype:s stage:s n:i",
    "select case when req_seq % 2 = 0 then 'EXPECTED' else 'UNEXPECTED' end as error_class, "
    f"'TT_PAYMENT' as ttype, 'EXECUTION' as stage, count(*) as n from r_pay where {_GONE} group by all",
)
def _(b):
    classed = errors.classify_errors(_stray_errors(b), [1062])
    return errors.summarize_log(errors.log_lines(classed, "TT_PAYMENT"))
