"""DuckDB SQL for the bridged tables, requests and logs that the oracle queries start from.

`with_ctes(body)` puts in front of a query just those common table expressions it needs.
"""

from __future__ import annotations

import re



def _cents(col: str) -> str:
    return f"cast(cast({col} as decimal(12,2)) * 100 as bigint)"


def _address(prefix: str, *parts: str) -> str:
    h = "md5(concat_ws(':', " + ", ".join(parts) + "))"
    return (
        f"substr({h},1,12) as {prefix}_street_1, substr({h},5,12) as {prefix}_street_2, "
        f"substr({h},9,12) as {prefix}_city, upper(substr({h},1,2)) as {prefix}_state, "
        f"substr({h},21,4) || '11111' as {prefix}_zip"
    )


_H_AMOUNT = "cast((cents % 499901 + 100) * 0.01 as decimal(6,2))"
_DISTS = ", ".join(
    f"substr(md5(concat_ws(':', w, p_partkey, '{n:02d}')),1,24) as s_dist_{n:02d}"
    for n in range(1, 11)
)
_PICK = "case d_id " + " ".join(f"when {n} then s_dist_{n:02d}" for n in range(1, 11)) + " end"
_RECORD = (
    "concat('C_ID=', c_id, ' C_D_ID=', c_d_id, ' C_W_ID=', c_w_id, ' D_ID=', d_id, "
    "' W_ID=', w_id, ' H_AMOUNT=', cast(h_amount as varchar), '   ')"
)
CPU = (
    "cpu_user cpu_nice cpu_system cpu_idle cpu_iowait cpu_irq cpu_softirq cpu_steal cpu_guest "
    "cpu_guest_nice"
).split()
BLOCK = "reads read_merges read_sectors writes write_merges write_sectors".split()
NET = "rx_packets rx_bytes tx_packets tx_bytes".split()


def _cum(names: list[str], base: int, part: str) -> str:
    over = f"over (partition by {part} order by event_id)"
    return ", ".join(f"sum(cents % {base + i}) {over} as {n}" for i, n in enumerate(names))


def _req(kind: str) -> str:
    return (
        "select event_id as req_seq, user_id % 5 + 1 as w_id, event_id % 5 + 1 as d_id, value "
        f"from events where event_type = '{kind}'"
    )


CTES: dict[str, str] = {
    "dist": (
        "select n_nationkey, n_name, n_regionkey, n_regionkey + 1 as w, row_number() over "
        "(partition by n_regionkey order by n_nationkey) as d from nation"
    ),
    "buyers": (
        "select c_custkey, c_name, c_acctbal, c_mktsegment, w, d from customer "
        "join dist on c_nationkey = n_nationkey"
    ),
    "ranked_buyers": (
        "select *, row_number() over (partition by w, d order by c_custkey) as nth, "
        "count(*) over (partition by w, d) as n from buyers"
    ),
    "oo": (
        "select *, o_id * 10 > cnt * 7 as pending from (select o_orderkey as ok, w, d, o_custkey, "
        "row_number() over (partition by w, d order by o_orderkey) as o_id, "
        "count(*) over (partition by w, d) as cnt, "
        f"{_cents('o_totalprice')} as cents, o_orderdate from orders "
        "join buyers on o_custkey = c_custkey)"
    ),
    "t_history": (
        "select ok + 1 as hist_id, o_custkey as h_c_id, d as h_c_d_id, w as h_c_w_id, d as h_d_id, "
        f"w as h_w_id, o_orderdate as h_date, {_H_AMOUNT} as h_amount, "
        "substr(r_name,1,10) || '    ' || substr(n_name,1,10) as h_data "
        "from oo join dist using (w, d) join region on r_regionkey = n_regionkey"
    ),
    "t_district": (
        "select w as d_w_id, d as d_id, cast(30000 + coalesce(paid, 0) as decimal(20,2)) as d_ytd, "
        "cast((n_nationkey * 7 % 21) / 100.0 as decimal(4,4)) as d_tax, "
        "coalesce(last, 0) + 1 as d_next_o_id, substr(n_name,1,10) as d_name, "
        + _address("d", "'d'", "w", "d")
        + f" from dist left join (select w, d, sum({_H_AMOUNT}) as paid, max(o_id) as last from oo "
        "group by w, d) using (w, d)"
    ),
    "t_warehouse": (
        "select r_regionkey + 1 as w_id, cast(coalesce(paid, 0) as decimal(20,2)) as w_ytd, "
        "cast(r_regionkey * 3 / 100.0 as decimal(4,4)) as w_tax, substr(r_name,1,10) as w_name, "
        + _address("w", "'w'", "r_regionkey + 1")
        + " from region left join (select d_w_id, sum(d_ytd) as paid from t_district group by d_w_id) "
        "on d_w_id = r_regionkey + 1"
    ),
    "t_customer": (
        "select w as c_w_id, d as c_d_id, c_custkey as c_id, "
        "cast(c_custkey % 51 / 100.0 as decimal(4,4)) as c_discount, "
        "case when c_custkey % 10 = 0 then 'BC' else 'GC' end as c_credit, "
        "c_mktsegment as c_last, right(c_name, 16) as c_first, "
        "cast(50000 as decimal(12,2)) as c_credit_lim, "
        "cast(cast(c_acctbal as decimal(12,2)) as decimal(20,2)) as c_balance, "
        "cast(10 as decimal(20,2)) as c_ytd_payment, 1 as c_payment_cnt, 0 as c_delivery_cnt, "
        + _address("c", "'c'", "c_custkey")
        + ", lpad(cast(c_custkey as varchar), 16, '0') as c_phone, "
        "timestamp '2024-01-01 00:00:00' as c_since, 'OE' as c_middle, "
        "repeat(md5(cast(c_custkey as varchar)), 12) as c_data from buyers"
    ),
    "t_oorder": (
        "select w as o_w_id, d as o_d_id, o_id, o_custkey as o_c_id, "
        "case when not pending then ok % 10 + 1 end as o_carrier_id, "
        "coalesce(lines, 0) as o_ol_cnt, 1 - coalesce(remote, 0) as o_all_local, "
        "o_orderdate as o_entry_d from oo left join (select l_orderkey, count(*) as lines, "
        "max(case when l_suppkey % 100 = 7 then 1 else 0 end) as remote from lineitem "
        "group by l_orderkey) on l_orderkey = ok"
    ),
    "t_order_line": (
        "select w as ol_w_id, d as ol_d_id, o_id as ol_o_id, row_number() over (partition by "
        "l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
        "l_shipdate) as ol_number, l_partkey as ol_i_id, "
        "case when not pending then l_shipdate end as ol_delivery_d, "
        f"cast(({_cents('l_extendedprice')} % 999999 + 1) * 0.01 as decimal(6,2)) as ol_amount, "
        "case when l_suppkey % 100 = 7 then w % 5 + 1 else w end as ol_supply_w_id, "
        "cast(l_quantity as int) % 10 + 1 as ol_quantity, "
        "substr(md5(concat_ws(':', 'ol', l_orderkey, l_partkey)),1,24) as ol_dist_info "
        "from lineitem join oo on l_orderkey = ok"
    ),
    "t_new_order": "select w as no_w_id, d as no_d_id, o_id as no_o_id from oo where pending",
    "t_item": (
        "select p_partkey as i_id, p_name as i_name, cast(p_retailprice as decimal(12,2)) as i_price, "
        "p_type || ' ' || p_brand || case when p_partkey % 10 = 0 then ' ORIGINAL' else '' end "
        "as i_data, p_size as i_im_id from part"
    ),
    "t_stock": (
        "select w as s_w_id, p_partkey as s_i_id, 10 + (p_partkey * 7 + w * 13) % 91 as s_quantity, "
        "0 as s_ytd, 0 as s_order_cnt, 0 as s_remote_cnt, case when p_partkey % 20 = 0 then "
        "'ORIGINAL' else md5(concat_ws(':', w, p_partkey, 'data')) end as s_data, "
        f"{_DISTS} from part, (select unnest(range(1, 6)) as w)"
    ),
    # requests
    "e_purchase": _req("purchase"),
    "e_click": _req("click"),
    "e_error": _req("error"),
    "e_view": _req("view"),
    "e_signup": _req("signup"),
    "r_no": (
        "select req_seq, w_id, d_id, c_custkey as c_id, req_seq % 11 + 5 as o_ol_cnt "
        "from e_purchase join ranked_buyers on w = w_id and d = d_id and nth = req_seq % n + 1"
    ),
    "r_no_lines": (
        "select req_seq, w_id, d_id, slot, (req_seq * 31 + slot * 97) % (select count(*) from part) "
        "+ case when slot = o_ol_cnt and req_seq % 50 = 0 then 1000000 else 0 end as ol_i_id, "
        "case when (req_seq + slot) % 100 = 0 then w_id % 5 + 1 else w_id end as ol_supply_w_id, "
        "(req_seq + slot) % 10 + 1 as ol_quantity "
        "from (select *, unnest(range(1, o_ol_cnt + 1)) as slot from r_no)"
    ),
    "r_pay": (
        "select req_seq, w_id, d_id, c_w_id, c_d_id, "
        "case when req_seq % 7 >= 4 then c_custkey end as c_id, "
        "case when req_seq % 7 < 4 then c_mktsegment end as c_last, "
        "cast(cast(value as decimal(12,2)) + 1 as decimal(6,2)) as h_amount "
        "from (select *, case when req_seq % 20 < 3 then w_id % 5 + 1 else w_id end as c_w_id, "
        "case when req_seq % 20 < 3 then req_seq // 5 % 5 + 1 else d_id end as c_d_id from e_click) "
        "join ranked_buyers on w = c_w_id and d = c_d_id and nth = req_seq % n + 1"
    ),
    "r_status": (
        "select req_seq, w_id, d_id, case when req_seq % 7 >= 4 then c_custkey end as c_id, "
        "case when req_seq % 7 < 4 then c_mktsegment end as c_last "
        "from e_error join ranked_buyers on w = w_id and d = d_id and nth = req_seq % n + 1"
    ),
    "r_level": "select req_seq, w_id, d_id, req_seq % 11 + 10 as threshold from e_view",
    "r_delivery": "select req_seq, w_id, req_seq % 10 + 1 as o_carrier_id from e_signup",
    # new orders
    "no_numbered": (
        "select *, row_number() over (partition by req_seq order by ol_supply_w_id, ol_i_id, slot) "
        "as ol_number from r_no_lines"
    ),
    "no_lines": (
        "select l.*, i_name, i_price, i_data, s_data, s_quantity as q0, "
        f"cast(i_price * ol_quantity as decimal(12,2)) as ol_amount, {_PICK} as ol_dist_info, "
        "case when contains(i_data, 'ORIGINAL') and contains(s_data, 'ORIGINAL') then 'B' else 'G' "
        "end as brand_generic from no_numbered l left join t_item on i_id = ol_i_id "
        "left join t_stock on s_w_id = ol_supply_w_id and s_i_id = ol_i_id"
    ),
    "no_bad": (
        "select req_seq, min(ol_number) as bad from no_lines where i_price is null group by req_seq"
    ),
    "no_total": (
        "select req_seq, sum(ol_amount) as amount from no_lines left join no_bad using (req_seq) "
        "where bad is null or ol_number < bad group by req_seq"
    ),
    "no_req": (
        "select r.*, case when bad is null then 'Order placed' else 'Item number is not valid' end "
        "as status, d_tax, d_next_o_id, w_tax, c_discount, c_last, c_credit, "
        "round(coalesce(amount, 0) * (1 - c_discount) * (1 + w_tax + d_tax), 2) as total_amount, "
        "(select min(case when ol_supply_w_id = l.w_id then 1 else 0 end) from r_no_lines l "
        "where l.req_seq = r.req_seq) as o_all_local "
        "from r_no r left join no_bad using (req_seq) left join no_total using (req_seq) "
        "join t_district d on d_w_id = r.w_id and d.d_id = r.d_id "
        "join t_warehouse w on w.w_id = r.w_id "
        "join t_customer c on c_w_id = r.w_id and c_d_id = r.d_id and c.c_id = r.c_id"
    ),
    "no_placed": (
        "select *, d_next_o_id + row_number() over (partition by w_id, d_id order by req_seq) - 1 "
        "as o_id from no_req where status = 'Order placed'"
    ),
    "no_good": "select l.* from no_lines l join no_placed p using (req_seq)",
    "no_steps": (
        "select ol_supply_w_id as s_w_id, ol_i_id as s_i_id, req_seq, max(q0) as q0, "
        "arg_max(ol_quantity, ol_number) as qty from no_good group by all"
    ),
    "no_seen": (
        "select s_w_id, s_i_id, req_seq, qty, list_reduce(coalesce(list(qty) over (partition by "
        "s_w_id, s_i_id order by req_seq rows between unbounded preceding and 1 preceding), "
        "[]::bigint[]), lambda a, x: case when a >= x + 10 then a - x else a + 91 end, q0) as seen "
        "from no_steps"
    ),
    "no_left": (
        "select s_w_id, s_i_id, list_reduce(list(qty order by req_seq), "
        "lambda a, x: case when a >= x + 10 then a - x else a + 91 end, max(q0)) as s_quantity "
        "from no_steps group by s_w_id, s_i_id"
    ),
    "no_counts": (
        "select ol_supply_w_id as s_w_id, ol_i_id as s_i_id, sum(ol_quantity) as s_ytd, "
        "count(*) as s_order_cnt, sum(case when ol_supply_w_id <> w_id then 1 else 0 end) "
        "as s_remote_cnt from no_good group by all"
    ),
    # payments
    "by_last": (
        "select c_w_id, c_d_id, c_last, c_id from (select *, row_number() over (partition by c_w_id, "
        "c_d_id, c_last order by c_first, c_id) as rn, count(*) over (partition by c_w_id, c_d_id, "
        "c_last) as n from t_customer) where rn = (n + 1) // 2"
    ),
    "pay": (
        "select p.req_seq, p.w_id, p.d_id, p.c_w_id, p.c_d_id, c.c_id, p.h_amount, "
        "c.* exclude (c_w_id, c_d_id, c_id) from (select r.* exclude (c_id), "
        "coalesce(r.c_id, b.c_id) as c_id from r_pay r left join by_last b on b.c_w_id = r.c_w_id "
        "and b.c_d_id = r.c_d_id and b.c_last = r.c_last) p join t_customer c on "
        "c.c_w_id = p.c_w_id and c.c_d_id = p.c_d_id and c.c_id = p.c_id"
    ),
    "pay_records": f"select *, {_RECORD} as record from pay",
    # order status
    "status": (
        "select q.req_seq, q.w_id, q.d_id, c.c_id, c.c_first, c.c_middle, c.c_last, c.c_balance from "
        "(select r.* exclude (c_id), coalesce(r.c_id, b.c_id) as c_id from r_status r left join "
        "by_last b on b.c_w_id = r.w_id and b.c_d_id = r.d_id and b.c_last = r.c_last) q join "
        "t_customer c on c.c_w_id = q.w_id and c.c_d_id = q.d_id and c.c_id = q.c_id"
    ),
    "status_order": (
        "select s.*, o_id, o_entry_d, coalesce(o_carrier_id, -1) as o_carrier_id from status s "
        "left join (select * from t_oorder o where o_id = (select max(x.o_id) from t_oorder x where "
        "x.o_w_id = o.o_w_id and x.o_d_id = o.o_d_id and x.o_c_id = o.o_c_id)) o "
        "on o_w_id = w_id and o_d_id = d_id and o_c_id = c_id"
    ),
    # delivery
    "dl_asked": "select *, row_number() over (partition by w_id order by req_seq) as nth from r_delivery",
    "dl_claims": (
        "select req_seq, w_id, d_id, o_id, o_carrier_id, nth from dl_asked join (select no_w_id "
        "as w_id, no_d_id as d_id, no_o_id as o_id, row_number() over (partition by no_w_id, no_d_id "
        "order by no_o_id) as nth from t_new_order) using (w_id, nth)"
    ),
    "dl_priced": (
        "select c.*, o_c_id as c_id, coalesce((select sum(ol_amount) from t_order_line where "
        "ol_w_id = w_id and ol_d_id = d_id and ol_o_id = c.o_id), 0) as amount from dl_claims c "
        "join t_oorder o on o_w_id = w_id and o_d_id = d_id and o.o_id = c.o_id"
    ),
    # logs
    "ev": (
        "select *, (epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) // 1000 as elapsed, "
        f"{_cents('value')} as cents, 'dev_' || (user_id % 3) as device from events"
    ),
    "result": (
        "select 1 as run, elapsed, cents * m as latency, cents * m as dblatency, ttype, "
        "case when ttype = 'NEW_ORDER' and event_id % 100 = 0 then 1 else 0 end as rbk, "
        "case when ttype = 'DELIVERY_BG' then event_id % 3 else 0 end as dskipped, "
        "case when event_id % 200 = 1 then 1 else 0 end as error from ev join (values "
        "('purchase','NEW_ORDER',1), ('click','PAYMENT',1), ('view','STOCK_LEVEL',1), "
        "('error','ORDER_STATUS',1), ('signup','DELIVERY',1), ('signup','DELIVERY_BG',3)) "
        "k(event_type, ttype, m) using (event_type)"
    ),
    "front": "select *, elapsed // 600000 * 600000 as bucket from result where ttype <> 'DELIVERY_BG'",
    "raw_cpu": (
        f"select 1 as run, event_id * 60000 as elapsed, {_cum(CPU, 11, '1')}, cents % 1000 as vm_nr_dirty from ev"
    ),
    "raw_blk": f"select 1 as run, event_id * 60000 as elapsed, device, {_cum(BLOCK, 101, 'device')} from ev",
    "raw_net": f"select 1 as run, event_id * 60000 as elapsed, device, {_cum(NET, 1001, 'device')} from ev",
    "cpu_first": (
        "select elapsed, vm_nr_dirty, "
        + ", ".join(f"{c} - first_value({c}) over (order by elapsed) as {c}" for c in CPU)
        + " from raw_cpu"
    ),
    "cpu_step": (
        "select elapsed, vm_nr_dirty, "
        + ", ".join(f"{c} - lag({c}) over (order by elapsed) as {c}" for c in CPU)
        + " from raw_cpu"
    ),
    "sys_info": (
        "select elapsed, vm_nr_dirty, "
        + ", ".join(
            f"case when ({' + '.join(CPU)}) = 0 then 0.0 else {c} / cast(({' + '.join(CPU)}) as double) end as {c}"
            for c in CPU
        )
        + " from cpu_first where elapsed > (select min(elapsed) from raw_cpu)"
    ),
    "blk": (
        "select * from (select elapsed, device, "
        + ", ".join(
            f"({c} - lag({c}) over (partition by device order by elapsed)) * {m} as {n}"
            for c, n, m in zip(
                BLOCK, "rdiops rdmerges rdkbps wriops wrmerges wrkbps".split(), "1.0 1.0 0.5 1.0 1.0 0.5".split()
            )
        )
        + " from raw_blk) where rdiops is not null"
    ),
    "net": (
        "select * from (select elapsed, device, "
        + ", ".join(
            f"({c} - lag({c}) over (partition by device order by elapsed)) / {m} as {n}"
            for c, n, m in zip(NET, "rxpktsps rxkbps txpktsps txkbps".split(), "1.0 1024.0 1.0 1024.0".split())
        )
        + " from raw_net) where rxpktsps is not null"
    ),
    # tables with planted faults
    "f_warehouse": "select w_id, w_ytd + case when w_id % 2 = 0 then 1 else 0 end as w_ytd from t_warehouse",
    "f_district": (
        "select d_w_id, d_id, d_ytd, d_next_o_id + case when d_id = 3 then 1 else 0 end as d_next_o_id "
        "from t_district"
    ),
    "f_new_order": (
        "select * from t_new_order where no_o_id % 101 <> 0 union all "
        "select * from t_new_order where no_o_id % 97 = 0"
    ),
    "f_customer": "select * from t_customer union all select * from t_customer where c_id % 211 = 0",
    "f_oorder": "select * from t_oorder union all select * from t_oorder where o_id % 211 = 0",
    "f_stock": "select * from t_stock union all select * from t_stock where s_i_id % 211 = 0",
    "f_order_line": (
        "select * from t_order_line union all select * from t_order_line where ol_i_id % 211 = 0"
    ),
}

_WORD = re.compile(r"[a-z_0-9]+")
_NEEDS = {n: {w for w in _WORD.findall(sql) if w in CTES and w != n} for n, sql in CTES.items()}


def with_ctes(body: str) -> str:
    """`body` with the common table expressions it names, in an order that resolves."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for need in sorted(_NEEDS[name]):
            add(need)
        order.append(name)

    for word in _WORD.findall(body):
        if word in CTES:
            add(word)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order) + "\n" + body
