"""Small hand-built tables."""

from pyspark.sql import functions as F

from orderflow.sources.schemas import request_schema, table_schema


def rows(spark, table, *dicts):
    schema = table_schema(table)
    df = spark.createDataFrame(
        [tuple(d.get(f.name) for f in schema) for d in dicts],
        ", ".join(
            f"{f.name} {'string' if 'decimal' in f.dataType.simpleString() or 'timestamp' in f.dataType.simpleString() else f.dataType.simpleString()}"
            for f in schema
        ),
    )
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def requests(spark, kind, *dicts):
    schema = request_schema(kind)
    text = [f for f in schema if "decimal" in f.dataType.simpleString()]
    plain = ", ".join(
        f"{f.name} {'string' if f in text else f.dataType.simpleString()}" for f in schema
    )
    df = spark.createDataFrame([tuple(d.get(f.name) for f in schema) for d in dicts], plain)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def district(d=1, **kw):
    return {"d_w_id": 1, "d_id": d, "d_ytd": "0.00", "d_tax": "0.1000", "d_next_o_id": 10, "d_name": f"D{d}", **kw}


def warehouse(w=1, **kw):
    return {"w_id": w, "w_ytd": "0.00", "w_tax": "0.0500", "w_name": f"W{w}", **kw}


def customer(c=1, **kw):
    return {
        "c_w_id": 1,
        "c_d_id": 1,
        "c_id": c,
        "c_discount": "0.2000",
        "c_credit": "GC",
        "c_last": "BARBARBAR",
        "c_first": f"F{c:03d}",
        "c_balance": "-10.00",
        "c_ytd_payment": "10.00",
        "c_payment_cnt": 1,
        "c_delivery_cnt": 0,
        "c_data": "",
        **kw,
    }


def item(i, **kw):
    return {"i_id": i, "i_name": f"item{i}", "i_price": "2.50", "i_data": "x", "i_im_id": 1, **kw}


def stock(i, w=1, q=50, **kw):
    texts = {f"s_dist_{n:02d}": f"w{w}i{i}d{n}" for n in range(1, 11)}
    return {"s_w_id": w, "s_i_id": i, "s_quantity": q, "s_ytd": 0, "s_order_cnt": 0, "s_remote_cnt": 0, "s_data": "y", **texts, **kw}


def order(req_seq, *lines, w=1, d=1, c=1):
    """lines: (item, supplier, quantity)"""
    return {
        "req_seq": req_seq,
        "w_id": w,
        "d_id": d,
        "c_id": c,
        "lines": [(n, i, s, q) for n, (i, s, q) in enumerate(lines, 1)],
    }
