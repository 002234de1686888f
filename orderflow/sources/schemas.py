"""The ten tables, the logs and the request tables: columns, keys and DDL types."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Table columns in file order, as SQL types.
TABLE_COLUMNS: dict[str, str] = {
    "config": "cfg_name varchar(30), cfg_value varchar(50)",
    "warehouse": (
        "w_id int, w_ytd decimal(12,2), w_tax decimal(4,4), w_name varchar(10), "
        "w_street_1 varchar(20), w_street_2 varchar(20), w_city varchar(20), w_state char(2), "
        "w_zip char(9)"
    ),
    "district": (
        "d_w_id int, d_id int, d_ytd decimal(12,2), d_tax decimal(4,4), d_next_o_id int, "
        "d_name varchar(10), d_street_1 varchar(20), d_street_2 varchar(20), d_city varchar(20), "
        "d_state char(2), d_zip char(9)"
    ),
    "customer": (
        "c_w_id int, c_d_id int, c_id int, c_discount decimal(4,4), c_credit char(2), "
        "c_last varchar(16), c_first varchar(16), c_credit_lim decimal(12,2), "
        "c_balance decimal(12,2), c_ytd_payment decimal(12,2), c_payment_cnt int, "
        "c_delivery_cnt int, c_street_1 varchar(20), c_street_2 varchar(20), c_city varchar(20), "
        "c_state char(2), c_zip char(9), c_phone char(16), c_since timestamp, c_middle char(2), "
        "c_data varchar(500)"
    ),
    "history": (
        "hist_id bigint, h_c_id int, h_c_d_id int, h_c_w_id int, h_d_id int, h_w_id int, "
        "h_date timestamp, h_amount decimal(6,2), h_data varchar(24)"
    ),
    "new_order": "no_w_id int, no_d_id int, no_o_id int",
    "oorder": (
        "o_w_id int, o_d_id int, o_id int, o_c_id int, o_carrier_id int, o_ol_cnt int, "
        "o_all_local int, o_entry_d timestamp"
    ),
    "order_line": (
        "ol_w_id int, ol_d_id int, ol_o_id int, ol_number int, ol_i_id int, "
        "ol_delivery_d timestamp, ol_amount decimal(6,2), ol_supply_w_id int, ol_quantity int, "
        "ol_dist_info char(24)"
    ),
    "item": (
        "i_id int, i_name varchar(24), i_price decimal(5,2), i_data varchar(50), i_im_id int"
    ),
    "stock": (
        "s_w_id int, s_i_id int, s_quantity int, s_ytd int, s_order_cnt int, s_remote_cnt int, "
        "s_data varchar(50), "
        + ", ".join(f"s_dist_{n:02d} char(24)" for n in range(1, 11))
    ),
}

#: Columns that tables in folders carry: part of the warehouses, and batch.
LAYOUT = ("x_part", "x_batch")

# Primary keys.
TABLE_KEYS: dict[str, list[str]] = {
    "config": ["cfg_name"],
    "warehouse": ["w_id"],
    "district": ["d_w_id", "d_id"],
    "customer": ["c_w_id", "c_d_id", "c_id"],
    "history": ["hist_id"],
    "new_order": ["no_w_id", "no_d_id", "no_o_id"],
    "oorder": ["o_w_id", "o_d_id", "o_id"],
    "order_line": ["ol_w_id", "ol_d_id", "ol_o_id", "ol_number"],
    "item": ["i_id"],
    "stock": ["s_w_id", "s_i_id"],
}

# Log columns, as SQL types.
LOG_COLUMNS: dict[str, str] = {
    "result": (
        "run int, elapsed bigint, latency bigint, dblatency bigint, ttype string, rbk int, "
        "dskipped int, error int"
    ),
    "run_info": (
        "run int, driver string, driverVersion string, db string, sessionStart timestamp, "
        "runMins int, loadWarehouses int, runWarehouses int, numSUTThreads int, "
        "limitTxnsPerMin int, thinkTimeMultiplier double, keyingTimeMultiplier double"
    ),
    "sys_info": (
        "run int, elapsed bigint, cpu_user double, cpu_nice double, cpu_system double, "
        "cpu_idle double, cpu_iowait double, cpu_irq double, cpu_softirq double, "
        "cpu_steal double, cpu_guest double, cpu_guest_nice double, vm_nr_dirty bigint"
    ),
    "blk": (
        "run int, elapsed bigint, device string, rdiops double, rdmerges double, rdkbps double, "
        "wriops double, wrmerges double, wrkbps double"
    ),
    "net": (
        "run int, elapsed bigint, device string, rxpktsps double, rxkbps double, "
        "txpktsps double, txkbps double"
    ),
}

REQUEST_COLUMNS: dict[str, str] = {
    "new_order": (
        "req_seq bigint, w_id int, d_id int, c_id int, "
        "lines array<struct<slot:int,ol_i_id:int,ol_supply_w_id:int,ol_quantity:int>>"
    ),
    "payment": (
        "req_seq bigint, w_id int, d_id int, c_w_id int, c_d_id int, c_id int, c_last string, "
        "h_amount decimal(6,2)"
    ),
    "order_status": "req_seq bigint, w_id int, d_id int, c_id int, c_last string",
    "stock_level": "req_seq bigint, w_id int, d_id int, threshold int",
    "delivery": "req_seq bigint, w_id int, o_carrier_id int",
}


def _plain(ddl: str) -> str:
    """The same columns with text types a DataFrame can carry."""
    return re.sub(r"\b(?:var)?char\(\d+\)", "string", ddl)


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(_plain(TABLE_COLUMNS[name]))


def log_schema(name: str) -> StructType:
    return StructType.fromDDL(LOG_COLUMNS[name])


def request_schema(name: str) -> StructType:
    return StructType.fromDDL(REQUEST_COLUMNS[name])


def conform(df, name: str):
    """Columns of `df` in table order and with the table's types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in table_schema(name)])


def conform_like(df, table):
    """Columns of `df` in the order and with the types of the DataFrame `table`.

    A new row has no place in the layout yet, so those columns are null.
    """
    new = [f.name for f in table.schema if f.name in LAYOUT and f.name not in df.columns]
    df = df.withColumns({n: F.lit(None) for n in new}) if new else df
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in table.schema])


def create_tables(spark: SparkSession, db: str, partitioned: bool = False) -> None:
    """Create the database and its ten typed parquet tables.

    Spark tables carry no enforced key, so the keyed and the keyless variant are the same; the
    duplicate checks stand in for the keys. With `partitioned`, the large tables are laid out by
    warehouse.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, cols in TABLE_COLUMNS.items():
        by = TABLE_KEYS[name][0]
        split = partitioned and name in ("customer", "new_order", "oorder", "order_line", "stock")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {db}.{name} ({cols}) USING parquet"
            + (f" PARTITIONED BY ({by})" if split else "")
        )


def drop_tables(spark: SparkSession, db: str) -> None:
    for name in TABLE_COLUMNS:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")


def truncate_tables(spark: SparkSession, db: str) -> None:
    """Empty the nine data tables; the load parameters stay."""
    for name in TABLE_COLUMNS:
        if name != "config":
            spark.sql(f"TRUNCATE TABLE {db}.{name}")
