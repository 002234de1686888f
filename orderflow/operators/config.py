"""Load parameters kept as name/value rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.schemas import table_schema


def config_rows(
    spark: SparkSession, warehouses: int, c_last: int, c_customer: int, c_item: int
) -> DataFrame:
    # Parameter names.
    rows = [
        ("warehouses", str(warehouses)),
        ("nURandCLast", str(c_last)),
        ("nURandCC_ID", str(c_customer)),
        ("nURandCI_ID", str(c_item)),
    ]
    return spark.createDataFrame(rows, table_schema("config"))


def get_config(config: DataFrame, name: str) -> str:
    """The value of one load parameter; an error when it is missing."""
    found = config.filter(F.col("cfg_name") == name).select("cfg_value").take(1)
    if not found:
        raise KeyError(f"no row named {name} in the config table")
    return found[0][0]
