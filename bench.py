"""Seconds per headline query on the given tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from orderflow.plans import REGISTRY
from orderflow.session import drop_cuts, local_session

# The five transactions, their tables after a batch, the audit, the report and generation.
HEADLINE = [
    "stock_level",
    "order_status",
    "by_last_name",
    "no_status",
    "no_stock_quantity",
    "no_result",
    "pay_customer_after",
    "pay_bad_credit",
    "pay_result",
    "dl_customer_after",
    "dl_result",
    "check_all_sound",
    "tpm_total",
    "latency_series",
    "tx_summary",
    "running_tpm",
    "cpu_utilization",
    "blk_kbps",
    "gen_customer",
    "gen_stock",
    "gen_order_line",
    "stream_tpm",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    # Start-up of the session and its Python workers is not part of any query.
    REGISTRY["tpm_rows"].run(spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        begun = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    drop_cuts(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
