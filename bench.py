"""Time the report queries; prints one JSON line.

BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list, default the reports below). Each query
runs in full into a sink that discards the rows. A small scale factor, if present, is run first so that the timings do
not include class loading and compilation of the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from tallywright.registry import QUERIES
from tallywright.session import build_session

REPORTS = (
    "stmt_transaction_level",
    "stmt_payout_level",
    "stmt_summary_level",
    "fee_profiles",
    "profitability_daily",
    "transaction_ledger",
    "operating_account",
    "merchant_processing_view",
    "store_dimension_remit",
    "store_dimension_brand",
    "store_accrual_balance",
    "store_period_transactions",
    "ff_settlement_wide",
    "franchise_fee_staging",
    "franchise_fee_report",
    "reconcile_fee_minimums",
    "workbook_split",
    "statement_pack",
    "statement_file_names",
    "statement_dispatch_manifest",
    "statement_batches",
    "address_timezone",
)


def run(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(REPORTS)
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = Path(sf_dir).parent / "sf0.001"
    if small.is_dir():
        for name in names:
            run(spark, name, str(small))
    seconds = {}
    for name in names:
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "report_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "state": "warm JVM, cold data",
            }
        )
    )


if __name__ == "__main__":
    main()
