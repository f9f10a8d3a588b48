"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marketlake.plans.queries import QUERIES  # noqa: E402
from marketlake.session import get_session  # noqa: E402

HEADLINES = (
    "stock_facts",
    "stock_facts_silver",
    "macro_facts",
    "dedup_ohlcv",
    "rank_trim_ohlcv",
    "macro_median_fill",
    "contract_ohlcv",
    "unique_violations",
    "surrogate_key",
    "upsert_ohlcv",
    "dq_suite_ohlcv",
    "dq_suite_company",
    "dq_suite_fx",
    "dq_suite_macro",
    "null_profile",
    "latest_snapshot",
    "json_rates_explode",
)


#: Whole flows, landing and all; not part of the total.
FLOWS = ("historical_silver", "daily_silver", "stream_silver")


def run(spark, sf_dir: str, name: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = get_session(
        app="bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in (*HEADLINES, *FLOWS) if not sys.argv[1:] or n in sys.argv[1:]]
    run(spark, sf_dir, "stock_facts")  # session start and first compilation are not part of a query

    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(spark, sf_dir, name)
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(s for name, s in seconds.items() if name not in FLOWS), 3),
                "flows": round(sum(s for name, s in seconds.items() if name in FLOWS), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
