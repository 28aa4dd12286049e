"""Time headline queries and print one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. The
derived input tables are written first and timed as `derive_inputs`; the total
includes them.
"""

from __future__ import annotations

import json
import os
import time

from forecourt.session import local_session
from forecourt.sources.tpch import staged_inputs
from verification.queries import all_queries

HEADLINES = (
    "listing_fact",
    "market_fact_100",
    "market_bands",
    "metric_price_dealer",
    "metric_mileage_zip",
    "metric_price_style",
    "metric_price_snapshot_90",
    "metric_matrix_long",
    "wide_daily",
    "base_stats_ymm",
    "mad_style",
    "out_2std_log_6",
    "out_ntiles_11",
    "compare_methods",
    "mae_own",
    "backtest_oot",
    "mae_by_window",
    "rpt_cov_make_11",
)


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def discard(df) -> None:
    """Compute every row and column without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", int(os.environ.get("BENCH_CPUS", "8")))
    registered = all_queries()
    seconds = {"derive_inputs": timed(lambda: staged_inputs(spark, sf_dir))}
    for name in HEADLINES:
        seconds[name] = timed(lambda: discard(registered[name](spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
