"""Headline timings: one JSON line, warm wall seconds per query.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores.
Every query runs over its whole tables into the ``noop`` sink: one pass over all
queries to warm up, then the better of two timed runs. Building the DataFrame is
part of the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quartermill.catalog import load  # noqa: E402
from quartermill.session import get_session  # noqa: E402

HEADLINES = (
    "prefix_sum", "group_by_strings", "reshape_long", "reshape_semi_wide", "mirror_columns", "complete_grid", "lag_periods",
    "fill_downup", "find_dupes", "first_per_key", "share_of_total", "null_safe_map", "conform_map", "findings_by_level",
    "product_treatment", "product_site_lag",
)


def run(query, spark, folder: str) -> float:
    """Seconds to build and fully execute one query."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = load()
    names = sys.argv[1:] or HEADLINES
    timings = {}
    for name in names:
        run(catalog[name], spark, folder)
    for name in names:
        timings[name] = round(min(run(catalog[name], spark, folder) for _ in range(2)), 3)
    sf = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "warm wall seconds, headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
