"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) set the
input and the cores. Each query writes its whole result to the ``noop`` sink; the figure is
the better of two runs in one session, so compilation and first file reads are left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from millrace.plans.catalog import catalog
from millrace.session import build_session

HEADLINES = (
    "letter_counts", "vehicle_status", "large_deposit_join", "vehicle_check_in", "withdrawal_location_topic",
    "payment_topic", "country_now_and_home", "risk_by_birth_year", "click_events", "required_clicks_rejected",
    "uri_sums", "tumbling_uri_sums", "hopping_uri_sums", "latest_item_by_part", "count_latest_by_key",
    "station_table", "turnstile_summary", "status_board", "line_topology", "expected_entries", "incremental_ingest",
    "stream_uri_sums", "stream_hopping_uri_sums", "stream_large_deposit_join", "stream_status_board",
)


def seconds(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__driver__memory="12g",
                          spark__millrace__table__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog()
    times = {name: round(min(seconds(queries[name], spark, folder) for _ in range(2)), 3) for name in names}
    print(json.dumps({"metric": "total of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
