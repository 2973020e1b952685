"""Time the registered queries: one JSON line with seconds per query.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (names, comma-separated) may be set.
Each query is run once to the end, without collecting its rows; a short query
before the first one keeps the start of the JVM out of the figures.
"""

from __future__ import annotations

import json
import logging
import os
import sys
import time

from tillstream.plans.registry import QUERIES
from tillstream.session import build_session

HEADLINES = [
    "route_logs",
    "route_maxwell",
    "parse_orders",
    "user_info",
    "sku_info",
    "upsert_latest",
    "order_detail_enriched",
    "first_order_with_state",
    "order_info_enriched",
    "order_wide",
    "order_join_batches",
    "split_amount",
    "stat_trademark",
    "stat_category",
    "stat_spu",
    "stat_province",
    "stat_gender",
    "stat_age",
    "sliding_amount",
    "dau_first_seen",
    "dau_hour",
    "order_amount_hour",
    "realtime_total",
    "stream_wide",
    "stream_dau",
    "stream_stats",
    "stream_replayed_stats",
    "stream_first_order",
]


def main() -> None:
    # Streams log the time and the state of each batch.
    logging.basicConfig(stream=sys.stderr, format="%(message)s", level=logging.WARNING)
    logging.getLogger("tillstream").setLevel(logging.INFO)
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["stat_category_as_coded"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names.split(",") if names else HEADLINES:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("/sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
