"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores.  Each query is
built and run in full into a sink that discards its rows, once to warm up and then
``BENCH_RUNS`` times (default 1); the best time counts.  Times include deriving the listings
and pages that a query reads from the given tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forecourt.plans import catalog  # noqa: E402
from forecourt.session import build_session  # noqa: E402

HEADLINE = [
    "lm_fit_set", "lm_fit", "hot_deals", "best_deals", "price_quantiles",
    "frontier_new_links", "crawl_new_links", "harvest_batch", "parse_backlog", "parse_batch",
    "match_make", "match_make_unique", "fuzzy_match", "parse_listings",
]
SINGLE_RUN = {"parse_listings"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.time()
        frame = catalog.QUERIES[name](spark, sf_dir)
        frame.write.format("noop").mode("overwrite").save()
        return time.time() - started

    times = {}
    for name in HEADLINE:
        tries = [once(name)]
        if name not in SINGLE_RUN:
            tries = [once(name) for _ in range(runs)]
        times[name] = round(min(tries), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
