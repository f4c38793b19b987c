"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session (default: all)
BENCH_RUNS     timed rounds over all queries after two warm-up rounds (default 3); the median
               of each query counts
BENCH_QUERIES  names to run, separated by commas (default: the list below)

``python bench.py --plain`` times Spark SQL running each query's comparison statement
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.errors import ParseException

from dimkeeper.queries import ORACLES, QUERIES
from dimkeeper.queries.inputs import SCHEMAS, table
from dimkeeper.session import local_session

WARM_UPS = 2
HEADLINE = [
    "scd1_upsert",
    "merge_full_outer",
    "merge_update_set",
    "merge_evolve",
    "merge_ambiguous_keys",
    "scd2_change_rows",
    "scd2_merge",
    "scd2_merge_changed_only",
    "scd2_renumber",
    "scd3_change_rows",
    "scd3_merge",
    "scd4_merge",
    "v_as_of",
    "v_current",
    "v_restore",
    "v_history",
    "src_json_load",
]


def run(make) -> float:
    begin = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    cpus = os.environ.get("BENCH_CPUS", "*")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    plain = "--plain" in sys.argv
    if plain:
        for name in SCHEMAS:
            table(spark, folder, name).createOrReplaceTempView(name)

    times: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(WARM_UPS + runs):
        for name in list(times):
            if plain:
                make = lambda: spark.sql(ORACLES[name])
            else:
                make = lambda: QUERIES[name](spark, folder)
            try:
                times[name].append(run(make))
            except ParseException:
                if not plain:
                    raise
                print(f"{name}: not plain Spark SQL", file=sys.stderr)
                del times[name]
    seconds = {name: round(statistics.median(spent[WARM_UPS:]), 3) for name, spent in times.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "plain_sql_total" if plain else "dimension_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
