"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's result is first compared with its DuckDB oracle (which also warms
it up), then timed three times; the reported time is the median. Building a
query may run jobs (tables that are written once), so building is timed too.
Results are fully computed (``noop`` sink), not collected. Prints one JSON line;
``wrong`` lists queries whose result differed from the oracle.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

BENCH_SET = ["anchors_extracted", "items_deduped", "keyword_selected",
             "keyword_selected_table", "prompt_text", "digest", "digest_by_sender",
             "digest_parsed", "digest_raw", "message_bodies", "mail_date_parsed",
             "items_numbered", "digest_incremental"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or BENCH_SET

    from mailsift.plans.oracle import ORACLE_SQL
    from mailsift.plans.queries import QUERIES
    from mailsift.session import SPREAD_SETTING, get_spark
    from tests.oracle_check import compare, duck

    # The bench tables are files of one row group each: ask for rows to be dealt out.
    spark = get_spark("mailsift-bench", cpus=cpus, shuffle_partitions=int(cpus) * 2,
                      extra={SPREAD_SETTING: cpus})
    con, out, wrong = duck(sf_dir), {}, []
    for name in names:
        fn = QUERIES[name]
        if not compare(spark, con, name, fn, ORACLE_SQL[name], sf_dir)["ok"]:
            wrong.append(name)
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "median_query_sec_total", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf, "cpus": cpus, "wrong": wrong}))


if __name__ == "__main__":
    main()
