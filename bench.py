"""Headline benchmark: prints ONE JSON line.

``local[$BENCH_CPUS]`` (default 4): warm runs, median of ``$BENCH_RUNS`` (default 5).

* profile_full     numeric profile + recommendation of every numeric column of lineitem (one pass)
* profile_sample   the same on the planned sample (5 %, floor 10 000, ceiling 100 000 rows)
* check_key        key check of lineitem (l_orderkey, l_linenumber) and orders (o_orderkey)
* load_partitioned full load of lineitem partitioned by ship year and return flag
* load_merge       keyed merge of the orders changed since 1997 into a loaded orders table
* profile_wide     profile of a 96-column table derived from lineitem's numeric columns (decimal,
                   double and integer expressions), the shape of the reference's published figures
                   (125 NUMBER columns); values per second are reported for it as well

Every run of a load writes a fresh folder under the session's checkpoint directory.
Set ``BENCH_EVENT_LOG`` to a folder to record Spark's event log (stage and task times) there.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lakeload.operators import profile as P  # noqa: E402
from lakeload.operators.keys import check_key  # noqa: E402
from lakeload.session import build_session, work_path  # noqa: E402
from lakeload.sinks.load import estimate_row_bytes, load  # noqa: E402
from lakeload.sources.files import read_table  # noqa: E402
from lakeload.sources.scan import scan_sample  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(master=f"local[{cpus}]", app="lakeload-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra=extra)
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    li_rows = lineitem.count()
    n_numeric = len(P.numeric_columns(lineitem))
    li_bytes = estimate_row_bytes(lineitem)
    or_bytes = estimate_row_bytes(orders)
    cut = F.lit("1997-01-01").cast("timestamp_ntz")

    def profile_full():
        P.recommend_types(P.profile_numbers(lineitem, table="lineitem")).collect()

    def profile_sample():
        sample = scan_sample(lineitem, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], rows=li_rows)
        P.recommend_types(P.profile_numbers(sample, table="lineitem")).collect()

    def check_keys():
        check_key(lineitem, ["l_orderkey", "l_linenumber"], "lineitem").unionByName(
            check_key(orders, ["o_orderkey"], "orders")).collect()

    def load_partitioned():
        load(lineitem, work_path(spark, "bench_parts"), "full", row_bytes=li_bytes,
             partitions=["l_shipdate=YEAR", "l_returnflag=IDENTITY"])

    merge_targets = []

    def merge_setup():
        t = work_path(spark, "bench_merge")
        load(orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")), t, "full",
             row_bytes=or_bytes)
        merge_targets.append(t)

    def load_merge():
        t = merge_targets.pop()
        changes = orders.where(F.col("o_orderdate") >= cut).withColumn("o_orderstatus", F.lit("U"))
        load(changes, t, "merge", key=["o_orderkey"], row_bytes=or_bytes)

    base = [c for _, c, _ in P.numeric_columns(lineitem)]
    derived = []
    for k in range(12):
        for c in base:
            x = F.col(c)
            if k % 3 == 0:
                e = x.cast("decimal(18,4)") * F.lit(k + 1)
            elif k % 3 == 1:
                e = x * F.lit(float(k + 1))
            else:
                e = (x * F.lit(k + 1)).cast("bigint") if c in base[:4] else x + F.lit(k)
            derived.append(e.alias(f"{c}_{k}"))
    wide = lineitem.select(*derived)

    def profile_wide():
        P.recommend_types(P.profile_numbers(wide, table="wide")).collect()

    cases = [("profile_full", profile_full, None), ("profile_sample", profile_sample, None),
             ("check_key", check_keys, None), ("load_partitioned", load_partitioned, None),
             ("load_merge", load_merge, merge_setup), ("profile_wide", profile_wide, None)]
    results = {}
    for name, fn, setup in cases:
        if setup:
            setup()
        fn()  # warm-up
        times = []
        for _ in range(runs):
            if setup:
                setup()
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 4)
    values = li_rows * n_numeric
    wide_values = li_rows * len(wide.columns)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": runs,
        "profile_values": values,
        "profile_values_per_sec": round(values / results["profile_full"]) if results["profile_full"] else None,
        "profile_wide_values": wide_values,
        "profile_wide_values_per_sec": round(wide_values / results["profile_wide"]) if results["profile_wide"] else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
