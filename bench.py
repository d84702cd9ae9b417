"""Benchmark of the headline operators.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
Each query runs fully (noop sink, nothing collected), once to warm up and
then ``BENCH_REPEAT`` times (default 3); the median is reported.  ``value``
is the sum of the medians of the headline queries.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def session():
    from starfold.session import build_session
    scratch = tempfile.mkdtemp(prefix="starfold-bench-")
    spark = build_session(
        f"local[{CPUS}]", app_name="starfold-bench", shuffle_partitions=max(8, 2 * CPUS),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
               "spark.sql.warehouse.dir": os.path.join(scratch, "wh"),
               "spark.sql.files.maxPartitionBytes": "64m"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark, scratch


def run_df(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark, scratch = session()
    from pyspark.sql import functions as F

    from starfold.operators.keys import assign_dense_key
    from starfold.operators.profile import rule_counts
    from starfold.plans import adapter, pipeline, registry
    from starfold.plans.pipeline import LoadConfig

    def t(name):
        return adapter.read_table(spark, SF_DIR, name)

    rules = {
        "qty_not_positive": "l_quantity <= 0",
        "price_negative": "l_extendedprice < 0",
        "discount_out_of_range": "l_discount < 0 OR l_discount > 1",
        "tax_negative": "l_tax < 0",
        "returnflag_null": "l_returnflag IS NULL",
        "linenumber_over_7": "l_linenumber > 7",
    }
    order = list(registry.LINEITEM_ORDER)

    def e1_load():
        cfg = LoadConfig(target=tempfile.mkdtemp(prefix="dw-", dir=scratch), gate="report")
        pipeline.run(spark, adapter.source_tables(spark, SF_DIR), cfg)

    def j3_fact_to_fact():
        run_df(registry.j3_fact_to_fact(spark, SF_DIR))

    def g3_dense_key_lineitem():
        run_df(assign_dense_key(t("lineitem"), order, "k"))

    def g3_global_window_lineitem():
        from pyspark.sql import Window
        run_df(t("lineitem").withColumn("k", F.row_number().over(Window.orderBy(*order))))

    def a2_rules_one_pass():
        rule_counts(t("lineitem"), rules).collect()

    def a2_rule_per_scan():
        li = t("lineitem")
        for p in rules.values():
            li.filter(F.expr(p)).count()

    def j5_fact_reservation():
        run_df(registry.j5_fact_reservation(spark, SF_DIR))

    def d_report():
        run_df(registry.d_report(spark, SF_DIR))

    headline = {
        "e1_load": e1_load,
        "j3_fact_to_fact": j3_fact_to_fact,
        "g3_dense_key_lineitem": g3_dense_key_lineitem,
        "a2_rules_one_pass": a2_rules_one_pass,
        "j5_fact_reservation": j5_fact_reservation,
    }
    comparison = {
        "g3_global_window_lineitem": g3_global_window_lineitem,
        "a2_rule_per_scan": a2_rule_per_scan,
        "d_report": d_report,
    }
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    times: dict[str, float] = {}
    for name, fn in {**headline, **comparison}.items():
        if only and name not in only:
            continue
        fn()  # warm-up
        runs = []
        for _ in range(REPEAT):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        print(f"# {name}: {times[name]}s {[round(r, 3) for r in runs]}", file=sys.stderr,
              flush=True)
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    value = round(sum(v for k, v in times.items() if k in headline), 3)
    extra = {}
    if "e1_load" in times:
        src_rows = sum(df.count() for df in adapter.source_tables(spark, SF_DIR).values())
        extra = {"e1_source_rows": src_rows,
                 "e1_rows_per_sec": round(src_rows / times["e1_load"], 1)}
    print(json.dumps({"metric": "headline_median_sum", "value": value, "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else SF_DIR,
                      "cpus": CPUS, "repeat": REPEAT, **extra}))
    spark.stop()


if __name__ == "__main__":
    main()
