"""Print the physical plans of the headline operators (for PLANS.md).

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    text = re.sub(r"Location: InMemoryFileIndex\([^)]*\)", "", text)
    return "\n".join(line[:150] for line in text.splitlines())


def main(sf_dir: str) -> None:
    from pyspark.sql import functions as F

    from starfold.operators.keys import assign_dense_key
    from starfold.operators.lookups import Lookup, resolve_with_reasons
    from starfold.plans import quality
    from starfold.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")

    out = {}
    cmap = customer.select("c_custkey", (F.col("c_custkey") + 1).alias("client_key"))
    out["J1 dimension lookup (row count checked -> broadcast; pruned scans)"] = plan(
        resolve_with_reasons(orders.select("o_orderkey", "o_custkey"),
                             [Lookup("client", cmap, "c_custkey", "client_key", "o_custkey")]))
    omap = orders.select("o_orderkey", (F.col("o_orderkey") + 1).alias("order_sk"))
    out["J3 fact-to-fact lookup (sort-merge, null keys spread)"] = plan(
        resolve_with_reasons(lineitem.select("l_orderkey", "l_linenumber"),
                             [Lookup("order", omap, "o_orderkey", "order_sk", "l_orderkey",
                                     broadcast=False)]))
    out["G3 dense key, bucketed path (no single-partition exchange on the data)"] = plan(
        assign_dense_key(orders.select("o_orderkey"), ["o_orderkey"], "order_sk"))
    out["D13-D15 row rules of one table: one aggregate, one stack"] = plan(
        quality.evaluate({"t": lineitem}, [
            quality.RowRule("qty", "t", "l_quantity <= 0"),
            quality.RowRule("price", "t", "l_extendedprice < 0"),
            quality.RowRule("flag", "t", "l_returnflag IS NULL")]))
    out["Filter and projection pushed into the scan"] = plan(
        orders.filter(F.col("o_orderdate") >= "2000-01-01").select("o_orderkey"))
    for title, text in out.items():
        print(f"### {title}\n\n```\n{text}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
