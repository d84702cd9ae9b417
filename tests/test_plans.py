"""Plan checks: the physical plans the operators are meant to produce."""

from pyspark.sql import functions as F

from conftest import SF001, SF01
from starfold.operators.keys import assign_dense_key
from starfold.operators.lookups import Lookup, resolve_keys
from starfold.plans import registry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


# They load a warehouse or a stream and read a table back: a plain scan.
READ_BACK = ("e1_fact_trajet", "e1_fact_reservation", "e2_report", "e3_incremental", "o1_period",
             "k6_stream_report", "j8_quarantine", "u1_copy_on_write")


def test_no_python_evaluation_in_any_registered_query(spark):
    for name, fn in registry.QUERIES.items():
        if name in READ_BACK:
            continue
        p = _plan(fn(spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def _initial(df) -> str:
    return _plan(df).split("Initial Plan")[-1]


def test_the_report_reads_each_table_a_few_times(spark):
    p = _initial(registry.d_report(spark, SF001))
    # Per table: one pass for the row rules and counts, one for the keys; the two facts
    # once more for their join.  The calendar and two sources stand for two files each.
    assert p.count("FileScan") <= 25
    # One join of the two facts, one inside the source of the stations.
    assert p.count("SortMergeJoin") == 2 and "LeftAnti" not in p
    # The keys of all tables meet in one shuffle by domain and value.
    by_value = [x for x in p.splitlines() if "hashpartitioning(domain" in x and "number" in x]
    assert len(by_value) == 1


def test_rates_and_audit_read_what_they_need(spark):
    # The stored facts, and the trips once for the join on the trip key.
    p = _initial(registry.a6_rates(spark, SF001))
    assert p.count("FileScan") <= 5 and p.count("SortMergeJoin") == 1
    # Seven foreign keys: one scan per table (the stations read two files, the
    # calendar the trips), and no join but that of the stations' files.
    p = _initial(registry.j9_fk_audit(spark, SF001))
    assert p.count("FileScan") <= 7 and p.count("SortMergeJoin") <= 1
    assert "LeftAnti" not in p


def test_running_maximum_has_no_window_over_all_batches(spark):
    p = _plan(registry.a5_batches(spark, SF001))
    assert "Window" in p and "SinglePartition" not in p


def test_key_map_scan_is_pruned_and_dimension_broadcast(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    c = spark.read.parquet(f"{SF01}/customer.parquet").select("c_custkey",
                                                             (F.col("c_custkey") + 1).alias("sk"))
    out = resolve_keys(o.select("o_orderkey", "o_custkey"),
                       [Lookup("c", c, "c_custkey", "sk", "o_custkey")])
    formatted = _formatted(out)
    out.collect()
    # AQE measured the small side and broadcast it; nothing was counted before.
    final = _plan(out).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    assert "ReadSchema: struct<c_custkey:bigint>" in formatted
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in formatted


def test_fact_to_fact_is_a_shuffled_join(spark):
    p = _plan(registry.j3_fact_to_fact(spark, SF001))
    assert "SortMergeJoin" in p
    # Only the offsets of the stored partitions are broadcast.
    assert all("_sf_part" in line for line in p.splitlines() if "BroadcastHashJoin" in line)


KEYED = ["g3_dense_key", "g3_dense_key_lineitem", "g3_text_key", "g3_timestamp_key", "s2_batches",
         "s7_key_map", "j1_resolve", "j2_role_playing", "j3_fact_to_fact", "j4_fact_trajet",
         "j5_fact_reservation", "t1_dim_client", "t2_dim_gare", "t3_dim_train", "u1_upsert"]


def test_no_window_or_single_partition_on_data_in_keyed_queries(spark):
    for name in KEYED:
        p = _plan(registry.QUERIES[name](spark, SF001))
        assert "SinglePartition" not in p and "Window" not in p, name


def test_filters_reach_the_scan(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    df = o.filter(F.col("o_orderkey") < 100).select("o_orderkey")
    formatted = _formatted(df)
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,100)]" in formatted
    assert "ReadSchema: struct<o_orderkey:bigint>" in formatted
