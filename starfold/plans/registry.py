"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the whole test tables.  Every computed
column is aliased to the name its SQL twin in ``oracle.py`` uses."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import date_key
from ..functions.predicates import is_all_lower, is_all_upper
from ..functions.text import label_to_bool, normalize_city, normalize_sex, strip_ws
from ..operators.calendar import calendar_spanning, date_series_between, insert_if_absent
from ..operators.keys import assign_dense_key, upsert_type1
from ..operators.lookups import (FkCheck, Lookup, REASONS, fk_audit, orphans,
                                 rejected, resolve_keys, temporal_violations)
from ..operators.profile import (batch_ranges, distinct_values, duplicate_keys, outside_domain,
                                 rule_counts, uniqueness)
from ..sources.parts import create_parts, upsert_parts
from ..sources.readers import CORRUPT, ingest_files, read_batches, with_batches
from ..sources.versions import Run
from ..sources.writers import read_copy, with_load_ts, write_copy
from ..session import ensure_checkpoint_dir
from ..streaming import incremental_load, load_report
from . import adapter, dims, facts, pipeline, quality, warehouse

Query = Callable[[SparkSession, str], DataFrame]
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return adapter.read_table(spark, sf_dir, name)


def _src(spark, sf_dir):
    return adapter.source_tables(spark, sf_dir)


# ------------------------------------------------------------ scalar functions
def f1_title_case(spark, sf_dir):
    c = _src(spark, sf_dir)["client"]
    return c.select("id_client", normalize_city("ville").alias("ville"))


def f2_map_fallback(spark, sf_dir):
    c = _src(spark, sf_dir)["client"]
    return c.select("id_client", normalize_sex("sexe").alias("sexe"))


def f3_flag(spark, sf_dir):
    g = _src(spark, sf_dir)["gare"]
    return g.select("id_gare", label_to_bool("electrification").alias("electrification"))


def f4_fill(spark, sf_dir):
    g = _src(spark, sf_dir)["gare"]
    return g.select("id_gare", F.coalesce("annee_mise_en_service", "annee_mise_service")
                    .alias("annee_mise_en_service"))


def f5_strip(spark, sf_dir):
    c = _src(spark, sf_dir)["client"]
    return c.select("id_client", strip_ws("ville").alias("ville"),
                    F.length(strip_ws("ville")).alias("len"))


# ------------------------------------------------------------ generators/keys
def g2_calendar(spark, sf_dir):
    return calendar_spanning(_t(spark, sf_dir, "orders"), "o_orderdate")


def g3_dense_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return assign_dense_key(o, ["o_orderkey"], "order_sk")


LINEITEM_ORDER = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate")


def g3_dense_key_lineitem(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return assign_dense_key(li, list(LINEITEM_ORDER), "line_sk").select(
        "line_sk", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def g3_text_key(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_name", "c_custkey")
    return assign_dense_key(c, ["c_name", "c_custkey"], "name_sk")


def g3_timestamp_key(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("ts", "event_id")
    return assign_dense_key(e, ["ts", "event_id"], "event_sk").select("event_id", "event_sk")


def g4_date_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", date_key("o_orderdate").alias("date_key"))


def g1_date_series(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("lo"),
                                        F.max("o_orderdate").alias("hi"))
    return date_series_between(o, "lo", "hi")


def s2_batches(spark, sf_dir):
    """Batches of 1,000 trips in key order, as paging through ORDER BY would
    cut them."""
    return with_batches(_src(spark, sf_dir)["trajet"], "trajet", 1000).select(
        "id_trajet", "batch")


def s2_batch_reads(spark, sf_dir):
    """The order lines read batch by batch; together they are the table."""
    li = _t(spark, sf_dir, "orders")
    table = schemas.TableSpec("orders", li.schema, natural_key=("o_orderkey",))
    parts = list(read_batches(li, table, max(1, li.count() // 6)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("o_orderkey", "o_custkey", "o_orderstatus")


def _folder(spark, name) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# Fixed values of the ingest query: keys whose distance is no number, and keys whose
# line ends after two fields.
BAD_NUMBER, BAD_LINE = (50, 1), (70, 3)


def s6_ingest(spark, sf_dir):
    """Trips of three periods as CSV files, some lines broken, some values of the wrong
    kind, in one scan: typed rows, and the lines that are none."""
    t = _src(spark, sf_dir)["trajet"]
    base, key = _folder(spark, "csv"), F.col("id_trajet")
    fields = [F.coalesce(F.col(f.name).cast("string"), F.lit(""))
              for f in schemas.TRAJET.schema.fields]
    at = schemas.TRAJET.columns.index("distance_km")
    fields[at] = F.when(key % BAD_NUMBER[0] == BAD_NUMBER[1], F.concat(F.lit("x"), fields[at])
                        ).otherwise(fields[at])
    line = F.when(key % BAD_LINE[0] == BAD_LINE[1], F.concat_ws(",", *fields[:2])).otherwise(
        F.concat_ws(",", *fields))
    year = F.year("date_depart")
    paths = []
    for i, (lo, hi) in enumerate(((0, 1997), (1997, 1999), (1999, 9999))):
        paths.append(f"{base}/{i}")
        t.filter((year >= lo) & (year < hi)).select(line.alias("value")).write.text(paths[-1])
    typed, _ = ingest_files(spark, paths, schemas.TRAJET, f"{base}/staged")
    return typed.select("id_trajet", "date_depart", "distance_km",
                        F.col(CORRUPT).alias("broken_line"),
                        F.array_join(REASONS, ",").alias("reasons"))


def k4_round_trip(spark, sf_dir):
    """Whole texts with tabs, line breaks, backslashes, nulls and empties, written in
    the COPY text format and read back."""
    d, key = _t(spark, sf_dir, "documents"), F.col("doc_id")
    odd = (F.when(key % 7 == 0, F.lit(None)).when(key % 7 == 1, F.lit(""))
           .when(key % 7 == 2, F.concat("text", F.lit("\t\\N\r\n\\")))
           .when(key % 7 == 3, F.lit("\\N")).otherwise(F.col("text")))
    rows = d.select("doc_id", odd.alias("text"), "lang")
    path = _folder(spark, "copy")
    write_copy(rows, path)
    return read_copy(spark, path, rows.schema)


def k5_load_ts(spark, sf_dir):
    o = with_load_ts(_t(spark, sf_dir, "orders"), "2024-05-01T02:30:00+02:00")
    return o.select("o_orderkey", F.date_format("load_ts", "yyyy-MM-dd HH:mm:ss").alias("load_ts"))


def s7_key_map(spark, sf_dir):
    return dims.key_map(dims.dim_train(_src(spark, sf_dir)["train"]), schemas.DIM_TRAIN)


def e3_batch_keys(spark, sf_dir):
    """Keys of an incremental load by yearly batches: batch n continues from
    the largest key of the batches before it, i.e. the dense rank by
    (batch, natural key)."""
    o = _t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("batch"), "o_orderkey")
    return assign_dense_key(o, ["batch", "o_orderkey"], "order_sk")


# Fixed values of the incremental query: which trips come in which batch, and which
# come again: (batch, period, key modulo, kilometres added).
PERIOD_ENDS = (1997, 1999)
REPEATS = ((1, 0, 20, 1000), (2, 0, 30, 2000), (2, 2, 40, 3000))


def _incremental(spark, sf_dir) -> str:
    """Three files of trips, one picked up by each run of the stream, with trips of
    earlier files and of the same file coming again; the folder that was loaded."""
    s = _src(spark, sf_dir)
    dm = warehouse.dimensions(s)
    lookups = facts.trip_lookups(dims.key_map(dm["dim_train"], schemas.DIM_TRAIN),
                                 dims.key_map(dm["dim_gare"], schemas.DIM_GARE))
    base = _folder(spark, "stream")
    year = F.year("date_depart")
    first, second = PERIOD_ENDS
    period = F.when(year < first, 0).when(year < second, 1).otherwise(2)
    t = s["trajet"].withColumn("_period", period)
    for batch in range(3):
        rows = t.filter(F.col("_period") == batch)
        for to, of, modulo, more in REPEATS:
            if to == batch:
                again = t.filter((F.col("_period") == of) & (F.col("id_trajet") % modulo == 0))
                rows = rows.unionByName(again.withColumn("distance_km",
                                                         F.col("distance_km") + more))
        rows.drop("_period").write.mode("append").parquet(f"{base}/landing")
        incremental_load(
            spark, f"{base}/landing", schemas.TRAJET.schema,
            lambda b: facts.resolve(b, "date_depart", lookups), f"{base}/loaded", "trajet_key",
            f"{base}/checkpoint", max_files_per_trigger=100_000,
            rejected_target=f"{base}/rejected", spec=schemas.FACT_TRAJET, index_fan_in=2)
    return base


def e3_incremental(spark, sf_dir):
    base = _incremental(spark, sf_dir)
    ok = spark.read.parquet(f"{base}/loaded").select(
        "batch_id", "trajet_key", "id_trajet", "date_key", "train_key", "distance_km",
        F.lit("").alias("reasons"))
    bad = spark.read.parquet(f"{base}/rejected").select(
        "batch_id", F.lit(None).cast("long").alias("trajet_key"), "id_trajet",
        date_key("date_depart").alias("date_key"), F.lit(None).cast("int").alias("train_key"),
        "distance_km", F.array_join(REASONS, ",").alias("reasons"))
    return ok.unionByName(bad)


def k6_stream_report(spark, sf_dir):
    return load_report(spark, f"{_incremental(spark, sf_dir)}/loaded")


# --------------------------------------------------------------------- joins
def _customer_map(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    return assign_dense_key(c, ["c_custkey"], "client_key")


def j1_resolve(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("date_key", date_key("o_orderdate"))
    out = resolve_keys(o, [Lookup("client", _customer_map(spark, sf_dir), "c_custkey",
                                  "client_key", "o_custkey")])
    return out.select("o_orderkey", "date_key", "client_key")


def j2_role_playing(spark, sf_dir):
    s = _src(spark, sf_dir)
    gmap = dims.key_map(dims.dim_gare(s["gare"]), schemas.DIM_GARE)
    out = resolve_keys(s["trajet"], [
        Lookup("gare_depart", gmap, "id_gare", "gare_key", "id_gare_depart", "gare_depart_key"),
        Lookup("gare_arrivee", gmap, "id_gare", "gare_key", "id_gare_arrivee", "gare_arrivee_key"),
    ])
    return out.select("id_trajet", "gare_depart_key", "gare_arrivee_key")


def j3_fact_to_fact(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    omap = g3_dense_key(spark, sf_dir).select("o_orderkey", "order_sk")
    out = resolve_keys(li, [Lookup("order", omap, "o_orderkey", "order_sk", "l_orderkey",
                                   broadcast=False)])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "order_sk")


def _trips(spark, sf_dir):
    s = _src(spark, sf_dir)
    dm = warehouse.dimensions(s)
    return s, dm, warehouse.trips(s, dm)


def j4_fact_trajet(spark, sf_dir):
    return _trips(spark, sf_dir)[2]["fact_trajet"]


def j5_fact_reservation(spark, sf_dir):
    s, dm, tr = _trips(spark, sf_dir)
    return warehouse.reservations(s, dm, tr)["fact_reservation"]


def j6_orphans(spark, sf_dir):
    s = _src(spark, sf_dir)
    return orphans(s["trajet"], "id_train", s["train"], "id_train").select("id_trajet", "id_train")


def j7_temporal(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                              "l_shipdate")
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                           "o_orderdate")
    return temporal_violations(li, o, "l_orderkey", F.col("o_orderdate") > F.col("l_shipdate"))


def j8_rejects(spark, sf_dir):
    # Resolve and filter: nothing is stored and no fact is numbered.
    s = _src(spark, sf_dir)
    dm = warehouse.dimensions(s)
    resolved = facts.resolve(s["trajet"], "date_depart", facts.trip_lookups(
        dims.key_map(dm["dim_train"], schemas.DIM_TRAIN),
        dims.key_map(dm["dim_gare"], schemas.DIM_GARE)))
    return rejected(resolved).select("id_trajet", "id_train", "id_gare_arrivee",
                      F.array_join(REASONS, ",").alias("reasons"))


def j8_quarantine(spark, sf_dir):
    """Trips with dates missing, distances below zero and ids that come again, loaded
    with ``constraints="quarantine"``: what was set aside, and why."""
    s = _src(spark, sf_dir)
    key, far = F.col("id_trajet"), F.col("distance_km")
    t = s["trajet"].withColumns({
        "date_depart": F.when(key % 60 == 1, F.lit(None)).otherwise(F.col("date_depart")),
        "distance_km": F.when(key % 75 == 3, F.lit(-1)).otherwise(far)})
    again = t.filter(key % 90 == 2).withColumn("distance_km", far + 5000)
    cfg = pipeline.LoadConfig(target=_folder(spark, "quarantine"), gate="off", load_ts=False,
                              constraints="quarantine")
    for name, source in (("dim_gare", "gare"), ("dim_train", "train")):
        pipeline.load_dimension(spark, s[source], name, cfg)
    pipeline.load_fact_trajet(spark, t.unionByName(again), cfg)
    return pipeline.read_table(spark, cfg.target, "fact_trajet_rejected").select(
        "id_trajet", "distance_km", F.array_join(REASONS, ",").alias("reasons"))


def j9_fk_audit(spark, sf_dir):
    s = _src(spark, sf_dir)
    checks = [FkCheck("trajet", "id_train", "train", "id_train"),
              FkCheck("trajet", "id_gare_depart", "gare", "id_gare"),
              FkCheck("trajet", "id_gare_arrivee", "gare", "id_gare"),
              FkCheck("reservation", "id_client", "client", "id_client"),
              FkCheck("reservation", "id_trajet", "trajet", "id_trajet"),
              FkCheck("trajet", "date_key", "dim_date", "date_key"),
              FkCheck("reservation", "date_key", "dim_date", "date_key")]
    # The calendar of the trips, to the day: earlier bookings fall outside it.
    days = calendar_spanning(s["trajet"], "date_depart", whole_years=False)
    return fk_audit({**s, "dim_date": days,
                     "trajet": s["trajet"].withColumn("date_key", date_key("date_depart")),
                     "reservation": s["reservation"].withColumn(
                         "date_key", date_key("date_reservation"))}, checks)


# -------------------------------------------------------------- aggregations
def a1_count(spark, sf_dir):
    parts = [_t(spark, sf_dir, n).agg(F.lit(n).alias("table_name"),
                                      F.count(F.lit(1)).cast("long").alias("total"))
             for n in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def a2_rules_one_pass(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return rule_counts(li, {
        "qty_not_positive": "l_quantity <= 0",
        "price_negative": "l_extendedprice < 0",
        "discount_out_of_range": "l_discount < 0 OR l_discount > 1",
        "tax_negative": "l_tax < 0",
        "returnflag_null": "l_returnflag IS NULL",
        "linenumber_over_7": "l_linenumber > 7",
    })


def a3_unique(spark, sf_dir):
    li = uniqueness(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    o = uniqueness(_t(spark, sf_dir, "orders"), ["o_orderkey"])
    return (li.select(F.lit("lineitem").alias("table_name"), "*")
            .unionByName(o.select(F.lit("orders").alias("table_name"), "*")))


def a4_distinct(spark, sf_dir):
    dc = dims.dim_client(_src(spark, sf_dir)["client"], with_keys=False)
    return distinct_values(dc.filter(F.col("sexe").isNotNull()), "sexe")


def a5_batches(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("batch", F.year("o_orderdate"))
    return batch_ranges(o, "batch", "o_orderkey")


def a6_rates(spark, sf_dir):
    wh = warehouse.from_test_tables(spark, sf_dir)
    names = ("d5_null_service_year", "d6_total_vs_price", "d10_reservation_after_trip")
    rules = [r for r in quality.warehouse_rules() if r.rule in names]
    return quality.evaluate(wh, rules)


# -------------------------------------------------------------- quality rules
def d2_duplicates(spark, sf_dir):
    return duplicate_keys(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def d3_domain(spark, sf_dir):
    dc = dims.dim_client(_src(spark, sf_dir)["client"], with_keys=False)
    return outside_domain(dc, "sexe", ["H", "F"])


def d4_case_shape(spark, sf_dir):
    c = _src(spark, sf_dir)["client"]
    cleaned = c.select(normalize_city("ville").alias("clean"), F.col("ville").alias("raw"))
    return cleaned.agg(
        F.count_if(is_all_upper("raw")).cast("long").alias("raw_upper"),
        F.count_if(is_all_lower("raw")).cast("long").alias("raw_lower"),
        F.count_if(is_all_upper("clean")).cast("long").alias("clean_upper"),
        F.count_if(is_all_lower("clean")).cast("long").alias("clean_lower"))


def d_report(spark, sf_dir):
    wh = warehouse.from_test_tables(spark, sf_dir)
    return quality.evaluate(wh, quality.warehouse_rules())


# ------------------------------------------------------------ dims and sinks
def t1_dim_client(spark, sf_dir):
    return dims.dim_client(_src(spark, sf_dir)["client"])


def t2_dim_gare(spark, sf_dir):
    return dims.dim_gare(_src(spark, sf_dir)["gare"])


def t3_dim_train(spark, sf_dir):
    return dims.dim_train(_src(spark, sf_dir)["train"])


def k7_insert_if_absent(spark, sf_dir):
    # The calendar of the order dates exists; the ship dates run past it.
    existing = calendar_spanning(_t(spark, sf_dir, "orders"), "o_orderdate", whole_years=False)
    new = calendar_spanning(_t(spark, sf_dir, "lineitem"), "l_shipdate", whole_years=False)
    return insert_if_absent(existing, new, ["date_key"])


def _status_changes(spark, sf_dir):
    """The dimension of the accounts with a non-negative balance, and every customer
    with the status of their orders."""
    s = _src(spark, sf_dir)
    existing = dims.dim_client(s["client"].filter(F.col("statut_compte") == "Actif"))
    o = _t(spark, sf_dir, "orders")
    latest = (s["client"].join(o.select(F.col("o_custkey").alias("id_client"),
                                        F.col("o_orderdate").alias("_mod"),
                                        F.col("o_orderstatus")), "id_client")
              .withColumn("statut_compte", F.col("o_orderstatus")).drop("o_orderstatus"))
    return existing, dims.clean_client(latest).select(
        *[c for c in existing.columns if c != "client_key"], "_mod")


UPSERT_BELOW = 500        # a fixed value: the customers of the partial upsert


def u1_copy_on_write(spark, sf_dir):
    """The same upsert for some customers, on a published dimension in parts: only the
    parts they fall in are read and written."""
    existing, incoming = _status_changes(spark, sf_dir)
    target = _folder(spark, "parts")
    run = Run(spark, target)
    create_parts(run, existing, schemas.DIM_CLIENT, max(1, existing.count() // 8))
    run.commit()
    run = Run(spark, target)
    upsert_parts(run, incoming.filter(F.col("id_client") < UPSERT_BELOW), schemas.DIM_CLIENT,
                 "_mod")
    run.commit()
    return pipeline.read_table(spark, target, "dim_client").select(
        "client_key", "id_client", "sexe", "ville", "statut_compte")


def u1_upsert(spark, sf_dir):
    """Type-1 upsert of the client dimension: the accounts with a non-negative
    balance were loaded first; then every customer's latest order brings its
    status (new customers are numbered on)."""
    existing, incoming = _status_changes(spark, sf_dir)
    out = upsert_type1(existing, incoming, "id_client", "client_key", version_col="_mod")
    return out.select("client_key", "id_client", "sexe", "ville", "statut_compte")


def _load(spark, sf_dir) -> str:
    base = _folder(spark, "load")
    cfg = pipeline.LoadConfig(target=base, gate="report", load_ts=False)
    pipeline.run(spark, _src(spark, sf_dir), cfg)
    return base


def _loaded(spark, sf_dir, table):
    """One load (E1) into a fresh folder below the checkpoint folder, and one of
    its tables read back through the version it committed."""
    return pipeline.read_table(spark, _load(spark, sf_dir), table)


def e1_fact_trajet(spark, sf_dir):
    return _loaded(spark, sf_dir, "fact_trajet")


def e1_fact_reservation(spark, sf_dir):
    return _loaded(spark, sf_dir, "fact_reservation")


def e2_report(spark, sf_dir):
    return _loaded(spark, sf_dir, "_quality")


def o1_period(spark, sf_dir):
    """Trips of some months from the published fact: one folder a year is read."""
    return pipeline.read_period(spark, _load(spark, sf_dir), "fact_trajet", 19970215, 19990110)


QUERIES: dict[str, Query] = {
    "f1_title_case": f1_title_case,
    "f2_map_fallback": f2_map_fallback,
    "f3_flag": f3_flag,
    "f4_fill": f4_fill,
    "f5_strip": f5_strip,
    "g2_calendar": g2_calendar,
    "g3_dense_key": g3_dense_key,
    "g3_dense_key_lineitem": g3_dense_key_lineitem,
    "g3_text_key": g3_text_key,
    "g3_timestamp_key": g3_timestamp_key,
    "g4_date_key": g4_date_key,
    "g1_date_series": g1_date_series,
    "s2_batches": s2_batches,
    "s2_batch_reads": s2_batch_reads,
    "s6_ingest": s6_ingest,
    "s7_key_map": s7_key_map,
    "k4_round_trip": k4_round_trip,
    "k5_load_ts": k5_load_ts,
    "e3_batch_keys": e3_batch_keys,
    "e3_incremental": e3_incremental,
    "k6_stream_report": k6_stream_report,
    "j1_resolve": j1_resolve,
    "j2_role_playing": j2_role_playing,
    "j3_fact_to_fact": j3_fact_to_fact,
    "j4_fact_trajet": j4_fact_trajet,
    "j5_fact_reservation": j5_fact_reservation,
    "j6_orphans": j6_orphans,
    "j7_temporal": j7_temporal,
    "j8_rejects": j8_rejects,
    "j8_quarantine": j8_quarantine,
    "j9_fk_audit": j9_fk_audit,
    "a1_count": a1_count,
    "a2_rules_one_pass": a2_rules_one_pass,
    "a3_unique": a3_unique,
    "a4_distinct": a4_distinct,
    "a5_batches": a5_batches,
    "a6_rates": a6_rates,
    "d2_duplicates": d2_duplicates,
    "d3_domain": d3_domain,
    "d4_case_shape": d4_case_shape,
    "d_report": d_report,
    "t1_dim_client": t1_dim_client,
    "t2_dim_gare": t2_dim_gare,
    "t3_dim_train": t3_dim_train,
    "k7_insert_if_absent": k7_insert_if_absent,
    "u1_upsert": u1_upsert,
    "u1_copy_on_write": u1_copy_on_write,
    "e1_fact_trajet": e1_fact_trajet,
    "e1_fact_reservation": e1_fact_reservation,
    "e2_report": e2_report,
    "o1_period": o1_period,
}
