"""The whole load (E1) and the gated, step-wise load.

Order: dimensions -> calendar -> trips -> reservations -> quality report ->
gate.  A load writes its tables to a folder of its own and checks them there; one
commit then shows all of them (``sources.versions``).  The next step reads the stored
table back, so lineage is cut at every table and a lost executor only recomputes the
current step.  Row counts come from ``Observation``s of the writes.

Every step is a function that runs alone from the current version and commits what it
wrote, and is idempotent: re-running a step replaces its table.  Trips loaded alone
empty the reservations, whose foreign key points at trip keys, in the same commit, as
a cascading truncate would; ``reload_trips`` rebuilds both in one commit.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.calendar import calendar_dimension, calendar_spanning, insert_if_absent
from ..operators.contract import project
from ..operators.keys import assign_dense_key, mark_repeats
from ..operators.lookups import REASONS, Lookup
from ..session import materialize, temporaries
from ..sources import versions
from ..sources.versions import Run
from ..sources.writers import Layout, PublishRefused, with_load_ts
from . import dims, facts, quality

CONSTRAINT_MODES = ("fail", "quarantine")


@dataclass
class LoadConfig:
    target: str                                  # base folder of the warehouse
    calendar: tuple[str, str] | None = None      # None: whole years spanning the facts
    constraints: str = "fail"                    # fail | quarantine
    gate: str = "full"                           # full | basic | report | off
    load_ts: bool = True                         # K5: add load_ts (one value per run)
    parallel_steps: int = 4                      # independent steps run as concurrent jobs
    strict_calendar: bool = False                # reject fact dates outside dim_date
    keep_versions: int = 2                       # older versions go after a commit
    report: list[dict] = field(default_factory=list)
    run_ts: str = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc)
                        .isoformat(timespec="seconds"))


# O1: the facts lie in one folder per year, sorted by date inside.  The year comes from
# the integer date key; ``read_period`` turns a period into both filters.
FACT_LAYOUT = {name: Layout({"_by_year": "date_key div 10000"}, ("date_key", key))
               for name, key in (("fact_trajet", "id_trajet"),
                                 ("fact_reservation", "id_reservation"))}


def read_table(spark: SparkSession, target: str, name: str, number: int | None = None
               ) -> DataFrame:
    """A published table, of the latest version unless a number is given."""
    return versions.read_version(spark, target, name, number)


def read_period(spark: SparkSession, target: str, name: str, first: int, last: int) -> DataFrame:
    """Rows of a fact whose ``date_key`` lies in [first, last] (yyyymmdd): only the
    folders of these years are listed, and row groups by the date inside them."""
    df = versions.read_version(spark, target, name, layout=True)
    kept = df.filter(F.col("_by_year").between(first // 10000, last // 10000)
                     & F.col("date_key").between(first, last))
    return kept.drop("_by_year")


def read_days(spark: SparkSession, target: str, name: str, days: DataFrame) -> DataFrame:
    """Rows of a fact on the days of ``days`` (rows of the calendar): the join on the
    year lets Spark prune the fact's folders at run time by the days that are left."""
    df = versions.read_version(spark, target, name, layout=True)
    d = days.select(F.col("date_key").alias("_day"), F.col("year").cast("int").alias("_year"))
    # A calendar has a row a day: a few thousand.
    kept = df.join(F.broadcast(d), (F.col("_by_year") == F.col("_year"))
                   & (F.col("date_key") == F.col("_day")), "left_semi")
    return kept.drop("_by_year")


@contextmanager
def _in_run(spark: SparkSession, cfg: LoadConfig, run: Run | None) -> Iterator[Run]:
    """The run a step belongs to; alone, a run of its own, committed at its end.
    Copies made on the way are removed."""
    if run is not None:
        yield run
        return
    own = Run(spark, cfg.target)
    try:
        with temporaries(spark):
            yield own
    except BaseException:
        own.abandon()
        raise
    own.commit()
    versions.vacuum(spark, cfg.target, cfg.keep_versions)


def _log(cfg: LoadConfig, table: str, rows: int, t0: float, rejected: int | None = None):
    cfg.report.append({"table_name": table, "rows": rows, "rejected": rejected,
                       "seconds": round(time.time() - t0, 3)})


def _checks(spec: schemas.TableSpec) -> dict[str, str]:
    """The declared NOT NULL / CHECK / VARCHAR rules of a table as violation
    predicates, counted while the staged copy is written."""
    return {r.rule: r.violation for r in quality.constraint_rules(spec)
            if isinstance(r, quality.RowRule)}


def _quarantine(df: DataFrame, spec: schemas.TableSpec) -> DataFrame:
    """Every declared rule an accepted row breaks (NOT NULL, CHECK, VARCHAR) as a
    reject reason."""
    extra = [F.when(F.coalesce(F.expr(r.violation), F.lit(False)), F.lit(r.rule.split("_", 1)[1]))
             for r in quality.constraint_rules(spec) if isinstance(r, quality.RowRule)
             and not r.rule.endswith(f":{spec.surrogate_key}")]
    broken = F.filter(F.array(*extra), lambda x: x.isNotNull())
    return df.withColumn(REASONS, F.when(F.size(REASONS) == 0, broken).otherwise(F.col(REASONS)))


def _quarantined(df: DataFrame, spec: schemas.TableSpec) -> DataFrame:
    """Rows with all their reasons: the given ones, broken rules, and ``unique`` for
    the accepted rows beyond the first of their key."""
    key = spec.natural_key[0]
    marked = materialize(_quarantine(df, spec), spec.name)
    good = mark_repeats(marked.filter(F.size(REASONS) == 0), [key], "_sf_again")
    good = good.withColumn(REASONS, F.when(F.col("_sf_again"), F.array(F.lit(f"unique:{key}")))
                           .otherwise(F.col(REASONS))).drop("_sf_again")
    return good.unionByName(marked.filter(F.size(REASONS) > 0))


def _refuse_duplicates(spec: schemas.TableSpec):
    """UNIQUE of the declared keys, checked on the staged copy of a table."""
    def check(staged: DataFrame) -> None:
        keys = [list(spec.natural_key)] + [[c] for c in spec.unique]
        for key in keys:
            worst = staged.groupBy(*key).count().agg(F.max("count")).first()[0]
            if worst and worst > 1:
                raise PublishRefused(f"{spec.name}: {key} is not unique")
    return check


def _contract(spec: schemas.TableSpec, cfg: LoadConfig):
    if not cfg.load_ts:
        return spec.schema
    return T.StructType(spec.schema.fields + [T.StructField("load_ts", T.TimestampType())])


def _stamp(df: DataFrame, cfg: LoadConfig) -> DataFrame:
    return with_load_ts(df, cfg.run_ts) if cfg.load_ts else df


def load_dimension(spark: SparkSession, source: DataFrame, name: str, cfg: LoadConfig,
                   run: Run | None = None) -> int:
    t0 = time.time()
    spec = schemas.WAREHOUSE[name]
    build = {"dim_client": dims.dim_client, "dim_gare": dims.dim_gare,
             "dim_train": dims.dim_train}[name]
    with _in_run(spark, cfg, run) as run:
        if cfg.constraints == "fail":
            rows = run.write(_stamp(build(source), cfg), name, _contract(spec, cfg),
                             checks=_checks(spec), validate=_refuse_duplicates(spec))
            _log(cfg, name, rows, t0)
            return rows
        plain = build(source, with_keys=False).withColumn(REASONS, F.array().cast("array<string>"))
        # Ordered and numbered with the rejects last, from one stored copy.
        marked = _quarantined(plain, spec).withColumn(facts.BAD, F.size(REASONS) > 0)
        keyed = assign_dense_key(marked, [facts.BAD, *spec.natural_key], spec.surrogate_key)
        good = project(keyed.filter(~F.col(facts.BAD)), spec.schema)
        rows = run.write(_stamp(good, cfg), name, _contract(spec, cfg))
        rejected = run.write(keyed.filter(F.col(facts.BAD)).drop(facts.BAD, spec.surrogate_key),
                             name + "_rejected")
        _log(cfg, name, rows, t0, rejected)
        return rows


def load_calendar(spark: SparkSession, sources: dict[str, DataFrame], cfg: LoadConfig,
                  run: Run | None = None) -> int:
    """G2 + K7: add the missing days to the calendar (existing rows kept).  Returns
    the number of days added."""
    t0 = time.time()
    with _in_run(spark, cfg, run) as run:
        if cfg.calendar is not None:
            new = calendar_dimension(spark, *cfg.calendar)
        else:
            days = (sources["trajet"].select(F.col("date_depart").alias("d"))
                    .unionByName(sources["reservation"]
                                 .select(F.col("date_reservation").alias("d"))))
            new = calendar_spanning(days, "d")
        before = 0
        if run.has("dim_date"):
            existing = run.read("dim_date")
            before = existing.count()
            new = existing.unionByName(insert_if_absent(existing, new, ["date_key"]))
        added = run.write(new, "dim_date", schemas.DIM_DATE.schema,
                          checks=_checks(schemas.DIM_DATE),
                          validate=_refuse_duplicates(schemas.DIM_DATE)) - before
        _log(cfg, "dim_date", added, t0)
        return added


def _key_map(run: Run, name: str) -> DataFrame:
    """The two key columns of a table of the run or of the version before."""
    spec = schemas.WAREHOUSE[name]
    return run.read(name).select(spec.natural_key[0], spec.surrogate_key)


def _load_fact(name: str, source: DataFrame, date_col: str, lookups, cfg: LoadConfig, run: Run,
               t0: float) -> int:
    """Resolve, store once in key order with the numbers, write in the table's layout.

    The resolution (all lookups, including the shuffled fact-to-fact join) is stored
    once, accepted rows first and in key order, which numbers them; accepted and
    rejected rows are read from that copy."""
    spec = schemas.WAREHOUSE[name]
    if cfg.strict_calendar:
        # The calendar as one more lookup: a date outside it is a reject
        # reason.  By default such rows are kept and reported by the date
        # foreign-key rule, as the reference accepts them.
        cal = run.read("dim_date").select(
            F.col("date_key").alias("_sf_cal_key"), F.lit(True).alias("_sf_in_calendar"))
        lookups = list(lookups) + [Lookup("date", cal, "_sf_cal_key", "_sf_in_calendar",
                                          "date_key")]
    resolved = facts.resolve(source, date_col, lookups)
    brought = source.columns
    if cfg.constraints == "quarantine":
        # Quarantined rows keep what they brought, resolved keys included.
        resolved = _quarantined(resolved, spec)
        brought = [c for c in resolved.columns if c not in (REASONS, "_sf_in_calendar")]
    ok, bad = facts.number(resolved, brought, spec)
    rows = run.write(_stamp(ok, cfg), name, _contract(spec, cfg),
                     checks=_checks(spec) if cfg.constraints == "fail" else None,
                     validate=_refuse_duplicates(spec), layout=FACT_LAYOUT[name])
    rejected = run.write(bad, name + "_rejected")
    _log(cfg, name, rows, t0, rejected)
    return rows


def load_fact_trajet(spark: SparkSession, trajet: DataFrame, cfg: LoadConfig,
                     run: Run | None = None) -> int:
    """J4 over the current dimensions.  Alone, the commit also empties the
    reservations: their trip keys may point elsewhere now."""
    t0, alone = time.time(), run is None
    with _in_run(spark, cfg, run) as run:
        lookups = facts.trip_lookups(_key_map(run, "dim_train"), _key_map(run, "dim_gare"))
        rows = _load_fact("fact_trajet", trajet, "date_depart", lookups, cfg, run, t0)
        if alone and run.has("fact_reservation"):
            empty = run.read("fact_reservation").limit(0)
            run.write(empty, "fact_reservation", layout=FACT_LAYOUT["fact_reservation"])
            run.drop("fact_reservation_rejected")
        return rows


def load_fact_reservation(spark: SparkSession, reservation: DataFrame, cfg: LoadConfig,
                          run: Run | None = None) -> int:
    """J5 over the current client dimension and trip fact."""
    t0 = time.time()
    with _in_run(spark, cfg, run) as run:
        lookups = facts.reservation_lookups(_key_map(run, "dim_client"),
                                            _key_map(run, "fact_trajet"))
        return _load_fact("fact_reservation", reservation, "date_reservation", lookups, cfg, run,
                          t0)


def reload_trips(spark: SparkSession, sources: dict[str, DataFrame], cfg: LoadConfig) -> None:
    """K3: a retry of the trip load.  Trip keys may move, and reservations point at
    trip keys, so both are rebuilt, and shown by one commit."""
    with _in_run(spark, cfg, None) as run:
        load_fact_trajet(spark, sources["trajet"], cfg, run)
        load_fact_reservation(spark, sources["reservation"], cfg, run)


def quality_report(spark: SparkSession, cfg: LoadConfig, sources: dict[str, DataFrame],
                   rules=None, run: Run | None = None) -> DataFrame:
    """The report over a run's tables, or those of the current version."""
    here = run or versions.current(spark, cfg.target)
    names = ["dim_date", *schemas.LOAD_ORDER, "fact_trajet_rejected",
             "fact_reservation_rejected"]
    tables = dict(sources)
    for name in names:
        if run is not None and run.has(name):
            tables[name] = run.read(name)
        elif run is None and name in here.tables:
            tables[name] = read_table(spark, cfg.target, name, here.number)
    return quality.evaluate(tables, rules if rules is not None else quality.warehouse_rules())


def purge(spark: SparkSession, cfg: LoadConfig) -> None:
    """K2: a version without the facts and dimensions and their rejects, before a full
    reload; the calendar is kept.  Their folders go when ``versions.vacuum`` runs."""
    with _in_run(spark, cfg, None) as run:
        for name in reversed(schemas.LOAD_ORDER):
            for table in (name, name + "_rejected"):
                run.drop(table)


def quality_check(spark: SparkSession, cfg: LoadConfig,
                  sources: dict[str, DataFrame] | None = None, rules=None) -> list[dict]:
    """E2's closing step, runnable alone on the published tables: evaluate
    the rules (by default the closing checks: negative amounts, client
    orphans, empty facts), publish the report as ``_quality``, and raise
    when a rule failed."""
    rules = quality.gate_rules() if rules is None else rules
    with _in_run(spark, cfg, None) as run:
        run.write(quality_report(spark, cfg, sources or {}, rules, run), "_quality")
    return quality.gate(read_table(spark, cfg.target, "_quality"))


def run(spark: SparkSession, sources: dict[str, DataFrame], cfg: LoadConfig) -> DataFrame:
    """The whole load in dependency order, then the quality gate.

    The constraints, the uniqueness of the keys and the gate are checked on the run's
    own tables.  Only then one commit shows them, all at once; a refused step, a failed
    gate or a driver that dies leaves the previous version whole, and ``recover`` ends
    what a dead driver left.  Returns the load report (table, rows, rejected, seconds);
    the quality report is published with the tables as ``_quality``."""
    versions.recover(spark, cfg.target)
    with _in_run(spark, cfg, None) as mine:
        _build(spark, sources, cfg, mine)
    return spark.createDataFrame(cfg.report,
                                 "table_name string, rows long, rejected long, seconds double")


def _build(spark: SparkSession, sources: dict[str, DataFrame], cfg: LoadConfig, run: Run) -> None:
    """All steps of a run."""
    # The dimensions and the calendar do not depend on each other: they run
    # as concurrent Spark jobs (the scheduler shares the executors).
    with ThreadPoolExecutor(max_workers=cfg.parallel_steps) as pool:
        steps = [pool.submit(copy_context().run, load_dimension, spark, sources[src], name, cfg,
                             run)
                 for name, src in (("dim_client", "client"), ("dim_gare", "gare"),
                                   ("dim_train", "train"))]
        steps.append(pool.submit(copy_context().run, load_calendar, spark, sources, cfg, run))
        for step in steps:
            step.result()
    load_fact_trajet(spark, sources["trajet"], cfg, run)
    load_fact_reservation(spark, sources["reservation"], cfg, run)
    if cfg.gate != "off":
        rules = quality.gate_rules() if cfg.gate == "basic" else quality.warehouse_rules()
        run.write(quality_report(spark, cfg, sources, rules, run), "_quality")
        if cfg.gate != "report":
            quality.gate(run.read("_quality"))
