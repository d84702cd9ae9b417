"""Data-quality rules D1-D16 and the gate D17.

Every rule yields one report row::

    rule, table_name, violations, total, rate, tolerance, passed

The rules are compiled into few passes:

* row rules (predicates) of a table into ONE aggregate, which also counts the table;
* uniqueness and foreign keys of all tables into one scan per table and one shuffle
  (``operators.key_measures``), a key that several rules ask for measured once;
* rules that compare columns of a child and a parent row into ONE left join per pair,
  which also gives the orphans of that foreign key.

``passed`` is ``violations == 0`` for a zero tolerance, ``rate < tolerance`` otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.key_measures import KeyMeasures
from ..operators.lookups import spread_nulls

REPORT_COLUMNS = ("rule", "table_name", "violations", "total", "rate", "tolerance", "passed")


@dataclass(frozen=True)
class RowRule:
    """A violation predicate on one table's rows (D4, D6-D9, D13-D15).  A null
    predicate is not a violation."""
    rule: str
    table: str
    violation: str
    tolerance: float = 0.0


@dataclass(frozen=True)
class CountMatch:
    """Target rows + rejected rows == source rows."""
    rule: str
    table: str
    source: str
    rejected: str | None = None
    tolerance: float = 0.0


@dataclass(frozen=True)
class Unique:
    """No key tuple appears twice; violations = rows beyond the first."""
    rule: str
    table: str
    key: tuple[str, ...]
    tolerance: float = 0.0


@dataclass(frozen=True)
class Domain:
    """D3: non-null values within an allowed set."""
    rule: str
    table: str
    column: str
    allowed: tuple = ()
    tolerance: float = 0.0


@dataclass(frozen=True)
class ForeignKeyRule:
    """Child rows without a parent row (a null key is an orphan)."""
    rule: str
    table: str
    column: str
    parent: str
    parent_column: str
    tolerance: float = 0.0


@dataclass(frozen=True)
class Later:
    """Child rows (joined to the parent on ``on``) whose ``column`` is
    after the parent's ``parent_column``; the rate is over all child rows."""
    rule: str
    table: str
    parent: str
    on: str
    column: str
    parent_column: str
    tolerance: float = 0.0


@dataclass(frozen=True)
class NotEmpty:
    """The table has at least one row."""
    rule: str
    table: str


Rule = RowRule | CountMatch | Unique | Domain | ForeignKeyRule | Later | NotEmpty


def _finish(measures: DataFrame) -> DataFrame:
    v, t, tol = F.col("violations"), F.col("total"), F.col("tolerance")
    rate = F.round(F.try_divide(v.cast("double"), t.cast("double")), 6)
    passed = F.when(tol == 0, v == 0).otherwise(F.coalesce(rate < tol, F.lit(True)))
    return measures.select("rule", "table_name", "violations", "total", rate.alias("rate"),
                           "tolerance", passed.alias("passed"))


def _violation_sql(r: RowRule | Domain) -> str:
    if isinstance(r, Domain):
        allowed = ", ".join("'" + str(a).replace("'", "''") + "'" for a in r.allowed)
        return f"`{r.column}` IS NOT NULL AND NOT (`{r.column}` IN ({allowed}))"
    return r.violation


def _sql_str(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row_pass(df: DataFrame, table: str, rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """All row-level rules of one table and its row count from ONE aggregate,
    unpivoted with a single ``stack``: ``place, measure``."""
    aggs, cells = ["count(1) AS _sf_total"], [f"{_sql_str(_rows(table))}, _sf_total"]
    for i, r in rules:
        if isinstance(r, NotEmpty):
            cells.append(f"'{_rule(i)}', CAST(_sf_total = 0 AS BIGINT)")
        else:
            aggs.append(f"count_if(coalesce(({_violation_sql(r)}), false)) AS _sf_v{i}")
            cells.append(f"'{_rule(i)}', _sf_v{i}")
    return df.agg(*[F.expr(a) for a in aggs]).selectExpr(
        f"stack({len(cells)}, {', '.join(cells)}) AS (place, measure)")


# Places of the measures a report is put together from.
def _rows(table: str) -> str:
    return f"rows:{table}"


def _rule(i: int) -> str:
    return f"rule:{i}"


def _key(domain, slot) -> str:
    return f"key:{domain}:{slot}"


def _pair_pass(tables: Mapping[str, DataFrame], child: str, parent: str, on: str, on_parent: str,
               rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """All rules on one pair of tables from one left join: ``place, measure``."""
    later = [r for _, r in rules if isinstance(r, Later)]
    c = tables[child].select(F.col(on).alias("_sf_on"),
                             *[F.col(r.column).alias(f"_sf_c{i}") for i, r in enumerate(later)])
    p = tables[parent].select(F.col(on_parent).alias("_sf_pk"), F.lit(False).alias("_sf_pnull"),
                              *[F.col(r.parent_column).alias(f"_sf_p{i}")
                                for i, r in enumerate(later)])
    # A null key matches nothing: such rows are dealt to all tasks.
    spread = spread_nulls(c, "_sf_on", "_sf_key", "_sf_null")
    if spread is None:
        cond = c["_sf_on"] == p["_sf_pk"]
    else:
        c = spread
        cond = (c["_sf_key"] == p["_sf_pk"]) & (c["_sf_null"] == p["_sf_pnull"])
    # The parent grows with the data, so it stays shuffled; AQE splits hot keys.
    joined = c.join(p.hint("shuffle_merge"), cond, "left")
    aggs, cells, n = [], [], 0
    for i, r in rules:
        if isinstance(r, Later):
            aggs.append(F.count_if(F.coalesce(F.col(f"_sf_c{n}") > F.col(f"_sf_p{n}"),
                                              F.lit(False))).alias(f"_sf_v{i}"))
            n += 1
        else:
            aggs.append(F.count_if(F.col("_sf_pk").isNull()).alias(f"_sf_v{i}"))
        cells.append(f"'{_rule(i)}', _sf_v{i}")
    return joined.agg(*aggs).selectExpr(f"stack({len(cells)}, {', '.join(cells)}) AS "
                                        "(place, measure)")


def evaluate(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """The quality report of ``rules`` over ``tables`` (name -> DataFrame).
    Building the report starts no job."""
    rules = list(rules)
    numbered = list(enumerate(rules))
    # The tables whose rows are counted, each once, and their row rules.
    by_table: dict[str, list[tuple[int, Rule]]] = {}
    for i, r in numbered:
        names = [r.table] + ([r.source] + ([r.rejected] if r.rejected else [])
                             if isinstance(r, CountMatch) else [])
        for name in names:
            by_table.setdefault(name, [])
        if isinstance(r, (RowRule, Domain, NotEmpty)):
            by_table[r.table].append((i, r))
    found = [_row_pass(tables[t], t, rs) for t, rs in by_table.items()]
    # Pairs that are joined anyway answer their foreign keys too.
    pairs: dict[tuple[str, str, str, str], list[tuple[int, Rule]]] = {}
    for i, r in numbered:
        if isinstance(r, Later):
            pairs.setdefault((r.table, r.parent, r.on, r.on), []).append((i, r))
    keys, places = KeyMeasures(), {}
    for i, r in numbered:
        if isinstance(r, Unique):
            places[i] = _key(*keys.unique(r.table, r.key))
        elif isinstance(r, ForeignKeyRule):
            pair = (r.table, r.parent, r.column, r.parent_column)
            if pair in pairs:
                pairs[pair].append((i, r))
            else:
                places[i] = _key(*keys.orphans(r.table, r.column, r.parent, r.parent_column))
    found += [_pair_pass(tables, *pair, rs) for pair, rs in pairs.items()]
    if places:
        found.append(keys.measure(tables).selectExpr(
            "concat('key:', domain, ':', slot) AS place", "violations AS measure"))
    # A few rows for each rule and table: one map, from which every line is read.
    one = reduce(DataFrame.unionByName, found).agg(
        F.map_from_entries(F.collect_list(F.struct("place", "measure"))).alias("_sf_m"))

    def at(place: str) -> Column:
        return F.coalesce(F.try_element_at("_sf_m", F.lit(place)), F.lit(0))
    lines = []
    for i, r in numbered:
        violations, total = at(places.get(i, _rule(i))), at(_rows(r.table))
        if isinstance(r, CountMatch):
            total = at(_rows(r.source))
            kept = at(_rows(r.table)) + (at(_rows(r.rejected)) if r.rejected else F.lit(0))
            violations = F.abs(total - kept)
        lines.append(F.struct(F.lit(r.rule).alias("rule"), F.lit(r.table).alias("table_name"),
                              violations.cast("long").alias("violations"),
                              total.cast("long").alias("total"),
                              F.lit(float(getattr(r, "tolerance", 0.0))).alias("tolerance")))
    return _finish(one.select(F.explode(F.array(*lines)).alias("_sf")).select("_sf.*"))


class QualityGateError(ValueError):
    pass


def gate(report: DataFrame) -> list[dict]:
    """Collect the (small, one row per rule) report and raise when a rule
    failed, with its measure in the message.  Returns the rows otherwise."""
    rows = [r.asDict() for r in report.collect()]
    failed = sorted((r for r in rows if not r["passed"]), key=lambda r: (r["rule"], r["table_name"]))
    if failed:
        lines = [f"{r['rule']} on {r['table_name']}: {r['violations']}/{r['total']}"
                 f" (rate {r['rate']}, tolerance {r['tolerance']})" for r in failed]
        raise QualityGateError("quality gate failed: " + "; ".join(lines))
    return rows


# ------------------------------------------------------------ rule catalogue
# The predicates and tolerances below.
def constraint_rules(spec: schemas.TableSpec) -> list[Rule]:
    """Rules implied by a table's declaration: NOT NULL (D13), CHECK (D14),
    VARCHAR length (D15), natural and surrogate key uniqueness (D2), foreign
    keys (D16)."""
    t = spec.name
    out: list[Rule] = []
    for c in spec.not_null:
        out.append(RowRule(f"d13_not_null:{c}", t, f"`{c}` IS NULL"))
    for ck in spec.checks:
        out.append(RowRule(f"d14_check:{ck.name}", t, f"NOT ({ck.predicate})"))
    for c, n in spec.varchar.items():
        out.append(RowRule(f"d15_length:{c}", t, f"length(`{c}`) > {n}"))
    if spec.natural_key:
        out.append(Unique("d2_unique:" + ",".join(spec.natural_key), t, spec.natural_key))
    for c in spec.unique:
        out.append(Unique(f"d2_unique:{c}", t, (c,)))
    if spec.surrogate_key:
        out.append(Unique(f"d2_unique:{spec.surrogate_key}", t, (spec.surrogate_key,)))
    for fk in spec.foreign_keys:
        out.append(ForeignKeyRule(f"d16_fk:{fk.column}", t, fk.column, fk.parent,
                                  fk.parent_column))
    return out


def warehouse_rules(rejected_suffix: str = "_rejected") -> list[Rule]:
    """The checks of the reference's quality tests and gate task, plus every
    declared constraint of the warehouse."""
    rules: list[Rule] = []
    for dw, src in schemas.SOURCE_OF.items():
        rej = (dw + rejected_suffix) if dw.startswith("fact_") else None
        rules.append(CountMatch("d1_count_match", dw, src, rej))
    rules += [
        Domain("d3_domain:sexe", "dim_client", "sexe", ("H", "F")),
        RowRule("d4_city_all_upper", "dim_client", "ville = upper(ville) AND length(ville) > 1"),
        RowRule("d4_city_all_lower", "dim_client", "ville = lower(ville) AND length(ville) > 1"),
        RowRule("d5_null_service_year", "dim_gare", "annee_mise_en_service IS NULL", 0.05),
        RowRule("d6_total_vs_price", "fact_reservation",
                "abs(montant_total - prix_unitaire * nb_passagers) > 0.01", 0.20),
        RowRule("d7_negative_amount", "fact_reservation", "montant_total < 0 OR prix_unitaire < 0"),
        RowRule("d8_passengers_positive", "fact_reservation", "nb_passagers <= 0"),
        RowRule("d9_distance_not_negative", "fact_trajet", "distance_km < 0"),
        Later("d10_reservation_after_trip", "fact_reservation", "fact_trajet", "trajet_key",
              "date_key", "date_key", 0.05),
        ForeignKeyRule("d11_orphan_client", "fact_reservation", "client_key", "dim_client",
                       "client_key"),
        ForeignKeyRule("d11_orphan_train", "fact_trajet", "train_key", "dim_train", "train_key"),
        NotEmpty("d12_not_empty", "fact_trajet"),
        NotEmpty("d12_not_empty", "fact_reservation"),
    ]
    for name in ("dim_date",) + schemas.LOAD_ORDER:
        rules += constraint_rules(schemas.WAREHOUSE[name])
    return rules


def gate_rules() -> list[Rule]:
    """The three checks of the reference's closing task: negative amounts,
    client orphans, empty facts."""
    return [
        RowRule("d7_negative_amount", "fact_reservation", "montant_total < 0 OR prix_unitaire < 0"),
        ForeignKeyRule("d11_orphan_client", "fact_reservation", "client_key", "dim_client",
                       "client_key"),
        NotEmpty("d12_not_empty", "fact_trajet"),
        NotEmpty("d12_not_empty", "fact_reservation"),
    ]
