"""SQL twins of the registered queries, for DuckDB over the same parquet
tables (views ``region nation customer ... events``).  Written independently
of the Spark code: plain joins, ``row_number() OVER (ORDER BY ...)`` for dense
keys, ``NOT EXISTS`` for orphans."""

from __future__ import annotations

from pyspark.sql import types as T

from .. import schemas

# ------------------------------------------------------------------ helpers


def _sql_type(t: T.DataType) -> str:
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return {T.IntegerType: "INTEGER", T.ShortType: "SMALLINT", T.LongType: "BIGINT",
            T.StringType: "VARCHAR", T.DateType: "DATE", T.BooleanType: "BOOLEAN",
            T.DoubleType: "DOUBLE"}[type(t)]


def _conform(select_sql: str, schema: T.StructType, provided: set[str]) -> str:
    cols = ", ".join(
        f"CAST({f.name if f.name in provided else 'NULL'} AS {_sql_type(f.dataType)}) AS {f.name}"
        for f in schema.fields)
    return f"SELECT {cols} FROM ({select_sql})"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def title(x: str) -> str:
    return (rf"array_to_string(list_transform(regexp_extract_all({x}, '(\p{{L}}+|[^\p{{L}}]+)', 1),"
            r" lambda r: upper(r[1]) || lower(r[2:])), '')")


def city(x: str) -> str:
    return title(strip(x))


def sex(x: str) -> str:
    s = strip(x)
    return (f"coalesce(CASE lower({s}) WHEN 'homme' THEN 'H' WHEN 'femme' THEN 'F' "
            f"WHEN 'h' THEN 'H' WHEN 'f' THEN 'F' WHEN 'm' THEN 'H' END, upper(substr({s}, 1, 1)))")


def flag(x: str) -> str:
    return f"CASE {x} WHEN 'Electrifiée' THEN true WHEN 'Non électrifiée' THEN false END"


def dkey(x: str) -> str:
    return f"CAST(year({x}) * 10000 + month({x}) * 100 + day({x}) AS INTEGER)"


# ---------------------------------------------------------- source adapter
_CLIENT = """SELECT c_custkey AS id_client, c_name AS nom,
  CASE c_custkey % 6 WHEN 0 THEN 'Homme' WHEN 1 THEN 'FEMME' WHEN 2 THEN ' m '
                     WHEN 3 THEN 'f' WHEN 4 THEN 'Xyz' END AS sexe,
  CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN lower(c_mktsegment)
                     ELSE '  ' || c_mktsegment || '  ' END AS ville,
  CASE WHEN c_acctbal < 0 THEN 'Inactif' ELSE 'Actif' END AS statut_compte
FROM customer"""
_GARE = """SELECT n_nationkey AS id_gare, n_name AS nom_gare, r_name AS ville, r_name AS region,
  CASE n_nationkey % 3 WHEN 0 THEN 'Electrifiée' WHEN 1 THEN 'Non électrifiée' END
    AS electrification,
  CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_nationkey + 1950 END AS annee_mise_en_service,
  CASE WHEN n_nationkey % 8 = 0 THEN NULL ELSE n_nationkey + 1900 END AS annee_mise_service
FROM nation JOIN region ON n_regionkey = r_regionkey"""
_TRAIN = """SELECT p_partkey AS id_train, p_name AS code_train, p_type AS type_train,
  p_size * 10 AS capacite_totale, p_type AS ville_depart, p_brand AS ville_arrivee FROM part"""
_TRAJET = """SELECT o_orderkey AS id_trajet,
  CASE WHEN o_orderkey % 50 = 0 THEN -1 ELSE o_custkey END AS id_train,
  o_orderkey % 25 AS id_gare_depart, (o_orderkey * 7 + 3) % 26 AS id_gare_arrivee,
  CAST(o_orderdate AS DATE) AS date_depart, floor(o_totalprice / 1000) AS distance_km,
  o_orderstatus AS statut_circulation FROM orders"""
_RESERVATION = """SELECT event_id AS id_reservation, user_id AS id_client, event_id AS id_trajet,
  CAST(CAST(ts AS DATE) - INTERVAL 29 YEAR AS DATE) AS date_reservation,
  CAST(value AS DECIMAL(10,2)) AS prix_unitaire,
  CAST(event_id % 4 + 1 AS SMALLINT) AS nb_passagers,
  CAST(CAST(CAST(value AS DECIMAL(10,2)) * CAST(event_id % 4 + 1 AS SMALLINT) AS DECIMAL(12,2))
       + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS montant_total,
  event_type AS canal_vente FROM events"""

_SRC = {
    "client": _conform(_CLIENT, schemas.CLIENT.schema,
                       {"id_client", "nom", "sexe", "ville", "statut_compte"}),
    "gare": _conform(_GARE, schemas.GARE.schema,
                     {"id_gare", "nom_gare", "ville", "region", "electrification",
                      "annee_mise_en_service", "annee_mise_service"}),
    "train": _conform(_TRAIN, schemas.TRAIN.schema,
                      {"id_train", "code_train", "type_train", "capacite_totale",
                       "ville_depart", "ville_arrivee"}),
    "trajet": _conform(_TRAJET, schemas.TRAJET.schema,
                       {"id_trajet", "id_train", "id_gare_depart", "id_gare_arrivee",
                        "date_depart", "distance_km", "statut_circulation"}),
    "reservation": _conform(_RESERVATION, schemas.RESERVATION.schema,
                            {"id_reservation", "id_client", "id_trajet", "date_reservation",
                             "prix_unitaire", "nb_passagers", "montant_total", "canal_vente"}),
}

_DIM_CLIENT = f"""SELECT CAST(row_number() OVER (ORDER BY id_client) AS INTEGER) AS client_key,
  id_client, nom, prenom, date_naissance, {sex('sexe')} AS sexe, type_client,
  {city('ville')} AS ville, code_postal, pays, email, telephone, date_creation_compte,
  statut_compte FROM client_src"""
_DIM_GARE = f"""SELECT CAST(row_number() OVER (ORDER BY id_gare) AS INTEGER) AS gare_key,
  id_gare, nom_gare, {city('ville')} AS ville, region, pays, nb_quais, type_gare, taille_gare,
  {flag('electrification')} AS electrification,
  coalesce(annee_mise_en_service, annee_mise_service) AS annee_mise_en_service,
  latitude, longitude, categorie_strategique FROM gare_src"""
_DIM_TRAIN = f"""SELECT CAST(row_number() OVER (ORDER BY id_train) AS INTEGER) AS train_key,
  id_train, code_train, type_train, capacite_totale, capacite_classe1, capacite_classe2,
  {city('ville_depart')} AS ville_depart_base, {city('ville_arrivee')} AS ville_arrivee_base,
  annee_mise_en_service, statut_train, duree_estimee_minutes, energie FROM train_src"""
_FACT_TRAJET = f"""SELECT CAST(row_number() OVER (ORDER BY t.id_trajet) AS BIGINT) AS trajet_key,
  t.id_trajet, {dkey('t.date_depart')} AS date_key, tr.train_key,
  gd.gare_key AS gare_depart_key, ga.gare_key AS gare_arrivee_key, t.heure_depart,
  t.heure_arrivee_prevue, t.distance_km, t.statut_circulation
FROM trajet_src t JOIN dim_train tr ON t.id_train = tr.id_train
  JOIN dim_gare gd ON t.id_gare_depart = gd.id_gare
  JOIN dim_gare ga ON t.id_gare_arrivee = ga.id_gare"""
_TRAJET_REJECTED = """SELECT t.*, concat_ws(',',
    CASE WHEN tr.train_key IS NULL THEN 'train' END,
    CASE WHEN gd.gare_key IS NULL THEN 'gare_depart' END,
    CASE WHEN ga.gare_key IS NULL THEN 'gare_arrivee' END) AS reasons
FROM trajet_src t LEFT JOIN dim_train tr ON t.id_train = tr.id_train
  LEFT JOIN dim_gare gd ON t.id_gare_depart = gd.id_gare
  LEFT JOIN dim_gare ga ON t.id_gare_arrivee = ga.id_gare
WHERE tr.train_key IS NULL OR gd.gare_key IS NULL OR ga.gare_key IS NULL"""
_FACT_RESERVATION = f"""SELECT
  CAST(row_number() OVER (ORDER BY r.id_reservation) AS BIGINT) AS reservation_key,
  r.id_reservation, {dkey('r.date_reservation')} AS date_key, c.client_key, t.trajet_key,
  r.tarif_type, r.classe_reservee, r.prix_unitaire, r.nb_passagers, r.montant_total,
  r.canal_vente, r.mode_paiement, r.statut_reservation
FROM reservation_src r JOIN dim_client c ON r.id_client = c.id_client
  JOIN fact_trajet t ON r.id_trajet = t.id_trajet"""
_RESERVATION_REJECTED = """SELECT r.* FROM reservation_src r
  LEFT JOIN dim_client c ON r.id_client = c.id_client
  LEFT JOIN fact_trajet t ON r.id_trajet = t.id_trajet
WHERE c.client_key IS NULL OR t.trajet_key IS NULL"""


def _calendar(days_sql: str, whole_years: bool = True) -> str:
    """Calendar spanning the dates of ``days_sql`` (column d), by default
    widened to whole years."""
    lo, hi = "min(d)", "max(d)"
    if whole_years:
        lo = "CAST(date_trunc('year', min(d)) AS DATE)"
        hi = "CAST(date_trunc('year', max(d)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE)"
    return f"""SELECT {dkey('d')} AS date_key, d AS full_date,
  CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
  CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name,
  CAST(day(d) AS SMALLINT) AS day_of_month, CAST(isodow(d) AS SMALLINT) AS day_of_week,
  dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT CAST(unnest(generate_series({lo}, {hi}, INTERVAL 1 DAY)) AS DATE) AS d
      FROM ({days_sql}))"""


_DIM_DATE = _calendar("SELECT date_depart AS d FROM trajet_src "
                      "UNION ALL SELECT date_reservation FROM reservation_src")

_CTES = {
    "client_src": _SRC["client"], "gare_src": _SRC["gare"], "train_src": _SRC["train"],
    "trajet_src": _SRC["trajet"], "reservation_src": _SRC["reservation"],
    "dim_client": _DIM_CLIENT, "dim_gare": _DIM_GARE, "dim_train": _DIM_TRAIN,
    "fact_trajet": _FACT_TRAJET, "fact_trajet_rejected": _TRAJET_REJECTED,
    "fact_reservation": _FACT_RESERVATION, "fact_reservation_rejected": _RESERVATION_REJECTED,
    "dim_date": _DIM_DATE,
}


def with_warehouse(body: str) -> str:
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in _CTES.items())
    return f"WITH {ctes}\n{body}"


# ------------------------------------------------------------ quality rules
# Fixed values, written down a second time on purpose (from the declared tables and the
# quality tests), so that a rule missing or wrong on the Spark side shows.
_KEYS = {
    "dim_date": ("date_key", "full_date"), "dim_client": ("id_client", "client_key"),
    "dim_gare": ("id_gare", "gare_key"), "dim_train": ("id_train", "train_key"),
    "fact_trajet": ("id_trajet", "trajet_key"),
    "fact_reservation": ("id_reservation", "reservation_key"),
}
_REQUIRED = {
    "dim_date": "date_key full_date year quarter month month_name day_of_month day_of_week "
                "day_name is_weekend",
    "dim_client": "client_key id_client",
    "dim_gare": "gare_key id_gare nom_gare",
    "dim_train": "train_key id_train code_train",
    "fact_trajet": "trajet_key id_trajet date_key train_key gare_depart_key gare_arrivee_key",
    "fact_reservation": "reservation_key id_reservation date_key client_key trajet_key "
                        "prix_unitaire nb_passagers montant_total",
}
_LENGTHS = {
    "dim_date": {"month_name": 10, "day_name": 10},
    "dim_client": {"nom": 50, "prenom": 50, "sexe": 1, "type_client": 30, "ville": 50,
                   "code_postal": 10, "pays": 50, "email": 100, "telephone": 20,
                   "statut_compte": 20},
    "dim_gare": {"nom_gare": 60, "ville": 50, "region": 50, "pays": 50, "type_gare": 30,
                 "taille_gare": 20, "categorie_strategique": 30},
    "dim_train": {"code_train": 20, "type_train": 20, "ville_depart_base": 50,
                  "ville_arrivee_base": 50, "statut_train": 20, "energie": 20},
    "fact_trajet": {"statut_circulation": 20},
    "fact_reservation": {"tarif_type": 20, "classe_reservee": 10, "canal_vente": 20,
                         "mode_paiement": 30, "statut_reservation": 20},
}
_CHECKS = {
    ("fact_trajet", "distance_km_not_negative"): "distance_km < 0",
    ("fact_reservation", "prix_unitaire_not_negative"): "prix_unitaire < 0",
    ("fact_reservation", "nb_passagers_positive"): "nb_passagers < 1",
    ("fact_reservation", "montant_total_not_negative"): "montant_total < 0",
}
_REFERENCES = (
    ("fact_trajet", "date_key", "dim_date", "date_key"),
    ("fact_trajet", "train_key", "dim_train", "train_key"),
    ("fact_trajet", "gare_depart_key", "dim_gare", "gare_key"),
    ("fact_trajet", "gare_arrivee_key", "dim_gare", "gare_key"),
    ("fact_reservation", "date_key", "dim_date", "date_key"),
    ("fact_reservation", "client_key", "dim_client", "client_key"),
    ("fact_reservation", "trajet_key", "fact_trajet", "trajet_key"),
)
_ROW_RULES = (
    ("d3_domain:sexe", "dim_client", "sexe <> 'H' AND sexe <> 'F'", 0.0),
    ("d4_city_all_upper", "dim_client", "ville = upper(ville) AND length(ville) > 1", 0.0),
    ("d4_city_all_lower", "dim_client", "ville = lower(ville) AND length(ville) > 1", 0.0),
    ("d5_null_service_year", "dim_gare", "annee_mise_en_service IS NULL", 0.05),
    ("d6_total_vs_price", "fact_reservation",
     "abs(montant_total - prix_unitaire * nb_passagers) > 0.01", 0.2),
    ("d7_negative_amount", "fact_reservation", "montant_total < 0 OR prix_unitaire < 0", 0.0),
    ("d8_passengers_positive", "fact_reservation", "nb_passagers <= 0", 0.0),
    ("d9_distance_not_negative", "fact_trajet", "distance_km < 0", 0.0),
)


def _line(rule: str, table: str, v: str, tol: float = 0.0, total: str | None = None) -> str:
    total = total or f"(SELECT count(*) FROM {table})"
    rate = "round(CAST(v AS DOUBLE) / nullif(CAST(t AS DOUBLE), 0), 6)"
    passed = "v = 0" if tol == 0 else f"coalesce({rate} < {tol!r}, true)"
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, CAST(v AS BIGINT) AS violations,"
            f" CAST(t AS BIGINT) AS total, {rate} AS rate, CAST({tol!r} AS DOUBLE) AS tolerance,"
            f" {passed} AS passed FROM (SELECT {v} AS v, {total} AS t)")


def _where(table: str, bad: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {bad})"


def _orphans(child: str, col: str, parent: str, parent_col: str) -> str:
    return (f"(SELECT count(*) FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p"
            f" WHERE p.{parent_col} = c.{col}))")


def report_lines() -> dict[tuple[str, str], str]:
    """(rule, table) -> one row of the report."""
    out = {}

    def add(rule, table, v, tol=0.0, total=None):
        out[rule, table] = _line(rule, table, v, tol, total)
    for dw, src in (("dim_client", "client_src"), ("dim_gare", "gare_src"),
                    ("dim_train", "train_src"), ("fact_trajet", "trajet_src"),
                    ("fact_reservation", "reservation_src")):
        kept = f"(SELECT count(*) FROM {dw})"
        if dw.startswith("fact_"):
            kept += f" + (SELECT count(*) FROM {dw}_rejected)"
        source = f"(SELECT count(*) FROM {src})"
        add("d1_count_match", dw, f"abs({source} - ({kept}))", 0.0, source)
    for rule, table, bad, tol in _ROW_RULES:
        add(rule, table, _where(table, bad), tol)
    add("d10_reservation_after_trip", "fact_reservation",
        "(SELECT count(*) FROM fact_reservation r JOIN fact_trajet t ON r.trajet_key = t.trajet_key"
        " WHERE r.date_key > t.date_key)", 0.05)
    add("d11_orphan_client", "fact_reservation",
        _orphans("fact_reservation", "client_key", "dim_client", "client_key"))
    add("d11_orphan_train", "fact_trajet",
        _orphans("fact_trajet", "train_key", "dim_train", "train_key"))
    for table in ("fact_trajet", "fact_reservation"):
        add("d12_not_empty", table, f"CAST((SELECT count(*) FROM {table}) = 0 AS INTEGER)")
    for table, keys in _KEYS.items():
        for c in _REQUIRED[table].split():
            add(f"d13_not_null:{c}", table, _where(table, f"{c} IS NULL"))
        for c, n in _LENGTHS[table].items():
            add(f"d15_length:{c}", table, _where(table, f"length({c}) > {n}"))
        for c in keys:
            add(f"d2_unique:{c}", table,
                f"(SELECT count(*) - count(DISTINCT {c}) FROM {table} WHERE {c} IS NOT NULL)")
    for (table, name), bad in _CHECKS.items():
        add(f"d14_check:{name}", table, _where(table, bad))
    for child, col, parent, parent_col in _REFERENCES:
        add(f"d16_fk:{col}", child, _orphans(child, col, parent, parent_col))
    return out


def report_sql(names: tuple[str, ...] | None = None) -> str:
    return with_warehouse("\nUNION ALL\n".join(
        sql for (rule, _), sql in report_lines().items() if names is None or rule in names))


# ------------------------------------------------------------------ queries
LINEITEM_ORDER = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                  "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

ORACLE: dict[str, str] = {
    "f1_title_case": with_warehouse(f"SELECT id_client, {city('ville')} AS ville FROM client_src"),
    "f2_map_fallback": with_warehouse(f"SELECT id_client, {sex('sexe')} AS sexe FROM client_src"),
    "f3_flag": with_warehouse(
        f"SELECT id_gare, {flag('electrification')} AS electrification FROM gare_src"),
    "f4_fill": with_warehouse("SELECT id_gare, coalesce(annee_mise_en_service, annee_mise_service)"
                              " AS annee_mise_en_service FROM gare_src"),
    "f5_strip": with_warehouse(f"SELECT id_client, {strip('ville')} AS ville,"
                               f" CAST(length({strip('ville')}) AS INTEGER) AS len FROM client_src"),
    "g2_calendar": _calendar("SELECT CAST(o_orderdate AS DATE) AS d FROM orders"),
    "g3_dense_key": "SELECT o_orderkey, o_custkey, CAST(row_number() OVER (ORDER BY o_orderkey)"
                    " AS BIGINT) AS order_sk FROM orders",
    "g3_dense_key_lineitem": f"SELECT line_sk, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM"
                             f" (SELECT *, CAST(row_number() OVER (ORDER BY {LINEITEM_ORDER})"
                             f" AS BIGINT) AS line_sk FROM lineitem)",
    "g3_text_key": "SELECT c_name, c_custkey, CAST(row_number() OVER (ORDER BY c_name, c_custkey)"
                   " AS BIGINT) AS name_sk FROM customer",
    "g3_timestamp_key": "SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id)"
                        " AS BIGINT) AS event_sk FROM events",
    "g4_date_key": f"SELECT o_orderkey, {dkey('o_orderdate')} AS date_key FROM orders",
    "j1_resolve": f"""SELECT o.o_orderkey, {dkey('o.o_orderdate')} AS date_key, c.client_key
FROM orders o JOIN (SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT)
  AS client_key FROM customer) c ON o.o_custkey = c.c_custkey""",
    "j2_role_playing": with_warehouse("""SELECT t.id_trajet, gd.gare_key AS gare_depart_key,
  ga.gare_key AS gare_arrivee_key FROM trajet_src t
  JOIN dim_gare gd ON t.id_gare_depart = gd.id_gare
  JOIN dim_gare ga ON t.id_gare_arrivee = ga.id_gare"""),
    "j3_fact_to_fact": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.order_sk
FROM lineitem l JOIN (SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT)
  AS order_sk FROM orders) o ON l.l_orderkey = o.o_orderkey""",
    "j4_fact_trajet": with_warehouse("SELECT * FROM fact_trajet"),
    "j5_fact_reservation": with_warehouse("SELECT * FROM fact_reservation"),
    "j6_orphans": with_warehouse("""SELECT t.id_trajet, t.id_train FROM trajet_src t
WHERE NOT EXISTS (SELECT 1 FROM train_src tr WHERE tr.id_train = t.id_train)"""),
    "j7_temporal": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, o.o_orderdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderdate > l.l_shipdate""",
    "j8_rejects": with_warehouse(
        "SELECT id_trajet, id_train, id_gare_arrivee, reasons FROM fact_trajet_rejected"),
    "j9_fk_audit": with_warehouse("\nUNION ALL\n".join(
        f"SELECT '{c}' AS child_table, '{cc}' AS child_column, '{p}' AS parent_table,"
        f" '{pc}' AS parent_column, CAST(count(*) AS BIGINT) AS orphans FROM {c}_src x"
        f" WHERE NOT EXISTS (SELECT 1 FROM {p}_src y WHERE y.{pc} = x.{cc})"
        for c, cc, p, pc in [("trajet", "id_train", "train", "id_train"),
                             ("trajet", "id_gare_depart", "gare", "id_gare"),
                             ("trajet", "id_gare_arrivee", "gare", "id_gare"),
                             ("reservation", "id_client", "client", "id_client"),
                             ("reservation", "id_trajet", "trajet", "id_trajet")]
        ) + "".join(
        f"\nUNION ALL\nSELECT '{c}', 'date_key', 'dim_date', 'date_key', CAST(count(*) AS BIGINT)"
        f" FROM {c}_src x WHERE CAST({d} AS DATE) BETWEEN"
        f" (SELECT min(CAST(date_depart AS DATE)) FROM trajet_src) AND"
        f" (SELECT max(CAST(date_depart AS DATE)) FROM trajet_src) IS NOT TRUE"
        for c, d in [("trajet", "date_depart"), ("reservation", "date_reservation")])),
    "a1_count": "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS total FROM {n}"
        for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                  "events", "documents", "embeddings", "pages", "benchmark", "labels",
                  "conversations")),
    "a2_rules_one_pass": """SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE l_quantity <= 0) AS BIGINT) AS qty_not_positive,
  CAST(count(*) FILTER (WHERE l_extendedprice < 0) AS BIGINT) AS price_negative,
  CAST(count(*) FILTER (WHERE l_discount < 0 OR l_discount > 1) AS BIGINT) AS discount_out_of_range,
  CAST(count(*) FILTER (WHERE l_tax < 0) AS BIGINT) AS tax_negative,
  CAST(count(*) FILTER (WHERE l_returnflag IS NULL) AS BIGINT) AS returnflag_null,
  CAST(count(*) FILTER (WHERE l_linenumber > 7) AS BIGINT) AS linenumber_over_7
FROM lineitem""",
    "a3_unique": """SELECT 'lineitem' AS table_name, CAST(sum(c) AS BIGINT) AS total,
  CAST(count(*) AS BIGINT) AS distinct_keys, CAST(count(*) FILTER (WHERE c > 1) AS BIGINT)
  AS duplicated_keys, CAST(sum(c - 1) AS BIGINT) AS extra_rows
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL
SELECT 'orders', CAST(sum(c) AS BIGINT), CAST(count(*) AS BIGINT),
  CAST(count(*) FILTER (WHERE c > 1) AS BIGINT), CAST(sum(c - 1) AS BIGINT)
FROM (SELECT count(*) AS c FROM orders GROUP BY o_orderkey)""",
    "a4_distinct": with_warehouse(
        f"SELECT DISTINCT {sex('sexe')} AS sexe FROM client_src WHERE {sex('sexe')} IS NOT NULL"),
    "a5_batches": """SELECT batch, min_key, max_key, n,
  coalesce(min_key <= max(max_key) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), false) AS overlaps_earlier
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS batch, min(o_orderkey) AS min_key,
  max(o_orderkey) AS max_key, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1)""",
    "d2_duplicates": """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "d3_domain": with_warehouse(f"""SELECT sexe, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {sex('sexe')} AS sexe FROM client_src)
WHERE sexe IS NOT NULL AND sexe NOT IN ('H', 'F') GROUP BY sexe"""),
    "d4_case_shape": with_warehouse(f"""SELECT
  CAST(count(*) FILTER (WHERE raw = upper(raw) AND length(raw) > 1) AS BIGINT) AS raw_upper,
  CAST(count(*) FILTER (WHERE raw = lower(raw) AND length(raw) > 1) AS BIGINT) AS raw_lower,
  CAST(count(*) FILTER (WHERE clean = upper(clean) AND length(clean) > 1) AS BIGINT) AS clean_upper,
  CAST(count(*) FILTER (WHERE clean = lower(clean) AND length(clean) > 1) AS BIGINT) AS clean_lower
FROM (SELECT ville AS raw, {city('ville')} AS clean FROM client_src)"""),
    "t1_dim_client": with_warehouse("SELECT * FROM dim_client"),
    "t2_dim_gare": with_warehouse("SELECT * FROM dim_gare"),
    "t3_dim_train": with_warehouse("SELECT * FROM dim_train"),
    "k7_insert_if_absent": f"""SELECT n.* FROM ({_calendar(
        "SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem", False)}) n
WHERE n.date_key NOT IN (SELECT date_key FROM ({_calendar(
        "SELECT CAST(o_orderdate AS DATE) AS d FROM orders", False)}))""",
    "u1_upsert": with_warehouse(f"""SELECT client_key, id_client, sexe, ville, statut_compte FROM (
  SELECT e.client_key, coalesce(n.id_client, e.id_client) AS id_client,
    CASE WHEN n.id_client IS NOT NULL THEN n.sexe ELSE e.sexe END AS sexe,
    CASE WHEN n.id_client IS NOT NULL THEN n.ville ELSE e.ville END AS ville,
    CASE WHEN n.id_client IS NOT NULL THEN n.statut_compte ELSE e.statut_compte END
      AS statut_compte
  FROM (SELECT CAST(row_number() OVER (ORDER BY id_client) AS INTEGER) AS client_key,
          id_client, {sex('sexe')} AS sexe, {city('ville')} AS ville, statut_compte
        FROM client_src WHERE statut_compte = 'Actif') e
  FULL OUTER JOIN (
    SELECT id_client, sexe, ville, statut_compte FROM (
      SELECT c.id_client, {sex('c.sexe')} AS sexe, {city('c.ville')} AS ville,
        o.o_orderstatus AS statut_compte,
        row_number() OVER (PARTITION BY c.id_client
                           ORDER BY o.o_orderdate DESC, o.o_orderstatus DESC) AS rn
      FROM client_src c JOIN orders o ON o.o_custkey = c.id_client) WHERE rn = 1) n
  ON e.id_client = n.id_client) m
WHERE client_key IS NOT NULL
UNION ALL
SELECT CAST(mx + row_number() OVER (ORDER BY id_client) AS INTEGER) AS client_key, id_client,
  sexe, ville, statut_compte FROM (
  SELECT n.*, (SELECT count(*) FROM client_src WHERE statut_compte = 'Actif') AS mx FROM (
    SELECT id_client, sexe, ville, statut_compte FROM (
      SELECT c.id_client, {sex('c.sexe')} AS sexe, {city('c.ville')} AS ville,
        o.o_orderstatus AS statut_compte,
        row_number() OVER (PARTITION BY c.id_client
                           ORDER BY o.o_orderdate DESC, o.o_orderstatus DESC) AS rn
      FROM client_src c JOIN orders o ON o.o_custkey = c.id_client) WHERE rn = 1) n
  WHERE n.id_client NOT IN (SELECT id_client FROM client_src WHERE statut_compte = 'Actif'))"""),
    "e1_fact_trajet": with_warehouse("SELECT * FROM fact_trajet"),
    "e1_fact_reservation": with_warehouse("SELECT * FROM fact_reservation"),
}

ORACLE["g1_date_series"] = """SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE),
  CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS full_date FROM orders"""
ORACLE["s2_batches"] = with_warehouse(
    "SELECT id_trajet, CAST((row_number() OVER (ORDER BY id_trajet) - 1) // 1000 AS BIGINT)"
    " AS batch FROM trajet_src")
ORACLE["s7_key_map"] = with_warehouse("SELECT id_train, train_key FROM dim_train")
ORACLE["e3_batch_keys"] = """SELECT CAST(year(o_orderdate) AS INTEGER) AS batch, o_orderkey,
  CAST(row_number() OVER (ORDER BY year(o_orderdate), o_orderkey) AS BIGINT) AS order_sk
FROM orders"""
_STREAM = """periods AS (SELECT *, CASE WHEN year(date_depart) < 1997 THEN 0
    WHEN year(date_depart) < 1999 THEN 1 ELSE 2 END AS period FROM trajet_src),
arrivals AS (SELECT * EXCLUDE (period), period AS batch_id, '' AS again FROM periods
  UNION ALL SELECT * EXCLUDE (period) REPLACE (distance_km + 1000 AS distance_km), 1,
    'loaded:id_trajet' FROM periods WHERE period = 0 AND id_trajet % 20 = 0
  UNION ALL SELECT * EXCLUDE (period) REPLACE (distance_km + 2000 AS distance_km), 2,
    'loaded:id_trajet' FROM periods WHERE period = 0 AND id_trajet % 30 = 0
  UNION ALL SELECT * EXCLUDE (period) REPLACE (distance_km + 3000 AS distance_km), 2,
    'unique:id_trajet' FROM periods WHERE period = 2 AND id_trajet % 40 = 0),
judged AS (SELECT t.*, tr.train_key, CASE WHEN tr.train_key IS NULL OR gd.gare_key IS NULL
      OR ga.gare_key IS NULL THEN concat_ws(',', CASE WHEN tr.train_key IS NULL THEN 'train' END,
      CASE WHEN gd.gare_key IS NULL THEN 'gare_depart' END,
      CASE WHEN ga.gare_key IS NULL THEN 'gare_arrivee' END) ELSE again END AS reasons
  FROM arrivals t LEFT JOIN dim_train tr ON t.id_train = tr.id_train
    LEFT JOIN dim_gare gd ON t.id_gare_depart = gd.id_gare
    LEFT JOIN dim_gare ga ON t.id_gare_arrivee = ga.id_gare),
streamed AS (SELECT CAST(batch_id AS INTEGER) AS batch_id, CASE WHEN reasons = '' THEN CAST(
      row_number() OVER (PARTITION BY reasons = '' ORDER BY batch_id, id_trajet) AS BIGINT) END
      AS trajet_key, id_trajet, CAST(strftime(date_depart, '%Y%m%d') AS INTEGER) AS date_key,
    CASE WHEN reasons = '' THEN train_key END AS train_key, distance_km, reasons FROM judged)"""


def _streamed(body: str) -> str:
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in _CTES.items())
    return f"WITH {ctes},\n{_STREAM}\n{body}"


ORACLE["e3_incremental"] = _streamed("SELECT * FROM streamed")
ORACLE["k6_stream_report"] = _streamed("""SELECT CAST(batch_id AS BIGINT) AS batch_id,
  CAST(count(trajet_key) AS BIGINT) AS rows, CAST(count(*) - count(trajet_key) AS BIGINT)
    AS rejected, CAST(count(*) FILTER (WHERE reasons IN ('loaded:id_trajet', 'unique:id_trajet'))
    AS BIGINT) AS repeated, min(trajet_key) AS first_key, max(trajet_key) AS last_key
FROM streamed GROUP BY batch_id""")
ORACLE["a6_rates"] = report_sql(("d5_null_service_year", "d6_total_vs_price",
                                "d10_reservation_after_trip"))
ORACLE["d_report"] = report_sql()
ORACLE["e2_report"] = ORACLE["d_report"]
ORACLE["o1_period"] = with_warehouse("SELECT * FROM fact_trajet WHERE date_key BETWEEN 19970215"
                                     " AND 19990110")
ORACLE["s2_batch_reads"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"
ORACLE["s6_ingest"] = with_warehouse("""SELECT
  CASE WHEN id_trajet % 70 <> 3 THEN id_trajet END AS id_trajet,
  CASE WHEN id_trajet % 70 <> 3 THEN date_depart END AS date_depart,
  CASE WHEN id_trajet % 70 <> 3 AND id_trajet % 50 <> 1 THEN distance_km END AS distance_km,
  CASE WHEN id_trajet % 70 = 3 THEN id_trajet || ',' || id_train END AS broken_line,
  CASE WHEN id_trajet % 70 = 3 THEN 'malformed' WHEN id_trajet % 50 = 1 THEN 'cast:distance_km'
    ELSE '' END AS reasons FROM trajet_src""")
ORACLE["k4_round_trip"] = """SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN ''
  WHEN 2 THEN text || chr(9) || chr(92) || 'N' || chr(13) || chr(10) || chr(92)
  WHEN 3 THEN chr(92) || 'N' ELSE text END AS text, lang FROM documents"""
ORACLE["k5_load_ts"] = "SELECT o_orderkey, '2024-05-01 00:30:00' AS load_ts FROM orders"
ORACLE["j8_quarantine"] = with_warehouse("""SELECT t.id_trajet, t.distance_km,
  CASE WHEN tr.train_key IS NULL OR gd.gare_key IS NULL OR ga.gare_key IS NULL THEN
    concat_ws(',', CASE WHEN tr.train_key IS NULL THEN 'train' END,
      CASE WHEN gd.gare_key IS NULL THEN 'gare_depart' END,
      CASE WHEN ga.gare_key IS NULL THEN 'gare_arrivee' END)
  WHEN t.no_date OR t.distance_km < 0 THEN concat_ws(',',
      CASE WHEN t.no_date THEN 'not_null:date_key' END,
      CASE WHEN t.distance_km < 0 THEN 'check:distance_km_not_negative' END)
  ELSE 'unique:id_trajet' END AS reasons
FROM (SELECT * REPLACE (CASE WHEN id_trajet % 75 = 3 THEN -1 ELSE distance_km END AS distance_km),
        id_trajet % 60 = 1 AS no_date, false AS again FROM trajet_src
      UNION ALL SELECT * REPLACE (CASE WHEN id_trajet % 75 = 3 THEN 4999 ELSE distance_km + 5000
        END AS distance_km), id_trajet % 60 = 1, true FROM trajet_src WHERE id_trajet % 90 = 2) t
  LEFT JOIN dim_train tr ON t.id_train = tr.id_train
  LEFT JOIN dim_gare gd ON t.id_gare_depart = gd.id_gare
  LEFT JOIN dim_gare ga ON t.id_gare_arrivee = ga.id_gare
WHERE tr.train_key IS NULL OR gd.gare_key IS NULL OR ga.gare_key IS NULL OR t.no_date
  OR t.distance_km < 0 OR t.again""")
ORACLE["u1_copy_on_write"] = ORACLE["u1_upsert"].replace(
    "ON o.o_custkey = c.id_client)", "ON o.o_custkey = c.id_client WHERE c.id_client < 500)")
