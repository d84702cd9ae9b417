"""Adapter: the TPC-H-like test tables as the railway source model.

Deterministic expressions only, so an SQL engine can repeat them (the oracle
queries do).  Rejects are planted on purpose: train -1 and arrival station 25
do not exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.contract import conform

# Fixed values of the adapter: sex labels by key modulo 6 (None = null) and
# electrification labels by key modulo 3.
SEX_SAMPLES = ("Homme", "FEMME", " m ", "f", "Xyz", None)
ELECTRIFICATION_SAMPLES = ("Electrifiée", "Non électrifiée", None)
RESERVATION_YEARS_BACK = 29
# Calendar bounds that cover the adapted facts.
CALENDAR_START, CALENDAR_END = "1995-01-01", "2001-12-31"


def _pick(values: tuple, index: Column) -> Column:
    out = None
    for i, v in enumerate(values):
        val = F.lit(v).cast("string")
        out = F.when(index == i, val) if out is None else out.when(index == i, val)
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def client(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    df = customer.select(
        k.alias("id_client"),
        F.col("c_name").alias("nom"),
        _pick(SEX_SAMPLES, k % 6).alias("sexe"),
        F.when(k % 3 == 0, seg).when(k % 3 == 1, F.lower(seg))
         .otherwise(F.concat(F.lit("  "), seg, F.lit("  "))).alias("ville"),
        F.when(F.col("c_acctbal") < 0, F.lit("Inactif")).otherwise(F.lit("Actif"))
         .alias("statut_compte"),
    )
    return conform(df, schemas.CLIENT.schema)


def gare(nation: DataFrame, region: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    df = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        n.alias("id_gare"),
        F.col("n_name").alias("nom_gare"),
        F.col("r_name").alias("ville"),
        F.col("r_name").alias("region"),
        _pick(ELECTRIFICATION_SAMPLES, n % 3).alias("electrification"),
        F.when(n % 4 == 0, F.lit(None)).otherwise(n + 1950).alias("annee_mise_en_service"),
        F.when(n % 8 == 0, F.lit(None)).otherwise(n + 1900).alias("annee_mise_service"),
    )
    return conform(df, schemas.GARE.schema)


def train(part: DataFrame) -> DataFrame:
    df = part.select(
        F.col("p_partkey").alias("id_train"),
        F.col("p_name").alias("code_train"),
        F.col("p_type").alias("type_train"),
        (F.col("p_size") * 10).alias("capacite_totale"),
        F.col("p_type").alias("ville_depart"),
        F.col("p_brand").alias("ville_arrivee"),
    )
    return conform(df, schemas.TRAIN.schema)


def trajet(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    df = orders.select(
        k.alias("id_trajet"),
        F.when(k % 50 == 0, F.lit(-1)).otherwise(F.col("o_custkey")).alias("id_train"),
        (k % 25).alias("id_gare_depart"),
        ((k * 7 + 3) % 26).alias("id_gare_arrivee"),
        F.to_date("o_orderdate").alias("date_depart"),
        F.floor(F.col("o_totalprice") / 1000).alias("distance_km"),
        F.col("o_orderstatus").alias("statut_circulation"),
    )
    return conform(df, schemas.TRAJET.schema)


def reservation(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    price = F.col("value").cast("decimal(10,2)")
    pax = (k % 4 + 1).cast("smallint")
    total = (price * pax).cast("decimal(12,2)") + \
        F.when(k % 10 == 0, F.lit(1)).otherwise(F.lit(0)).cast("decimal(12,2)")
    df = events.select(
        k.alias("id_reservation"),
        F.col("user_id").alias("id_client"),
        k.alias("id_trajet"),
        F.add_months(F.to_date("ts"), -12 * RESERVATION_YEARS_BACK).alias("date_reservation"),
        price.alias("prix_unitaire"),
        pax.alias("nb_passagers"),
        total.cast("decimal(12,2)").alias("montant_total"),
        F.col("event_type").alias("canal_vente"),
    )
    return conform(df, schemas.RESERVATION.schema)


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five source tables of the railway model, derived from the test
    tables under ``sf_dir``."""
    r = lambda n: read_table(spark, sf_dir, n)
    return {
        "client": client(r("customer")),
        "gare": gare(r("nation"), r("region")),
        "train": train(r("part")),
        "trajet": trajet(r("orders")),
        "reservation": reservation(r("events")),
    }
