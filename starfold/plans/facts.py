"""Fact transforms J4 (trips) and J5 (reservations).

Each returns ``(accepted, rejected)`` from ONE resolution plan: rows whose
lookups all resolve get dense surrogate keys numbered after rejection (so the
keys equal the rank among accepted rows); the others keep their natural keys
and the list of lookups that failed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import date_key
from ..operators.contract import project
from ..operators.keys import assign_dense_key
from ..operators.lookups import REASONS, Lookup, accepted, rejected, resolve_with_reasons


def trip_lookups(dim_train_map: DataFrame, dim_gare_map: DataFrame) -> list[Lookup]:
    # The station map plays two roles (departure, arrival); the second join
    # reuses the first broadcast exchange.
    return [
        Lookup("train", dim_train_map, "id_train", "train_key", "id_train"),
        Lookup("gare_depart", dim_gare_map, "id_gare", "gare_key", "id_gare_depart",
               output="gare_depart_key"),
        Lookup("gare_arrivee", dim_gare_map, "id_gare", "gare_key", "id_gare_arrivee",
               output="gare_arrivee_key"),
    ]


def reservation_lookups(dim_client_map: DataFrame, fact_trajet_map: DataFrame) -> list[Lookup]:
    # Fact-to-fact: the trip map grows with the facts, so it is never
    # broadcast; a shuffled join with AQE skew splitting handles hot trips.
    return [
        Lookup("client", dim_client_map, "id_client", "client_key", "id_client"),
        Lookup("trajet", fact_trajet_map, "id_trajet", "trajet_key", "id_trajet",
               broadcast=False),
    ]


def resolve(source: DataFrame, date_col: str, lookups: list[Lookup]) -> DataFrame:
    """G4 + J8: every source row with its date key, its surrogate keys and
    the lookups that failed -- one plan for accepted and rejected rows."""
    staged = source.withColumn("date_key", date_key(date_col))
    return resolve_with_reasons(staged, lookups)


BAD = "_sf_bad"


def number(resolved: DataFrame, source_columns: list[str], spec: schemas.TableSpec,
           key_start: int = 1) -> tuple[DataFrame, DataFrame]:
    """(accepted rows in the contract, numbered after rejection; rejected rows with
    their source columns and reasons) from ONE stored copy: all rows are put in the
    order (rejected, natural key) and numbered, so the accepted ones get the first
    numbers, which are their ranks among the accepted.  Lookups are not run again
    for the rejects, and both sides skip the other's row groups."""
    typed = {f.name: F.col(f.name).cast(f.dataType)
             for f in spec.schema.fields if f.name != spec.surrogate_key}
    kept = resolved.select(
        (F.size(REASONS) > 0).alias(BAD), REASONS,
        # A rejected row's values need not fit the contract: cast where accepted.
        *[F.when(F.size(REASONS) == 0, c).alias(n) for n, c in typed.items()],
        F.when(F.size(REASONS) > 0, F.struct(*source_columns)).alias("_sf_source"),
        # Rejects have no place in the order: their hash deals them to many tasks.
        F.when(F.size(REASONS) > 0, F.xxhash64(*source_columns)).alias("_sf_spread"))
    keyed = assign_dense_key(kept, [BAD, *spec.natural_key, "_sf_spread"], spec.surrogate_key,
                             start=key_start)
    ok = project(keyed.filter(~F.col(BAD)), spec.schema)
    # The numbers are for the accepted rows, so the rejects come from the stored copy.
    bad = keyed.filter(F.col(BAD)).select("_sf_source.*", REASONS)
    return ok, bad


def split(resolved: DataFrame, source_columns: list[str], spec: schemas.TableSpec
          ) -> tuple[DataFrame, DataFrame]:
    """(accepted rows in the contract without a surrogate key; rejected rows)."""
    ok = project(accepted(resolved), spec.without(spec.surrogate_key))
    return ok, rejected(resolved).select(*source_columns, REASONS)


def _fact(source: DataFrame, date_col: str, lookups: list[Lookup], spec: schemas.TableSpec,
          with_keys: bool, key_start: int = 1) -> tuple[DataFrame, DataFrame]:
    resolved = resolve(source, date_col, lookups)
    if with_keys:
        return number(resolved, source.columns, spec, key_start)
    return split(resolved, source.columns, spec)


def fact_trajet(trajet: DataFrame, dim_train_map: DataFrame, dim_gare_map: DataFrame,
                with_keys: bool = True, key_start: int = 1) -> tuple[DataFrame, DataFrame]:
    """J4 = G4 + J1 + J2 + P1 (+ G3)."""
    lookups = trip_lookups(dim_train_map, dim_gare_map)
    return _fact(trajet, "date_depart", lookups, schemas.FACT_TRAJET, with_keys, key_start)


def fact_reservation(reservation: DataFrame, dim_client_map: DataFrame,
                     fact_trajet_map: DataFrame, with_keys: bool = True, key_start: int = 1
                     ) -> tuple[DataFrame, DataFrame]:
    """J5 = G4 + J1 + J3 + P1 (+ G3).  A rejected trip takes its reservations
    with it, since its id is absent from the trip map."""
    lookups = reservation_lookups(dim_client_map, fact_trajet_map)
    return _fact(reservation, "date_reservation", lookups, schemas.FACT_RESERVATION,
                 with_keys, key_start)
