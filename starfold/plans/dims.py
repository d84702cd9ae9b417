"""Dimension transforms T1-T3: cleaning, contract projection, then dense
surrogate keys in natural-key order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import label_to_bool, normalize_city, normalize_sex
from ..operators.contract import project
from ..operators.keys import assign_dense_key


def _keyed(df: DataFrame, spec: schemas.TableSpec, with_keys: bool) -> DataFrame:
    cleaned = project(df, spec.without(spec.surrogate_key))
    if not with_keys:
        return cleaned
    keyed = assign_dense_key(cleaned, list(spec.natural_key), spec.surrogate_key)
    return project(keyed, spec.schema)


def clean_client(client: DataFrame) -> DataFrame:
    """T1 cleaning: sex to H/F (fallback first letter), city to title case."""
    return client.withColumns({"sexe": normalize_sex("sexe"), "ville": normalize_city("ville")})


def clean_gare(gare: DataFrame) -> DataFrame:
    """T2 cleaning: city title case, electrification label to boolean, the
    service year filled from the duplicate column."""
    return gare.withColumns({
        "ville": normalize_city("ville"),
        "electrification": label_to_bool("electrification"),
        "annee_mise_en_service": F.coalesce("annee_mise_en_service", "annee_mise_service"),
    })


def clean_train(train: DataFrame) -> DataFrame:
    """T3 cleaning: base cities in title case under their warehouse names."""
    return train.withColumns({"ville_depart_base": normalize_city("ville_depart"),
                              "ville_arrivee_base": normalize_city("ville_arrivee")})


def dim_client(client: DataFrame, with_keys: bool = True) -> DataFrame:
    return _keyed(clean_client(client), schemas.DIM_CLIENT, with_keys)


def dim_gare(gare: DataFrame, with_keys: bool = True) -> DataFrame:
    return _keyed(clean_gare(gare), schemas.DIM_GARE, with_keys)


def dim_train(train: DataFrame, with_keys: bool = True) -> DataFrame:
    return _keyed(clean_train(train), schemas.DIM_TRAIN, with_keys)


def key_map(dim: DataFrame, spec: schemas.TableSpec) -> DataFrame:
    """The (natural key, surrogate key) pair of a loaded table."""
    return dim.select(spec.natural_key[0], spec.surrogate_key)
