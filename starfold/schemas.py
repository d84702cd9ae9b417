"""Table catalog: one definition per table of the source and warehouse model.

A ``TableSpec`` carries the explicit ``StructType`` (the column contract, in
order), the natural key, the surrogate key, foreign keys, NOT NULL columns,
CHECK predicates and VARCHAR lengths.  Readers, the contract projection, the
quality rules and the pipeline all read from here, so a table is described
once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Check:
    name: str
    predicate: str  # Spark SQL boolean expression; a null result passes


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    natural_key: tuple[str, ...] = ()
    surrogate_key: str | None = None
    foreign_keys: tuple[ForeignKey, ...] = ()
    unique: tuple[str, ...] = ()          # columns unique beside the two keys
    not_null: tuple[str, ...] = ()
    checks: tuple[Check, ...] = ()
    varchar: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def without(self, *names: str) -> T.StructType:
        return T.StructType([f for f in self.schema.fields if f.name not in names])


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


I, S, H, L, D, B = (T.IntegerType(), T.StringType(), T.ShortType(), T.LongType(),
                    T.DateType(), T.BooleanType())
TS = T.TimestampType()


def DEC(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


# ---------------------------------------------------------------- source model
# Column names, types, lengths, keys and checks of the two models.
CLIENT = TableSpec(
    "client",
    _s(("id_client", I), ("nom", S), ("prenom", S), ("date_naissance", D), ("sexe", S),
       ("type_client", S), ("ville", S), ("code_postal", S), ("pays", S), ("email", S),
       ("telephone", S), ("date_creation_compte", D), ("date_derniere_modification", D),
       ("statut_compte", S)),
    natural_key=("id_client",),
)
GARE = TableSpec(
    "gare",
    _s(("id_gare", I), ("nom_gare", S), ("ville", S), ("region", S), ("pays", S),
       ("nb_quais", H), ("type_gare", S), ("taille_gare", S), ("electrification", S),
       ("annee_mise_en_service", H), ("latitude", DEC(9, 6)), ("longitude", DEC(9, 6)),
       ("annee_mise_service", H), ("categorie_strategique", S)),
    natural_key=("id_gare",),
)
TRAIN = TableSpec(
    "train",
    _s(("id_train", I), ("code_train", S), ("type_train", S), ("capacite_totale", H),
       ("capacite_classe1", H), ("capacite_classe2", H), ("id_gare_depart", I),
       ("id_gare_arrivee", I), ("ville_depart", S), ("ville_arrivee", S),
       ("annee_mise_en_service", H), ("statut_train", S), ("duree_estimee_minutes", H),
       ("energie", S)),
    natural_key=("id_train",),
)
TRAJET = TableSpec(
    "trajet",
    _s(("id_trajet", I), ("id_train", I), ("id_gare_depart", I), ("id_gare_arrivee", I),
       ("date_depart", D), ("heure_depart", S), ("heure_arrivee_prevue", S),
       ("distance_km", I), ("statut_circulation", S)),
    natural_key=("id_trajet",),
)
RESERVATION = TableSpec(
    "reservation",
    _s(("id_reservation", I), ("id_client", I), ("id_trajet", I), ("date_reservation", D),
       ("tarif_type", S), ("classe_reservee", S), ("prix_unitaire", DEC(10, 2)),
       ("nb_passagers", H), ("montant_total", DEC(12, 2)), ("canal_vente", S),
       ("mode_paiement", S), ("statut_reservation", S)),
    natural_key=("id_reservation",),
)
SOURCES = {t.name: t for t in (CLIENT, GARE, TRAIN, TRAJET, RESERVATION)}

# ------------------------------------------------------------- warehouse model
DIM_DATE = TableSpec(
    "dim_date",
    _s(("date_key", I), ("full_date", D), ("year", H), ("quarter", H), ("month", H),
       ("month_name", S), ("day_of_month", H), ("day_of_week", H), ("day_name", S),
       ("is_weekend", B)),
    natural_key=("date_key",),
    unique=("full_date",),
    not_null=("date_key", "full_date", "year", "quarter", "month", "month_name",
              "day_of_month", "day_of_week", "day_name", "is_weekend"),
    varchar={"month_name": 10, "day_name": 10},
)
DIM_CLIENT = TableSpec(
    "dim_client",
    _s(("client_key", I), ("id_client", I), ("nom", S), ("prenom", S), ("date_naissance", D),
       ("sexe", S), ("type_client", S), ("ville", S), ("code_postal", S), ("pays", S),
       ("email", S), ("telephone", S), ("date_creation_compte", D), ("statut_compte", S)),
    natural_key=("id_client",),
    surrogate_key="client_key",
    not_null=("client_key", "id_client"),
    varchar={"nom": 50, "prenom": 50, "sexe": 1, "type_client": 30, "ville": 50,
             "code_postal": 10, "pays": 50, "email": 100, "telephone": 20,
             "statut_compte": 20},
)
DIM_GARE = TableSpec(
    "dim_gare",
    _s(("gare_key", I), ("id_gare", I), ("nom_gare", S), ("ville", S), ("region", S),
       ("pays", S), ("nb_quais", H), ("type_gare", S), ("taille_gare", S),
       ("electrification", B), ("annee_mise_en_service", H), ("latitude", DEC(9, 6)),
       ("longitude", DEC(9, 6)), ("categorie_strategique", S)),
    natural_key=("id_gare",),
    surrogate_key="gare_key",
    not_null=("gare_key", "id_gare", "nom_gare"),
    varchar={"nom_gare": 60, "ville": 50, "region": 50, "pays": 50, "type_gare": 30,
             "taille_gare": 20, "categorie_strategique": 30},
)
DIM_TRAIN = TableSpec(
    "dim_train",
    _s(("train_key", I), ("id_train", I), ("code_train", S), ("type_train", S),
       ("capacite_totale", H), ("capacite_classe1", H), ("capacite_classe2", H),
       ("ville_depart_base", S), ("ville_arrivee_base", S), ("annee_mise_en_service", H),
       ("statut_train", S), ("duree_estimee_minutes", H), ("energie", S)),
    natural_key=("id_train",),
    surrogate_key="train_key",
    not_null=("train_key", "id_train", "code_train"),
    varchar={"code_train": 20, "type_train": 20, "ville_depart_base": 50,
             "ville_arrivee_base": 50, "statut_train": 20, "energie": 20},
)
FACT_TRAJET = TableSpec(
    "fact_trajet",
    _s(("trajet_key", L), ("id_trajet", I), ("date_key", I), ("train_key", I),
       ("gare_depart_key", I), ("gare_arrivee_key", I), ("heure_depart", S),
       ("heure_arrivee_prevue", S), ("distance_km", I), ("statut_circulation", S)),
    natural_key=("id_trajet",),
    surrogate_key="trajet_key",
    foreign_keys=(ForeignKey("date_key", "dim_date", "date_key"),
                  ForeignKey("train_key", "dim_train", "train_key"),
                  ForeignKey("gare_depart_key", "dim_gare", "gare_key"),
                  ForeignKey("gare_arrivee_key", "dim_gare", "gare_key")),
    not_null=("trajet_key", "id_trajet", "date_key", "train_key", "gare_depart_key",
              "gare_arrivee_key"),
    checks=(Check("distance_km_not_negative", "distance_km >= 0"),),
    varchar={"statut_circulation": 20},
)
FACT_RESERVATION = TableSpec(
    "fact_reservation",
    _s(("reservation_key", L), ("id_reservation", I), ("date_key", I), ("client_key", I),
       ("trajet_key", L), ("tarif_type", S), ("classe_reservee", S),
       ("prix_unitaire", DEC(10, 2)), ("nb_passagers", H), ("montant_total", DEC(12, 2)),
       ("canal_vente", S), ("mode_paiement", S), ("statut_reservation", S)),
    natural_key=("id_reservation",),
    surrogate_key="reservation_key",
    foreign_keys=(ForeignKey("date_key", "dim_date", "date_key"),
                  ForeignKey("client_key", "dim_client", "client_key"),
                  ForeignKey("trajet_key", "fact_trajet", "trajet_key")),
    not_null=("reservation_key", "id_reservation", "date_key", "client_key", "trajet_key",
              "prix_unitaire", "nb_passagers", "montant_total"),
    checks=(Check("prix_unitaire_not_negative", "prix_unitaire >= 0"),
            Check("nb_passagers_positive", "nb_passagers > 0"),
            Check("montant_total_not_negative", "montant_total >= 0")),
    varchar={"tarif_type": 20, "classe_reservee": 10, "canal_vente": 20,
             "mode_paiement": 30, "statut_reservation": 20},
)
WAREHOUSE = {t.name: t for t in (DIM_DATE, DIM_CLIENT, DIM_GARE, DIM_TRAIN, FACT_TRAJET,
                                 FACT_RESERVATION)}

# Load order of a full reload: dimensions, then trips, then reservations
# (reservations refer to trip keys, so they are rebuilt whenever trips are).
LOAD_ORDER = ("dim_client", "dim_gare", "dim_train", "fact_trajet", "fact_reservation")

# Source table behind each warehouse table (the calendar is generated).
SOURCE_OF = {"dim_client": "client", "dim_gare": "gare", "dim_train": "train",
             "fact_trajet": "trajet", "fact_reservation": "reservation"}


def contract(spec: TableSpec, include_surrogate: bool = True) -> list[str]:
    cols = spec.columns
    if not include_surrogate and spec.surrogate_key:
        cols = [c for c in cols if c != spec.surrogate_key]
    return cols
