"""The driver contract: entry, queries and their SQL twins."""

import os
import re
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as se  # noqa: E402
import oracle_check  # noqa: E402


def test_entry_returns_the_reservation_fact(spark):
    df = se.entry(spark)
    assert df.columns == ["reservation_key", "id_reservation", "date_key", "client_key",
                          "trajet_key", "tarif_type", "classe_reservee", "prix_unitaire",
                          "nb_passagers", "montant_total", "canal_vente", "mode_paiement",
                          "statut_reservation"]
    assert df.count() == 944


def test_every_query_has_a_sql_twin():
    own = {k for k in se.queries() if not re.match(r"op\d+_|pipeline$", k)}
    assert own == {k for k in se.oracle_sql() if not re.match(r"op\d+_|pipeline$", k)}
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", ["f1_title_case", "f2_map_fallback", "g2_calendar",
                                  "g3_dense_key_lineitem", "j3_fact_to_fact", "j8_rejects",
                                  "j9_fk_audit", "a5_batches", "u1_upsert", "e3_batch_keys"])
def test_query_matches_sql_twin(spark, name):
    con = oracle_check.duck(SF001)
    df = se.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert oracle_check.digest(df.columns, srows)[0] == oracle_check.digest(dcols, drows)[0]
