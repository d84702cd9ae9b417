"""The registered queries and their SQL twins."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as se  # noqa: E402
import oracle_check  # noqa: E402
from starfold.llm import registry  # noqa: E402


def test_thirteen_operators_and_the_pipeline():
    assert len(registry.QUERIES) == 14 and set(registry.ORACLE) <= set(registry.QUERIES)
    assert all(isinstance(sql, str) for sql in registry.ORACLE.values())


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql_twin(spark, name):
    con = oracle_check.duck(SF001)
    df = se.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(se.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    assert oracle_check.digest(df.columns, rows)[0] == oracle_check.digest(cols, rel.fetchall())[0]
