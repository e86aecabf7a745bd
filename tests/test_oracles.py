"""Registered queries against their SQL twins at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
CHOSEN = ["kpi_by_channel", "unify_sources", "repair_audit", "row_positions", "surrogate_keys",
          "class_report_fixed_labels", "global_metrics", "dq_catalog", "onehot_meta"]


@pytest.fixture(scope="module")
def base():
    return duck(FOLDER)


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, base, name):
    _, _, problem = compare(spark, base, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert problem is None


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
