"""Every registered query against its SQL twin, whole tables, at the smallest scale."""

import pytest

from priorframe import plans
from tests.oracle import compare, duck

# Model fits take long and have no SQL twin; they have a test of their own.
SLOW = {"k10_boosted_tree_reference", "k11_logistic_reference"}


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", [n for n in plans.QUERIES if n not in SLOW])
def test_query(spark, sf, con, name):
    r = compare(spark, name, plans.QUERIES[name], plans.ORACLES.get(name), sf, con)
    assert r["ok"], r.get("why")
    assert "odd" not in r, r.get("odd")
    assert "bad_nodes" not in r, r.get("bad_nodes")  # no cross join, no row-at-a-time Python


def test_every_oracle_has_a_query():
    assert set(plans.ORACLES) <= set(plans.QUERIES)
