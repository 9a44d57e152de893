"""Every query with an SQL equivalent gives the same rows in both engines."""

import pytest

import __spark_entry__ as driver
from tallyrec.plans.catalog import all_queries
from tallyrec.plans.oracle import all_oracles
from tests.check import canonical, connect, sql_rows

SF = "/root/testdata/sf0.001"
#: Two hundred items are too few for a forest.
LARGER = {"als_forest_faults": "/root/testdata/sf0.01"}
EMPTY = {"users_without_validation"}  # every user of the smallest tables has five items


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_same_rows(spark, con, name):
    sf_dir = LARGER.get(name, SF)
    df = driver.queries()[name](spark, sf_dir)
    names, expected, _ = sql_rows(connect(sf_dir) if name in LARGER else con, driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(names)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(names, expected)
    assert got or name in EMPTY


def test_only_fitting_and_hashing_lack_sql():
    without = set(all_queries()) - set(all_oracles())
    assert {n.split("_")[0] for n in without} == {"als", "lsh"}
