"""Registered queries against their SQL on the smallest data."""

import os

import pytest
from oracle import compare, duck

import __spark_entry__ as contract
from kinfold.plans import catalog, trees

FOLDER = "/root/testdata/sf0.001"
ORACLES = dict(catalog.ORACLES)
NAMES = sorted(ORACLES)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not mounted")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    status, *_, detail = compare(spark, con, name, contract.queries()[name], ORACLES[name], FOLDER)
    assert status == "ok", detail


def test_every_query_without_sql_is_known():
    assert set(catalog.QUERIES) - set(ORACLES) == {"de_test", "mcl_cluster"}
    assert set(catalog.QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry_has_rows_and_sound_values(spark):
    rows = contract.entry(spark).collect()
    assert rows
    for r in rows:
        for s in ("AFRICA", "AMERICA", "ASIA", "EUROPE"):
            assert 0 <= r[f"{s}_sigDE"] <= r[f"{s}_total"]
        assert all(r[c] is None or 0 <= r[c] <= 1 for c in ("oaes_hyper", "cafe_pvalue", "tea_value"))


@pytest.mark.parametrize("name", ["monophyly", "prune"])
def test_trees_of_long_texts_are_worked_on_apart(spark, con, monkeypatch, name):
    monkeypatch.setattr(trees, "LONG_TEXT", 400)
    monkeypatch.setattr(trees, "BUCKET_TEXT", 4000)
    status, *_, detail = compare(spark, con, name, contract.queries()[name], ORACLES[name], FOLDER)
    assert status == "ok", detail
