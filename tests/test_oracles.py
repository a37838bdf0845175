"""Every query with an oracle agrees with it, and every other one gives rows."""

import re

import pytest

import __spark_entry__ as driver
from checks.compare import canonical, difference, oracle
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return oracle(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, small, name):
    assert difference(spark, con, small, name) == ""


def test_difference_sees_a_wrong_value(spark, con, small, monkeypatch):
    wrong = f"select * replace (revenue + 0.01 as revenue) from ({ORACLES['hourly_revenue']})"
    monkeypatch.setitem(ORACLES, "hourly_revenue", wrong)
    assert "rows differ" in difference(spark, con, small, "hourly_revenue")


def test_driver_contract(spark):
    assert driver.entry(spark).count() == 7
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert all(q.__doc__ for q in driver.queries().values())


def test_canonical_ignores_order():
    assert canonical(["b", "a"], [(1, 2), (0, 5)]) == canonical(["a", "b"], [(5, 0), (2, 1)])


def test_every_inventory_id_is_named_by_a_query():
    families = {"S": 14, "P": 23, "J": 7, "A": 23, "Q": 9, "W": 6, "O": 2, "U": 1, "F": 8, "M": 12, "ST": 9, "K": 4}
    wanted = {f"{family}{i}" for family, n in families.items() for i in range(1, n + 1)}
    named = set(re.findall(r"\b[A-Z]{1,2}\d+\b", " ".join(q.__doc__ for q in QUERIES.values())))
    assert wanted - named == set()
