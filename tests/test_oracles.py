"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from checks import MODULES  # noqa: E402
from checks.compare import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(queries()[name], ORACLES.get(name), spark, con, SF)
    assert ok, note


def test_every_query_of_the_checks_has_sql():
    own = {name for m in MODULES for name in m.QUERIES}
    assert own <= set(ORACLES) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
