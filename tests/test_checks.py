"""Every registered query against its SQL, on whole tables."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from webtrail.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    made = duckdb.connect()
    for t in check.TABLES:
        made.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return made


NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, sf_dir, name):
    assert check.compare(spark, con, name, sf_dir).startswith(("ok", "rows only"))


def test_entry(spark):
    assert entry(spark).count() == 20


def test_every_check_has_its_query():
    assert set(oracle_sql()) <= set(queries())
