"""Every registered query against its SQL on DuckDB."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract

QUERIES = contract.catalog.queries()
ORACLES = contract.oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_only_the_random_sample_has_no_oracle():
    assert set(QUERIES) - set(ORACLES) == {"stratified_sample"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_query_is_empty(duck, name):
    assert duck.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchone()[0] > 0


def test_stratified_sample_keeps_full_classes(spark, sf_dir):
    sample = QUERIES["stratified_sample"](spark, sf_dir)
    labels = QUERIES["labels_same_day"](spark, sf_dir)
    assert sample.filter("y > 0").count() == labels.filter("y > 0").count()
    assert sample.filter("y = 0").count() <= labels.filter("y = 0").count()


def test_entry(spark):
    assert contract.entry(spark).columns == contract.catalog.schemas.SNAPSHOT_COLUMNS
