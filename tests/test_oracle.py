"""Registered queries against their SQL on the smallest test tables."""

import pytest

from verification.compare import connect, difference
from verification.oracle import all_oracles
from verification.queries import all_queries

SF = "/root/testdata/sf0.001"

# One query per operator family; `python -m verification.compare` runs all of them.
SAMPLE = [
    "listing_fact",
    "market_fact_100",
    "market_bands",
    "study_rows",
    "log_profile",
    "log2s_trim",
    "metric_price_dealer",
    "metric_mpy_style",
    "metric_dol_today",
    "metric_matrix_long",
    "wide_daily",
    "publish",
    "out_ntiles_6",
    "out_med_dl_ibm_11",
    "base_stats_ymm",
    "compare_methods",
    "mae_own",
    "backtest_oot",
    "mae_by_window",
    "rpt_outliers_year_make",
    "rpt_cov_make_6",
    "size_buckets",
    "reconcile_versions",
]


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_its_sql(spark, db, name):
    assert difference(all_queries()[name](spark, SF), db, all_oracles()[name]) is None


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


def test_driver_contract(spark):
    import __spark_entry__ as driver

    assert len(driver.entry(spark).columns) == 13
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(all_queries()) <= set(driver.oracle_sql())
