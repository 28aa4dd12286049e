"""Groups gathered in one task give the same metrics as histograms, and no second shuffle."""

import random
import re

import pytest
from conftest import AS_OF, ago
from pyspark.sql import functions as F

from forecourt.operators import together
from forecourt import staging
from forecourt.plans import daily, markets, refresh
from forecourt.sources import tpch
from test_plans import SF, plan_of


@pytest.fixture
def mixed(listings):
    """Dealers and styles of one car to dozens, copies, unknown states, empty and zero values, no zip."""
    pick = random.Random(3)
    cars = [
        {
            "dealer": pick.choice([1, 1, 1, 2, 3, 4, 5]),
            "style": pick.choice([7, 7, 7, 8, 9, *range(20, 40)]),
            "sold": pick.choice([True, True, False, None]),
            "first": ago(pick.choice([3, 40, 95, 200])),
            "last": ago(pick.choice([0, 1, 2, 45, 60, 89, 90, 100])),
            "price": pick.choice([None, 0, 0.01, 100, 100, 101.5, 20_000, 99_999.99]),
            "mileage": pick.choice([0, 1000, 1000, 250_000.5]),
        }
        for _ in range(240)
    ]
    distances = [(a, b, 40.0 * abs(int(a) - int(b)) / 10) for a in ("10", "20", "30") for b in ("10", "20", "30")]
    return listings(cars, {1: "10", 2: "20", 3: "30", 4: None, 5: "10"}, distances)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


def test_crowded_styles_and_dealers_have_the_same_metrics(mixed, monkeypatch):
    found = {}
    for most in (10_000, 12, 0):
        monkeypatch.setattr(together, "TOGETHER", most)
        found[most] = sorted_rows(daily.metric_matrix(mixed, AS_OF))
    assert found[10_000] == found[12] == found[0]


def test_shared_dimensions_are_shuffled_once(spark):
    """From staged cars to metrics, a dimension's rows move once, and before they are repeated."""
    inputs = tpch.staged_inputs(spark, SF)
    facts = daily.stage_market_columns(daily.daily_facts(inputs, AS_OF))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(daily.matrix_of(facts, inputs.zipdist, AS_OF, dimensions=["zip_style"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    moved = [line for line in plan.splitlines() if re.search(r"(?<!Broadcast)Exchange hash", line)]
    assert sum("style_id" in line for line in moved) == 1, plan


def test_crowded_values_are_counted_by_copies(spark):
    rows = spark.range(10).select((F.col("id") % 3).alias("k"), F.lit(2).alias("n"))
    assert [r.k for r in together.crowded(rows, "k", 6, "n").collect()] == [0]


def test_bands_of_crowded_styles_are_the_same_and_others_are_not_counted_by_value(mixed, monkeypatch):
    staged = {}

    def stage(df, label):
        staged[label] = staging.stage(df, label)
        return staged[label]

    monkeypatch.setattr(markets, "stage", stage)
    found, dims = {}, {}
    for most in (10_000, 12, 0):
        monkeypatch.setattr(together, "TOGETHER", most)
        found[most] = sorted_rows(markets.metric_matrix_bands(mixed, AS_OF))
        dims[most] = {r.dim for r in staged["own-values"].select("dim").distinct().collect()}
    assert found[10_000] == found[12] == found[0]
    assert dims[10_000] == {"zip"} and dims[0] == {"zip", "zip_style"}


def test_refreshed_matrix_of_crowded_keys_is_the_same_and_others_are_not_ranked_by_value(
    spark, mixed, monkeypatch, tmp_path
):
    staged = {}

    def stage(df, label):
        staged[label] = staging.stage(df, label)
        return staged[label]

    refresh.start(spark, str(tmp_path), mixed, mixed.hist, AS_OF)
    monkeypatch.setattr(refresh, "stage", stage)
    found, dims = {}, {}
    for most in (10_000, 3, 0):
        monkeypatch.setattr(together, "TOGETHER", most)
        found[most] = sorted_rows(refresh.matrix(spark, str(tmp_path), mixed.zipdist))
        dims[most] = {r.dim for r in staged["values"].select("dim").distinct().collect()}
    assert found[10_000] == found[3] == found[0]
    assert dims[10_000] == {"zip", *daily.SNAPSHOTS} and dims[0] == set(daily.DIMENSIONS)


def test_wide_rows_of_crowded_styles_are_the_same_and_others_are_not_counted_by_value(mixed, monkeypatch):
    staged = []

    def stage(df, label):
        staged.append(label)
        return staging.stage(df, label)

    monkeypatch.setattr(markets, "stage", stage)
    found = {}
    for most, repeated in ((10_000, 100_000), (10_000, 100), (12, 100_000)):
        monkeypatch.setattr(together, "TOGETHER", most)
        monkeypatch.setattr(together, "REPEATED", repeated)
        staged.clear()
        found[most, repeated] = sorted_rows(markets.wide_metrics(mixed, AS_OF))
        assert ("wide-values" in staged) == ((most, repeated) != (10_000, 100_000)), staged
    one, *others = found.values()
    assert len(one) > 40 and all(other == one for other in others)


def test_wide_rows_of_a_style_are_shuffled_once(spark):
    inputs = tpch.staged_inputs(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(markets.wide_metrics(inputs, AS_OF))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Round|Single)", plan)) == 1, plan


def test_values_with_many_rows_or_places_are_crowded(spark):
    rows = spark.createDataFrame([(1, "a")] * 5 + [(2, z) for z in "abcd"] + [(3, "a"), (3, None)], "k int, zip string")
    assert {r.k for r in together.crowded_markets(rows, "k", "zip", 4, 15).collect()} == {1, 2}
    assert {r.k for r in together.crowded_markets(rows, "k", "zip", 5, 16).collect()} == set()
