"""Metrics of nested cells against the same metrics of each cell by itself."""

import random

import pytest
from conftest import AS_OF, ago, rows_of
from pyspark.sql import functions as F

from forecourt.operators.histogram import CHUNK, value_histogram
from forecourt.operators.metrics import metric_summary
from forecourt.operators.nested import cell_histogram, cell_summary, crossed, narrowest, nested_cells
from forecourt.plans import markets


def test_narrowest_bound(spark):
    df = spark.createDataFrame([(0.0,), (25.0,), (25.5,), (250.0,), (251.0,), (None,)], "d double")
    found = [r[0] for r in df.select(narrowest(F.col("d"), (25, 50, 250))).collect()]
    assert found == [0, 0, 1, 2, None, None]


@pytest.mark.parametrize("spread", [50, 3 * CHUNK])
def test_cells_are_what_each_group_alone_would_be(spark, spread):
    rng = random.Random(spread)
    rows = [
        (rng.choice("ab"), rng.choice((0, 1, -1)), rng.choice((0, 1)), rng.randint(1, spread), rng.randrange(3), rng.randrange(2))
        for _ in range(400)
    ] + [("c", 1, 1, 7, 2, 1), (None, 1, 1, 7, 0, 0), ("a", 1, 1, None, 0, 0)]
    df = spark.createDataFrame(rows, "k string, sold int, moved int, x long, age int, band int")
    df = df.withColumn("measure", F.lit("price"))
    cells = crossed(nested_cells("a", "age", 3), nested_cells("b", "band", 2))
    hist = cell_histogram(df, ["k", "measure", "sold"], cells, moved="moved")
    got = rows_of(cell_summary(hist, ["k"], cells, 90), "k", "cell")
    want = {}
    for age in range(3):
        for band in range(2):
            part = df.filter(f"age <= {age} and band <= {band}")
            alone = value_histogram(part, ["k", "measure", "sold"], ["moved"])
            for k, r in rows_of(metric_summary(alone, ["k"], 90), "k").items():
                want[k, f"a{age}_b{band}"] = r | {"cell": f"a{age}_b{band}"}
    assert got == want
    assert ("c", "a2_b1") in got and ("c", "a1_b1") not in got


def test_bands_are_nested_and_the_nation_has_all(listings):
    cars = [{"dealer": d, "price": 1000 * d + i, "sold": True} for d in (1, 2, 3) for i in range(4)]
    zips = {1: "10", 2: "20", 3: "30"}
    far = {("10", "20"): 40.0, ("10", "30"): 200.0, ("20", "30"): 300.0}
    distances = [(z, z, 0.0) for z in zips.values()]
    distances += [(a, b, d) for (a, b), d in far.items()] + [(b, a, d) for (a, b), d in far.items()]
    found = markets.metric_matrix_bands(listings(cars, zips, distances), AS_OF)
    sold = {
        (r.band, r.key): r.cars_sold
        for r in found.filter("measure = 'price' and dim = 'zip'").collect()
    }
    assert sold == {
        ("25", "10"): 4, ("50", "10"): 8, ("100", "10"): 8, ("250", "10"): 12,
        ("25", "20"): 4, ("50", "20"): 8, ("100", "20"): 8, ("250", "20"): 8,
        ("25", "30"): 4, ("50", "30"): 4, ("100", "30"): 4, ("250", "30"): 8,
        ("nationwide", "nationwide"): 12,
    }
    styled = found.filter("measure = 'price' and dim = 'zip_style' and band = '50'")
    assert {r.key for r in styled.collect()} == {"10*7", "20*7", "30*7"}


def test_wide_table_of_a_small_market(listings):
    cars = [
        {"last": ago(1), "first": ago(1), "sold": True, "price": 100},
        {"last": ago(45), "first": ago(50), "sold": True, "price": 300},
        {"last": ago(45), "first": ago(50), "sold": True, "price": 200},
        {"last": ago(46), "first": ago(90), "price": 500},
        {"last": ago(91), "price": 900},  # outside all snapshots
        {"last": ago(0), "price": 700, "dealer": 2},  # the day itself is not today's snapshot
    ]
    inputs = listings(cars, {1: "10", 2: "20"}, [("10", "10", 0.0), ("20", "20", 0.0), ("10", "20", 60.0), ("20", "10", 60.0)])
    rows = rows_of(markets.wide_metrics(inputs, AS_OF), "dealer_id", "style_id")
    assert set(rows) == {(1, 7), (2, 7)}
    one, two = rows[1, 7], rows[2, 7]
    assert [one[f"cars_sold_dealer_{w}"] for w in markets.WINDOWS] == [1, 3, 3, 3]
    assert [one[f"cars_lstd_dealer_{w}"] for w in markets.WINDOWS] == [0, 0, 1, 1]
    assert [one[f"cars_moved_on_dealer_{w}"] for w in markets.WINDOWS] == [1, 1, 3, 4]
    assert [one[f"days_supply_dealer_{w}"] for w in markets.WINDOWS] == [None, 0, 20, 30]
    assert [one[f"median_price_sold_dealer_{w}"] for w in markets.WINDOWS] == [100, 200, 200, 200]
    assert one["max_price_sold_25_mile_market_45_day"] == 300
    assert one["avg_price_lstd_50_mile_market_45_day"] is None
    assert one["avg_price_lstd_100_mile_market_45_day"] == 700
    assert one["avg_price_lstd_nationwide_90_day"] == 600
    assert two["cars_lstd_dealer_today"] == 0 and two["cars_lstd_dealer_45_day"] == 1
    assert two["min_price_sold_100_mile_market_60_day"] == 100
    assert len(one) == 3 + 24 * (4 + 32)
