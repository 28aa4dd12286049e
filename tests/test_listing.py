"""Listing fact: who gets in, and every derived column."""

from datetime import date
from decimal import Decimal

import pytest
from conftest import AS_OF, ago, rows_of
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.operators.listing import (
    listing_fact,
    study_rows,
    with_keys,
    with_names,
    with_snapshots,
    with_ymm_key,
)


def fact(inputs, days=121):
    return listing_fact(inputs.hist, inputs.dealers, inputs.vins, AS_OF, days)


@pytest.mark.parametrize(
    ("year", "mileage", "want"),
    [
        ("N/A", 1000, None),
        ("", 1000, None),
        (" 1999", 1000, None),
        ("2001", 1000, Decimal("1000.00")),
        ("2005", 1000, Decimal("1000.00")),
        ("1999", 1001, Decimal("500.50")),
        ("1993", 9, Decimal("1.13")),
        ("1998", 100.5, Decimal("33.67")),
    ],
)
def test_miles_per_year(spark, year, mileage, want):
    df = spark.createDataFrame([(Decimal(str(mileage)), year)], "m decimal(12,2), y string")
    got = df.select(X.miles_per_year(F.col("m"), F.col("y"), AS_OF).alias("v")).first().v
    assert got == want


def test_days_on_lot_counts_both_ends(listings):
    cars = [{"first": ago(1), "last": ago(1)}, {"first": ago(11), "last": ago(1)}]
    rows = rows_of(fact(listings(cars)), "vin")
    assert [rows["v0"]["days_on_lot"], rows["v1"]["days_on_lot"]] == [1, 11]


def test_only_decoded_latest_cars_of_known_dealers(listings):
    cars = [
        {},
        {"dealer": 99},
        {"style": None},
        {"year": None},
        {"latest": False},
        {"last": ago(120)},
        {"last": ago(121)},
        {"last": ago(-1)},
    ]
    assert set(rows_of(fact(listings(cars)), "vin")) == {"v0", "v5"}


def test_stale_record_of_the_same_car_is_left_out(listings):
    cars = [{"vin": "x", "price": 5}, {"vin": "x", "price": 9, "latest": False}]
    rows = fact(listings(cars)).collect()
    assert [(r.vin, r.price) for r in rows] == [("x", Decimal("5.00"))]


def test_snapshot_edges(listings):
    ages = [0, 1, 45, 46, 60, 61, 90, 91]
    df = with_snapshots(fact(listings([{"last": ago(a)} for a in ages])), AS_OF)
    rows = rows_of(df, "vin")
    names = ["today_snapshot", "snapshot_45", "snapshot_60", "snapshot_90"]
    got = {a: [rows[f"v{i}"][n] for n in names] for i, a in enumerate(ages)}
    assert got == {
        0: [0, 1, 1, 1],
        1: [1, 1, 1, 1],
        45: [0, 1, 1, 1],
        46: [0, 0, 1, 1],
        60: [0, 0, 1, 1],
        61: [0, 0, 0, 1],
        90: [0, 0, 0, 1],
        91: [0, 0, 0, 0],
    }


def test_keys_and_names(listings):
    inputs = listings([{"style": 7, "make": 1, "model": 23}, {"make": 12, "model": 3}])
    df = with_names(with_ymm_key(with_keys(fact(inputs))), inputs.divisions, inputs.models)
    rows = rows_of(df, "vin")
    assert rows["v0"]["dealer_style"] == "1*7" and rows["v0"]["zip_style"] == "10*7"
    assert rows["v0"]["ymm_key"] == rows["v1"]["ymm_key"] == 1999123
    assert rows["v1"]["make"] == "make12" and rows["v1"]["model"] == "model3"


def test_study_rows_need_a_price_and_a_known_dealer(listings):
    cars = [{}, {"price": 0}, {"price": -1}, {"price": None}, {"dealer": 99}, {"last": ago(91)}]
    inputs = listings(cars + [{"last": ago(90)}, {"style": None}])
    df = study_rows(inputs.hist, inputs.dealers, inputs.vins, ago(90), AS_OF)
    assert set(rows_of(df, "vin")) == {"v0", "v6"}
    loose = study_rows(inputs.hist, inputs.dealers, inputs.vins, ago(90), AS_OF, ("model_year",))
    assert set(rows_of(loose, "vin")) == {"v0", "v6", "v7"}


def test_accepts_dates_and_text(listings):
    inputs = listings([{}])
    a = listing_fact(inputs.hist, inputs.dealers, inputs.vins, "2001-07-01")
    b = listing_fact(inputs.hist, inputs.dealers, inputs.vins, date(2001, 7, 1))
    assert a.collect() == b.collect()
