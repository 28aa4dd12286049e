"""Metric tables: hand-made keys, and the matrix against single tables."""

import pytest
from conftest import AS_OF, ago, rows_of

from forecourt.operators.metrics import metric_table, published_names
from forecourt.plans import daily


def table(inputs, key="dealer_id", measure="price", days=90):
    return metric_table(daily.daily_facts(inputs, AS_OF), key, measure, AS_OF, days)


def cars(sold, listed, **more):
    return [{"sold": True, **more}] * sold + [{"sold": False, **more}] * listed


def test_documented_days_of_supply(listings):
    groups = cars(8, 6, dealer=1) + cars(12, 3, dealer=2) + cars(2, 5, dealer=3)
    inputs = listings(groups + cars(3, 2, dealer=4), zips=dict.fromkeys((1, 2, 3, 4), "10"))
    rows = rows_of(table(inputs), "dealer_id")
    assert [rows[d]["days_supply"] for d in (1, 2, 3, 4)] == [68, 23, None, 60]
    assert (rows[1]["cars_sold"], rows[1]["cars_lstd"]) == (8, 6)


def test_unknown_sold_flag_counts_only_as_moved_on(listings):
    row = rows_of(table(listings([{"sold": None}, {"sold": True}])), "dealer_id")[1]
    assert (row["cars_sold"], row["cars_lstd"], row["cars_moved_on"]) == (1, 0, 2)
    assert row["avg_lstd"] is None and row["median_lstd"] is None


def test_moved_on_edge(listings):
    seen = [{"first": ago(89)}, {"first": ago(90)}]
    assert rows_of(table(listings(seen)), "dealer_id")[1]["cars_moved_on"] == 1


def test_window_edge_and_measures_above_zero(listings):
    kept = [{"last": ago(89)}, {"last": ago(90)}, {"price": 0}, {"price": -1}, {"price": None}]
    assert rows_of(table(listings(kept)), "dealer_id")[1]["cars_lstd"] == 1


def test_medians_of_odd_and_even_groups(listings):
    odd = [{"price": p, "sold": True} for p in (1, 2, 3)]
    even = [{"price": p, "sold": False} for p in (1, 2, 3, 10)]
    row = rows_of(table(listings(odd + even)), "dealer_id")[1]
    assert (row["median_sold"], row["median_lstd"]) == (2, 3)


def test_trim_starts_at_six_cars_and_spares_the_median(listings):
    prices = [100, 101, 99, 100, 100]
    five = [{"price": p, "dealer": 1} for p in [*prices[:4], 9000]]
    many = [{"price": p, "dealer": 2} for p in [*prices * 3, 9000]]
    rows = rows_of(table(listings(five + many, zips={1: "10", 2: "10"})), "dealer_id")
    assert rows[1]["max_lstd"] == 9000 and rows[1]["avg_lstd"] == 1880
    assert rows[2]["max_lstd"] == 101 and rows[2]["avg_lstd"] == 100
    assert rows[2]["median_lstd"] == 100


def test_published_names(listings):
    named = published_names(table(listings([{}])), "dealer_id", "price")
    assert {
        "dealer_id",
        "avg_price_dealer_id_sold",
        "min_price_dealer_id_lstd",
        "median_price_lstd",
        "dealer_id_days_supply",
        "cars_moved_on",
    } <= set(named.columns)


@pytest.fixture
def mixed(listings):
    rows = [
        {
            "dealer": i % 3,
            "style": 5 + i % 2,
            "sold": [True, False, None][i % 3],
            "price": 100 + 37 * i % 1000,
            "mileage": 1000 * (i % 7),
            "first": ago(3 + i % 100),
            "last": ago(1 + i % 95),
        }
        for i in range(90)
    ]
    distances = [(a, b, d) for a, b, d in
                 [("10", "10", 0.0), ("10", "11", 80.0), ("11", "10", 80.0), ("11", "11", 0.0),
                  ("12", "12", 0.0), ("12", "11", 100.0), ("11", "12", 100.0),
                  ("99", "10", 5.0)]]
    return listings(rows, zips={0: "10", 1: "11", 2: "12"}, distances=distances)


def test_matrix_equals_the_single_tables(mixed):
    matrix = rows_of(daily.metric_matrix(mixed, AS_OF), "dim", "measure", "key")
    seen = 0
    for dim in ("dealer_id", "snapshot_45", "zip", "zip_style"):
        for measure in ("price", "days_on_lot"):
            for key, row in rows_of(
                daily.dimension_table(mixed, dim, measure, AS_OF), dim
            ).items():
                want = {k: v for k, v in row.items() if k != dim}
                got = matrix[dim, measure, str(key)]
                assert {k: got[k] for k in want} == want
                seen += 1
    keys = {(d, m, k) for d, m, k in matrix if d in ("dealer_id", "snapshot_45", "zip",
            "zip_style") and m in ("price", "days_on_lot")}
    assert seen == len(keys)
    assert {d for d, _, _ in matrix} == set(daily.DIMENSIONS)
