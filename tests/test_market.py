"""Markets: cars counted once per covering centre, bands, and the wide table."""

from conftest import AS_OF, ago, rows_of

from forecourt.operators.listing import listing_fact
from forecourt.operators.market import band_counts, market_bands, market_fact
from forecourt.plans import daily

DISTANCES = [
    ("1", "1", 0.0), ("2", "2", 0.0), ("3", "3", 0.0), ("4", "4", 0.0),
    ("1", "2", 20.0), ("2", "1", 20.0), ("2", "3", 90.0), ("3", "2", 90.0),
    ("1", "3", 110.0), ("3", "1", 110.0), ("9", "2", 1.0), ("4", "2", 240.0), ("2", "4", 240.0),
]
ZIPS = {1: "1", 2: "2", 3: "3", 4: "4"}


def facts_of(inputs):
    return listing_fact(inputs.hist, inputs.dealers, inputs.vins, AS_OF)


def test_a_car_belongs_to_every_covering_market(listings):
    inputs = listings([{"dealer": d} for d in (1, 2, 3)], ZIPS, DISTANCES)
    rows = market_fact(facts_of(inputs), inputs.zipdist).collect()
    got = sorted((r.zip, r.vin) for r in rows)
    assert got == [("1", "v0"), ("1", "v1"), ("2", "v0"), ("2", "v1"), ("2", "v2"),
                   ("3", "v1"), ("3", "v2")]
    assert {(r.zip, r.zip_style) for r in rows} == {(z, f"{z}*7") for z in "123"}


def test_bands_grow_and_nationwide_counts_everything(listings):
    inputs = listings([{"dealer": d, "sold": d == 1} for d in (1, 2, 3, 4)], ZIPS, DISTANCES)
    rows = rows_of(market_bands(facts_of(inputs), inputs.zipdist), "band", "zip")
    cars = {k: r["cars_sold"] + r["cars_lstd"] for k, r in rows.items()}
    assert [cars[b, "2"] for b in ("25", "50", "100", "250")] == [2, 2, 3, 4]
    assert [cars.get((b, "1")) for b in ("25", "100", "250")] == [2, 2, 3]
    assert cars["nationwide", None] == 4
    assert rows["25", "1"]["cars_sold"] == 1


def test_market_metrics_equal_metrics_over_expanded_cars(listings):
    cars = [{"dealer": 1 + i % 4, "price": 100 + i, "sold": i % 2 == 0} for i in range(60)]
    inputs = listings(cars, ZIPS, DISTANCES)
    expanded = market_fact(facts_of(inputs), inputs.zipdist)
    rows = rows_of(daily.dimension_table(inputs, "zip", "price", AS_OF), "zip")
    want = {}
    for r in expanded.collect():
        want.setdefault(r.zip, []).append(r)
    assert set(rows) == set(want)
    for zip_, group in want.items():
        assert rows[zip_]["cars_sold"] == sum(r.sold_flg for r in group)
        assert rows[zip_]["cars_lstd"] == sum(not r.sold_flg for r in group)


def test_wide_table_has_every_scope(listings):
    cars = [{"dealer": 1}, {"dealer": 2, "sold": True}, {"dealer": 3, "last": ago(50)}]
    inputs = listings(cars, ZIPS, DISTANCES)
    rows = rows_of(daily.wide_daily(inputs, AS_OF), "dealer_id", "style_id")
    row = rows[2, 7]
    assert row["calendar_date"] == AS_OF
    assert row["cars_sold_dealer_today"] == 1 and row["cars_lstd_dealer_today"] == 0
    assert row["cars_lstd_25_mile_market_today"] == 1
    assert row["cars_lstd_100_mile_market_45_day"] == 1
    assert row["cars_lstd_100_mile_market_60_day"] == 2
    assert row["cars_lstd_nationwide_90_day"] == 2
    assert rows[1, 7]["cars_sold_25_mile_market_today"] == 1


def test_counts_go_only_to_centres_that_have_the_key(spark):
    facts = spark.createDataFrame(
        [("10", 1, 1), ("20", 2, 1), ("20", 1, 1), ("30", 3, 1), (None, 1, 1)], "zip string, style_id long, sold int"
    )
    zips = ["10", "20", "30"]
    zipdist = spark.createDataFrame(
        [(a, b, abs(int(a) - int(b)) * 4.0) for a in zips for b in zips], "zip1 string, zip2 string, distance double"
    )
    found = band_counts(facts, zipdist, ["style_id"], ["sold"], (25, 50))
    rows = {(r["zip"], r.style_id): (r.sold_25, r.sold_50) for r in found.collect()}
    assert rows == {("10", 1): (1, 2), ("20", 1): (1, 2), ("20", 2): (1, 1), ("30", 3): (1, 1)}
