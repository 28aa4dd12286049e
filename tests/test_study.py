"""Comparison, errors, backtest and windows against plain Python over the same cars."""

import random
from datetime import date, timedelta

import pytest
from conftest import AS_OF, ago, rows_of
from pyspark.sql import functions as F
from test_rules import expected, half_up

from forecourt.functions.rules import RULES
from forecourt.operators import checks, reports
from forecourt.operators.listing import study_rows
from forecourt.plans import evaluation as ev


@pytest.fixture
def cars():
    rng = random.Random(3)
    found = []
    for style, n in ((1, 4), (2, 8), (3, 30), (4, 130)):
        for _ in range(n):
            price = round(rng.lognormvariate(9, 0.5), 2) if rng.random() > 0.1 else 99999
            made = {"style": style, "make": style % 2, "year": str(1998 + style)}
            found.append({"price": price, "last": ago(rng.randrange(0, 80)), **made})
    return found


def by_style(cars):
    groups = {}
    for car in cars:
        groups.setdefault(car["style"], []).append(car["price"])
    return groups


def test_comparison_and_own_errors(listings, cars):
    inputs = listings(cars)
    study = ev.fit(inputs, ev.STYLE, ago(90), AS_OF)
    rows = rows_of(study.comparison, "style_id")
    errors = ev.own_errors(study).first().asDict()
    groups = by_style(cars)
    for name in RULES:
        for t in (11, 6):
            total = count = 0
            for style, prices in groups.items():
                kept, outliers = expected(prices, name, t)
                estimate = half_up(round(sum(kept) / len(kept), 9))
                assert rows[style][f"avg_price_{name}_{t}"] == estimate
                assert rows[style][f"outlier_{name}_{t}"] == outliers
                total += sum(abs(p - estimate) for p in kept)
                count += len(kept)
            assert errors[f"mae_{name}_{t}"] == pytest.approx(total / len(cars), abs=1e-3)
            assert errors[f"mae_kept_{name}_{t}"] == pytest.approx(total / count, abs=1e-3)
    assert rows[1]["make"] == "make1" and rows[1]["model_year"] == "1999"


def test_common_error_counts_rows_without_a_fit(listings, cars):
    late = [{"style": 9, "price": 500, "last": ago(0)}, {"style": 1, "price": 700, "last": ago(0)}]
    early = [c | {"last": c["last"] - timedelta(days=5)} for c in cars]
    inputs = listings(early + late)
    row = ev.backtest(inputs, ev.STYLE, ago(3), 90, ago(2), AS_OF).first().asDict()
    estimate = half_up(sum(by_style(cars)[1]) / 4)
    assert row["price_rough"] == 600 and row["price"] == 700
    assert row["mae_mean"] == pytest.approx(abs(700 - estimate) / 2)
    assert row["mae_kept_med"] == pytest.approx(abs(700 - estimate))


def test_backtest_reads_listings_once_and_shuffles_them_by_key_only(listings, cars, monkeypatch):
    reads = []
    monkeypatch.setattr(ev, "study_rows", lambda *a: reads.append(a) or study_rows(*a))
    row = ev.backtest(listings(cars), ev.STYLE, ago(20), 90, ago(19), AS_OF)
    plan = row._jdf.queryExecution().executedPlan().toString()
    assert len(reads) == 1
    assert 1 <= plan.count("hashpartitioning(style_id") <= 2 and "hashpartitioning(style_id, bucket" not in plan
    assert "Window" not in plan


@pytest.mark.parametrize("grain", [ev.STYLE, ev.YMM])
def test_crowded_keys_are_fitted_and_scored_alike(listings, cars, monkeypatch, grain):
    late = [{"style": 3, "price": 10000 + n, "last": ago(n % 19), "make": 1, "year": "2001"} for n in range(30)]
    unknown = [{"model": None, "price": 500 + n, "last": ago(n % 40)} for n in range(25)]
    inputs = listings(cars + late + unknown)
    periods = (ago(20), 90, ago(19), AS_OF)
    together = ev.backtest(inputs, grain, *periods).first()
    fit = rows_of(ev.fit(inputs, grain, ago(90), AS_OF).comparison, *grain.key)
    later = study_rows(inputs.hist, inputs.dealers, inputs.vins, ago(19), AS_OF, grain.required)
    study = ev.fit(inputs, grain, ago(109), ago(20), min_ns=(11,))
    apart = ev.common_error_row(study, ev.price_histogram(later, grain.key, null_groups=True)).first()
    assert together == apart
    own = ev.own_errors(ev.fit(inputs, grain, ago(90), AS_OF, keep_rows=True)).first()
    monkeypatch.setattr(ev, "TOGETHER", 20)
    assert ev.backtest(inputs, grain, *periods).first() == together
    crowded = ev.fit(inputs, grain, ago(90), AS_OF, keep_rows=True)
    assert ev.own_errors(crowded).first() == own
    found = rows_of(crowded.comparison, *grain.key)
    assert found.keys() == fit.keys()
    for key, row in found.items():
        assert {c: round(v, 9) if isinstance(v, float) else v for c, v in row.items()} == {
            c: round(v, 9) if isinstance(v, float) else v for c, v in fit[key].items()
        }


def test_windows_equal_separate_runs(listings, cars):
    inputs = listings(cars)
    study = ev.fit(inputs, ev.STYLE, ago(90), AS_OF, min_ns=(11,))
    rows = study_rows(inputs.hist, inputs.dealers, inputs.vins, ago(900), AS_OF)
    got = rows_of(ev.mae_by_window(study, rows, AS_OF, {"45": 45, "10": 10}), "dim")
    for label, days in (("10", 10), ("45", 45), ("all", 900)):
        part = rows.filter(f"vin_last_dt > date '{ago(days)}'")
        want = ev.common_error_row(study, ev.price_histogram(part, ["style_id"])).first().asDict()
        assert {k: got[label][k] for k in want} == want


def test_windows_without_listings_have_a_row(listings, cars):
    inputs = listings(cars)
    study = ev.fit(inputs, ev.STYLE, ago(90), AS_OF, min_ns=(11,))
    rows = study_rows(inputs.hist, inputs.dealers, inputs.vins, None, AS_OF)
    got = rows_of(ev.mae_by_window(study, rows, date(2005, 1, 1)), "dim")
    assert set(got) == {"curr", "45", "90", "120", "all"}
    assert got["120"]["price"] is None and got["all"]["price"] is not None
    with pytest.raises(ValueError, match="different days"):
        ev.mae_by_window(study, rows, AS_OF, {"a": 5, "b": 5})


def test_rows_without_a_key_are_counted_when_scored(listings, cars):
    inputs = listings(cars)
    study = ev.fit(inputs, ev.STYLE, ago(90), AS_OF, min_ns=(11,))
    rows = study_rows(inputs.hist, inputs.dealers, inputs.vins, ago(90), AS_OF)
    some = rows.withColumn("style_id", F.when(F.col("vin") != "v0", F.col("style_id")))
    hist = ev.price_histogram(some, ["style_id"], null_groups=True)
    assert hist.agg(F.sum("n")).first()[0] == rows.count()
    kept = ev.price_histogram(rows, ["style_id"])
    both = [ev.common_error_row(study, h).first().asDict() for h in (hist, kept)]
    assert both[0]["price_rough"] == both[1]["price_rough"]
    assert both[0]["mae_mean"] < both[1]["mae_mean"]


def test_colliding_labels_stay_two_groups(listings):
    inputs = listings([{"make": 1, "model": 23}, {"make": 12, "model": 3}])
    hist = ev.histogram(inputs, ev.YMM, ago(90), AS_OF)
    assert ev.base_stats(hist, ev.YMM.key).count() == 2


def test_reports_and_sizes_add_up(listings, cars):
    inputs = listings(cars)
    comparison = ev.compare_methods(inputs, ev.STYLE, ago(90), AS_OF).cache()
    report = rows_of(reports.coverage_report(comparison, ["make"], 11), "make")
    assert sum(r["cars"] for r in report.values()) == len(cars)
    for row in report.values():
        assert row["keys_lt_11"] + row["keys_ge_11"] == row["keys"]
        assert row["outlier_emp"] + row["cars_left_emp"] == row["cars"]
    totals = reports.size_totals(comparison).first()
    assert (totals.lt_6, totals.lt_11, totals.ge_11) == (1, 2, 2)
    buckets = rows_of(reports.size_buckets(comparison), "lt_6", "lt_11", "ge_11")
    assert {k: r["keys"] for k, r in buckets.items()} == {
        (1, 1, 0): 1, (0, 1, 0): 1, (0, 0, 1): 2}
    means = rows_of(reports.outlier_report(comparison, ["model_year", "make"]), "model_year")
    styles = rows_of(comparison, "model_year")
    assert means["2002"]["outlier_emp"] == styles["2002"]["outlier_emp_11"]
    assert means["2002"]["outlier_emp_pct"] == styles["2002"]["outlier_emp_pct_11"]


def test_checks(spark, listings):
    inputs = listings([{"last": ago(7)}, {"last": ago(3), "latest": False}])
    assert checks.freshness(inputs.hist).first().latest == ago(3)
    a = spark.createDataFrame([(1, 5), (1, 5), (2, 9)], "k int, n int")
    b = spark.createDataFrame([(1, 7), (2, 4), (3, 1)], "k int, n int")
    assert tuple(checks.key_check(a, ["k"]).first()) == (3, 2)
    some = spark.createDataFrame([(1, 5), (None, 5)], "k int, n int")
    assert tuple(checks.key_check(some, ["k"]).first()) == (2, 1)
    assert tuple(checks.key_check(some.limit(0), ["k"]).first()) == (0, 0)
    assert tuple(checks.reconcile(a, b, ["k"], "n").first()) == (-2, 5)
