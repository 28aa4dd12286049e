"""The thirteen rules against a row-by-row version in Python."""

import math
import random
import statistics

import pytest
from conftest import AS_OF, ago, rows_of

from forecourt.functions.rules import RULES, small
from forecourt.operators.study import estimates, judged
from forecourt.plans import evaluation as ev

RNG = random.Random(11)
GROUPS = {
    1: [100, 101, 102, 103, 900],
    2: [100, 101, 102, 103, 104, 900],
    3: [100, 101, 102, 103, 104, 105, 106, 107, 108, 900],
    4: [100, 101, 102, 103, 104, 105, 106, 107, 108, 109, 900],
    5: [500] * 9 + [495, 900],
    6: [100, 100, 101, 102, 103, 100, 99, 98, 97, 100, 82, 118],
    7: [1000 + i for i in range(50)],
    8: [1000 + i // 3 for i in range(250)],
    9: [RNG.choice([50, 50, 51, 49, RNG.randrange(1, 90000)]) for _ in range(400)],
    10: [42],
    11: [70] * 20,
    12: [round(RNG.lognormvariate(9, 0.6), 2) for _ in range(101)],
}


def half_up(x):
    return math.floor(abs(x) + 0.5) * (1 if x >= 0 else -1)


def ntile_100(prices):
    """Group number of each price, highest first; earlier groups take the remainder."""
    size, extra = divmod(len(prices), 100)
    numbers = []
    for group in range(1, 101):
        numbers += [group] * (size + (group <= extra))
    return list(zip(sorted(prices, reverse=True), numbers, strict=True))


def expected(prices, name, t):
    """Kept prices and the outlier count, by the definition of the rule."""
    n = len(prices)
    if n < t:
        return prices, 0
    med = half_up(statistics.median(prices))
    gaps = [abs(p - med) for p in prices]
    mad, mean_gap = statistics.median(gaps), sum(gaps) / n
    mean, std = statistics.fmean(prices), statistics.stdev(prices)
    logs = [math.log(p) for p in prices]
    log_mean, log_std = statistics.fmean(logs), statistics.stdev(logs)
    flat = mad == 0
    bounds = {
        "med": (5.189 * mad, 5.189 * mad),
        "med_nob": (3.5 * mad, 3.5 * mad),
        "med_dl": (3.7 * mad, 5.189 * mad),
        "med_nob_dl": (2.5 * mad, 3.5 * mad),
        "med_ibm": (4.3866 * mean_gap,) * 2 if flat else (5.189 * mad,) * 2,
        "med_nob_ibm": (3.5 * (mean_gap if flat else mad),) * 2,
        "med_dl_ibm": (3.13 * mean_gap, 4.3866 * mean_gap) if flat else (3.7 * mad, 5.189 * mad),
        "med_nob_dl_ibm": tuple(k * (mean_gap if flat else mad) for k in (2.5, 3.5)),
    }
    tiny = 1e-7
    if name in bounds:
        low, high = bounds[name]
        kept = [p for p in prices if -low - tiny <= p - med <= high + tiny]
    elif name == "ntiles":
        kept = [p for p, group in ntile_100(prices) if 2 <= group <= 99]
    elif name in ("emp", "chb"):
        k = 3 if name == "emp" else 4.5
        kept = [p for p in prices if abs(p - mean) <= k * std + tiny]
    else:
        k = int(name[0])
        kept = [p for p in prices if abs(math.log(p) - log_mean) <= k * log_std + tiny]
    return kept, n - len(kept)


@pytest.fixture(scope="module")
def judged_groups(spark):
    rows = [(style, float(p)) for style, prices in GROUPS.items() for p in prices]
    df = spark.createDataFrame(rows, "style_id long, price double")
    hist = ev.price_histogram(df, ["style_id"]).cache()
    base = ev.base_stats(hist, ["style_id"])
    bounds = ev.fitted_bounds(hist, base, ["style_id"])
    rows = judged(hist, ["style_id"], bounds)
    return rows_of(estimates(rows, ["style_id"], ev.ALL_RULES, (11, 6)), "style_id")


@pytest.mark.parametrize("t", [11, 6])
@pytest.mark.parametrize("name", list(RULES))
def test_rule_matches_its_definition(judged_groups, name, t):
    for style, prices in GROUPS.items():
        kept, outliers = expected(prices, name, t)
        row = judged_groups[style]
        want = half_up(round(sum(kept) / len(kept), 9)) if kept else None
        assert row[f"outlier_{name}_{t}"] == outliers, (style, name)
        assert row[f"avg_price_{name}_{t}"] == want, (style, name)
        share = row[f"outlier_{name}_pct_{t}"]
        assert share == pytest.approx(outliers / len(prices), abs=1e-6)


def test_small_samples_are_trimmed_only_from_the_minimum_on(judged_groups):
    assert [judged_groups[s]["outlier_med_6"] for s in (1, 2, 3, 4)] == [0, 1, 1, 1]
    assert [judged_groups[s]["outlier_med_11"] for s in (1, 2, 3, 4)] == [0, 0, 0, 1]


def test_invariants(judged_groups):
    for style, row in judged_groups.items():
        for name in RULES:
            assert row[f"outlier_{name}_6"] >= row[f"outlier_{name}_11"], (style, name)
        assert row["outlier_med_nob_11"] >= row["outlier_med_11"]
        if style != 5 and style != 11:
            for name in ("med", "med_nob", "med_dl", "med_nob_dl"):
                assert row[f"outlier_{name}_11"] == row[f"outlier_{name}_ibm_11"]


def test_half_equal_prices_use_the_mean_deviation(judged_groups):
    assert judged_groups[5]["outlier_med_11"] == 2
    assert judged_groups[5]["outlier_med_ibm_11"] == 1


def test_asymmetric_rule_drops_the_low_price_only(judged_groups):
    assert judged_groups[6]["outlier_med_dl_11"] >= 1
    assert judged_groups[6]["outlier_med_dl_11"] <= judged_groups[6]["outlier_med_nob_dl_11"]


def test_a_minimum_of_one_row_is_refused():
    with pytest.raises(ValueError, match="two rows"):
        small(1)


def test_rule_table_from_listings(listings):
    prices = GROUPS[4]
    inputs = listings([{"price": p, "last": ago(5)} for p in prices])
    for name in ("med", "2std_log", "ntiles"):
        table = ev.rule_table(inputs, ev.STYLE, name, 11, ago(90), AS_OF)
        kept, outliers = expected(prices, name, 11)
        row = rows_of(table, "style_id")[7]
        assert row[f"outlier_{name}_11"] == outliers
        assert row[f"avg_price_{name}_11"] == half_up(sum(kept) / len(kept))
