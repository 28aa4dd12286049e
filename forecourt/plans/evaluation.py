"""The outlier study from listings to errors, for any key, window and set of rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.functions.rules import MIN_NS, RULES, Rule
from forecourt.operators.histogram import attach, value_histogram
from forecourt.operators.listing import study_rows, with_names
from forecourt.operators.scoring import add_sums, common_errors, common_sums, mae_own
from forecourt.operators.study import (
    JUDGED,
    base_stats,
    dispersion,
    estimates,
    judged,
    judged_together,
    price_histogram,
    prices,
)
from forecourt.operators.together import TOGETHER, apart_groups, crowded_groups
from forecourt.staging import stage
from forecourt.sources.schemas import Inputs

ALL_RULES = tuple(RULES.values())

# Score windows in days, from the narrowest to all days.
WINDOWS = {"curr": 1, "45": 45, "90": 90, "120": 120}
ALL_DAYS = "all"


@dataclass(frozen=True)
class Grain:
    """What a study groups by, and which columns describe a group.

    Keys that have few cars as a rule are judged where their cars lie `together`, others by value.
    """

    key: tuple[str, ...]
    carry: tuple[str, ...]
    required: tuple[str, ...]
    models: bool = False
    together: bool = True


STYLE = Grain(("style_id",), ("model_year", "make"), ("model_year", "style_id"))
YMM = Grain(("model_year", "make_id", "model_id"), ("make", "model"), ("model_year",), models=True, together=False)


def named_rows(inputs: Inputs, grain: Grain, start: date | str, end: date | str) -> DataFrame:
    """Study rows with make (and model) names; one row set for every later step."""
    rows = study_rows(inputs.hist, inputs.dealers, inputs.vins, start, end, grain.required)
    return with_names(rows, inputs.divisions, inputs.models if grain.models else None)


def histogram(inputs: Inputs, grain: Grain, start: date | str, end: date | str) -> DataFrame:
    return price_histogram(named_rows(inputs, grain, start, end), grain.key, grain.carry)


def fitted_bounds(hist: DataFrame, base: DataFrame, key: Sequence[str]) -> DataFrame:
    """Median and both deviations per key: what rules need beyond group statistics."""
    return base.select(*key, "median").join(dispersion(hist, base, key), list(key), "inner")


def rule_table(
    inputs: Inputs, grain: Grain, rule: str, min_n: int, start: date | str, end: date | str
) -> DataFrame:
    """Estimate, outlier count and share of one rule per key."""
    chosen = RULES[rule]
    hist = stage(histogram(inputs, grain, start, end), "prices")
    key = list(grain.key)
    if chosen.deviations:
        base = stage(base_stats(hist, key).select(*key, "median"), "medians")
        rows = judged(hist, key, fitted_bounds(hist, base, key))
    else:
        rows = judged(hist, key)
    return estimates(rows, key, [chosen], [min_n])


@dataclass(frozen=True)
class Study:
    """A staged fit: the price histogram, its ranked rows if kept, and everything known per key."""

    grain: Grain
    hist: DataFrame
    comparison: DataFrame
    ranked: DataFrame | None = None


def fit(
    inputs: Inputs,
    grain: Grain,
    start: date | str,
    end: date | str,
    rules: Sequence[Rule] = ALL_RULES,
    min_ns: Sequence[int] = MIN_NS,
    keep_rows: bool = False,
) -> Study:
    """Estimates of all rules beside the base statistics, one row per key, with the columns that
    describe it, such as the make.

    With `keep_rows` the ranked rows are staged, for scores over the same rows.
    """
    key = list(grain.key)
    if not grain.together:
        hist = stage(histogram(inputs, grain, start, end), "prices")
        return study_of(grain, hist, judged_by_value(hist, key), rules, min_ns, keep_rows)
    cars = stage(prices(named_rows(inputs, grain, start, end), key, carried(grain)), "prices")
    crowd = stage(crowded_groups(cars, key, TOGETHER), "crowded")
    return study_of(grain, *judged_cars(cars, grain, crowd), rules, min_ns, keep_rows)


def carried(grain: Grain) -> list[str]:
    return [c for c in grain.carry if c not in grain.key]


def judged_by_value(hist: DataFrame, key: Sequence[str]) -> DataFrame:
    base = stage(base_stats(hist, key).select(*key, "median"), "base")
    return judged(hist, key, fitted_bounds(hist, base, key))


def judged_cars(cars: DataFrame, grain: Grain, crowd: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Price histogram and judged rows of prices per car: keys of `crowd` go by value."""
    key, carry = list(grain.key), carried(grain)
    hist, many = apart_groups(cars.select(*key, *carry, "bucket", "x", "n"), key, crowd)
    rows = judged_together(hist, key, carry)
    if many is not None:
        counted = stage(value_histogram(many, key, carry, copies="n"), "prices")
        rows = rows.unionByName(judged_by_value(counted, key).select(rows.columns))
        hist = hist.unionByName(counted)
    return hist, rows


def study_of(
    grain: Grain,
    hist: DataFrame,
    rows: DataFrame,
    rules: Sequence[Rule] = ALL_RULES,
    min_ns: Sequence[int] = MIN_NS,
    keep_rows: bool = False,
) -> Study:
    """Estimates of judged rows, beside the base statistics."""
    key, carry = list(grain.key), carried(grain)
    if keep_rows:
        rows = stage(rows, "ranked")
    fitted = estimates(rows, key, rules, min_ns, keep=JUDGED, carry=carry)
    described = {
        "n": "n_group",
        "mean": X.whole("mean"),
        "std": X.whole("std"),
        "median": "median",
        "min": X.whole("low / 100D"),
        "max": X.whole("high / 100D"),
    }
    rest = [c for c in fitted.columns if c not in {*key, *JUDGED}]
    comparison = fitted.select(*key, *X.named(described), "mad", "meanad", *rest)
    return Study(grain, hist, comparison, rows if keep_rows else None)


def compare_methods(
    inputs: Inputs, grain: Grain, start: date | str, end: date | str
) -> DataFrame:
    """The wide comparison of all rules at both minimum samples, with names."""
    return fit(inputs, grain, start, end).comparison


def own_errors(study: Study, min_ns: Sequence[int] = MIN_NS) -> DataFrame:
    """Every method scored on the rows it keeps, over the fitted rows."""
    key = list(study.grain.key)
    names = [f"avg_price_{r.name}_{t}" for r in ALL_RULES for t in min_ns]
    fitted = stage(study.comparison.select(*key, "median", "mad", "meanad", *names), "comparison")
    if study.ranked is None:
        return mae_own(judged(study.hist, key, fitted), ALL_RULES, min_ns)
    return mae_own(attach(study.ranked, fitted.select(*key, *names), key), ALL_RULES, min_ns)


def scored(study: Study, score_hist: DataFrame, rules: Sequence[Rule] = ALL_RULES) -> DataFrame:
    """Score rows with the fit of their key; keys without a fit stay, with NULLs."""
    return attach(score_hist, fit_columns(study, rules), study.grain.key, "left")


def fit_columns(study: Study, rules: Sequence[Rule] = ALL_RULES) -> DataFrame:
    """What scores need of a fit, by key."""
    names = [f"avg_price_{r.name}_11" for r in rules]
    return study.comparison.select(
        *study.grain.key,
        F.col("n").alias("n_group"),
        F.col("mean").alias("fit_mean"),
        "median",
        "mad",
        "meanad",
        *names,
    )


def common_error_row(study: Study, score_hist: DataFrame) -> DataFrame:
    """Every method scored on the rows kept by one common rule, in one row."""
    return common_errors(common_sums(scored(study, score_hist), ALL_RULES), ALL_RULES)


def backtest(
    inputs: Inputs,
    grain: Grain,
    fit_end: date,
    fit_days: int,
    score_start: date | str,
    score_end: date | str,
) -> DataFrame:
    """Fit on the days up to `fit_end`, score on the listings of a later period.

    Listings of both periods are read and decoded at once, and those of a key are fitted and scored where they
    lie together.
    """
    key = list(grain.key)
    start = fit_end - timedelta(days=fit_days - 1)
    fits, scores = (X.as_date(start), X.as_date(fit_end)), (X.as_date(score_start), X.as_date(score_end))
    first, last = F.least(fits[0], scores[0]), F.greatest(fits[1], scores[1])
    seen = F.col("vin_last_dt")
    periods = {"fits": seen.between(*fits), "scores": seen.between(*scores)}
    listed = study_rows(inputs.hist, inputs.dealers, inputs.vins, first, last, grain.required)
    ids = [c for c in ("model_year", "make_id", *(["model_id"] if grain.models else [])) if c not in key]
    cars = prices(listed.withColumns(periods).filter("fits or scores"), key, [*ids, *periods], null_groups=True)
    cars = stage(cars, "prices")
    crowd = stage(crowded_groups(cars, key, TOGETHER), "crowded")

    known = " and ".join(f"{c} is not null" for c in key)
    named = with_names(
        cars.filter("fits").filter(known), inputs.divisions, inputs.models if grain.models else None
    )
    study = study_of(grain, *judged_cars(named, grain, crowd), min_ns=(11,))
    fitted = fit_columns(study)
    later, many = apart_groups(cars.filter("scores").select(*key, "bucket", "x", "n"), key, crowd)
    if many is None:
        rows = later.join(fitted, key, "left")
    else:
        fitted = stage(fitted, "fitted")
        counted = stage(value_histogram(many, key, copies="n", null_groups=True), "scored-prices")
        rows = later.join(fitted, key, "left").unionByName(attach(counted, fitted, key, "left"))
    return common_errors(common_sums(rows, ALL_RULES), ALL_RULES)


def narrowest_window(
    last_seen: Column, as_of: date | str, windows: Mapping[str, int]
) -> Column:
    """Label of the narrowest window a day falls in; ALL_DAYS outside all of them.

    `windows` come narrowest first.
    """
    age = F.datediff(X.as_date(as_of), last_seen)
    label = F.lit(None).cast("string")
    for name, days in windows.items():
        label = F.coalesce(label, F.when(age < days, name))
    return F.coalesce(label, F.lit(ALL_DAYS))


def mae_by_window(
    study: Study,
    rows: DataFrame,
    as_of: date | str,
    windows: Mapping[str, int] = WINDOWS,
) -> DataFrame:
    """Common-filter errors per score window, one labelled row each.

    Windows are nested, so each listing is counted once, in its narrowest
    window, and the sums of narrow windows are added to the wider ones. A window
    without listings has a row with NULL errors. Windows may come in any order.
    """
    windows = dict(sorted(windows.items(), key=lambda w: w[1]))
    if len(set(windows.values())) < len(windows) or ALL_DAYS in windows:
        raise ValueError("windows need different days, and names other than that of all days")
    labels = [*windows, ALL_DAYS]
    classed = rows.withColumn("window", narrowest_window(F.col("vin_last_dt"), as_of, windows))
    hist = price_histogram(classed, [*study.grain.key, "window"], null_groups=True)
    sums = common_sums(scored(study, stage(hist, "window-prices")), ALL_RULES, ["window"])
    covering = F.create_map(
        *[
            part
            for i, label in enumerate(labels)
            for part in (F.lit(label), F.array(*[F.lit(w) for w in labels[i:]]))
        ]
    )
    stacked = sums.withColumn("dim", F.explode(covering[F.col("window")]))
    added = add_sums(stacked, ALL_RULES, ["dim"])
    named = rows.sparkSession.createDataFrame([(label,) for label in labels], "dim string")
    return common_errors(named.join(added, "dim", "left"), ALL_RULES, ["dim"])
