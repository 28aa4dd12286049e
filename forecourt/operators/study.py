"""Outlier study: base statistics, deviations and trimmed means per key.

All operators take a price histogram (`x`, `n`, `bucket`), see `price_histogram`. Prices of single cars are one
as well, see `prices`; where a key has few, `judged_together` needs no further shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.functions.rules import Rule, small, with_inside
from forecourt.operators.histogram import (
    attach,
    bucket,
    locate,
    median_of,
    middle,
    ranked,
    value_histogram,
)
from forecourt.operators.together import together

# What rules need beside a value and its ranks, in the order of `judged_together`.
JUDGED = ("n_group", "low", "high", "mean", "std", "mean_log", "std_log", "median", "mad", "meanad")


def price_histogram(
    rows: DataFrame, key: Sequence[str], carry: Sequence[str] = (), null_groups: bool = False
) -> DataFrame:
    """Price histogram per key; `carry` columns describe the key, such as its make."""
    prices = rows.select(*key, *carry, *X.named({"x": X.hundredths("price")}))
    return value_histogram(prices, key, carry, null_groups=null_groups)


def prices(rows: DataFrame, key: Sequence[str], others: Sequence[str] = (), null_groups: bool = False) -> DataFrame:
    """Price histogram whose copies are not added up: one row per car."""
    cars = rows.select(*key, *others, *X.named({"x": X.hundredths("price")})).withColumn("bucket", bucket())
    needed = ["bucket"] if null_groups else [*key, "bucket"]
    return cars.filter(" and ".join(f"{c} is not null" for c in needed)).withColumn("n", F.lit(1).cast("bigint"))


def base_stats(hist: DataFrame, key: Sequence[str]) -> DataFrame:
    """Row count, mean, deviation, extremes and rounded median per key.

    Only values of the middle buckets are ranked; the rest comes with the buckets.
    """
    rows = ranked(hist, middle(locate(hist, key)), key)
    stats = {
        "n": "max(n_group)",
        "mean": X.whole("max(mean)"),
        "std": X.whole("max(std)"),
        "median": X.whole(median_of()),
        "min": X.whole("max(low) / 100D"),
        "max": X.whole("max(high) / 100D"),
    }
    return rows.groupBy(*key).agg(*X.named(stats))


def described(hist: DataFrame, key: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """One row per key with the lowest value of each carried column."""
    return hist.groupBy(*key).agg(*[F.min(c).alias(c) for c in carry])


def dispersion(hist: DataFrame, base: DataFrame, key: Sequence[str]) -> DataFrame:
    """Median and mean absolute deviation from the rounded median.

    Deviations form a histogram of their own, so their median is exact too.
    """
    gaps = attach(hist, base.select(*key, "median"), key).select(
        *key, *X.named({"x": "abs(x - median * 100)"}), "n"
    )
    gap_hist = value_histogram(gaps, key, copies="n")
    rows = ranked(gap_hist, middle(locate(gap_hist, key)), key)
    return rows.groupBy(*key).agg(*X.named({"mad": median_of(), "meanad": "max(mean)"}))


def judged(hist: DataFrame, key: Sequence[str], fitted: DataFrame | None = None) -> DataFrame:
    """Histogram rows with ranks, group statistics and the per-key columns of `fitted`."""
    located = locate(hist, key)
    if fitted is not None:
        located = located.join(fitted, list(key), "inner")
    return ranked(hist, located, key)


def judged_together(cars: DataFrame, key: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """As `judged`, of single cars and with the bounds of `dispersion`, for keys whose cars fit into one task.

    Cars are shuffled once, by key, and stay there. `carry` columns get their lowest value per key.
    Deviations are taken relative to the lowest price, so that a tight group of large values keeps its digits.
    """
    halves = "get({0}, int((n_group + 1) div 2) - 1) + get({0}, int(n_group div 2))"
    log = "log1p(double(x - low) / low)"
    spread = "case when n_group > 1 then if(low < high, sqrt({} / (n_group - 1)), 0D) end"
    steps = [
        {"n_group": "bigint(size(xs))"},
        {
            "low": "xs[0]",
            "high": "xs[int(n_group) - 1]",
            "sum_x": "aggregate(xs, 0L, (s, x) -> s + x)",
            "median": X.whole(f"({halves.format('xs')}) / 200D"),
        },
        {
            "off": "(sum_x - low * n_group) / double(n_group)",
            "off_log": f"aggregate(xs, 0D, (s, x) -> s + {log}) / n_group",
            "gaps": "sort_array(transform(xs, x -> abs(x - median * 100)))",
        },
        {
            "mean": X.mean_of("sum_x", "n_group"),
            "std": spread.format("aggregate(xs, 0D, (s, x) -> s + pow(x - low - off, 2))") + " / 100D",
            "mean_log": "ln(low / 100D) + off_log",
            "std_log": spread.format(f"aggregate(xs, 0D, (s, x) -> s + pow({log} - off_log, 2))"),
            "mad": f"({halves.format('gaps')}) / 200D",
            "meanad": X.mean_of("aggregate(gaps, 0L, (s, x) -> s + x)", "n_group"),
        },
    ]
    lowest = [F.min(c).alias(c) for c in carry]
    groups = together(cars.select(*key, *carry, "x"), *key).groupBy(*key).agg(
        F.sort_array(F.collect_list("x")).alias("xs"), *lowest
    )
    for step in steps:
        groups = groups.select("*", *X.named(step))
    values = groups.select(*key, *carry, *JUDGED, F.posexplode("xs").alias("place", "x"))
    ranks = {"n": "1L", "last_rank": "bigint(place + 1)", "first_rank": "bigint(place + 1)"}
    return values.withColumn("bucket", bucket()).select(*key, *carry, "bucket", "x", *JUDGED, *X.named(ranks))


def estimates(
    rows: DataFrame,
    key: Sequence[str],
    rules: Sequence[Rule],
    min_ns: Sequence[int],
    keep: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per rule and minimum sample: mean of kept prices, outlier count and share.

    Every rule is a column of one aggregation. The minimum sample is a matter of
    the whole group, so it is applied to the sums and costs no further pass.
    `keep` names per-key columns of the rows to pass on, `carry` columns whose lowest value
    describes the key.
    """
    sums = {c: f"max({c})" for c in keep} | {c: f"min({c})" for c in carry}
    sums |= {"n_group": "sum(n)", "total": X.total("x", "n")}
    columns = {}
    for rule in rules:
        inside, total = f"inside_{rule.name}", f"total_{rule.name}"
        sums[inside] = f"sum({inside})"
        sums[total] = X.total("x", inside)
        everything = X.whole(X.mean_of("total", "n_group"))
        trimmed = X.whole(X.mean_of(total, inside))
        for t in min_ns:
            outliers = f"if({small(t)}, 0L, n_group - {inside})"
            columns[f"avg_price_{rule.name}_{t}"] = f"if({small(t)}, {everything}, {trimmed})"
            columns[f"outlier_{rule.name}_{t}"] = outliers
            columns[f"outlier_{rule.name}_pct_{t}"] = X.share(outliers, "n_group")
    totals = with_inside(rows, rules).groupBy(*key).agg(*X.named(sums))
    return totals.select(*key, *keep, *carry, *X.named(columns))
