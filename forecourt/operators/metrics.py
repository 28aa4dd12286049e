"""Sold and listed metrics per key: counts, trimmed statistics, medians, days of supply."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.functions.rules import LOG_SLACK, between, small
from forecourt.operators.histogram import locate, median_of, ranked, value_histogram

SOLD, LISTED, UNKNOWN = 1, 0, -1

# Fixed values of the production trim and of days of supply.
TRIM_SIGMA = 2
TRIM_MIN_N = 6
SUPPLY_MIN_N = 3


def sold_state(sold_flg: Column) -> Column:
    """1 sold, 0 listed, -1 unknown; unknown cars count in neither."""
    return F.when(sold_flg, SOLD).when(~sold_flg, LISTED).otherwise(UNKNOWN)


def measured_rows(
    facts: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    as_of: date | str,
    days: int,
) -> DataFrame:
    """One row per car and measure above zero, for cars seen in the window."""
    recent = recent_cars(facts, keys, measures, as_of, days)
    ids = [*keys, "sold", "moved"]
    return recent.unpivot(ids, list(measures), "measure", "x").filter(F.col("x") > 0)


def recent_cars(
    facts: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    as_of: date | str,
    days: int,
) -> DataFrame:
    """Cars seen in the window: their keys, sold state, moved-on flag, and measures in hundredths."""
    return facts.filter(X.seen_since(F.col("vin_last_dt"), as_of, days)).select(
        *keys,
        sold_state(F.col("sold_flg")).alias("sold"),
        X.snapshot_flag(F.col("vin_frst_dt") > F.date_sub(X.as_date(as_of), days)).alias("moved"),
        *X.named({m: X.hundredths(m) for m in measures}),
    )


def metric_histogram(
    facts: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    as_of: date | str,
    days: int,
) -> DataFrame:
    """Value histogram per keys, measure, sold state and moved-on flag."""
    rows = measured_rows(facts, keys, measures, as_of, days)
    return value_histogram(rows, [*keys, "measure", "sold"], ["moved"])


def by_dimension(facts: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Repeat each car once per dimension, as (dim, key)."""
    others = [c for c in facts.columns if c not in dimensions]
    keyed = facts.withColumns({d: F.col(d).cast("string") for d in dimensions})
    return keyed.unpivot(others, list(dimensions), "dim", "key")


def keep_log_sigma(k: float = TRIM_SIGMA, min_n: int = TRIM_MIN_N) -> str:
    """SQL text: the group is small, or ln(x) is within k deviations of the mean logarithm."""
    low, high = f"mean_log - {k} * std_log", f"mean_log + {k} * std_log"
    near = between("ln(x / 100D)", low, high, LOG_SLACK)
    return f"({small(min_n)} or {near})"


def counts() -> dict[str, str]:
    """Cars sold, listed and moved on."""
    return {
        "cars_sold": f"sum(if(sold = {SOLD}, n, 0L))",
        "cars_lstd": f"sum(if(sold = {LISTED}, n, 0L))",
        "cars_moved_on": "sum(if(moved = 1, n, 0L))",
    }


def trimmed(state: int, suffix: str) -> dict[str, str]:
    """Average, maximum and minimum of the kept values of one sold state."""
    kept = f"case when sold = {state} and keep then x end"
    total = X.total(kept, "n")
    count = f"sum(if(sold = {state} and keep, n, 0L))"
    return {
        f"avg_{suffix}": X.whole(X.mean_of(total, count)),
        f"max_{suffix}": X.whole(f"max({kept}) / 100D"),
        f"min_{suffix}": X.whole(f"min({kept}) / 100D"),
    }


def medians() -> dict[str, str]:
    """Untrimmed medians of sold and listed cars."""
    return {
        "median_sold": X.whole(median_of(f"sold = {SOLD}")),
        "median_lstd": X.whole(median_of(f"sold = {LISTED}")),
    }


def days_supply(listed: str, sold: str, days: int) -> str:
    """SQL text: days until the listed cars are gone at the pace of sales; NULL without sales."""
    return f"bigint(ceil({listed} / nullif({sold} / {float(days)}D, 0D)))"


def supply(days: int) -> dict[str, str]:
    """Days of supply; keys with fewer than SUPPLY_MIN_N sales have no pace."""
    listed = f"sum(if(sold = {LISTED}, n, 0L))"
    selling = f"sum(if(sold = {SOLD} and n_group >= {SUPPLY_MIN_N}, n, 0L))"
    return {"days_supply": days_supply(listed, selling, days)}


def metric_rows(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Histogram rows with the statistics, ranks and trim of their key, measure and state."""
    group = [*keys, "measure", "sold"]
    rows = ranked(hist, locate(hist, group), group)
    return rows.withColumn("keep", F.expr(keep_log_sigma()))


def metric_summary(hist: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """All metrics, one row per keys and measure."""
    metrics = {
        **counts(),
        **trimmed(SOLD, "sold"),
        **trimmed(LISTED, "lstd"),
        **medians(),
        **supply(days),
    }
    return metric_rows(hist, keys).groupBy(*keys, "measure").agg(*X.named(metrics))


def metric_table(
    facts: DataFrame, key: str, measure: str, as_of: date | str, days: int = 90
) -> DataFrame:
    """All metrics of one measure by one key."""
    hist = metric_histogram(facts, [key], [measure], as_of, days)
    return metric_summary(hist, [key], days).drop("measure")


def published_names(table: DataFrame, key: str, measure: str) -> DataFrame:
    """Rename metrics as in the published tables, e.g. `avg_price_dealer_id_sold`."""
    names = {"days_supply": f"{key}_days_supply"}
    for state in ("sold", "lstd"):
        names[f"median_{state}"] = f"median_{measure}_{state}"
        for statistic in ("avg", "max", "min"):
            names[f"{statistic}_{state}"] = f"{statistic}_{measure}_{key}_{state}"
    return table.withColumnsRenamed(names)
