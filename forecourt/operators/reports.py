"""Reports over the comparison of methods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.functions.rules import RULES


def outlier_report(comparison: DataFrame, by: Sequence[str], min_n: int = 11) -> DataFrame:
    """Average outlier count and share per key, by model year, make or both.

    Shares have six digits and are added as whole millionths, alike in every order.
    """
    metrics = {}
    for name in RULES:
        count, share = f"outlier_{name}_{min_n}", f"outlier_{name}_pct_{min_n}"
        millionths = f"sum(bigint(round({share} * 1000000)))"
        metrics[f"outlier_{name}"] = f"avg({count})"
        metrics[f"outlier_{name}_pct"] = f"{millionths} / (count({share}) * 1000000D)"
    return comparison.groupBy(*by).agg(*X.named(metrics))


def coverage_report(comparison: DataFrame, by: Sequence[str], min_n: int) -> DataFrame:
    """Sample sizes, and per method: keys with outliers, outliers, cars left, mean estimate."""
    metrics = {
        "keys_lt_6": "count_if(n < 6)",
        "keys_lt_11": "count_if(n < 11)",
        "keys_ge_11": "count_if(n >= 11)",
        "keys": "count(1)",
        "cars": "sum(n)",
    }
    for name in RULES:
        outliers, estimate = f"outlier_{name}_{min_n}", f"avg_price_{name}_{min_n}"
        metrics[f"keys_with_outlier_{name}"] = f"count_if({outliers} > 0)"
        metrics[f"outlier_{name}"] = f"sum({outliers})"
        metrics[f"cars_left_{name}"] = f"sum(n - {outliers})"
        metrics[f"avg_price_{name}"] = f"round(sum({estimate}) / count({estimate}), 4)"
    return comparison.groupBy(*by).agg(*X.named(metrics))


def size_buckets(base: DataFrame) -> DataFrame:
    """Keys per sample size class, the classes as three flags."""
    n = F.col("n")
    return base.groupBy(
        X.snapshot_flag(n < 6).alias("lt_6"),
        X.snapshot_flag(n < 11).alias("lt_11"),
        X.snapshot_flag(n >= 11).alias("ge_11"),
    ).agg(F.count(F.lit(1)).alias("keys"))


def size_totals(base: DataFrame) -> DataFrame:
    """Keys with fewer than 6, fewer than 11, and 11 or more rows."""
    n = F.col("n")
    return base.agg(
        F.count_if(n < 6).alias("lt_6"),
        F.count_if(n < 11).alias("lt_11"),
        F.count_if(n >= 11).alias("ge_11"),
    )
