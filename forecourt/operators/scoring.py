"""Mean absolute error of the estimates, per method."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.functions.rules import RULES, Rule, small, with_inside

# The rule whose kept rows score every method in the common-filter error.
COMMON_RULE = "med_nob"
COMMON_MIN_N = 11


def error_sum(kept: str, estimate: str) -> str:
    """SQL text: sum of absolute errors over the kept copies; NULL estimates add nothing."""
    return X.total(f"abs(x - {estimate} * 100)", kept)


def error_columns(label: str, total: str, rows: str, kept: str) -> dict[str, str]:
    """Error over all rows, which rewards dropping rows, and over kept rows only."""
    return {
        f"mae_{label}": f"round({X.mean_of(total, rows)}, 4)",
        f"mae_kept_{label}": f"round({X.mean_of(total, kept)}, 4)",
    }


def mae_own(rows: DataFrame, rules: Sequence[Rule], min_ns: Sequence[int]) -> DataFrame:
    """One row: each method scored on the rows it keeps itself.

    `rows` are judged histogram rows with the estimates of their key.
    """
    metrics = {}
    for rule in rules:
        for t in min_ns:
            label = f"{rule.name}_{t}"
            kept = f"if({small(t)}, n, inside_{rule.name})"
            total = error_sum(kept, f"avg_price_{label}")
            metrics.update(error_columns(label, total, "sum(n)", f"sum({kept})"))
    return with_inside(rows, rules).agg(*X.named(metrics))


def common_sums(
    rows: DataFrame, rules: Sequence[Rule], groups: Sequence[str] = (), min_n: int = COMMON_MIN_N
) -> DataFrame:
    """Sums behind the common-filter error, per `groups`: they add up over groups.

    Rows of keys without a fit are counted, but not kept.
    """
    judged = with_inside(rows, [RULES[COMMON_RULE]])
    kept = F.expr(f"if({small(min_n)}, n, inside_{COMMON_RULE})")
    sums = {
        "rows": "sum(n)",
        "kept": "sum(kept)",
        "total": X.total("x", "n"),
        "kept_total": X.total("x", "kept"),
        "error_mean": error_sum("kept", "fit_mean"),
    }
    for rule in rules:
        sums[f"error_{rule.name}"] = error_sum("kept", f"avg_price_{rule.name}_{min_n}")
    return judged.withColumn("kept", kept).groupBy(*groups).agg(*X.named(sums))


def add_sums(sums: DataFrame, rules: Sequence[Rule], groups: Sequence[str]) -> DataFrame:
    """Add up sums of finer groups."""
    names = ["rows", "kept", "total", "kept_total", "error_mean"]
    names += [f"error_{r.name}" for r in rules]
    return sums.groupBy(*groups).agg(*[F.sum(name).alias(name) for name in names])


def common_errors(
    sums: DataFrame, rules: Sequence[Rule], groups: Sequence[str] = ()
) -> DataFrame:
    """Kept mean, rough mean and the error of the plain mean and of every method."""
    columns = {
        "price": f"round({X.mean_of('kept_total', 'kept')}, 4)",
        "price_rough": f"round({X.mean_of('total', 'rows')}, 4)",
    }
    for label in ["mean", *[r.name for r in rules]]:
        columns.update(error_columns(label, f"error_{label}", "rows", "kept"))
    return sums.select(*groups, *X.named(columns))
