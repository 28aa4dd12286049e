"""Exact group statistics from value histograms.

A group here can be huge: a snapshot flag has two values, so one of them holds
most of all cars. Medians, percentile ranks and trimmed means are therefore not
taken over rows of a group but over its histogram: one row per distinct value
`x` with the number of copies `n`. Building it is a plain count, which Spark
combines before the shuffle, and it is spread by value as well as by group.
Measures have two decimals, so `x` is a whole number of hundredths.

Values fall into buckets of CHUNK consecutive numbers. A group has few buckets,
and a bucket has at most CHUNK values, so ranks come from two bounded steps:
running counts over the buckets of a group, then over the values of a bucket.
Statistics of a group travel back to its values by (group, bucket), which keeps
a hot group spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions import expressions as X

# About as many values as an ordinary task handles anyway.
CHUNK = 1 << 20

# Statistics of a whole group, as `locate` gives them.
GROUP_STATS = ("n_group", "low", "high", "mean", "std", "mean_log", "std_log")

# Ranks whose values make the median: one middle rank for odd groups, two for even ones.
MIDDLE_RANKS = ("floor((n_group + 1) / 2)", "floor(n_group / 2) + 1")


def bucket() -> Column:
    """Bucket of `x`; buckets are ordered like values."""
    return F.expr(f"x div {CHUNK}")


def value_histogram(
    rows: DataFrame,
    group: Sequence[str],
    others: Sequence[str] = (),
    copies: str | None = None,
    null_groups: bool = False,
) -> DataFrame:
    """Count rows (or sum `copies`) per group, other columns and value `x`.

    Rows without a value drop out, and without a group too unless `null_groups`. A histogram is read once to locate
    its buckets and once to rank its values: stage it where it is costly to make.
    """
    counted = F.sum(copies) if copies else F.count(F.lit(1))
    needed = ["bucket"] if null_groups else [*group, "bucket"]
    known = " and ".join(f"{c} is not null" for c in needed)
    return (
        rows.withColumn("bucket", bucket())
        .filter(known)
        .groupBy(*group, *others, "bucket", "x")
        .agg(counted.alias("n"))
    )


def locate(hist: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group and bucket, with the statistics of the whole group.

    `n_bucket` counts the rows of the bucket, `n_below` those in lower buckets.
    Squared deviations are added up per bucket and merged with the distances of the buckets'
    means, so that a tight group of large values keeps its digits. Those of `x` are exact per
    bucket; those of logarithms are taken relative to the bucket's middle.
    """
    middle_x = f"((bucket + 0.5D) * {CHUNK})"
    off = f"(x - bucket * {CHUNK}L)"
    log = f"log1p((x - {middle_x}) / {middle_x})"
    parts = hist.groupBy(*group, "bucket").agg(
        *X.named(
            {
                "n_bucket": "sum(n)",
                "low": "min(x)",
                "high": "max(x)",
                "sum_x": X.total("x", "n"),
                "sum_d": f"sum(n * {off})",
                "sum_dd": f"sum(cast(n as decimal(19,0)) * cast({off} * {off} as decimal(19,0)))",
                "sum_e": f"sum(n * {log})",
                "sum_ee": f"sum(n * {log} * {log})",
            }
        )
    )
    whole_number = "cast({} as decimal(19,0))"
    n_dd = f"{whole_number.format('n_bucket')} * sum_dd"
    d_d = f"{whole_number.format('sum_d')} * {whole_number.format('sum_d')}"
    parts = parts.select(
        *group,
        *["bucket", "n_bucket", "low", "high", "sum_x"],
        *X.named(
            {
                "part_mean": X.mean_of("sum_x", "n_bucket"),
                "part_m2": f"double({n_dd} - {d_d}) / n_bucket / 10000D",
                "part_log": f"ln({middle_x} / 100D) + sum_e / n_bucket",
                "part_log_m2": "greatest(sum_ee - sum_e * sum_e / n_bucket, 0D)",
            }
        ),
    )
    ordered = f"partition by {', '.join(group)} order by bucket rows between unbounded preceding"
    whole = f"over ({ordered} and unbounded following)"
    lower = f"over ({ordered} and 1 preceding)"
    sums = {
        "n_group": f"sum(n_bucket) {whole}",
        "n_below": f"coalesce(sum(n_bucket) {lower}, 0L)",
        "n_bucket": "n_bucket",
        "low": f"min(low) {whole}",
        "high": f"max(high) {whole}",
        "sum_x": f"sum(sum_x) {whole}",
        "sum_log": f"sum(n_bucket * part_log) {whole}",
    }
    means = {"mean": X.mean_of("sum_x", "n_group"), "mean_log": "sum_log / n_group"}
    spreads = {
        "m2": f"sum(part_m2 + n_bucket * pow(part_mean - mean, 2)) {whole}",
        "log_m2": f"sum(part_log_m2 + n_bucket * pow(part_log - mean_log, 2)) {whole}",
    }
    stats = {
        "mean": "mean",
        "std": _sample_std("m2"),
        "mean_log": "mean_log",
        "std_log": _sample_std("log_m2"),
    }
    kept = ["part_mean", "part_m2", "part_log", "part_log_m2"]
    located = parts.select(*group, "bucket", *kept, *X.named(sums))
    located = located.select("*", *X.named(means)).select("*", *X.named(spreads))
    return located.select(
        *group, "bucket", "n_bucket", "n_below", "n_group", "low", "high", *X.named(stats)
    )


def _sample_std(squares: str) -> str:
    """SQL text: NULL for one row, exactly 0 for equal rows."""
    spread = f"sqrt({squares} / (n_group - 1))"
    return f"case when n_group > 1 then if(low < high, {spread}, 0D) end"


def group_stats(located: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group: the row of its lowest bucket."""
    return located.filter(F.col("n_below") == 0).select(*group, *GROUP_STATS)


def middle(located: DataFrame) -> DataFrame:
    """The one or two buckets per group that hold its median."""
    last = "n_below + n_bucket"
    hits = [f"({rank} > n_below and {rank} <= {last})" for rank in MIDDLE_RANKS]
    return located.filter(" or ".join(hits))


def ranked(hist: DataFrame, located: DataFrame, group: Sequence[str]) -> DataFrame:
    """Histogram rows with their group's statistics and their first and last rank."""
    upto = (
        Window.partitionBy(*group, "bucket")
        .orderBy("x")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last_rank = F.col("n_below") + F.sum("n").over(upto)
    return (
        hist.join(located, [*group, "bucket"], "inner")
        .withColumn("last_rank", last_rank)
        .withColumn("first_rank", F.col("last_rank") - F.col("n") + 1)
    )


def attach(
    rows: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join per-key statistics to rows that carry `bucket`, by key and bucket.

    The statistics are first repeated for each bucket the key really has, so
    rows of a hot key stay spread instead of meeting in one task.
    """
    buckets = rows.select(*keys, "bucket").distinct()
    return rows.join(buckets.join(stats, list(keys), "inner"), [*keys, "bucket"], how)


def median_of(condition: str = "true") -> str:
    """SQL text over ranked rows: exact median, the mean of the middle one or two ranks."""
    hits = [
        f"sum(case when {condition} and {rank} between first_rank and last_rank then x end)"
        for rank in MIDDLE_RANKS
    ]
    return f"(({' + '.join(hits)}) / 200D)"
