"""Data checks: key uniqueness, freshness, difference between two builds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def key_check(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows and distinct keys without NULLs; equal when the key is unique and always there."""
    whole = F.lit(True)
    for name in key:
        whole = whole & F.col(name).isNotNull()
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
            F.count_if(whole).alias("n_keys"),
        )
    )


def freshness(hist: DataFrame) -> DataFrame:
    """Latest day in the history."""
    return hist.agg(F.max("vin_last_dt").alias("latest"))


def reconcile(a: DataFrame, b: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Lowest and highest difference of a column between two builds, over common keys."""
    left = a.select(*key, F.col(column).alias("in_a"))
    right = b.select(*key, F.col(column).alias("in_b"))
    gap = F.col("in_a") - F.col("in_b")
    return left.join(right, list(key), "inner").agg(
        F.min(gap).alias("min_diff"), F.max(gap).alias("max_diff")
    )


def reconcile_buckets(
    a: DataFrame, b: DataFrame, key: Sequence[str], column: str, buckets: int = 4096
) -> DataFrame:
    """One row: keys in both builds, in one of them only, with other values; range of the difference.

    A checksum and a count per bucket of keys are compared first, which is one pass without a join;
    only keys of buckets that differ are then joined. NULL keys and values equal themselves. A key that
    repeats is compared by the sum of its values.
    """
    sides = [_bucketed(df, key, column, buckets) for df in (a, b)]
    sums = [
        df.groupBy("bucket").agg(
            F.count(F.lit(1)).alias(f"n_{i}"),
            F.sum(F.xxhash64("key", "value").cast("decimal(38,0)")).alias(f"h_{i}"),
        )
        for i, df in enumerate(sides)
    ]
    both = sums[0].join(sums[1], "bucket", "full")
    same = F.col("n_0").eqNullSafe(F.col("n_1")) & F.col("h_0").eqNullSafe(F.col("h_1"))
    agreed = both.filter(same).agg(F.coalesce(F.sum("n_0"), F.lit(0)).alias("n_agreed"))
    # At most `buckets` numbers, whatever the size of the builds.
    odd = F.broadcast(both.filter(~same).select("bucket"))
    left, right = (
        df.join(odd, "bucket", "left_semi").select("key", F.col("value").alias(f"in_{i}"), F.lit(1).alias(f"has_{i}"))
        for i, df in enumerate(sides)
    )
    paired = left.join(right, left["key"].eqNullSafe(right["key"]), "full")
    gap = F.when(F.col("has_0").isNotNull() & F.col("has_1").isNotNull(), F.col("in_0") - F.col("in_1"))
    differ = ~F.col("in_0").eqNullSafe(F.col("in_1"))
    joined = F.col("has_0").isNotNull() & F.col("has_1").isNotNull()
    found = paired.agg(
        F.count_if(joined).alias("n_joined"),
        F.count_if(F.col("has_1").isNull()).alias("only_in_a"),
        F.count_if(F.col("has_0").isNull()).alias("only_in_b"),
        F.count_if(joined & differ).alias("n_differ"),
        F.min(gap).alias("min_gap"),
        F.max(gap).alias("max_gap"),
    )
    # Keys of buckets that agree differ by nothing.
    none = F.when(F.col("n_agreed") > 0, F.lit(0))
    return found.join(agreed).select(
        (F.col("n_joined") + F.col("n_agreed")).cast("long").alias("in_both"),
        "only_in_a",
        "only_in_b",
        "n_differ",
        F.least("min_gap", none).alias("min_diff"),
        F.greatest("max_gap", none).alias("max_diff"),
    )


def _bucketed(df: DataFrame, key: Sequence[str], column: str, buckets: int) -> DataFrame:
    """Bucket, key and value, one row per key."""
    keyed = df.groupBy(F.struct(*key).alias("key")).agg(F.sum(column).alias("value"))
    return keyed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))


FOOTERS = {
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
}


def latest_from_footers(spark: SparkSession, path: str, column: str = "vin_last_dt") -> DataFrame:
    """Latest value of a column of Parquet files, from the statistics in their footers.

    No column is read. Runs at once, as the settings it needs hold for its own run only. An empty
    table gives NULL.
    """
    before = {k: spark.conf.get(k, None) for k in FOOTERS}
    try:
        for k, v in FOOTERS.items():
            spark.conf.set(k, v)
        found = spark.read.parquet(path).agg(F.max(column).alias("latest"))
        kind = found.schema
        row = found.first()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.createDataFrame([row], kind)
