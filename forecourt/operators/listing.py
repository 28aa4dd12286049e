"""Listing fact: one row per car, with its keys, snapshots and measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X

MEASURES = ("price", "mileage", "mileage_per_year", "days_on_lot")


def latest_listings(hist: DataFrame, as_of: date | str, days: int) -> DataFrame:
    """Latest record of each car last seen in the `days` days up to `as_of`."""
    return hist.filter(F.col("latest_record_flg") & X.seen_since(F.col("vin_last_dt"), as_of, days))


def decode(listings: DataFrame, vins: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Add the decoded columns; cars whose `required` columns are unknown drop out.

    The filter rejects unmatched cars, so the optimizer plans an inner join.
    """
    decoded = listings.join(vins, "vin", "left")
    for column in required:
        decoded = decoded.filter(F.col(column).isNotNull())
    return decoded


def listing_fact(
    hist: DataFrame, dealers: DataFrame, vins: DataFrame, as_of: date | str, days: int = 121
) -> DataFrame:
    """Decoded latest listings of known dealers with mileage per year and days on lot.

    Small dealer tables are broadcast by Spark after it has checked their size;
    larger ones are shuffled, with hot dealers split by the adaptive skew join.
    """
    recent = latest_listings(hist, as_of, days)
    located = recent.join(dealers.select("dealer_id", "zip"), "dealer_id", "inner")
    decoded = decode(located, vins, required=("model_year", "style_id"))
    return decoded.select(
        "vin",
        "vin_last_dt",
        "vin_frst_dt",
        "style_id",
        "model_year",
        "make_id",
        "model_id",
        "dealer_id",
        "zip",
        "sold_flg",
        "price",
        "mileage",
        X.miles_per_year(F.col("mileage"), F.col("model_year"), as_of).alias("mileage_per_year"),
        X.days_on_lot(F.col("vin_frst_dt"), F.col("vin_last_dt")).alias("days_on_lot"),
    )


def with_keys(facts: DataFrame) -> DataFrame:
    """Add the dealer x style and zip x style keys."""
    style = F.col("style_id")
    return facts.withColumns(
        {
            "dealer_style": X.pair_key(F.col("dealer_id"), style),
            "zip_style": X.pair_key(F.col("zip"), style),
        }
    )


def with_snapshots(
    facts: DataFrame, as_of: date | str, windows: tuple[int, ...] = (45, 60, 90)
) -> DataFrame:
    """Add 0/1 flags: seen the day before `as_of`, and within each window.

    A window of n days reaches one day further back than a metric table of n
    days does: it counts cars last seen n days before `as_of`.
    """
    last_seen = F.col("vin_last_dt")
    flags = {"today_snapshot": X.snapshot_flag(last_seen == F.date_sub(X.as_date(as_of), 1))}
    for n in windows:
        inside = last_seen > F.date_sub(X.as_date(as_of), n + 1)
        flags[f"snapshot_{n}"] = X.snapshot_flag(inside)
    return facts.withColumns(flags)


def with_ymm_key(facts: DataFrame) -> DataFrame:
    """Add the year/make/model label."""
    label = X.ymm_label(F.col("model_year"), F.col("make_id"), F.col("model_id"))
    return facts.withColumn("ymm_key", label)


def with_names(
    facts: DataFrame, divisions: DataFrame | None = None, models: DataFrame | None = None
) -> DataFrame:
    """Add make and model names; rows whose id has no name drop out."""
    if divisions is not None:
        makes = divisions.select(
            F.col("division_id").alias("make_id"), F.col("division_name").alias("make")
        )
        facts = facts.join(makes, "make_id", "inner")
    if models is not None:
        names = models.select("model_id", F.col("model_name").alias("model"))
        facts = facts.join(names, "model_id", "inner")
    return facts


def study_rows(
    hist: DataFrame,
    dealers: DataFrame,
    vins: DataFrame,
    start: date | str | Column | None,
    end: date | str | Column,
    required: tuple[str, ...] = ("model_year", "style_id"),
) -> DataFrame:
    """Priced latest listings last seen from `start` (if any) to `end`, both included.

    The dealer must exist but none of its columns is used, hence the semi join.
    """
    seen = F.col("vin_last_dt") <= X.as_date(end)
    if start is not None:
        seen = seen & (F.col("vin_last_dt") >= X.as_date(start))
    priced = hist.filter(
        F.col("latest_record_flg")
        & seen
        & (F.col("price") > 0)
    ).select("vin", "dealer_id", "vin_last_dt", "price")
    known = priced.join(dealers.select("dealer_id"), "dealer_id", "left_semi")
    return decode(known, vins, required)
