"""Input tables laid out by car, so that the daily join of listings and decode moves nothing.

History and decode are written as catalog tables of the same number of buckets by vin, sorted
within. Spark then joins bucket by bucket, whatever their size. The dealer join comes after
it: dealers are few and usually broadcast, and otherwise only the cars of the window are moved.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from forecourt.functions import expressions as X
from forecourt.operators.listing import decode, latest_listings
from forecourt.sources.schemas import Inputs
from pyspark.sql import functions as F


def write_bucketed(inputs: Inputs, folder: str, buckets: int, prefix: str = "") -> dict[str, str]:
    """Write history and decode as bucketed tables under `folder`; returns their catalog names.

    An existing table of that name is replaced.
    """
    names = {}
    for table, df in (("hist", inputs.hist), ("vins", inputs.vins)):
        names[table] = f"{prefix}{table}_by_vin"
        # One file per bucket, as rows are dealt by the bucket's own hash before they are written.
        (
            df.repartition(buckets, "vin")
            .write.mode("overwrite")
            .bucketBy(buckets, "vin")
            .sortBy("vin")
            .option("path", f"{folder}/{names[table]}")
            .saveAsTable(names[table])
        )
    return names


def bucketed_listing_fact(
    spark: SparkSession,
    names: dict[str, str],
    dealers: DataFrame,
    as_of: date | str,
    days: int = 121,
) -> DataFrame:
    """The listing fact from bucketed tables: the same rows and columns as `listing_fact`."""
    recent = latest_listings(spark.table(names["hist"]), as_of, days)
    decoded = decode(recent, spark.table(names["vins"]), required=("model_year", "style_id"))
    located = decoded.join(dealers.select("dealer_id", "zip"), "dealer_id", "inner")
    return located.select(
        *"vin vin_last_dt vin_frst_dt style_id model_year make_id model_id dealer_id zip sold_flg price mileage".split(),
        X.miles_per_year(F.col("mileage"), F.col("model_year"), as_of).alias("mileage_per_year"),
        X.days_on_lot(F.col("vin_frst_dt"), F.col("vin_last_dt")).alias("days_on_lot"),
    )
