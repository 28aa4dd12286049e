"""Markets: the cars of all zips within some miles of a centre zip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X

# Market radius of the daily tables and the documented bands, in miles.
MARKET_MILES = 100
BANDS = (25, 50, 100, 250)
NATIONWIDE = "nationwide"


def market_pairs(zipdist: DataFrame, centres: DataFrame, max_miles: float) -> DataFrame:
    """Pairs within the band whose first zip is one of the centres.

    Centres are made distinct first: a zip may hold a large part of all cars, and
    a semi join alone would send all of them to one task.
    """
    near = zipdist.filter(F.col("distance") <= max_miles)
    wanted = centres.select(F.col("zip").alias("zip1")).distinct()
    return near.join(wanted, "zip1", "left_semi")


def market_reach(
    zipdist: DataFrame, facts: DataFrame, keys: Sequence[str], max_miles: float
) -> DataFrame:
    """Centre (`zip`) and other keys that a car has, with each zip (`zip2`) in the band and its distance.

    Other combinations of centres and keys have no row that could show them.
    """
    wanted = facts.select("zip", *keys).distinct().withColumnRenamed("zip", "zip1")
    near = zipdist.filter(F.col("distance") <= max_miles)
    return wanted.join(near, "zip1", "inner").withColumnRenamed("zip1", "zip")


def market_fact(
    facts: DataFrame, zipdist: DataFrame, max_miles: float = MARKET_MILES
) -> DataFrame:
    """One row per car and market. `zip` is the centre, `zip2` the car's own zip.

    The market x style key uses the centre. Rows multiply by the number of
    covering markets: use it to list cars, and `expand_counts` to count them.
    """
    pairs = market_pairs(zipdist, facts, max_miles)
    cars = facts.withColumnRenamed("zip", "zip2")
    markets = cars.join(pairs, "zip2", "inner").withColumnRenamed("zip1", "zip")
    return markets.select(
        "vin",
        "vin_last_dt",
        "vin_frst_dt",
        X.pair_key(F.col("zip"), F.col("style_id")).alias("zip_style"),
        "zip",
        "zip2",
        "distance",
        "style_id",
        "sold_flg",
        "price",
        "mileage",
        "mileage_per_year",
        "days_on_lot",
    )


def expand_counts(
    counted: DataFrame, pairs: DataFrame, keys: Sequence[str], sums: Sequence[str] = ("n",)
) -> DataFrame:
    """Move counts from each car's own zip to all markets that cover it.

    Cars are counted per own zip before they are repeated per market, so the
    repeated rows are distinct values and not cars. The sums are the same.
    """
    others = [k for k in keys if k != "zip"]
    return (
        counted.withColumnRenamed("zip", "zip2")
        .join(pairs.select("zip1", "zip2"), "zip2", "inner")
        .groupBy(F.col("zip1").alias("zip"), *others)
        .agg(*[F.sum(s).alias(s) for s in sums])
    )


def band_counts(
    facts: DataFrame,
    zipdist: DataFrame,
    keys: Sequence[str],
    flags: Sequence[str],
    bands: Sequence[int] = BANDS,
) -> DataFrame:
    """Sums of 0/1 `flags` per market zip and other keys, one column per flag and band.

    `keys` are columns besides the zip. One join at the widest band serves all. Only zips and keys that
    some car has get a row: counts go nowhere else.
    """
    own = facts.groupBy("zip", *keys).agg(*[F.sum(f).alias(f) for f in flags])
    reach = market_reach(zipdist, facts, keys, max(bands))
    spread = own.withColumnRenamed("zip", "zip2").join(reach, ["zip2", *keys], "inner")
    return spread.groupBy("zip", *keys).agg(
        *[
            F.sum(F.when(F.col("distance") <= b, F.col(f)).otherwise(0)).alias(f"{f}_{b}")
            for b in bands
            for f in flags
        ]
    )


def market_bands(
    facts: DataFrame, zipdist: DataFrame, bands: Sequence[int] = BANDS
) -> DataFrame:
    """Cars sold and listed per band and market zip; nationwide is one group without zip."""
    flagged = facts.select(
        "zip",
        X.snapshot_flag(F.col("sold_flg")).alias("sold"),
        X.snapshot_flag(~F.col("sold_flg")).alias("lstd"),
    )
    wide = band_counts(flagged, zipdist, [], ["sold", "lstd"], bands)
    stacked = F.array(
        *[
            F.struct(
                F.lit(str(b)).alias("band"),
                F.col(f"sold_{b}").alias("cars_sold"),
                F.col(f"lstd_{b}").alias("cars_lstd"),
            )
            for b in bands
        ]
    )
    near = wide.select("zip", F.inline(stacked)).select("band", "zip", "cars_sold", "cars_lstd")
    everywhere = flagged.agg(
        F.lit(NATIONWIDE).alias("band"),
        F.lit(None).cast("string").alias("zip"),
        F.sum("sold").alias("cars_sold"),
        F.sum("lstd").alias("cars_lstd"),
    )
    return near.unionByName(everywhere).filter(F.col("cars_sold") + F.col("cars_lstd") > 0)
