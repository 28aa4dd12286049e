"""Read the input tables from Parquet files, the catalog or a database."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from forecourt.sources.schemas import TABLES, Inputs, conform


def from_parquet(spark: SparkSession, folder: str) -> Inputs:
    """`folder/<table>.parquet` for each of the six tables."""
    return _inputs(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))


def from_catalog(spark: SparkSession, names: Mapping[str, str] | None = None) -> Inputs:
    """Catalog tables; `names` maps ours to theirs where they differ."""
    names = names or {}
    return _inputs(lambda name: spark.table(names.get(name, name)))


# How tables other than the history are divided for parallel reads.
RANGED = {"dealers": "dealer_id", "vins": "style_id", "divisions": "division_id", "models": "model_id"}


def from_jdbc(
    spark: SparkSession,
    url: str,
    as_of: date,
    days: int,
    names: Mapping[str, str] | None = None,
    properties: Mapping[str, str] | None = None,
    parts: int = 32,
    ranged: Mapping[str, str] = RANGED,
) -> Inputs:
    """Database tables, every one read in parallel.

    The history is read with one query per day of the window. Tables in `ranged` have a whole-number
    column whose bounds are read first and divided into `parts` ranges; the distance table is divided
    by distance.
    """
    names = names or {}
    properties = dict(properties or {})

    def read(name: str) -> DataFrame:
        source = names.get(name, name)
        if name == "hist":
            conditions = daily_predicates(as_of, days)
        elif name == "zipdist":
            conditions = distance_predicates(parts)
        else:
            column = ranged[name]
            bounds = f"(select min({column}) as low, max({column}) as high from {source}) bounds"
            low, high = spark.read.jdbc(url, bounds, properties=properties).first()
            conditions = range_predicates(column, low, high, parts)
        return spark.read.jdbc(url, source, predicates=conditions, properties=properties)

    return _inputs(read)


def range_predicates(column: str, low: int | None, high: int | None, parts: int) -> list[str]:
    """Conditions that divide all rows by ranges of a column; the first one takes rows without value.

    The outer ranges are open, so rows that came after the bounds were read are not lost.
    """
    if low is None or high is None or parts < 2 or low == high:
        return ["1 = 1"]
    cuts = sorted({int(low) + (int(high) - int(low) + 1) * i // parts for i in range(1, parts)} - {int(low)})
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def distance_predicates(parts: int, widest: float = 250.0) -> list[str]:
    """Conditions that divide pairs of zips by distance; pairs grow in number with the distance's square."""
    cuts = [round(widest * (i / parts) ** 0.5, 3) for i in range(1, parts)]
    inner = [f"distance >= {a} AND distance < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    if not cuts:
        return ["1 = 1"]
    return [f"distance < {cuts[0]} OR distance IS NULL", *inner, f"distance >= {cuts[-1]}"]


def daily_predicates(as_of: date, days: int) -> list[str]:
    """One condition per day of the window that ends at `as_of`, so reads run in parallel."""
    window = [as_of - timedelta(days=n) for n in reversed(range(days))]
    return [f"vin_last_dt = DATE '{day.isoformat()}'" for day in window]


def _inputs(read) -> Inputs:
    return Inputs(**{name: conform(read(name), schema) for name, schema in TABLES.items()})
