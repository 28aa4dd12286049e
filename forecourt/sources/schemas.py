"""Input tables: declared columns and a check against what was read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

HIST = T.StructType(
    [
        T.StructField("vin", T.StringType()),
        T.StructField("dealer_id", T.LongType()),
        T.StructField("vin_frst_dt", T.DateType()),
        T.StructField("vin_last_dt", T.DateType()),
        T.StructField("sold_flg", T.BooleanType()),
        T.StructField("latest_record_flg", T.BooleanType()),
        T.StructField("price", T.DecimalType(12, 2)),
        T.StructField("mileage", T.DecimalType(12, 2)),
    ]
)
DEALERS = T.StructType(
    [T.StructField("dealer_id", T.LongType()), T.StructField("zip", T.StringType())]
)
VINS = T.StructType(
    [
        T.StructField("vin", T.StringType()),
        T.StructField("style_id", T.LongType()),
        T.StructField("model_year", T.StringType()),
        T.StructField("make_id", T.LongType()),
        T.StructField("model_id", T.LongType()),
    ]
)
DIVISIONS = T.StructType(
    [T.StructField("division_id", T.LongType()), T.StructField("division_name", T.StringType())]
)
MODELS = T.StructType(
    [T.StructField("model_id", T.LongType()), T.StructField("model_name", T.StringType())]
)
ZIPDIST = T.StructType(
    [
        T.StructField("zip1", T.StringType()),
        T.StructField("zip2", T.StringType()),
        T.StructField("distance", T.DoubleType()),
    ]
)

TABLES = {
    "hist": HIST,
    "dealers": DEALERS,
    "vins": VINS,
    "divisions": DIVISIONS,
    "models": MODELS,
    "zipdist": ZIPDIST,
}


# Columns that hold texts that are no numbers.
LENIENT = ("mileage",)


@dataclass(frozen=True)
class Inputs:
    """The six input tables of every operator."""

    hist: DataFrame
    dealers: DataFrame
    vins: DataFrame
    divisions: DataFrame
    models: DataFrame
    zipdist: DataFrame


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the declared columns, cast to the declared types.

    Text that is no number, which the history can hold in `mileage`, becomes NULL there. In any
    other column a value that does not fit the declared type raises.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    found = df.schema
    return df.select(
        [
            df[f.name]
            if found[f.name].dataType == f.dataType
            else df[f.name].try_cast(f.dataType).alias(f.name)
            if f.name in LENIENT
            else df[f.name].cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
