"""Small helpers for frames whose columns are not known beforehand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_name(df: DataFrame, base: str) -> str:
    """`base`, with underscores added until `df` has no such column (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, even if that holds dots."""
    return df["`" + name.replace("`", "``") + "`"]


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else.

    Where a text has ASCII characters only, `lower` does the same and is faster.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def text_or_empty(df: DataFrame, name: str) -> Column:
    return F.coalesce(column(df, name).cast("string"), F.lit(""))
