"""Shards that all match the mixture: proportional stratified interleaving.

Rows are shuffled by a seeded hash within their stratum (source) and ranked there.
Rank `r` of a stratum with `n` rows lies at the fraction (r - 1 + u) / n of the whole,
where the phase u in [0, 1) is drawn per stratum, so that many tiny strata do not all
meet at the same fraction. All rows in the order of their fractions are cut into
shards whose row counts differ by one at most; each shard then holds its share of
every stratum, give or take one row.

A stratum may hold any part of all rows, and a key any part of a stratum, so no rank is counted over
either. Rows are sorted into ranges of (stratum, hash, place in the input), which hold about
equally many rows; a row's rank is the number of its stratum's rows in earlier ranges plus
its rank in its own. The second order is cut into about sqrt(N) slices by the fraction, which is
uniform. Only columns the caller passes are shuffled, three times.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.frames import column
from forecourt.staging import stage


def _unit(text: Column) -> Column:
    """The first 32 bits of an MD5 sum as a number in [0, 1)."""
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def _slice(unit: Column, n: int) -> Column:
    return F.floor(unit * n).cast("int")


def interleave(
    df: DataFrame, n_shards: int, key: str = "doc_id", stratum: str = "source", seed: int = 17
) -> DataFrame:
    """All rows of `df` with `shard` (0 to n_shards - 1), `slot` (0 upwards, no gaps).

    A null stratum is a stratum of its own, a null key sorts as an empty text. Rows that
    repeat a key get places of their own; which of them gets which is open. Columns named
    `shard` or `slot` are replaced. An empty frame stays empty; with fewer rows than shards
    some shards are empty.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    name = {c: f"c{i}" for i, c in enumerate(kept)}
    rows = stage(
        df.select(
            *[column(df, c).alias(name[c]) for c in kept],
            F.coalesce(F.concat(F.lit("s"), column(df, stratum).cast("string")), F.lit("")).alias(
                "stratum"
            ),
            F.md5(
                F.concat(F.lit(f"{seed}:"), F.coalesce(column(df, key).cast("string"), F.lit("")))
            ).alias("h"),
        ),
        "shard-rows",
    )
    total = rows.count()
    n_slices = max(1, math.isqrt(total))

    # Ranges of (stratum, hash, place) hold about equally many rows, however many share a key.
    tie = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    ranged = rows.withColumn("tie", tie).repartitionByRange("stratum", "h", "tie")
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "shard-ranges")
    before = Window.partitionBy("stratum").orderBy("part")
    offsets = (
        ranged.groupBy("stratum", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "stratum",
            "part",
            (F.sum("n").over(before) - F.col("n")).alias("earlier"),
            F.sum("n").over(Window.partitionBy("stratum")).alias("n_stratum"),
        )
    )
    phase = _unit(F.md5(F.concat(F.lit(f"{seed}:phase:"), F.col("stratum"))))
    within = Window.partitionBy("stratum", "part").orderBy("h", "tie")
    ranked = stage(
        ranged.join(offsets, ["stratum", "part"])
        .withColumn("rank", F.row_number().over(within) + F.col("earlier"))
        .withColumn("at", (F.col("rank") - 1 + phase) / F.col("n_stratum"))
        .withColumn("part", _slice(F.col("at"), n_slices))
        .drop("h", "tie", "earlier", "n_stratum"),
        "shard-ranks",
    )

    # At most sqrt(N) slices, so one task may add up their counts.
    starts = (
        ranked.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("earlier"))
    )
    within = Window.partitionBy("part").orderBy("at", "stratum", "rank")
    place = (F.col("earlier") + F.row_number().over(within) - 1).cast("long")
    return (
        ranked.join(starts, "part")
        .withColumn("place", place)
        .withColumn("shard", F.expr(f"cast(place * {n_shards} div {max(total, 1)} as int)"))
        .select(
            *[F.col(name[c]).alias(c) for c in kept],
            "shard",
            F.expr(f"place - (shard * {total} + {n_shards - 1}) div {n_shards}").alias("slot"),
        )
    )


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write one folder per shard, its files in slot order and no longer than `rows_per_file`."""
    piece = F.floor(F.col("slot") / rows_per_file).cast("long")
    (
        placed.withColumn("piece", piece)
        .repartition("shard", "piece")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard", "piece")
        .parquet(path)
    )
