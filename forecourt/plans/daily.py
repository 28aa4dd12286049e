"""The daily batch: metric tables for every measure and dimension, and their publication."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.operators.histogram import value_histogram
from forecourt.operators.listing import MEASURES, listing_fact, with_keys, with_snapshots
from forecourt.operators.market import (
    BANDS,
    MARKET_MILES,
    NATIONWIDE,
    band_counts,
    expand_counts,
    market_pairs,
)
from forecourt.operators.metrics import (
    measured_rows,
    metric_histogram,
    metric_summary,
    recent_cars,
)
from forecourt.operators import together as T
from forecourt.staging import stage
from forecourt.sources.schemas import Inputs

LISTING_DIMENSIONS = (
    "style_id",
    "dealer_id",
    "dealer_style",
    "today_snapshot",
    "snapshot_45",
    "snapshot_60",
    "snapshot_90",
)
SNAPSHOTS = LISTING_DIMENSIONS[3:]
MARKET_DIMENSIONS = ("zip", "zip_style")
DIMENSIONS = LISTING_DIMENSIONS + MARKET_DIMENSIONS

# Dimensions with few cars per key as a rule, by the column that brings their cars together.
SHARED = {"style_id": ("style_id", "zip_style"), "dealer_id": ("dealer_id", "dealer_style")}

WINDOWS = ("today", "45_day", "60_day", "90_day")
STATES = ("sold", "lstd")


def daily_facts(inputs: Inputs, as_of: date | str, days: int = 121) -> DataFrame:
    """Listing fact with composite keys and snapshot flags."""
    facts = listing_fact(inputs.hist, inputs.dealers, inputs.vins, as_of, days)
    return with_snapshots(with_keys(facts), as_of)


def market_histogram(
    facts: DataFrame,
    zipdist: DataFrame,
    dimensions: Sequence[str],
    measures: Sequence[str],
    as_of: date | str,
    days: int,
    max_miles: float = MARKET_MILES,
    centres: DataFrame | None = None,
) -> DataFrame:
    """Value histogram per market dimension.

    Values are counted per own zip first; only those counts are repeated for the
    markets around. The style is left out of the zip dimension's counts. Markets are those of
    the facts' zips, or of the `centres` where the facts are a part only.
    """
    style = {"zip": F.lit(None).cast("bigint"), "zip_style": F.col("style_id")}
    targets = F.array(
        *[F.struct(F.lit(d).alias("dim"), style[d].alias("style")) for d in dimensions]
    )
    others = ("zip", "vin_last_dt", "vin_frst_dt", "sold_flg", *measures)
    located = facts.select(*others, F.inline(targets))
    rows = measured_rows(located, ["dim", "zip", "style"], measures, as_of, days)
    keys = ["dim", "zip", "style", "measure", "sold", "moved"]
    own = value_histogram(rows, ["zip"], [k for k in keys if k != "zip"])
    spread = expand_counts(own, market_pairs(zipdist, facts if centres is None else centres, max_miles), [*keys, "bucket", "x"])
    key = F.when(F.col("dim") == "zip", F.col("zip")).otherwise(
        X.pair_key(F.col("zip"), F.col("style"))
    )
    return spread.withColumn("key", key).drop("zip", "style")


def dimension_table(
    inputs: Inputs, dimension: str, measure: str, as_of: date | str, days: int = 90
) -> DataFrame:
    """Metric table of one measure by one dimension."""
    facts = daily_facts(inputs, as_of, max(days + 1, 121))
    if dimension not in MARKET_DIMENSIONS:
        hist = metric_histogram(facts, [dimension], [measure], as_of, days)
        return metric_summary(stage(hist, "values"), [dimension], days).drop("measure")
    hist = market_histogram(
        stage_market_columns(facts), inputs.zipdist, [dimension], [measure], as_of, days
    )
    summary = metric_summary(stage(hist, "values"), ["dim", "key"], days)
    return summary.drop("dim", "measure").withColumnRenamed("key", dimension)


def stage_market_columns(facts: DataFrame) -> DataFrame:
    """The fact is needed twice, for its cars and for the zips that become centres."""
    return stage(
        facts.select("zip", "style_id", "vin_last_dt", "vin_frst_dt", "sold_flg", *MEASURES),
        "market-facts",
    )


def metric_matrix(inputs: Inputs, as_of: date | str, days: int = 90) -> DataFrame:
    """All measures by all dimensions in one long table, from one read of the listings."""
    facts = stage(daily_facts(inputs, as_of, max(days + 1, 121)), "daily-facts")
    return matrix_of(facts, inputs.zipdist, as_of, days)


def matrix_of(
    facts: DataFrame,
    zipdist: DataFrame,
    as_of: date | str,
    days: int = 90,
    dimensions: Sequence[str] = DIMENSIONS,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Long metric table of the given facts, which are staged: dimension, key, measure and metrics.

    Cars of a style or a dealer meet by a single shuffle for all its keys. Those of crowded styles and dealers, and
    of dimensions with few keys, are repeated per dimension and measure before they are
    counted, so that these share the same few shuffles. Dimensions and measures go through them as numbers.
    """
    found, parts = [], []

    def count(cars: DataFrame, names: Sequence[str]) -> None:
        listing = [d for d in names if d not in MARKET_DIMENSIONS]
        market = [d for d in names if d in MARKET_DIMENSIONS]
        if listing:
            parts.append(listing_histogram(cars, listing, measures, as_of, days))
        if market:
            part = market_histogram(cars, zipdist, market, measures, as_of, days, centres=facts)
            numbers = {"dim": _number("dim", DIMENSIONS), "measure": _number("measure", measures)}
            parts.append(part.withColumns(numbers))

    shared = [d for names in SHARED.values() for d in names]
    count(facts, [d for d in dimensions if d not in shared])
    for column, names in SHARED.items():
        wanted = [d for d in names if d in dimensions]
        if not wanted:
            continue
        seen = facts.filter(X.seen_since(F.col("vin_last_dt"), as_of, days))
        many = stage(T.crowded(seen, column, T.TOGETHER), "crowded")
        few, rest = T.apart(facts, column, many)
        found += [_summary_of(few, facts, zipdist, d, column, measures, as_of, days) for d in wanted]
        if rest is not None:
            count(rest, wanted)
    if parts:
        hist = parts[0]
        for part in parts[1:]:
            hist = hist.unionByName(part)
        found.append(metric_summary(stage(hist, "values"), ["dim", "key"], days))
    summary = found[0]
    for part in found[1:]:
        summary = summary.unionByName(part)
    return summary.withColumns({"dim": _name("dim", DIMENSIONS), "measure": _name("measure", measures)})


def _summary_of(
    cars: DataFrame,
    facts: DataFrame,
    zipdist: DataFrame,
    dimension: str,
    column: str,
    measures: Sequence[str],
    as_of: date | str,
    days: int,
) -> DataFrame:
    """Metrics of one dimension of SHARED, from cars of which a task can hold all that share the column.

    The markets of zip_style are those of the facts' zips.
    """
    others = {"dealer_style": ["style_id"], "zip_style": ["zip"]}.get(dimension, [])
    rows = recent_cars(cars, [column, *others], measures, as_of, days)
    rows = T.together(rows.dropna(subset=[column, *others]), column)
    if dimension == "zip_style":
        pairs = market_pairs(zipdist, facts, MARKET_MILES).select("zip1", "zip2")
        rows = rows.withColumnRenamed("zip", "zip2").join(pairs, "zip2").drop("zip2")
        rows = rows.withColumnRenamed("zip1", "zip")
    cars = T.gathered(rows, [column, *others], ["sold", "moved", *measures])
    values = T.per_measure(cars, [column, *others], measures, [str(i) for i in range(len(measures))])
    found = T.summary_of_values(values, [column, *others], days)
    key = {
        "dealer_style": X.pair_key(F.col("dealer_id"), F.col("style_id")),
        "zip_style": X.pair_key(F.col("zip"), F.col("style_id")),
    }.get(dimension, F.col(column).cast("string"))
    numbered = found.withColumns({"key": key, "dim": F.lit(DIMENSIONS.index(dimension))})
    return numbered.drop(column, *others)


def _number(column: str, names: Sequence[str]) -> Column:
    """Place of a name in a short list."""
    found = F.lit(None).cast("int")
    for i, name in enumerate(names):
        found = F.when(F.col(column) == name, i).otherwise(found)
    return found


def _name(column: str, names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])[F.col(column)]


def listing_histogram(
    facts: DataFrame,
    dimensions: Sequence[str],
    measures: Sequence[str],
    as_of: date | str,
    days: int,
) -> DataFrame:
    """Value histogram of listing dimensions, which are numbered as in DIMENSIONS, measures as given.

    All snapshots of a car travel as one key, a digit for each, and are taken apart after counting.
    """
    plain = [d for d in dimensions if d not in SNAPSHOTS]
    snapshots = [d for d in dimensions if d in SNAPSHOTS]
    targets = [(DIMENSIONS.index(d), F.col(d).cast("string")) for d in plain]
    if snapshots:
        targets.append((-1, F.concat(*[F.col(d).cast("string") for d in snapshots])))
    keyed = facts.select(
        "vin_last_dt",
        "vin_frst_dt",
        "sold_flg",
        *measures,
        F.inline(F.array(*[F.struct(F.lit(i).alias("dim"), k.alias("key")) for i, k in targets])),
    )
    rows = measured_rows(keyed, ["dim", "key"], measures, as_of, days)
    rows = rows.withColumn("measure", _number("measure", measures))
    hist = value_histogram(rows, ["dim", "key", "measure", "sold"], ["moved"])
    if not snapshots:
        return hist
    apart = F.array(
        *[
            F.struct(F.lit(DIMENSIONS.index(d)).alias("dim"), F.substring("key", i + 1, 1).alias("key"))
            for i, d in enumerate(snapshots)
        ]
    )
    itself = F.array(F.struct("dim", "key"))
    others = [c for c in hist.columns if c not in ("dim", "key")]
    return hist.select(*others, F.inline(F.when(F.col("dim") < 0, apart).otherwise(itself)))


def wide_daily(inputs: Inputs, as_of: date | str) -> DataFrame:
    """One row per day, dealer and style, with sold and listed counts as columns.

    Counts cover the dealer itself, its market at each distance and the nation,
    for each snapshot. Cars are counted per zip and style before the market join.
    """
    flags = {
        f"cars_{state}_{window}": flag.cast("bigint")
        for window, snapshot in zip(
            WINDOWS, ("today_snapshot", "snapshot_45", "snapshot_60", "snapshot_90"), strict=True
        )
        for state, flag in zip(
            STATES,
            (
                X.snapshot_flag(F.col("sold_flg") & (F.col(snapshot) == 1)),
                X.snapshot_flag(~F.col("sold_flg") & (F.col(snapshot) == 1)),
            ),
            strict=True,
        )
    }
    facts = stage(
        daily_facts(inputs, as_of).select(
            "dealer_id", "style_id", "zip", *[c.alias(name) for name, c in flags.items()]
        ),
        "wide-facts",
    )
    own = facts.groupBy("dealer_id", "style_id", "zip").agg(
        *[F.sum(f).alias(_wide_name(f, "dealer")) for f in flags]
    )
    market = band_counts(facts, inputs.zipdist, ["style_id"], list(flags)).withColumnsRenamed(
        {f"{f}_{b}": _wide_name(f, f"{b}_mile_market") for b in BANDS for f in flags}
    )
    nation = facts.groupBy("style_id").agg(
        *[F.sum(f).alias(_wide_name(f, NATIONWIDE)) for f in flags]
    )
    return (
        own.join(market, ["zip", "style_id"], "left")
        .join(nation, "style_id", "inner")
        .withColumn("calendar_date", X.as_date(as_of))
        .drop("zip")
    )


def _wide_name(flag: str, scope: str) -> str:
    """cars_sold_45_day and 25_mile_market give cars_sold_25_mile_market_45_day."""
    cars, state, window = flag.split("_", 2)
    return f"{cars}_{state}_{scope}_{window}"


def publish(df: DataFrame, path: str, as_of: date | str) -> None:
    """Replace one day's folder of a published table, by nothing if `df` is empty; other days stay."""
    df.write.mode("overwrite").parquet(f"{path}/as_of={_day(as_of)}")


def _day(as_of: date | str) -> str:
    return as_of if isinstance(as_of, str) else as_of.isoformat()


def published(spark: SparkSession, path: str, as_of: date | str) -> DataFrame:
    """Read back one day of a published table."""
    return spark.read.parquet(f"{path}/as_of={_day(as_of)}")


def ensure(spark: SparkSession, name: str, builder: Callable[[], DataFrame]) -> DataFrame:
    """The catalog table `name`, built first if it is absent.

    A table that depends on the day must carry the day in its name, or it goes stale.
    """
    if not spark.catalog.tableExists(name):
        builder().write.saveAsTable(name)
    return spark.table(name)
