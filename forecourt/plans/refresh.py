"""The daily matrix by difference: only cars that changed, and days that slid over a border, are counted.

State is a folder of runs. Each run has the value histograms of its day and a log of signed listing
facts: a car's new record is added with sign 1, the one it replaces is added again with sign -1, so the
sum over the log is the current state and nothing is ever rewritten. A refresh

- decodes and locates the day's new records only,
- retracts what changed and vanished cars contributed the day before,
- finds, by two dates and the model year, the other cars whose contribution is not the same today (they left
  a window or a snapshot, or are no longer newly arrived), and takes the difference of both days,
- adds these signed counts to the histograms of the day before.

The history is not read again, and 121 days of cars are neither joined, repeated per dimension nor
counted. A run counts once it is in the list of runs, so an aborted one leaves the day before.
Facts keep the dealer's place and the decoded style of the day their record came: after a change to
those tables, start a new state.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.operators.histogram import value_histogram
from forecourt.operators.listing import MEASURES, listing_fact, with_keys, with_snapshots
from forecourt.operators.market import MARKET_MILES, expand_counts, market_pairs
from forecourt.operators.metrics import by_dimension, measured_rows, metric_summary
from forecourt.operators import together as T
from forecourt.plans.daily import LISTING_DIMENSIONS, MARKET_DIMENSIONS, SNAPSHOTS
from forecourt.sources.schemas import Inputs
from forecourt.staging import stage

HISTORY_DAYS = 121
RUNS = "as_of date, run string, at timestamp, days int, base boolean"
FACTS = (
    "vin vin_last_dt vin_frst_dt style_id model_year make_id model_id dealer_id zip sold_flg price"
    " mileage days_on_lot"
).split()
GROUP = ("dim", "key", "zip", "style", "measure", "sold", "moved")


def runs(spark: SparkSession, root: str) -> list:
    """Committed runs from the last base on, oldest first."""
    found = spark.read.schema(RUNS).parquet(f"{root}/runs").collect()
    found.sort(key=lambda r: (r.as_of, r.at))
    bases = [i for i, r in enumerate(found) if r.base]
    return found[bases[-1] :]


def contributions(signed: DataFrame, as_of: date, days: int) -> DataFrame:
    """Signed value counts of listing facts (with `sign`) as the matrix of a day has them.

    Rows of listing dimensions have a key, those of market dimensions the car's own zip, and the style
    where the dimension has one.
    """
    age = X.miles_per_year(F.col("mileage"), F.col("model_year"), as_of)
    facts = with_snapshots(with_keys(signed.withColumn("mileage_per_year", age)), as_of)
    needed = facts.select("sign", "vin_last_dt", "vin_frst_dt", "sold_flg", *MEASURES, *LISTING_DIMENSIONS)
    listed = measured_rows(by_dimension(needed, LISTING_DIMENSIONS), ["dim", "key", "sign"], MEASURES, as_of, days)
    style = {"zip": F.lit(None).cast("bigint"), "zip_style": F.col("style_id")}
    targets = F.array(
        *[F.struct(F.lit(d).alias("dim"), style[d].alias("style")) for d in MARKET_DIMENSIONS]
    )
    placed = facts.select("sign", "zip", "vin_last_dt", "vin_frst_dt", "sold_flg", *MEASURES, F.inline(targets))
    near = measured_rows(placed, ["dim", "zip", "style", "sign"], MEASURES, as_of, days)
    rows = listed.filter("key is not null").unionByName(
        near.filter("zip is not null"), allowMissingColumns=True
    )
    return value_histogram(rows, GROUP, copies="sign", null_groups=True).filter("n <> 0")


def _standing(as_of: date, days: int) -> Column:
    """What of a car's contribution depends on the day."""
    last, first = F.col("vin_last_dt"), F.col("vin_frst_dt")
    return F.struct(
        (last == F.date_sub(X.as_date(as_of), 1)).alias("today"),
        *[(last > F.date_sub(X.as_date(as_of), n + 1)).alias(f"s{n}") for n in (45, 60, 90)],
        X.seen_since(last, as_of, days).alias("seen"),
        (first > F.date_sub(X.as_date(as_of), days)).alias("moved"),
        X.miles_per_year(F.col("mileage"), F.col("model_year"), as_of).alias("per_year"),
    )


def _newest(records: DataFrame, as_of: date) -> DataFrame:
    """One record per car: the last seen up to the day; of those, the greatest in column order."""
    known = records.filter(F.col("vin").isNotNull() & (F.col("vin_last_dt") <= X.as_date(as_of)))
    others = [c for c in known.columns if c not in ("vin", "vin_last_dt")]
    newest = known.groupBy("vin").agg(F.max(F.struct("vin_last_dt", *others)).alias("r"))
    return newest.select("vin", "r.*")


def start(
    spark: SparkSession, root: str, inputs: Inputs, records: DataFrame, as_of: date, days: int = 90
) -> None:
    """A new state from all records that are known on a day.

    Each car's newest record counts, whatever its flag says; records of later days are left out.
    """
    latest = _newest(records, as_of).withColumn("latest_record_flg", F.lit(True))
    facts = listing_fact(latest, inputs.dealers, inputs.vins, as_of, HISTORY_DAYS)
    run = f"r{uuid.uuid4().hex}"
    log = facts.select(*FACTS, F.lit(1).cast("long").alias("sign"))
    log.sortWithinPartitions("vin_last_dt").write.parquet(f"{root}/run={run}/log")
    counted = contributions(spark.read.parquet(f"{root}/run={run}/log"), as_of, days)
    _commit(spark, root, run, counted, as_of, days, base=True)


def refresh(
    spark: SparkSession,
    root: str,
    inputs: Inputs,
    records: DataFrame,
    as_of: date,
    gone: DataFrame | None = None,
) -> None:
    """Bring the state to a later day by what came since.

    `records` are new or corrected records of any cars, `gone` the cars (`vin`) that vanished. A car's
    record is replaced by one that was seen as late or later; an older one that comes late is ignored. A new
    record of an unknown dealer or style takes the car out. Repeated records count once.
    """
    done = runs(spark, root)
    last = done[-1]
    if as_of <= last.as_of:
        raise ValueError(f"the state is of {last.as_of} already")
    log = spark.read.parquet(*[f"{root}/run={r.run}/log" for r in done])
    fresh = _newest(records, as_of)
    if gone is not None:
        gone = gone.select("vin").distinct()
        fresh = fresh.join(gone, "vin", "left_anti")
    touched = fresh.select("vin", F.col("vin_last_dt").alias("fresh_dt"))
    if gone is not None:
        touched = touched.unionByName(gone.withColumn("fresh_dt", F.lit(None).cast("date")))
    # The current facts of cars that a record or a deletion names; the log's signs cancel old ones.
    held = (
        log.join(touched, "vin")
        .groupBy(*FACTS, "fresh_dt")
        .agg(F.sum("sign").alias("sign"))
        .filter("sign > 0")
    )
    held = stage(held, "touched-facts")
    late = held.filter(F.col("fresh_dt") < F.col("vin_last_dt")).select("vin")
    replaced = held.filter(F.col("fresh_dt").isNull() | (F.col("fresh_dt") >= F.col("vin_last_dt")))
    accepted = fresh.join(late, "vin", "left_anti").withColumn("latest_record_flg", F.lit(True))
    added = listing_fact(accepted, inputs.dealers, inputs.vins, as_of, HISTORY_DAYS)

    run = f"r{uuid.uuid4().hex}"
    signed = replaced.select(*FACTS, (-F.col("sign")).alias("sign")).unionByName(
        added.select(*FACTS, F.lit(1).cast("long").alias("sign"))
    )
    signed.write.parquet(f"{root}/run={run}/log")
    new = spark.read.parquet(f"{root}/run={run}/log")

    # Facts of the day before whose standing changes by the day alone, changed cars included: their
    # old facts are retracted below as of today, so both days' counts of them cancel.
    sliding = log.filter(~_standing(last.as_of, last.days).eqNullSafe(_standing(as_of, last.days)))
    sliding = stage(_worth(sliding, last.as_of, as_of, last.days), "sliding-facts")
    before = contributions(sliding.withColumn("sign", -F.col("sign")), last.as_of, last.days)
    counted = (
        spark.read.parquet(f"{root}/run={last.run}/histogram")
        .unionByName(before)
        .unionByName(contributions(sliding, as_of, last.days))
        .unionByName(contributions(new, as_of, last.days))
        .groupBy(*GROUP, "bucket", "x")
        .agg(F.sum("n").alias("n"))
        .filter("n <> 0")
    )
    _commit(spark, root, run, counted, as_of, last.days)


def _worth(facts: DataFrame, before: date, now: date, days: int) -> DataFrame:
    """Facts that count on one of the two days, those whose signs cancel left out."""
    last = F.col("vin_last_dt")
    counted = facts.filter(X.seen_since(last, before, days) | X.seen_since(last, now, days))
    return counted.groupBy(*FACTS).agg(F.sum("sign").alias("sign")).filter("sign <> 0")


def _commit(
    spark: SparkSession,
    root: str,
    run: str,
    counted: DataFrame,
    as_of: date,
    days: int,
    base: bool = False,
) -> None:
    """Write the histograms of a run, then list it. A base needs no run before it."""
    counted.write.parquet(f"{root}/run={run}/histogram")
    row = (as_of, run, datetime.now(UTC).replace(tzinfo=None), days, base)
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(f"{root}/runs")


def compact(spark: SparkSession, root: str) -> None:
    """One run in place of all: facts whose signs cancel, or that no window will reach again, go.

    Older runs stay on disk until someone deletes them; nothing reads them any more.
    """
    done = runs(spark, root)
    last = done[-1]
    oldest = F.date_sub(X.as_date(last.as_of), HISTORY_DAYS)
    log = spark.read.parquet(*[f"{root}/run={r.run}/log" for r in done])
    log = log.filter(F.col("vin_last_dt") > oldest).groupBy(*FACTS).agg(F.sum("sign").alias("sign"))
    run = f"r{uuid.uuid4().hex}"
    log.filter("sign <> 0").sortWithinPartitions("vin_last_dt").write.parquet(f"{root}/run={run}/log")
    held = spark.read.parquet(f"{root}/run={last.run}/histogram")
    _commit(spark, root, run, held, last.as_of, last.days, base=True)


def matrix(
    spark: SparkSession, root: str, zipdist: DataFrame, max_miles: float = MARKET_MILES
) -> DataFrame:
    """The long metric table of the state's day: dimension, key, measure and metrics.

    Counts of a style meet by one shuffle for all its markets, and so do those of other keys; crowded ones, zips and
    snapshots go by histograms.
    """
    done = runs(spark, root)
    last = done[-1]
    held = spark.read.parquet(f"{root}/run={last.run}/histogram")
    listed = held.filter("key is not null").drop("zip", "style")
    own = held.filter("zip is not null").drop("key")
    keys: Sequence[str] = ["dim", "zip", "style", "measure", "sold", "moved", "bucket", "x"]
    seen = X.seen_since(F.col("vin_last_dt"), last.as_of, HISTORY_DAYS)
    log = spark.read.parquet(*[f"{root}/run={r.run}/log" for r in done]).filter(seen)
    centres = log.groupBy("zip").agg(F.sum("sign").alias("n")).filter("n > 0")
    near = market_pairs(zipdist, centres, max_miles)
    pair = X.pair_key(F.col("zip"), F.col("style"))

    few, many = _split(own.filter("dim = 'zip_style' and style is not null"), "style")
    placed = few.withColumnRenamed("zip", "zip2").join(near.select("zip2", F.col("zip1").alias("zip")), "zip2")
    markets = _read_off(placed, ["dim", "zip", "style"], last.days).withColumn("key", pair).drop("zip", "style")
    zips = own.filter("dim = 'zip'")
    spread = expand_counts(zips if many is None else zips.unionByName(many), near, keys)
    key = F.when(F.col("dim") == "zip", F.col("zip")).otherwise(pair)
    hist = spread.withColumn("key", key).drop("zip", "style")

    few, many = _split(listed.filter(~F.col("dim").isin(*SNAPSHOTS)), "key")
    others = _read_off(few, ["dim", "key"], last.days)
    hist = hist.unionByName(listed.filter(F.col("dim").isin(*SNAPSHOTS)))
    hist = hist if many is None else hist.unionByName(many)
    summary = metric_summary(stage(hist, "values"), ["dim", "key"], last.days)
    return summary.unionByName(markets).unionByName(others)


def _split(hist: DataFrame, column: str) -> tuple[DataFrame, DataFrame | None]:
    """Counts of values of a column that have few cars, together by it, and those of the others, if any."""
    many = stage(T.crowded(hist, column, T.TOGETHER * len(MEASURES), "n"), "crowded")
    few, rest = T.apart(hist, column, many)
    return T.together(few, column), rest


def _read_off(hist: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """All metrics of counts that lie together by one of the keys."""
    copies = F.expr("inline(array_repeat(struct(sold, moved, x), int(n)))")
    cars = T.gathered(hist.select(*keys, "measure", copies), [*keys, "measure"], ["sold", "moved", "x"])
    values = cars.selectExpr(*keys, "measure", "cars.sold as states", "cars.moved as moves", "cars.x as xs")
    return T.summary_of_values(values, keys, days)
