"""Every registered query: a callable of (session, folder of the test tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.functions.rules import MIN_NS, RULES
from forecourt.operators import checks, market, metrics, reports
from forecourt.operators.histogram import attach, bucket, group_stats, locate, value_histogram
from forecourt.operators.listing import (
    listing_fact,
    study_rows,
    with_keys,
    with_names,
    with_snapshots,
    with_ymm_key,
)
from forecourt.operators.study import base_stats, described, dispersion
from forecourt.plans import daily, publish, refresh, statements
from forecourt.plans import evaluation as ev
from forecourt.plans import markets as bands
from forecourt.sources import bucketed
from forecourt.sources.schemas import Inputs
from forecourt.sources.tpch import inputs as derived_inputs
from forecourt.sources.tpch import staged_inputs
from forecourt.staging import new_path, stage

AS_OF = date(2001, 7, 1)
DAYS = 90
STUDY_DAYS = 1080
STUDY_START = AS_OF - timedelta(days=STUDY_DAYS)
FIT_END = date(2001, 1, 1)
VALIDATION_START = date(2000, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]

# Short names of dimensions and measures in query keys.
DIMENSIONS = {
    "style": "style_id",
    "dealer": "dealer_id",
    "zip": "zip",
    "zip_style": "zip_style",
    "dealer_style": "dealer_style",
    "today": "today_snapshot",
    "snapshot_45": "snapshot_45",
    "snapshot_60": "snapshot_60",
    "snapshot_90": "snapshot_90",
}
SHORT_MEASURES = {
    "price": "price",
    "mileage": "mileage",
    "mpy": "mileage_per_year",
    "dol": "days_on_lot",
}
GRAINS = {"style": ev.STYLE, "ymm": ev.YMM}


def days_of(dimension: str) -> int:
    """Styles have few cars in the test data, so they get the long window."""
    return STUDY_DAYS if dimension == "style_id" else DAYS


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines return the same type."""
    decimals = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def _facts(inputs: Inputs, days: int = 121) -> DataFrame:
    return listing_fact(inputs.hist, inputs.dealers, inputs.vins, AS_OF, days)


def _listing(select: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: _doubles(select(_facts(staged_inputs(spark, sf))))


def _market_fact(spark: SparkSession, sf: str) -> DataFrame:
    inputs = staged_inputs(spark, sf)
    facts = stage(_facts(inputs), "market-listings")
    return _doubles(market.market_fact(facts, inputs.zipdist))


def _market_bands(spark: SparkSession, sf: str) -> DataFrame:
    inputs = staged_inputs(spark, sf)
    facts = stage(_facts(inputs).select("zip", "sold_flg"), "band-listings")
    return market.market_bands(facts, inputs.zipdist)


def _names(spark: SparkSession, sf: str) -> DataFrame:
    inputs = staged_inputs(spark, sf)
    named = with_names(_facts(inputs), inputs.divisions, inputs.models)
    return named.select("vin", "make_id", "make", "model_id", "model")


def _study_rows(spark: SparkSession, sf: str) -> DataFrame:
    inputs = staged_inputs(spark, sf)
    rows = study_rows(inputs.hist, inputs.dealers, inputs.vins, STUDY_START, AS_OF)
    return _doubles(rows)


def _histogram(inputs: Inputs, key: str, measure: str) -> DataFrame:
    return metrics.metric_histogram(_facts(inputs), [key], [measure], AS_OF, DAYS)


def _cars_sold(spark: SparkSession, sf: str) -> DataFrame:
    columns = {k: v for k, v in metrics.counts().items() if k != "cars_moved_on"}
    hist = _histogram(staged_inputs(spark, sf), "dealer_id", "price")
    return hist.groupBy("dealer_id").agg(*X.named(columns))


def _cars_moved_on(spark: SparkSession, sf: str) -> DataFrame:
    hist = _histogram(staged_inputs(spark, sf), "dealer_id", "price")
    return hist.groupBy("dealer_id").agg(
        *X.named({"cars_moved_on": metrics.counts()["cars_moved_on"]})
    )


def _count_by_key_sold(spark: SparkSession, sf: str) -> DataFrame:
    hist = _histogram(staged_inputs(spark, sf), "dealer_id", "price")
    return hist.groupBy("dealer_id", "sold").agg(F.sum("n").alias("n"))


def _log_profile(spark: SparkSession, sf: str) -> DataFrame:
    hist = _histogram(staged_inputs(spark, sf), "dealer_id", "mileage")
    profile = {
        "n": "n_group",
        "mean_log": "round(mean_log, 6)",
        "std_log": "round(std_log, 6)",
    }
    stats = group_stats(locate(hist, ["dealer_id", "sold"]), ["dealer_id", "sold"])
    return stats.select("dealer_id", "sold", *X.named(profile))


def _log2s_trim(spark: SparkSession, sf: str) -> DataFrame:
    """Which cars the production trim keeps, dealer by dealer."""
    facts = _facts(staged_inputs(spark, sf))
    cars = facts.filter(X.seen_since(F.col("vin_last_dt"), AS_OF, DAYS) & (F.col("price") > 0))
    sold = metrics.sold_state(F.col("sold_flg"))
    rows = cars.select(
        "vin", "dealer_id", sold.alias("sold"), *X.named({"x": X.hundredths("price")})
    ).withColumn("bucket", bucket())
    rows = stage(rows, "trim-rows")
    group = ["dealer_id", "sold"]
    stats = group_stats(locate(value_histogram(rows, group), group), group)
    judged = attach(rows, stats, group)
    return judged.select("vin", "dealer_id", "sold", *X.named({"keep": metrics.keep_log_sigma()}))


def _aggregated(key: str, measure: str, columns: dict[str, str]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        hist = stage(_histogram(staged_inputs(spark, sf), key, measure), "values")
        return metrics.metric_rows(hist, [key]).groupBy(key).agg(*X.named(columns))

    return run


def _metric(dimension: str, measure: str) -> Query:
    return lambda spark, sf: daily.dimension_table(
        staged_inputs(spark, sf), dimension, measure, AS_OF, days_of(dimension)
    )


def _dimension(*dimensions: str) -> Query:
    """All four measures of the dimensions in one long table."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        inputs = staged_inputs(spark, sf)
        facts = daily.daily_facts(inputs, AS_OF)
        if set(dimensions) & set(daily.MARKET_DIMENSIONS):
            facts = daily.stage_market_columns(facts)
        else:
            facts = stage(facts, "daily-facts")
        return daily.matrix_of(facts, inputs.zipdist, AS_OF, DAYS, dimensions)

    return run


def _published(spark: SparkSession, sf: str) -> DataFrame:
    """Publish two days, replace one of them, and read it back under the published names."""
    path = new_path(spark, "price-dealer")
    inputs = staged_inputs(spark, sf)
    for day in (AS_OF - timedelta(days=1), AS_OF, AS_OF):
        table = daily.dimension_table(inputs, "dealer_id", "price", day)
        daily.publish(metrics.published_names(table, "dealer_id", "price"), path, day)
    return daily.published(spark, path, AS_OF)


def _published_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Publish two days, leave a third run uncommitted, commit an older day late; read all 36 tables."""
    root = new_path(spark, "published")
    inputs = staged_inputs(spark, sf)
    day_before = AS_OF - timedelta(days=1)
    publish.create_tables(spark, root, DAYS)
    early = stage(publish.laid_out(daily.metric_matrix(inputs, day_before, DAYS)), "matrix", publish.CODEC)
    publish.publish_tables(early, root, day_before, lies=True)
    publish.publish_tables(daily.metric_matrix(inputs, AS_OF, DAYS), root, AS_OF)
    publish.write_run(early, root, AS_OF, lies=True)  # a run that never got to its commit
    publish.publish_tables(early, root, day_before - timedelta(days=1), lies=True)
    found = None
    for name, measure, dim in publish.tables(DAYS):
        columns = [
            F.col(publish.published_name(m, dim, measure)).alias(m) for m in publish.METRICS
        ]
        key = F.col(dim).cast("string").alias("key")
        table = spark.table(name).select(F.lit(name).alias("table_name"), key, *columns)
        found = table if found is None else found.unionByName(table)
    return found


def _market_ensured(spark: SparkSession, sf: str) -> DataFrame:
    """The market's cars as a table: built for the day before, again for the day, not again for
    the same day and inputs, but once more when the inputs have changed."""
    inputs = staged_inputs(spark, sf)
    folder = new_path(spark, "market-tables")
    version = publish.input_version(inputs.hist, inputs.vins, inputs.dealers, inputs.zipdist)
    built = 0
    for day, files in (
        (AS_OF - timedelta(days=1), version),
        (AS_OF, version),
        (AS_OF, version),
        (AS_OF, f"{version}, changed"),
    ):

        def build(day: date = day) -> DataFrame:
            facts = stage(
                listing_fact(inputs.hist, inputs.dealers, inputs.vins, day), "market-listings"
            )
            return market.market_fact(facts, inputs.zipdist)

        table, new = publish.ensure_current(spark, "market_listings", folder, build, day, files)
        built += new
    return _doubles(table).withColumn("n_builds", F.lit(built))


def _metric_statement(spark: SparkSession, sf: str) -> DataFrame:
    _facts(staged_inputs(spark, sf)).createOrReplaceTempView("listing_facts")
    found = statements.metric_table(
        spark, "listing_facts", "dealer_id", "mileage", AS_OF, DAYS
    )
    return found.withColumnRenamed("key", "dealer_id")


#: How the refreshed state's records come in: days late, days until a price is corrected.
LATE_DAYS, CORRECTION_DAYS, CORRECTION, REFRESHES = 2, 3, 100, 3


def _matrix_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """A state of three days ago and three refreshes: every seventh car's records come late, every
    eleventh car's price is corrected, and every thirteenth car vanishes on the last day."""
    inputs = staged_inputs(spark, sf)
    number = F.col("vin").cast("long")
    late = F.when(number % 7 == 0, LATE_DAYS).otherwise(0)
    original = inputs.hist.withColumn("latest_record_flg", F.lit(True)).withColumn(
        "posted", F.date_add("vin_last_dt", late)
    )
    corrected = original.filter(number % 11 == 0).withColumns(
        {
            "price": (F.col("price") + CORRECTION).cast(X.MONEY),
            "posted": F.date_add("posted", CORRECTION_DAYS),
        }
    )
    records = original.unionByName(corrected)
    root = new_path(spark, "refreshed")
    first = AS_OF - timedelta(days=REFRESHES)
    known = records.filter(F.col("posted") <= X.as_date(first)).drop("posted")
    refresh.start(spark, root, inputs, known, first, DAYS)
    for n in range(1, REFRESHES + 1):
        day = first + timedelta(days=n)
        new = records.filter(F.col("posted") == X.as_date(day)).drop("posted")
        gone = inputs.hist.filter(number % 13 == 0).select("vin") if day == AS_OF else None
        refresh.refresh(spark, root, inputs, new, day, gone)
        if n == 2:
            refresh.compact(spark, root)
    return refresh.matrix(spark, root, inputs.zipdist)


def _bucketed_fact(spark: SparkSession, sf: str) -> DataFrame:
    inputs = staged_inputs(spark, sf)
    names = bucketed.write_bucketed(inputs, new_path(spark, "bucketed"), BUCKETS)
    return _doubles(bucketed.bucketed_listing_fact(spark, names, inputs.dealers, AS_OF))


def _footer_freshness(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "history")
    staged_inputs(spark, sf).hist.write.parquet(path)
    return checks.latest_from_footers(spark, path)


def _reconcile_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Prices per style of two builds whose windows overlap, compared by checksums first."""
    inputs = staged_inputs(spark, sf)
    shift = timedelta(days=RECONCILE_DAYS)

    def build(start: date, end: date) -> DataFrame:
        rows = study_rows(inputs.hist, inputs.dealers, inputs.vins, start, end)
        return rows.select("style_id", *X.named({"x": X.hundredths("price")}))

    first, second = build(STUDY_START, AS_OF - shift), build(STUDY_START + shift, AS_OF)
    return checks.reconcile_buckets(first, second, ["style_id"], "x", buckets=64)


BUCKETS = 8
RECONCILE_DAYS = 720


def _rule(name: str, min_n: int) -> Query:
    return lambda spark, sf: ev.rule_table(
        staged_inputs(spark, sf), ev.STYLE, name, min_n, STUDY_START, AS_OF
    )


def _prices(spark: SparkSession, sf: str, grain: ev.Grain) -> DataFrame:
    return ev.histogram(staged_inputs(spark, sf), grain, STUDY_START, AS_OF)


def _base(grain: ev.Grain) -> Query:
    return lambda spark, sf: base_stats(stage(_prices(spark, sf, grain), "prices"), grain.key)


def _named_base(grain: ev.Grain) -> Query:
    """Base statistics with the columns that describe the key."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        hist = stage(_prices(spark, sf, grain), "prices")
        names = described(hist, grain.key, grain.carry)
        return base_stats(hist, grain.key).join(names, list(grain.key), "inner")

    return run


def _labelled_ymm(spark: SparkSession, sf: str) -> DataFrame:
    label = X.ymm_label(F.col("model_year"), F.col("make_id"), F.col("model_id"))
    return _named_base(ev.YMM)(spark, sf).withColumn("ymm_key", label)


def _mad(grain: ev.Grain) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        hist = stage(_prices(spark, sf, grain), "prices")
        return dispersion(hist, base_stats(hist, grain.key), grain.key)

    return run


def _study(
    spark: SparkSession, sf: str, grain: ev.Grain, start: date, end: date, keep_rows: bool = False
) -> ev.Study:
    return ev.fit(staged_inputs(spark, sf), grain, start, end, keep_rows=keep_rows)


def _compare(grain: ev.Grain, start: date) -> Query:
    return lambda spark, sf: ev.compare_methods(staged_inputs(spark, sf), grain, start, AS_OF)


def _mae_common(grain: ev.Grain) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        study = _study(spark, sf, grain, STUDY_START, AS_OF)
        return ev.common_error_row(study, study.hist)

    return run


def _mae_own(grain: ev.Grain, start: date) -> Query:
    return lambda spark, sf: ev.own_errors(
        _study(spark, sf, grain, start, AS_OF, keep_rows=True)
    )


def _backtest(grain: ev.Grain) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        later = FIT_END + timedelta(days=1)
        return ev.backtest(staged_inputs(spark, sf), grain, FIT_END, STUDY_DAYS, later, AS_OF)

    return run


def _mae_by_window(grain: ev.Grain) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        inputs = staged_inputs(spark, sf)
        study = ev.fit(inputs, grain, STUDY_START, AS_OF, min_ns=(11,))
        rows = study_rows(
            inputs.hist, inputs.dealers, inputs.vins, None, AS_OF, grain.required
        )
        return ev.mae_by_window(study, rows, AS_OF)

    return run


def _report(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: build(
        ev.compare_methods(staged_inputs(spark, sf), ev.STYLE, STUDY_START, AS_OF)
    )


def _key_check(spark: SparkSession, sf: str) -> DataFrame:
    return checks.key_check(_base(ev.STYLE)(spark, sf), ["style_id"])


def _input_key_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of the inputs themselves: decode and distances are unique, the history is not by car."""
    inputs = staged_inputs(spark, sf)
    checked = {
        "vins": (inputs.vins, ["vin"]),
        "hist": (inputs.hist, ["vin"]),
        "zipdist": (inputs.zipdist, ["zip1", "zip2"]),
        "styles": (inputs.vins, ["style_id"]),  # some cars are not decoded
    }
    found = None
    for name, (df, key) in checked.items():
        part = checks.key_check(df, key).withColumn("input", F.lit(name))
        found = part if found is None else found.unionByName(part)
    return found


def _freshness(spark: SparkSession, sf: str) -> DataFrame:
    return checks.freshness(derived_inputs(spark, sf).hist)


def _reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts per style of two builds, one of them 90 days shorter."""
    inputs = staged_inputs(spark, sf)

    def build(start: date) -> DataFrame:
        rows = study_rows(inputs.hist, inputs.dealers, inputs.vins, start, AS_OF)
        return rows.groupBy("style_id").agg(F.count(F.lit(1)).alias("n"))

    return checks.reconcile(
        build(STUDY_START), build(STUDY_START + timedelta(days=90)), ["style_id"], "n"
    )


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "listing_fact": _listing(lambda f: f),
        "composite_keys": _listing(
            lambda f: with_keys(f).select("vin", "dealer_style", "zip_style")
        ),
        "snapshot_flags": _listing(
            lambda f: with_snapshots(f, AS_OF).select(
                "vin", "today_snapshot", "snapshot_45", "snapshot_60", "snapshot_90"
            )
        ),
        "miles_per_year": _listing(
            lambda f: f.select("vin", "mileage", "model_year", "mileage_per_year")
        ),
        "days_on_lot": _listing(lambda f: f.select("vin", "days_on_lot")),
        "ymm_key": _listing(lambda f: with_ymm_key(f).select("vin", "ymm_key")),
        "market_fact_100": _market_fact,
        "market_bands": _market_bands,
        "make_model_names": _names,
        "study_rows": _study_rows,
        "cars_sold_lstd": _cars_sold,
        "cars_moved_on": _cars_moved_on,
        "count_by_key_sold": _count_by_key_sold,
        "log_profile": _log_profile,
        "log2s_trim": _log2s_trim,
        "trimmed_stats": _aggregated(
            "dealer_id",
            "price",
            {**metrics.trimmed(metrics.SOLD, "sold"), **metrics.trimmed(metrics.LISTED, "lstd")},
        ),
        "group_median": _aggregated("dealer_id", "price", metrics.medians()),
        "days_supply": _aggregated("dealer_id", "price", metrics.supply(DAYS)),
    }
    for short, dimension in DIMENSIONS.items():
        for name, measure in SHORT_MEASURES.items():
            found[f"metric_{name}_{short}"] = _metric(dimension, measure)
    for short in ("style", "dealer", "zip", "zip_style", "dealer_style"):
        found[f"dim_{short}"] = _dimension(DIMENSIONS[short])
    found["dim_snapshots"] = _dimension(
        "today_snapshot", "snapshot_45", "snapshot_60", "snapshot_90"
    )
    found["metric_matrix_long"] = lambda spark, sf: daily.metric_matrix(
        staged_inputs(spark, sf), AS_OF, DAYS
    )
    found["wide_daily"] = lambda spark, sf: daily.wide_daily(staged_inputs(spark, sf), AS_OF)
    found["metric_matrix_bands"] = lambda spark, sf: bands.metric_matrix_bands(
        staged_inputs(spark, sf), AS_OF, DAYS
    )
    found["wide_daily_metrics"] = lambda spark, sf: bands.wide_metrics(
        staged_inputs(spark, sf), AS_OF
    )
    found["publish"] = _published
    found |= {
        "published_tables": _published_tables,
        "market_ensured": _market_ensured,
        "metric_statement": _metric_statement,
        "matrix_refreshed": _matrix_refreshed,
        "bucketed_listing_fact": _bucketed_fact,
        "footer_freshness": _footer_freshness,
        "reconcile_buckets": _reconcile_buckets,
    }
    for name in RULES:
        for t in MIN_NS:
            found[f"out_{name}_{t}"] = _rule(name, t)
    found |= {
        "base_stats_style": _named_base(ev.STYLE),
        "base_stats_ymm": _labelled_ymm,
        "mad_style": _mad(ev.STYLE),
        "mad_ymm": _mad(ev.YMM),
        "compare_methods": _compare(ev.STYLE, STUDY_START),
        "compare_methods_ymm": _compare(ev.YMM, STUDY_START),
        "compare_methods_val": _compare(ev.STYLE, VALIDATION_START),
        "mae_common": _mae_common(ev.STYLE),
        "mae_common_ymm": _mae_common(ev.YMM),
        "mae_own": _mae_own(ev.STYLE, STUDY_START),
        "mae_own_val": _mae_own(ev.STYLE, VALIDATION_START),
        "backtest_oot": _backtest(ev.STYLE),
        "mae_by_window": _mae_by_window(ev.YMM),
        "rpt_outliers_year_make": _report(
            lambda c: reports.outlier_report(c, ["model_year", "make"])
        ),
        "rpt_outliers_make": _report(lambda c: reports.outlier_report(c, ["make"])),
        "rpt_cov_year_11": _report(lambda c: reports.coverage_report(c, ["model_year"], 11)),
        "rpt_cov_make_11": _report(lambda c: reports.coverage_report(c, ["make"], 11)),
        "rpt_cov_year_6": _report(lambda c: reports.coverage_report(c, ["model_year"], 6)),
        "rpt_cov_make_6": _report(lambda c: reports.coverage_report(c, ["make"], 6)),
        "size_buckets": lambda spark, sf: reports.size_buckets(_base(ev.STYLE)(spark, sf)),
        "size_totals": lambda spark, sf: reports.size_totals(_base(ev.STYLE)(spark, sf)),
        "key_check": _key_check,
        "input_key_checks": _input_key_checks,
        "freshness": _freshness,
        "reconcile_versions": _reconcile,
    }
    return found
