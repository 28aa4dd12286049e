"""Physical plans: pushed filters, no cross products, skew-safe shapes."""

import re

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from forecourt.operators.histogram import CHUNK, locate, ranked, value_histogram
from forecourt.operators.listing import listing_fact, study_rows
from forecourt.operators.market import market_fact
from forecourt import staging
from forecourt.plans import daily, markets
from forecourt.plans import evaluation as ev
from forecourt.sources import tpch

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    return tpch.staged_inputs(spark, SF)


@pytest.fixture(scope="module")
def staged_plans(spark, inputs):
    """Plans of everything that the pipelines write on their way, and of their results, by pipeline."""
    found = {}

    def recorded(name, build, *modules):
        plans = found.setdefault(name, [])

        def stage(df, label):
            plans.append((label, plan_of(df)))
            return staging.stage(df, label)

        with pytest.MonkeyPatch.context() as patch:
            for module in modules:
                patch.setattr(module, "stage", stage)
            plans.append(("result", plan_of(build())))

    since = "1998-07-17"
    recorded("matrix", lambda: daily.metric_matrix(inputs, AS_OF), daily)
    recorded("comparison", lambda: ev.compare_methods(inputs, ev.STYLE, since, AS_OF), ev)
    recorded("own errors", lambda: ev.own_errors(ev.fit(inputs, ev.STYLE, since, AS_OF, keep_rows=True)), ev)
    recorded("bands", lambda: markets.metric_matrix_bands(inputs, AS_OF), markets, daily)
    recorded("wide", lambda: markets.wide_metrics(inputs, AS_OF), markets)
    return found


def test_no_step_of_a_pipeline_multiplies_or_meets_in_one_task(staged_plans):
    for name, plans in staged_plans.items():
        assert len(plans) > 1, name
        for label, plan in plans:
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, (name, label)
            assert "Python" not in plan and "Pandas" not in plan, (name, label)
            allowed = 1 if (name, label) == ("own errors", "result") else 0
            assert plan.count("Exchange SinglePartition") == allowed, (name, label)


def exchanges(plans):
    """Shuffles of all steps; what Spark reuses counts once."""
    return sum(len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|range|Round)", p)) for _, p in plans)


def test_ranked_rows_are_not_ranked_again(staged_plans):
    ranks = [label for label, plan in staged_plans["own errors"] if re.search(r"Window .*x#\d+L? ASC", plan)]
    assert ranks == ["base", "ranked"]
    assert exchanges(staged_plans["own errors"]) <= exchanges(staged_plans["comparison"]) + 2


def test_snapshots_travel_as_one_key(staged_plans):
    """A car is repeated for three dimensions and all snapshots together, not for each of them."""
    plan = next(p for label, p in staged_plans["matrix"] if label == "values")
    assert plan.count("Generate inline") == 3  # listing targets, snapshots after counting, market targets


def test_all_bands_share_one_expansion(staged_plans):
    joins = [len(re.findall(r"Join \[zip#", p)) for _, p in staged_plans["bands"]]
    assert sum(joins) == 1


@pytest.fixture(scope="module")
def frames(spark, inputs):
    facts = listing_fact(inputs.hist, inputs.dealers, inputs.vins, AS_OF)
    study = ev.fit(inputs, ev.STYLE, "1998-07-17", AS_OF)
    return {
        "listing": facts,
        "study rows": study_rows(inputs.hist, inputs.dealers, inputs.vins, "1998-07-17", AS_OF),
        "market": market_fact(facts, inputs.zipdist),
        "matrix": daily.metric_matrix(inputs, AS_OF),
        "wide": daily.wide_daily(inputs, AS_OF),
        "comparison": study.comparison,
        "own errors": ev.own_errors(study),
        "common errors": ev.common_error_row(study, study.hist),
    }


def test_no_cross_products_and_no_python(frames):
    for name, df in frames.items():
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        assert "Python" not in plan and "Pandas" not in plan, name


def test_only_global_sums_meet_in_one_partition(frames):
    for name, df in frames.items():
        single = plan_of(df).count("Exchange SinglePartition")
        assert single == (1 if "errors" in name else 0), name


def test_filters_and_columns_reach_the_scan(spark, inputs):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        rows = study_rows(inputs.hist, inputs.dealers, inputs.vins, "1998-07-17", AS_OF)
        lines = plan_of(rows).splitlines()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in lines if "latest_record_flg" in line and "FileScan" in line)
    pushed = re.search(r"PushedFilters: \[(.*?)\]", scan).group(1)
    assert "latest_record_flg" in pushed
    assert "GreaterThanOrEqual(vin_last_dt,1998-07-17)" in pushed
    assert "LessThanOrEqual(vin_last_dt,2001-07-01)" in pushed
    assert "GreaterThan(price,0.00)" in pushed
    assert "mileage" not in scan.split("ReadSchema")[1]


def test_dealers_of_a_study_are_only_checked_for_existence(frames):
    assert "LeftSemi" in plan_of(frames["study rows"])
    assert "LeftOuter" not in plan_of(frames["study rows"])


def test_latest_record_is_limited_before_the_shuffle(spark):
    latest = tpch.inputs(spark, SF).hist.filter("latest_record_flg")
    plan = plan_of(latest)
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_a_hot_group_is_spread_over_tasks(spark):
    """Most rows in one group: no shuffled partition may hold most of the values."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(40_000).select(
            F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).alias("g"),
            (F.col("id") * (CHUNK // 500) + 1).alias("x"),
        )
        hist = value_histogram(rows, ["g"])
        values = hist.groupBy(F.spark_partition_id()).count().collect()
        joined = ranked(hist, locate(hist, ["g"]), ["g"])
        hot = joined.filter("g = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(r["count"] for r in values) < 40_000 * 0.4
    assert len(hot) == 4 and max(r["count"] for r in hot) < 32_000 * 0.5


def test_window_groups_are_bounded(frames):
    """Every window is split by group, and values are ranked within a bucket."""
    for name in ("matrix", "comparison"):
        for line in plan_of(frames[name]).splitlines():
            if " Window " not in line:
                continue
            ranks_values = re.search(r"\bx#\d+L? ASC", line)
            assert "bucket#" in line, (name, line[:200])
            if ranks_values:
                assert re.search(r"bucket#\d+L?, x#\d+L? ASC", line), line[:300]
