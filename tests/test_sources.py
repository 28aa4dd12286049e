"""Readers, staging and publication."""

import re
from datetime import date
from pathlib import Path

import pytest
from conftest import AS_OF, ago
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from forecourt import staging
from forecourt.plans.daily import ensure, publish, published
from forecourt.sources import schemas, tables, tpch

SF = "/root/testdata/sf0.001"


def test_parquet_round_trip_and_casts(spark, tmp_path, listings):
    inputs = listings([{"mileage": 12.5}])
    for name in schemas.TABLES:
        getattr(inputs, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    read = tables.from_parquet(spark, str(tmp_path))
    assert read.hist.schema == schemas.HIST and read.hist.count() == 1
    text = inputs.hist.withColumn("mileage", inputs.hist.mileage.cast("string"))
    odd = text.replace("12.50", "n/a", "mileage")
    assert schemas.conform(odd, schemas.HIST).first().mileage is None
    wrong = inputs.dealers.withColumn("dealer_id", F.lit("no number"))
    with pytest.raises(NumberFormatException):
        schemas.conform(wrong, schemas.DEALERS).collect()
    with pytest.raises(ValueError, match="zip"):
        schemas.conform(inputs.dealers.drop("zip"), schemas.DEALERS)


def test_catalog_tables(spark, listings):
    inputs = listings([{}])
    for name in schemas.TABLES:
        getattr(inputs, name).createOrReplaceTempView(f"in_{name}")
    read = tables.from_catalog(spark, {name: f"in_{name}" for name in schemas.TABLES})
    assert read.vins.collect() == inputs.vins.collect()


def test_database_reads_are_split_by_day():
    days = tables.daily_predicates(date(2001, 3, 1), 3)
    assert days == [f"vin_last_dt = DATE '2001-{d}'" for d in ("02-27", "02-28", "03-01")]


def test_stage_uses_the_folder_of_the_session(spark):
    df = spark.range(5).selectExpr("id", "cast(id as decimal(12,2)) as d")
    back = staging.stage(df, "test")
    assert sorted(back.collect()) == sorted(df.collect())
    assert back.inputFiles()[0].startswith(f"file://{staging.shared_folder(spark)}")


def test_released_files_are_gone(spark, monkeypatch):
    monkeypatch.setattr(staging, "own_folder", lambda s: f"{staging.shared_folder(s)}/forecourt/released")
    kept = staging.stage(spark.range(3), "test").inputFiles()[0].removeprefix("file://")
    assert Path(kept).exists()
    staging.release(spark)
    assert not Path(kept).exists() and not Path(kept).parent.parent.exists()


def test_publish_replaces_one_day_only(spark, tmp_path):
    path = str(tmp_path / "table")
    publish(spark.range(3), path, ago(1))
    publish(spark.range(9), path, AS_OF)
    publish(spark.range(4), path, AS_OF)
    assert published(spark, path, AS_OF).count() == 4
    assert published(spark, path, ago(1)).count() == 3
    publish(spark.range(0), path, AS_OF)
    assert published(spark, path, AS_OF).collect() == []
    assert published(spark, path, ago(1)).count() == 3


def test_ensure_builds_once(spark):
    built = []

    def builder():
        built.append(1)
        return spark.range(2)

    spark.sql("drop table if exists ensured_20010701")
    try:
        for _ in range(2):
            assert ensure(spark, "ensured_20010701", builder).count() == 2
        assert len(built) == 1
    finally:
        spark.sql("drop table if exists ensured_20010701")


def test_derived_tables_have_the_declared_columns(spark):
    derived = tpch.inputs(spark, SF)
    for name, schema in schemas.TABLES.items():
        found = {f.name: f.dataType for f in getattr(derived, name).schema}
        assert found == {f.name: f.dataType for f in schema}, name
    latest = derived.hist.filter("latest_record_flg")
    assert latest.count() == latest.select("vin").distinct().count()
    staged = tpch.staged_inputs(spark, SF)
    columns = ["vin", "price", "latest_record_flg"]
    assert sorted(staged.hist.select(columns).collect()) == sorted(
        derived.hist.select(columns).collect()
    )


def test_part_types_are_numbered_by_name(spark):
    part = spark.createDataFrame([("B",), ("C",), ("A",), ("B",)], "p_type string")
    assert sorted(map(tuple, tpch._models(part).collect())) == [(1, "A"), (2, "B"), (3, "C")]


@pytest.mark.parametrize("low, high, parts", [(1, 100, 8), (5, 7, 8), (-3, 3, 2), (0, 10**12, 32), (4, 4, 8), (None, None, 8), (1, 9, 1)])
def test_ranges_divide_all_rows(spark, low, high, parts):
    conditions = tables.range_predicates("id", low, high, parts)
    values = [None, -(10**13), 10**13, -1, 0, 1, 2, 5, 6, 7, 50, 99, 100, 10**6, 10**12 - 1]
    df = spark.createDataFrame([(v,) for v in values], "id long")
    hits = [r[0] for c in conditions for r in df.filter(c).collect()]
    assert sorted(map(str, hits)) == sorted(map(str, values))
    assert len(conditions) <= max(1, parts)


def test_distances_divide_all_pairs(spark):
    conditions = tables.distance_predicates(8)
    values = [None, -1.0, 0.0, 24.9, 88.388, 125.0, 249.0, 250.0, 900.0]
    df = spark.createDataFrame([(v,) for v in values], "distance double")
    hits = [r[0] for c in conditions for r in df.filter(c).collect()]
    assert sorted(map(str, hits)) == sorted(map(str, values)) and len(conditions) == 8


def test_bucketed_tables_join_without_moving_rows(spark, tmp_path):
    from forecourt.operators.listing import listing_fact
    from forecourt.sources import bucketed

    inputs = tpch.staged_inputs(spark, SF)
    names = bucketed.write_bucketed(inputs, str(tmp_path), 4, prefix="tested_")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = bucketed.bucketed_listing_fact(spark, names, inputs.dealers, AS_OF)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(str, fact.collect()))
    finally:
        for k in settings:
            spark.conf.unset(k)
        for name in names.values():
            spark.sql(f"drop table {name}")
    want = listing_fact(inputs.hist, inputs.dealers, inputs.vins, AS_OF)
    assert got == sorted(map(str, want.select(fact.columns).collect()))
    lines = plan.splitlines()
    depth = [re.search(r"[A-Za-z*]", line).start() if line.strip() else 0 for line in lines]
    (at,) = (i for i, line in enumerate(lines) if "SortMergeJoin [vin#" in line)
    below = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
    decode = lines[at:below]
    assert not any("Exchange" in line for line in decode)
    assert sum("Bucketed: true" in line for line in decode) == 2


def test_freshness_reads_no_column(spark, tmp_path):
    from forecourt.operators import checks

    inputs = tpch.staged_inputs(spark, SF)
    path = str(tmp_path / "hist")
    inputs.hist.write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in checks.FOOTERS}
    latest = checks.latest_from_footers(spark, path).first().latest
    assert latest == inputs.hist.agg(F.max("vin_last_dt")).first()[0]
    assert {k: spark.conf.get(k, None) for k in checks.FOOTERS} == before
    for k, v in checks.FOOTERS.items():
        spark.conf.set(k, v)
    try:
        plan = spark.read.parquet(path).agg(F.max("vin_last_dt"))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in checks.FOOTERS:
            spark.conf.unset(k)
    assert "PushedAggregation: [MAX(vin_last_dt)]" in plan
    spark.createDataFrame([], "vin_last_dt date").write.parquet(str(tmp_path / "none"))
    assert checks.latest_from_footers(spark, str(tmp_path / "none")).first().latest is None


def test_builds_are_compared_by_checksum(spark):
    from forecourt.operators import checks

    a = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (None, 5), (7, None)], "k int, v long")
    b = spark.createDataFrame([(2, 20), (3, 33), (4, 40), (5, 50), (None, 5), (7, None)], "k int, v long")
    for buckets in (1, 64):
        got = checks.reconcile_buckets(a, b, ["k"], "v", buckets).first().asDict()
        assert got == {"in_both": 4, "only_in_a": 1, "only_in_b": 2, "n_differ": 1, "min_diff": -3, "max_diff": 0}
        same = checks.reconcile_buckets(a, a, ["k"], "v", buckets).first().asDict()
        assert same == {"in_both": 5, "only_in_a": 0, "only_in_b": 0, "n_differ": 0, "min_diff": 0, "max_diff": 0}
    none = checks.reconcile_buckets(a, b.limit(0), ["k"], "v").first()
    assert (none.in_both, none.only_in_a, none.max_diff) == (0, 5, None)


def test_derived_tables_are_written_small_and_not_sorted_again(spark):
    staged = tpch.staged_inputs(spark, SF)
    files = [*staged.hist.inputFiles(), *staged.vins.inputFiles()]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    cars = [int(r[0]) for r in spark.read.parquet(staged.hist.inputFiles()[0]).select("vin").collect()]
    assert cars == sorted(cars)  # as the window leaves them, not sorted again
