"""Histogram statistics against Python's, with hot groups and many buckets."""

import math
import random
import statistics

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.operators.histogram import (
    CHUNK,
    attach,
    bucket,
    group_stats,
    locate,
    median_of,
    middle,
    ranked,
    value_histogram,
)


def frame(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "g string, x long")


def medians(hist, located):
    rows = ranked(hist, located, ["g"])
    return rows_of(rows.groupBy("g").agg(*X.named({"m": median_of()})), "g")


@pytest.fixture
def groups():
    rng = random.Random(5)
    return {
        "one": [500],
        "odd": [100, 200, 300],
        "even": [100, 200, 300, 1000],
        "equal": [777] * 9,
        "hot": [rng.choice([5, 5, 5, 6, 9 * CHUNK + 1, rng.randrange(1, 8 * CHUNK)])
                for _ in range(3000)],
        "two halves": [10] * 50 + [3 * CHUNK] * 50,
    }


def test_median_is_exact_for_every_group(spark, groups):
    hist = value_histogram(frame(spark, groups), ["g"])
    for located in (locate(hist, ["g"]), middle(locate(hist, ["g"]))):
        got = medians(hist, located)
        for name, values in groups.items():
            assert got[name]["m"] == statistics.median(values) / 100, name


def test_statistics_match_python(spark, groups):
    hist = value_histogram(frame(spark, groups), ["g"])
    got = rows_of(group_stats(locate(hist, ["g"]), ["g"]), "g")
    for name, values in groups.items():
        xs = [v / 100 for v in values]
        logs = [math.log(x) for x in xs]
        row = got[name]
        assert row["n_group"] == len(xs)
        assert (row["low"], row["high"]) == (min(values), max(values))
        assert row["mean"] == pytest.approx(statistics.fmean(xs), rel=1e-12)
        assert row["mean_log"] == pytest.approx(statistics.fmean(logs), rel=1e-12)
        if len(xs) == 1:
            assert row["std"] is None and row["std_log"] is None
        else:
            assert row["std"] == pytest.approx(statistics.stdev(xs), rel=1e-9)
            assert row["std_log"] == pytest.approx(statistics.stdev(logs), rel=1e-9, abs=1e-12)


def test_ranks_cover_each_group_once(spark, groups):
    hist = value_histogram(frame(spark, groups), ["g"])
    found = {}
    for r in ranked(hist, locate(hist, ["g"]), ["g"]).collect():
        found.setdefault(r.g, []).append((r.first_rank, r.last_rank, r.x))
    for name, values in groups.items():
        spans = sorted(found[name])
        assert [v for first, last, v in spans for _ in range(first, last + 1)] == sorted(values)


def test_copies_count_like_rows(spark, groups):
    rows = frame(spark, groups)
    once = value_histogram(rows, ["g"])
    again = value_histogram(once.drop("bucket"), ["g"], copies="n")
    assert sorted(once.collect()) == sorted(again.collect())


def test_attach_keeps_rows_of_a_hot_key_apart(spark, groups):
    hist = value_histogram(frame(spark, groups), ["g"])
    stats = hist.groupBy("g").agg(F.sum("n").alias("rows"))
    joined = attach(hist, stats.filter("g <> 'odd'"), ["g"], "left")
    assert joined.count() == hist.count()
    got = {(r.g, r.rows) for r in joined.collect()}
    assert got == {(n, None if n == "odd" else len(v)) for n, v in groups.items()}


def test_buckets_are_ordered_like_values_and_bounded(spark):
    rng = random.Random(1)
    xs = sorted(rng.randrange(0, 10**12) for _ in range(500))
    df = spark.createDataFrame([(x,) for x in xs], "x long").withColumn("b", bucket())
    pairs = sorted((r.x, r.b) for r in df.collect())
    assert [b for _, b in pairs] == sorted(b for _, b in pairs)
    assert all(b * CHUNK <= x < (b + 1) * CHUNK for x, b in pairs)


@pytest.mark.parametrize("level", ["10000.00", "1000000.00", "100000000.00"])
def test_tight_groups_of_large_values_keep_their_deviation(spark, level):
    base = int(level.replace(".", ""))
    values = [base + i for i in range(12)] + [base + 3] * 4
    df = spark.createDataFrame([("a", v) for v in values], "g string, x long")
    want = statistics.stdev(values) / 100
    want_log = statistics.stdev(math.log(v) - math.log(base) for v in values)
    for parts in (1, 7):
        hist = value_histogram(df.repartition(parts), ["g"])
        stats = group_stats(locate(hist, ["g"]), ["g"]).first()
        assert math.isclose(stats.std, want, rel_tol=1e-9)
        # Relative to the bucket's middle; the logarithms themselves have fewer digits here.
        assert math.isclose(stats.std_log, want_log, rel_tol=1e-4)


def test_deviations_of_groups_over_many_buckets(spark):
    values = [1, 2, 50_000_000, 50_000_001, 7_000_000_000, 123_456]
    df = spark.createDataFrame([("a", v) for v in values * 3], "g string, x long")
    stats = group_stats(locate(value_histogram(df, ["g"]), ["g"]), ["g"]).first()
    assert math.isclose(stats.std, statistics.stdev(v / 100 for v in values * 3), rel_tol=1e-12)
    logs = [math.log(v / 100) for v in values * 3]
    assert math.isclose(stats.std_log, statistics.stdev(logs), rel_tol=1e-12)
