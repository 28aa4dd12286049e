"""Interleaving into shards."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from forecourt.llm import sharding


def check(rows, n):
    sizes = Counter(r.shard for r in rows)
    counts = [sizes[s] for s in range(n)]
    assert max(counts) - min(counts) <= 1 and set(sizes) <= set(range(n))
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


@pytest.mark.parametrize("singles, most", [(False, 2), (True, 15)])
def test_every_shard_matches_the_mixture(spark, singles, most):
    # One source has a third of the rows; with singles, 500 have a single one at random places.
    single = "when id < 1500 then concat('one', id)" * singles
    df = spark.range(3000).selectExpr(
        "id as doc_id",
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then concat('s', id % 7) "
        f"{single} end as source",
    )
    rows = sharding.interleave(df, 8).collect()
    check(rows, 8)
    for source, n in Counter(r.source for r in rows).items():
        got = Counter(r.shard for r in rows if r.source == source)
        assert all(abs(got[s] - n / 8) <= most for s in range(8)), source


def test_a_hot_key_is_spread(spark):
    """A third of the rows share a key, another third have none; they still fill every shard alike."""
    df = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 7 when id % 3 = 1 then id end as doc_id", "cast(id % 2 as string) as source"
    )
    rows = sharding.interleave(df.repartition(6), 10).collect()
    check(rows, 10)
    for source in "01":
        got = Counter(r.shard for r in rows if r.source == source)
        assert all(abs(got[s] - 150) <= 2 for s in range(10))


def test_places_do_not_depend_on_partitions_but_on_the_seed(spark):
    df = spark.range(500).selectExpr("id as doc_id", "cast(id % 5 as string) as source")
    one = {r.doc_id: (r.shard, r.slot) for r in sharding.interleave(df, 4).collect()}
    two = sharding.interleave(df.repartition(7).orderBy(F.desc("doc_id")), 4).collect()
    assert one == {r.doc_id: (r.shard, r.slot) for r in two}
    other = {r.doc_id: (r.shard, r.slot) for r in sharding.interleave(df, 4, seed=3).collect()}
    assert one != other


def test_odd_tables(spark, odd_docs, no_docs, tmp_path):
    placed = sharding.interleave(odd_docs, 40)
    rows = placed.collect()
    assert len(rows) == odd_docs.count() and "a.b" in placed.columns
    check(rows, 40)
    assert sharding.interleave(no_docs, 40).collect() == []
    path = str(tmp_path / "shards")
    few = sharding.interleave(odd_docs.select("doc_id", "source"), 3)
    sharding.write_shards(few, path, rows_per_file=4)
    assert spark.read.parquet(path).count() == odd_docs.count()
