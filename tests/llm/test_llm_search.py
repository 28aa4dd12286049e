"""Bit-sliced search against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import bitslice
from forecourt.llm.oracle import ORACLES
from forecourt.llm.queries import op6_bit_sliced


def brute(rows, k, asks):
    part = [
        (key, [int(np.floor(64 * x)) for x in v])
        for key, v in rows
        if v is not None and not any(x is None or not np.isfinite(x) for x in v)
    ]
    found = []
    for n, (own, q) in enumerate(part):
        if own is not None and asks(own):
            scores = sorted(
                (-sum(a * b for a, b in zip(q, v, strict=False)), key is None, key or 0)
                for m, (key, v) in enumerate(part)
                if m != n
            )
            found += [(own, i + 1, None if null else key, -s) for i, (s, null, key) in enumerate(scores[:k])]
    return found


def check(spark, rows, k, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}")
    df = df.withColumns({c: F.lit(1) for c in ("key", "v", "block", "chunk", "score", "rank", "at", "copies")})
    got = bitslice.nearest(df, F.col("key") % 4 == 0, k=k).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows, k, lambda i: i % 4 == 0)))


@pytest.mark.parametrize("block, batch", [(65_536, 1024), (20, 3)])
def test_blocks_and_batches(spark, monkeypatch, block, batch):
    monkeypatch.setattr(bitslice, "QUERIES", batch)
    monkeypatch.setattr(bitslice, "block_rows", lambda rows: block)
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.3, (90, 5)).astype(np.float32).tolist()
    vectors[30:50] = [vectors[7]] * 20  # ties
    check(spark, list(enumerate(vectors)), 6)


ODD = [
    (0, [0.5, 0.5]),
    (1, None),
    (2, [None, 1.0]),
    (3, [float("nan"), 1.0]),
    (4, [float("inf"), 1.0]),
    (5, []),
    (6, [1.0]),
    (7, [1.0, -1.0, 2.0]),
    (8, [0.0, 0.0]),
    (8, [-1.0, 3.0]),
    (8, [-1.0, 3.0]),
    (None, [1.0, 1.0]),
    (None, [1.0, 1.0]),
    (12, [1000.0, -1000.0]),
    (16, [1e6, 2.0]),
]


def test_odd_vectors(spark):
    check(spark, ODD, 3)
    check(spark, ODD, 50, "array<double>")
    check(spark, [(4, [1.0])], 3)
    check(spark, [], 3)
    check(spark, [(1, [1.0]), (2, [2.0])], 3)  # no queries


def test_numbers_too_large_for_bitmap_sums(spark):
    wide = [(i, [(-1.0) ** i * (2.0**25 + i), 3.0 * i, 2.0**18]) for i in range(24)]
    check(spark, wide + ODD, 5, "array<double>")
    check(spark, [(4, [2.0**56]), (8, [-1.0 / 64]), (9, [1.0 / 64])], 3, "array<double>")
    with pytest.raises(Exception, match="beyond the range of long"):
        check(spark, [(4, [2.0**40]), (5, [2.0**40])], 3, "array<double>")


@pytest.mark.parametrize("block, batch", [(65_536, 1024), (20, 3)])
def test_repeated_ids_as_the_query_has_them(spark, saved, tmp_path, monkeypatch, block, batch):
    monkeypatch.setattr(bitslice, "QUERIES", batch)
    monkeypatch.setattr(bitslice, "block_rows", lambda rows: block)
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 0.3, (150, 5)).astype(np.float32).tolist()
    ids = list(range(100)) + [7] * 20 + [20] * 3 + [40] * 25 + [None] * 2
    vectors[110:120] = [vectors[7]] * 10  # the same row again
    vectors[123:148] = [vectors[40]] * 25  # and a query more often than it has places
    rows = list(zip(ids, vectors, strict=True))
    saved(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "embeddings")
    got = op6_bit_sliced(spark, str(tmp_path)).collect()
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = duck.execute(ORACLES["op6_bit_sliced"]).fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sorted(map(repr, want)) == sorted(map(repr, brute(rows, 20, lambda i: i % 20 == 0)))
    assert len(want) == 20 * (5 + 3 + 25)


def test_blocks_stay_within_their_bytes(spark):
    df = spark.createDataFrame([(list(range(4096)),), ([1 << 40],)], "v array<long>")
    n = bitslice.block_rows(df)
    assert 64 <= n and n * 4096 * (42 + 48) // 8 <= bitslice.BLOCK_BYTES
    assert bitslice.block_rows(df.limit(0)) == bitslice.BLOCK_ROWS


def test_every_block_is_read_once_when_there_are_as_many_as_tasks(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "block_rows", lambda rows: 10)
    rows = spark.createDataFrame([(i, [i]) for i in range(200)], "key long, v array<long>")
    rows = rows.withColumn("at", F.col("key"))
    path, blocks = bitslice.build_index(rows)
    held = spark.read.parquet(path)
    assert blocks == 20 and held.count() <= 20
    assert held.select(F.sum(F.length("at") / 8)).first()[0] == 200
