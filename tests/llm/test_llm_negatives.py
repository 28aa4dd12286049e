"""Hard negatives against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.llm import hard_negatives as H


def brute(rows, asks, positives=5, negatives=3, low=50, high=95, scale=256):
    """Rows are (id, label, vector)."""
    part = [
        (i, label, [int(np.floor(scale * x)) for x in v])
        for i, label, v in rows
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    found = []
    for at, (anchor, label, q) in enumerate(part):
        if anchor is None or not asks(anchor):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, v)), i is None, i or 0, other != label)
            for n, (i, other, v) in enumerate(part)
            if n != at
        )
        for s, null, i, _ in [x for x in scored if not x[3]][:positives]:
            inside = [x for x in scored if x[3] and low * -s <= 100 * -x[0] <= high * -s]
            for rank, x in enumerate(inside[:negatives]):
                found.append(
                    (anchor, None if null else i, rank + 1, None if x[1] else x[2], -s, -x[0])
                )
    return found


def check(spark, rows, kind="array<double>", asks=4, **more):
    df = spark.createDataFrame(rows, f"vec_id long, label int, embedding {kind}")
    df = df.withColumns({c: F.lit(1) for c in ("id", "v", "at", "score", "copies", "windows", "anchor")})
    got = H.mine(df, F.col("id") % asks == 0, **more).collect()
    want = brute(rows, lambda i: i % asks == 0, **more)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    return got


@pytest.mark.parametrize("block", [4 << 20, 60])
def test_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(H, "BLOCK_VALUES", block)
    monkeypatch.setattr(H, "ANCHORS", 7)
    rng = np.random.default_rng(1)
    vectors = rng.normal(0.2, 0.3, (150, 5)).tolist()
    vectors[30:60] = [vectors[7]] * 30  # ties
    rows = [(i, int(rng.integers(3)), v) for i, v in enumerate(vectors)]
    assert check(spark, rows)
    assert check(spark, rows, positives=2, negatives=9, low=0, high=100)


ODD = [
    (0, 1, [0.5, 0.5]),
    (1, 1, None),
    (2, None, [1.0, 1.0]),
    (3, 1, [None, 1.0]),
    (4, 1, [float("nan"), 1.0]),
    (5, 1, [float("-inf"), 1.0]),
    (8, 1, []),
    (12, 1, [1.0]),
    (16, 1, [1.0, -1.0, 2.0]),
    (20, 2, [0.4, 0.4]),
    (None, 2, [0.3, 0.3]),
    (None, 2, [0.3, 0.3]),
    (None, 1, [0.6, 0.6]),
    (24, 2, [0.0, 0.0]),
    (28, 1, [0.0, 0.0]),
    (32, 1, [-1.0, -1.0]),
    (36, 2, [1e6, 2.0]),
    (40, 1, [1e6, 1e6]),
]


def test_odd_rows(spark):
    assert check(spark, ODD)
    check(spark, ODD, positives=50, negatives=50)
    check(spark, ODD, low=0, high=100)
    check(spark, [(4, 1, [1.0])])
    check(spark, [(1, 1, [1.0]), (2, 2, [1.0])])  # no anchors
    check(spark, [])


def test_wide_components(spark):
    rows = [(i, i % 2, [float(2**40 + i * 2**33), -(2.0**20)]) for i in range(1, 13)]
    with pytest.raises(Exception, match="beyond the range of long"):
        check(spark, rows, scale=1)
    rows = [(i, i % 2, [float(2**29 + i * 2**24), -(2.0**20)]) for i in range(1, 13)]
    assert check(spark, rows, scale=1)
    check(spark, [(4, 1, [2.0**62]), (5, 1, [1.0]), (6, 2, [0.75])], scale=1)


def test_repeated_identifiers(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(0.2, 0.3, (40, 4)).tolist()
    rows = [(i % 9, i % 2, v) for i, v in enumerate(vectors)]
    rows += [(4, 0, vectors[0])] * 25 + [(8, 1, vectors[1])] * 3  # hot copies, anchors themselves
    assert check(spark, rows)


def test_windows_are_whole_numbers():
    for score in (-10, -1, 0, 1, 7, 99, 100, 12345):
        least, most = H.window(score, 50, 95)
        inside = [n for n in range(-200, 13_000) if 50 * score <= 100 * n <= 95 * score]
        assert inside == list(range(least, most + 1))


long = st.integers(-(2**63), 2**63 - 1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**63 - 1), long, st.one_of(st.none(), long)), min_size=1, max_size=8))
def test_packed_keys_sort_as_pairs_do(pairs):
    columns = [np.array([p[i] or 0 for p in pairs], np.int64) for i in (0, 1, 2)]
    null = np.array([p[2] is None for p in pairs])
    keys = H.packed(columns[0], columns[1], H.NEGATIVE, null, columns[2]).to_pylist()
    assert [H.unpacked(k) for k in keys] == [(a, s, H.NEGATIVE, i) for a, s, i in pairs]
    in_order = sorted(pairs, key=lambda p: (p[0], -p[1], p[2] is None, p[2] or 0))
    assert [H.unpacked(k)[::3] for k in sorted(keys)] == [(a, i) for a, s, i in in_order]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-5, 5), min_size=6, max_size=6), min_size=1, max_size=4), st.integers(1, 8), st.booleans())
def test_best(scores, k, wide):
    scores = np.array(scores, np.int64) * (1 << 59 if wide else 1)
    able = scores % 3 != 0
    row, col = H.best(scores, able, k)
    for i, line in enumerate(scores.tolist()):
        places = sorted((-s, j) for j, s in enumerate(line) if able[i, j])[:k]
        assert sorted(col[row == i].tolist()) == sorted(j for _, j in places)
