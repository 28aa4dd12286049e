"""Importance resampling against brute force; sums of word runs; the exact cutoff."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm import byte_words, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs(words, most):
    return [" ".join(words[i : i + n]) for i in range(len(words)) for n in range(1, min(most, len(words) - i) + 1)]


def brute(docs, target, percent, buckets, most, min_words, seed):
    def counted(texts):
        found = [0] * buckets
        for t in texts:
            for run in runs(words_of(t), most):
                found[zlib.crc32(run.encode()) % buckets] += 1
        return found

    s, t = counted(x for _, x in docs), counted(target)
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for key, text in docs:
        words = words_of(text)
        features = runs(words, most)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features)
        spelled = f"{seed}:{'' if key is None else key}"
        h = int(hashlib.sha256(spelled.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(words), len(features), weight, weight + noise, None])
    able = [r for r in rows if r[1] >= min_words]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = i + 1
    return rows


@pytest.mark.parametrize("percent, buckets, most, min_words", [(10, 10_000, 1, 20), (50, 7, 3, 0), (100, 70_000, 2, 1), (0, 5, 1, 0)])
def test_odd_tables(spark, odd_docs, percent, buckets, most, min_words):
    target = ["a few words here", None, "", "日本語 a b"]
    benchmark = spark.createDataFrame([(t, 1) for t in target], "text string, key int")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = resample.resample(odd_docs, benchmark, percent, buckets, most, min_words, seed=3).collect()
    want = brute(rows, target, percent, buckets, most, min_words, 3)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


def test_empty_tables(spark, no_docs):
    none = spark.createDataFrame([], "text string")
    assert resample.resample(no_docs, none).collect() == []
    docs = spark.createDataFrame([(i, f"w{i} x") for i in range(30)], "doc_id long, text string")
    got = resample.resample(docs, none, min_words=1).collect()
    want = brute([(i, f"w{i} x") for i in range(30)], [], 10, 10_000, 1, 1, 2024)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


def test_hot_copies_are_drawn_whole(spark):
    rows = [(7, "same words again")] * 60 + [(i, f"word {i} again") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("same again",)], "text string")
    got = resample.resample(docs, target, 25, min_words=1).collect()
    want = brute(rows, ["same again"], 25, 10_000, 1, 1, 2024)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


@pytest.mark.parametrize("k", [1, 2, 250, 499, 500])
def test_cutoff(spark, saved, k):
    rng = random.Random(k)
    rows = [(rng.randrange(-9, 9), rng.randrange(40)) for _ in range(450)] + [(3, 3)] * 50
    df = saved(spark.createDataFrame(rows, "a long, b long").repartition(7))
    assert resample.cutoff(df, k) == sorted(rows)[k - 1]
    with pytest.raises(ValueError):
        resample.cutoff(df, 501)


def test_only_features_and_scores_are_written(spark, monkeypatch):
    labels, stage = [], resample.stage
    monkeypatch.setattr(resample, "stage", lambda df, label, **kw: labels.append(label) or stage(df, label, **kw))
    rows = [(i, f"word {i % 9} again") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("same again",)], "text string")
    got = resample.resample(docs, target, 50, min_words=1).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 151))
    assert labels == ["features", "scored"]


@pytest.mark.parametrize("n, ranges", [(0, 3), (1, 3), (40, 1), (40, 7), (5000, 16), (300, 2000)])
def test_ranges_are_even_and_in_order(spark, saved, n, ranges):
    rng = random.Random(n)
    rows = [(rng.randrange(-3, 3), rng.randrange(1 << 40)) for _ in range(n)]
    df = saved(spark.createDataFrame(rows, "a long, b long").repartition(4))
    ends = resample.bounds(df, ranges)
    assert ends == sorted(set(ends)) and len(ends) < ranges
    parts = {}
    for a, b, part in resample.parted(df, ["a", "b"], ends).collect():
        parts.setdefault(part, []).append((a, b))
    assert sum((sorted(parts[p]) for p in sorted(parts)), []) == sorted(rows)
    assert all(sorted(parts[i])[-1] == end for i, end in enumerate(ends))
    assert max(map(len, parts.values()), default=0) <= n / ranges + n / resample.SPREAD + 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(1, 9)), min_size=1, max_size=12))
def test_weighted_median_leaves_half_on_either_side(parts):
    medians = [((m,), n) for m, n in parts]
    (pivot,) = resample.weighted_median(medians)
    total = sum(n for _, n in parts)
    assert 2 * sum(n for m, n in parts if m < pivot) <= total
    assert 2 * sum(n for m, n in parts if m > pivot) <= total


text = st.lists(st.sampled_from(["a", "b" * 63, "c" * 64, "d" * 65, "e" * 200, "é", "日本"]), max_size=9).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(text, max_size=4), st.integers(1, 4))
def test_sums_of_runs(texts, most):
    sums, first = byte_words.run_sums(byte_words.find(pa.array(texts, pa.string())), most)
    for i, t in enumerate(texts):
        got = np.sort(sums[first[i] : first[i + 1]])
        want = sorted(zlib.crc32(r.encode()) for r in runs(words_of(t), most))
        assert got.tolist() == want
