"""SimHash near duplicates against brute force."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from forecourt.llm import simhash
from forecourt.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    shingles = shingles or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, radius=2):
    """The smallest position reachable from each value."""
    least = np.arange(len(values))
    values = np.array(values, np.uint64)
    while True:
        new = least.copy()
        for i, v in enumerate(values):
            near = np.bitwise_count(v ^ values) <= radius
            new[near] = np.minimum(new[near], least[near].min())
        if (new == least).all():
            return least.tolist()
        least = new


def check(df):
    rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r[0] is None, r[0]))
    found = simhash.near_duplicates(df).collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    least = brute_groups(prints)
    want = sorted(str((r.doc_id, p, rows[i].doc_id)) for r, p, i in zip(rows, prints, least))
    assert sorted(str((r.key, r.fp % (1 << 64), r.component)) for r in found) == want


def test_documents_against_brute_force(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_tables(odd_docs, no_docs, spark, monkeypatch):
    check(odd_docs.filter("length(text) < 1000 or text is null"))
    assert simhash.near_duplicates(no_docs).collect() == []
    nulls = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")
    assert [r.component for r in simhash.near_duplicates(nulls).collect()] == [None, None]


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = " ".join(f"W{i % 50} x" for i in range(500)) + "\n"
    whole = simhash.fingerprint(text.encode(), 3)
    assert whole == brute_fingerprint(text)
    for words in (1, 2, 3, 7, 999, 1000):
        monkeypatch.setattr(simhash, "WORDS", words)
        assert simhash.fingerprint(text.encode(), 3) == whole
        assert simhash.fingerprint(b" a B ", 3) == brute_fingerprint("a b")


def clustered(rng, n):
    """Chains of values that lie one or two bits from the one before."""
    found = []
    for _ in range(n):
        v = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 12))):
            found.append(v)
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                v ^= 1 << int(b)
    return list(dict.fromkeys(found))


def test_no_link_is_missed_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 3)
    monkeypatch.setattr(simhash, "ROWS", 2)
    rng = np.random.default_rng(5)
    values = clustered(rng, 60) + [0, 1, 3, (1 << 64) - 1, (1 << 64) - 2]
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = dict(components(simhash.links(df, 2)).collect())
    groups, want = {}, {}
    for v, i in zip(signed, brute_groups(values)):
        groups.setdefault(roots.get(v, v), set()).add(v)
        want.setdefault(i, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 200)]
    df = spark.createDataFrame(edges + edges[:5], "u long, v long")
    got = dict(components(df).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}
    assert components(df.filter(F.lit(False))).collect() == []
