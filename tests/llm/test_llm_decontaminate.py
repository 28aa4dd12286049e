"""Benchmark passages in documents against brute force."""

import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm import byte_words, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def windows_of(items, size=10):
    found = {}
    for item, text in items:
        words = WORD.findall(low(text))
        n = min(size, len(words))
        for i in range(len(words) - n + 1) if n else ():
            found.setdefault(tuple(words[i : i + n]), set()).add(item)
    return found


def brute(text, windows):
    """Number of words, stretches of hit words in the text, and items."""
    places = [m.span() for m in WORD.finditer(low(text))]
    words = WORD.findall(low(text))
    hit, items = set(), set()
    for i in range(len(words)):
        for n in {len(w) for w in windows}:
            found = windows.get(tuple(words[i : i + n])) if i + n <= len(words) else None
            if found is not None:
                hit |= set(range(i, i + n))
                items |= {str(x) for x in found if x is not None}
    spans = []
    for i in sorted(hit):
        if i - 1 in hit:
            spans[-1][1] = places[i][1]
        else:
            spans.append(list(places[i]))
    return len(words), len(hit), sorted(items), [tuple(s) for s in spans]


def result(r):
    return r.n_words, r.n_hit, list(r["items"]), [tuple(s) for s in r.spans]


def check(docs, benchmark, items, size=10, **more):
    windows = windows_of(items, size)
    want = sorted(repr((r.doc_id, brute(r.text, windows))) for r in docs.collect())
    got = decontaminate.find(docs, benchmark, size, **more).collect()
    assert sorted(repr((r.doc_id, result(r))) for r in got) == want


ITEMS = [
    (1, "Plain words here and a few of them"),
    (2, "word3 AND a few of them. Word3"),
    (2, "two spaces"),
    (3, ""),
    (4, None),
    (5, " .,! "),
    (None, "nul"),
    (6, "ÀÉ é"),
    (7, "a few of them " * 30),
    (8, "123 456"),
    (8, "123 456"),
]


@pytest.mark.parametrize("part_bytes", [4 << 20, 200])
@pytest.mark.parametrize("size", [1, 3, 10])
def test_odd_tables(spark, odd_docs, no_docs, saved, monkeypatch, part_bytes, size):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part_bytes)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    check(odd_docs.filter("length(text) < 1000 or text is null"), benchmark, ITEMS, size)
    assert decontaminate.find(no_docs, benchmark).collect() == []


def test_long_text_and_empty_benchmark(spark, odd_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.find(odd_docs, nothing).collect()} == {0}
    item = [(9, "of them. Word%d and a few")]
    benchmark = spark.createDataFrame(item, "item_id long, text string")
    long = odd_docs.filter("length(text) > 1000")
    (found,) = decontaminate.find(long, benchmark).collect()
    # Seven words a sentence; the first one's five and the last one's two are in no passage.
    n = 20_000
    assert found.n_words == 7 * n and found.n_hit == 7 * (n - 1) and list(found["items"]) == ["9"]
    assert [tuple(s) for s in found.spans] == [(17, 26 * (n - 1) + 16)]


def test_questions_and_answers(spark):
    docs = spark.createDataFrame([(1, "x what is it y"), (2, "a thing"), (3, "what is")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(5, "What is it?", "A thing.")], "item_id long, question string, answer string")
    found = decontaminate.find(docs, benchmark, item_texts=("question", "answer")).collect()
    assert {(r.doc_id, tuple(r["items"])) for r in found} == {(1, ("5",)), (2, ("5",)), (3, ())}


words = st.lists(st.sampled_from(["a", "B", "ab", "é", "1", "日"]), max_size=14)
seps = st.sampled_from([" ", "  ", ", ", "\n", "-"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, seps), max_size=4), st.lists(st.tuples(words, seps), max_size=4))
def test_scanner_against_brute_force(texts, items):
    texts = [sep.join(w) for w, sep in texts]
    items = [(str(i), sep.join(w)) for i, (w, sep) in enumerate(items)]
    windows = windows_of(items, 3)
    listed = [(" " + " ".join(w) + " ", len(w), i) for w, names in windows.items() for i in names]
    spelled = [(w.encode().decode("latin-1"), n, i) for w, n, i in listed]
    n_words, runs, found = decontaminate.Scanner(spelled).scan(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        spans = [(r["start"], r["end"]) for r in runs[i]]
        n_hit = sum(r["last"] - r["first"] + 1 for r in runs[i])
        assert (n_words[i], n_hit, found[i], spans) == brute(text, windows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=5))
def test_words_by_byte(texts):
    words = byte_words.find(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        span = range(words.first[i], words.first[i + 1])
        got = [words.data[words.starts[j] : words.ends[j]].tobytes().decode() for j in span]
        assert got == WORD.findall(low(text))


def test_runs_that_touch_are_one():
    runs = [(5, 7, 50, 70), (0, 2, 0, 20), (3, 3, 22, 30), (6, 6, 55, 60), (10, 11, 90, 99)]
    assert decontaminate.merged_runs(runs) == [(0, 3, 0, 30), (5, 7, 50, 70), (10, 11, 90, 99)]
