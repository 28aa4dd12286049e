"""Passages of benchmark items in documents, by one Aho-Corasick automaton over item windows.

Questions and answers are normalised to words with one space between them, and every run of so many
words (a window) goes into the automaton; an item of fewer words is one window. A text is
normalised alike and scanned once, whatever the number of windows. Hits are turned into
words, and words into places of the original text.

The automaton lives in each worker, so its windows are bounded by PART_BYTES. A benchmark with more
of them is cut into parts by a hash; the texts are then scanned once per part, and
the hits of all parts are put together. Either way every window is looked for in every text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import byte_words
from forecourt.llm.arrow_words import held, slices
from forecourt.llm.frames import column
from forecourt.staging import stage

PART_BYTES = 4 << 20  # of windows and item identifiers in one automaton
WINDOW_BYTES = 64  # what a window costs beside its letters

_RUN = "first: long, last: long, start: long, end: long"
_FOUND = f"n_words long, runs array<struct<{_RUN}>>, items array<string>"
_BREAK = 0x0A  # stands before each text; no window has it


def _spelled(words: byte_words.Words) -> tuple[str, np.ndarray]:
    """All texts as words with one space around each, and where the space after each word is.

    Bytes stand for characters. A text begins with a mark that no window has.
    """
    keep = words.data != byte_words.SPACE
    keep[1:] |= keep[:-1].copy()
    marked = words.data.copy()
    marked[words.texts] = _BREAK
    keep[words.texts] = keep[words.texts + 1] = True
    text = np.repeat(np.arange(len(words.texts)), np.diff(words.first))
    after = np.cumsum(words.ends - words.starts + 1) - 1 + 2 * (text + 1)
    return marked[keep].tobytes().decode("latin-1"), after


def item_windows(
    items: DataFrame, item: str, texts: Sequence[str], size: int
) -> DataFrame:
    """Distinct (window, size, item) of all texts of all items; the window as one letter per byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = byte_words.find(part["text"])
                spelled, after = _spelled(words)
                found = []
                for row, name in enumerate(part["item"].to_pylist()):
                    a, b = words.first[row], words.first[row + 1]
                    n = min(size, b - a)
                    for last in range(a + n - 1, b) if n else ():
                        before = last - n
                        start = after[before] if before >= a else after[a] - (words.ends[a] - words.starts[a]) - 1
                        found.append((spelled[start : after[last] + 1], n, name))
                columns = zip(*found, strict=True) if found else ([], [], [])
                kinds = (pa.string(), pa.int32(), pa.string())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.record_batch(arrays, ["window", "size", "item"])

    parts = [
        items.select(
            column(items, item).cast("string").alias("item"),
            column(items, t).cast("string").alias("text"),
        ).filter("text is not null")
        for t in texts
    ]
    slim = parts[0]
    for part in parts[1:]:
        slim = slim.unionByName(part)
    return slim.mapInArrow(run, "window string, size int, item string").distinct()


class Scanner:
    """The automaton of some windows."""

    def __init__(self, windows: Sequence[tuple[str, int, str | None]]):
        self.size: list[int] = []
        self.items: list[set[str]] = []
        number: dict[str, int] = {}
        for window, size, item in windows:
            i = number.setdefault(window, len(number))
            if i == len(self.size):
                self.size.append(size)
                self.items.append(set())
            if item is not None:
                self.items[i].add(item)
        self.sizes = np.array(self.size, np.int64)
        self.automaton = ahocorasick.Automaton()
        for window, i in number.items():
            self.automaton.add_word(window, i)
        if number:
            self.automaton.make_automaton()

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]], list[list[str]]]:
        """Number of words, runs of hit words and items, of each text."""
        words = byte_words.find(texts)
        n = len(texts)
        runs: list[list[dict]] = [[] for _ in range(n)]
        items: list[list[str]] = [[] for _ in range(n)]
        n_words = np.diff(words.first)
        if not self.size or not len(words.starts):
            return n_words, runs, items
        spelled, after = _spelled(words)
        hits = np.array(list(self.automaton.iter(spelled)), np.int64).reshape(-1, 2)
        if not len(hits):
            return n_words, runs, items
        last = np.searchsorted(after, hits[:, 0])
        text = np.searchsorted(words.first, last, side="right") - 1
        for t, i in np.unique(np.stack([text, hits[:, 1]], axis=1), axis=0).tolist():
            items[t].append(i)
        for t in np.unique(text).tolist():
            items[t] = sorted(set().union(*(self.items[i] for i in items[t])))
        cover = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(cover, last - self.sizes[hits[:, 1]] + 1, 1)
        np.add.at(cover, last + 1, -1)
        hit = cover[:-1].cumsum() > 0
        begins = hit.copy()
        begins[1:] &= ~hit[:-1]
        heads = words.first[:-1][n_words > 0]
        begins[heads] = hit[heads]
        closes = hit.copy()
        closes[:-1] &= ~hit[1:] | begins[1:]
        first, final = np.flatnonzero(begins), np.flatnonzero(closes)
        text = np.searchsorted(words.first, first, side="right") - 1
        # Characters begin at bytes that continue none.
        characters = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])
        origin = characters[words.texts[text] + 2]
        columns = (
            text,
            first - words.first[text],
            final - words.first[text],
            characters[words.starts[first]] - origin,
            characters[words.ends[final]] - origin,
        )
        for t, a, b, start, end in zip(*(c.tolist() for c in columns), strict=True):
            runs[t].append({"first": a, "last": b, "start": start, "end": end})
        return n_words, runs, items


def _scanned(spark: SparkSession, rows: DataFrame, windows: list) -> DataFrame:
    """`rows` (with a column `text`) with what `windows` hit in place of the text."""
    shared = spark.sparkContext.broadcast(windows)
    name = ("windows", uuid.uuid4().hex)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    run_type = pa.struct([(f, pa.int64()) for f in ("first", "last", "start", "end")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = held(name, lambda: Scanner(shared.value))
        for batch in batches:
            for part in slices(batch, "text"):
                n_words, runs, items = scanner.scan(part["text"])
                found = {f.name: part[f.name] for f in kept}
                found["n_words"] = pa.array(n_words, pa.int64())
                found["runs"] = pa.array(runs, pa.list_(run_type))
                found["items"] = pa.array(items, pa.list_(pa.string()))
                yield pa.record_batch(found)

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), _FOUND])
    return rows.mapInArrow(run, schema)


def merged_runs(runs: list[tuple]) -> list[tuple]:
    """Runs of words (first, last, start, end) in order, those that touch made one."""
    found: list[tuple] = []
    for first, last, start, end in sorted(map(tuple, runs)):
        if found and first <= found[-1][1] + 1:
            first, before, start, stop = found.pop()
            last, end = max((before, stop), (last, end))
        found.append((first, last, start, end))
    return found


def find(
    df: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_texts: Sequence[str] = ("text",),
) -> DataFrame:
    """key, n_words, n_hit, `items` and `spans` of each row of `df`.

    `items` are the identifiers, as sorted strings, of items of which a window occurs; `spans` are
    the stretches of hit words as (start, end) in characters of the original text, end excluded.
    Null and empty texts, and texts without words, have no words and no hits; so have all texts if
    the benchmark is empty. Items without words hit nothing. An item without identifier hits words
    but is in no list. Repeated rows of `df` each give a row; rows that repeat an identifier in the
    benchmark are one item with the windows of all of them. A very long text is scanned whole, and needs some
    twenty times its size in its worker. Other columns play no part, whatever their names.
    """
    spark = df.sparkSession
    windows = stage(item_windows(benchmark, item, item_texts, size), "windows")
    cost = f"length(window) + coalesce(length(item), 0) + {WINDOW_BYTES}"
    total = windows.select(F.sum(F.expr(cost))).first()[0] or 0
    slim = df.select(
        column(df, key).alias("key"), F.coalesce(column(df, text).cast("string"), F.lit("")).alias("text")
    )
    if total <= PART_BYTES:
        found = _scanned(spark, slim, [tuple(r) for r in windows.collect()])
    else:
        found = _in_parts(spark, slim, windows, -(-total // PART_BYTES))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    spans = F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    return found.select(F.col("key").alias(key), "n_words", n_hit.alias("n_hit"), "items", spans.alias("spans"))


def _in_parts(spark: SparkSession, slim: DataFrame, windows: DataFrame, parts: int) -> DataFrame:
    """What all parts of the windows hit; a part is scanned before the next one is loaded."""
    rows = stage(slim, "texts").select(
        "key", "text", F.struct("_metadata.file_path", "_metadata.row_index").alias("at")
    )
    part = F.pmod(F.xxhash64("window", "item"), F.lit(parts))
    hits = None
    for i in range(parts):
        some = [tuple(r) for r in windows.filter(part == i).collect()]
        found = _scanned(spark, rows.drop("key"), some).filter("size(runs) > 0").drop("n_words")
        found = stage(found, "window-hits")
        hits = found if hits is None else hits.unionByName(found)
    joined = F.udf(lambda runs: merged_runs(runs), f"array<struct<{_RUN}>>")
    together = hits.groupBy("at").agg(
        joined(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    counted = _scanned(spark, rows, []).drop("runs", "items")
    empty = {"runs": f"array<struct<{_RUN}>>", "items": "array<string>"}
    return counted.join(together, "at", "left").select(
        "key", "n_words", *[F.coalesce(c, F.array().cast(t)).alias(c) for c, t in empty.items()]
    )
