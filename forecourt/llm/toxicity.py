"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

A text's features are its distinct words and the beginnings of its words, hashed. One weight
per feature is shared by all ordered thresholds: P(grade > k) = sigmoid(w.x - t_k) with rising t_k.
The expected severity is the sum of these probabilities.

The model is fitted on the driver from a bounded sample of labelled rows, of which only
hashed features are collected; every text is scored whole.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.arrow_words import Recent, encoded, held, slices
from forecourt.llm.frames import column, text_or_empty

SAMPLE_ROWS = 12_000  # labelled rows the model is fitted on, about
SLICE = 2 << 20  # bytes of text at once; each word has several features
SAMPLE_FEATURES = 4_000  # of one sampled row; longer ones are not learned from
BUCKETS = 1 << 20
PREFIXES = (3, 4, 5, 6)
MIN_ROWS = 5  # that hold a feature
MIN_Z = 4.5  # standard errors by which a feature must be more frequent above grade 0
MARK_Z = 8.0
MAX_FEATURES = 50_000
STEPS = 400
RATE = 0.05
RIDGE = 1e-5

_WORD = re.compile(r"\w+")


def features(word: str) -> list[int]:
    """Hashed features of a stretch without white space, in lower case."""
    names = set()
    for part in _WORD.findall(word):
        names.add(f"{part}$")
        names.update(part[:n] for n in PREFIXES if len(part) >= n)
    return sorted(zlib.crc32(n.encode()) % BUCKETS for n in names)


@dataclass(frozen=True)
class Model:
    """Feature buckets in rising order, their weights, and the rising thresholds."""

    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


class Reader:
    """Features of texts, by word of an Arrow slice; only those in `buckets` if given."""

    def __init__(self, buckets: np.ndarray | None = None):
        self.known = None if buckets is None else {int(b): i for i, b in enumerate(buckets)}
        self.words = Recent(self._new)

    def _new(self, words: list[str]) -> list[bytes]:
        found = map(features, words)
        if self.known is not None:
            found = ([self.known[b] for b in x if b in self.known] for x in found)
        return [np.array(x, np.int32).tobytes() if x else b"" for x in found]

    def pairs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Row number and feature of each distinct feature of each text, in this order."""
        offsets, words, distinct = encoded(pc.utf8_split_whitespace(pc.utf8_lower(texts)))
        answers = self.words.answers(distinct)
        sizes = np.fromiter(map(len, answers), np.int64, len(answers)) // 4
        starts = np.cumsum(sizes) - sizes
        values = np.frombuffer(b"".join(answers), np.int32)
        rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
        held = sizes[words] > 0
        rows, words = rows[held], words[held]
        n = sizes[words]
        at = np.repeat(starts[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.unique(np.repeat(rows, n) * BUCKETS + values[at])
        return both // BUCKETS, both % BUCKETS


def sample(labelled: DataFrame, docs: DataFrame, key: str, text: str, rows: int) -> DataFrame:
    """grade and hashed features of about `rows` labelled texts, chosen by a hash of their key."""
    total = labelled.count()
    share = min(1.0, rows / max(total, 1))
    chosen = labelled.filter(F.crc32(F.col("key").cast("string")) < share * 2**32).limit(2 * rows)
    # The sample has a bounded number of rows and goes to the texts.
    slim = docs.select(column(docs, key).alias("key"), text_or_empty(docs, text).alias("text"))
    texts = slim.join(F.broadcast(chosen), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                row, feature = reader.pairs(part["text"])
                ends = np.cumsum(np.bincount(row, minlength=part.num_rows))
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(feature.astype(np.int32))
                )
                found = {"key": part["key"], "grade": part["grade"], "features": lists}
                yield pa.record_batch(found)

    kind = texts.schema["key"].dataType.simpleString()
    held = texts.mapInArrow(run, f"key {kind}, grade int, features array<int>")
    # One row per key, however often the key comes with other texts.
    held = held.filter(F.size("features") <= SAMPLE_FEATURES).groupBy("key")
    return held.agg(F.min("grade").alias("grade"), F.min("features").alias("features")).drop("key")


def graded(labels: DataFrame, key: str = "doc_id", grade: str = "toxic") -> DataFrame:
    """key and whole-number grade per labelled key; the highest where a key repeats.

    Rows without key or grade are left out.
    """
    return (
        labels.select(column(labels, key).alias("key"), column(labels, grade).cast("int").alias("g"))
        .filter("key is not null and g is not null")
        .groupBy("key")
        .agg(F.max("g").alias("grade"))
    )


def fit(
    labelled: DataFrame,
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """A model of labelled keys (key, grade from 0 up) and their texts.

    Where labels only tell two grades, the upper one is split: rows with more marked features
    than the median row of that grade get one grade more. Without two grades in the sample, the model gives every text a severity near zero.
    """
    table = sample(labelled, docs, key, text, sample_rows).toArrow()
    table = table.combine_chunks()
    grades = table["grade"].to_numpy().astype(np.int64)
    lists = table["features"].combine_chunks() if len(grades) else None
    if lists is None or grades.max() <= 0 or grades.min() > 0:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.array([20.0]))
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.flatten().to_numpy()
    rows = np.repeat(np.arange(len(grades), dtype=np.int32), np.diff(offsets))
    # The rows of a sample come in no order of their own; put them into one.
    order = np.lexsort([_checks(rows, values, len(grades)), grades])
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    rows, grades = place[rows], grades[order]
    z = _z(rows, values, grades)
    if len(np.unique(grades)) == 2:
        grades = _split(rows, values, grades, z)
    return _regress(rows, values, grades, z)


def _checks(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """A number per row that depends on its set of features only."""
    found, some = np.zeros(n), 1 << 20
    for at in range(0, len(rows), some):
        part = values[at : at + some] % 65_521
        found += np.bincount(rows[at : at + some], weights=part, minlength=n)
    return found


def _z(rows: np.ndarray, values: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """How many standard errors more of the rows above grade 0 hold each feature than of the others."""
    upper = grades > 0
    n1, n0 = upper.sum(), (~upper).sum()
    c1 = np.bincount(values[upper[rows]], minlength=BUCKETS)
    c0 = np.bincount(values[~upper[rows]], minlength=BUCKETS)
    share = (c1 + c0 + 1) / (n1 + n0 + 2)
    error = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    return np.where(c1 + c0 >= MIN_ROWS, (c1 / n1 - c0 / n0) / error, 0.0)


def _split(rows: np.ndarray, values: np.ndarray, grades: np.ndarray, z: np.ndarray) -> np.ndarray:
    n = len(grades)
    marked = np.bincount(rows[(z >= MARK_Z)[values]], minlength=n)
    upper = grades > 0
    return upper.astype(np.int64) + (upper & (marked > np.median(marked[upper])))


def _regress(rows: np.ndarray, values: np.ndarray, grades: np.ndarray, z: np.ndarray) -> Model:
    """Weights and thresholds of highest likelihood, less a ridge, by Adam on all sampled rows.

    Weights are not negative: no amount of other text makes up for a toxic passage.
    """
    picked = np.flatnonzero(z >= MIN_Z)
    if len(picked) > MAX_FEATURES:
        picked = np.sort(picked[np.argsort(-z[picked], kind="stable")[:MAX_FEATURES]])
    index = np.full(BUCKETS, -1, np.int32)
    index[picked] = np.arange(len(picked))
    held = (index >= 0)[values]
    rows, feature = rows[held], index[values[held]]
    n, top = len(grades), int(grades.max())
    above = grades[:, None] > np.arange(top)  # a row's grade lies above each threshold, or not

    # First threshold, logarithms of the gaps to the next ones, then the weights.
    share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    start = -np.log(share / (1 - share))
    x = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1)), np.zeros(len(picked))])
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        gaps = np.exp(x[1:top])
        t = x[0] + np.concatenate([[0], np.cumsum(gaps)])
        w = x[top:]
        score = np.bincount(rows, weights=w[feature], minlength=n)
        p = 1 / (1 + np.exp(np.clip(t - score[:, None], -30, 30)))  # of lying above
        d_t, d_score = _gradient(p, above, grades, top)
        later = np.cumsum(d_t[::-1])[::-1]
        slope = np.concatenate(
            [
                later[:1],
                gaps * later[1:],
                np.bincount(feature, weights=d_score[rows], minlength=len(picked)),
            ]
        )
        slope = slope / n
        slope[top:] += RIDGE * w
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        rate = RATE / (1 + 10 * step / STEPS)
        x -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        np.maximum(x[top:], 0, out=x[top:])
    thresholds = x[0] + np.concatenate([[0], np.cumsum(np.exp(x[1:top]))])
    return Model(picked, x[top:], thresholds)


def _gradient(
    p: np.ndarray, above: np.ndarray, grades: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the negative log likelihood by threshold (summed) and by row's score.

    A row of grade g has probability p[g - 1] - p[g], with p[-1] = 1 and p[top] = 0.
    """
    n = len(grades)
    padded = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
    at = np.arange(n)
    upper, lower = padded[at, grades], padded[at, grades + 1]
    chance = np.maximum(upper - lower, 1e-12)
    d_upper, d_lower = upper * (1 - upper), lower * (1 - lower)
    d_score = -(d_upper - d_lower) / chance
    d_t = np.zeros(top)
    has = grades > 0
    np.add.at(d_t, grades[has] - 1, (d_upper / chance)[has])
    has = grades < top
    np.add.at(d_t, grades[has], (-d_lower / chance)[has])
    return d_t, d_score


def predictor(spark: SparkSession, model: Model):
    """A function of a text column to struct(severity, chance, grade).

    `severity` is the expected grade, `chance` that of a grade above 0, `grade` the highest grade that is
    reached with a chance of one half or more. Null and empty texts are scored as empty, a very long
    one whole.
    """
    shared = spark.sparkContext.broadcast(model)
    name = ("toxicity", uuid.uuid4().hex)

    @F.arrow_udf("severity double, chance double, grade int")
    def predict(texts: pa.Array) -> pa.Array:
        fitted = shared.value
        reader = held(name, lambda: Reader(fitted.buckets))
        chances = [np.zeros((0, len(fitted.thresholds)))]
        for part in slices(pa.record_batch({"text": pc.fill_null(texts, "")}), "text", SLICE):
            row, feature = reader.pairs(part["text"])
            score = np.bincount(row, weights=fitted.weights[feature], minlength=part.num_rows)
            gap = np.clip(fitted.thresholds - score[:, None], -30, 30)
            chances.append(1 / (1 + np.exp(gap)))
        chance = np.concatenate(chances)
        columns = [
            pa.array(chance.sum(axis=1)),
            pa.array(chance[:, 0]),
            pa.array((chance >= 0.5).sum(axis=1).astype(np.int32)),
        ]
        return pa.StructArray.from_arrays(columns, ["severity", "chance", "grade"])

    return predict
