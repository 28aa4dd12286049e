"""Documents like a target collection: importance weights, and an exact draw of the highest scores.

Every run of words is a feature and falls into a hashed bucket. A text's buckets are kept as an
array; its weight is the sum of the buckets' gains, looked up in an array of all gains. Noise by a hash of
the identifier makes the highest scores a draw without replacement.

The score of the last row drawn is found by weighted median of medians: each partition gives the
median of its keys that are still open and their number, the median of these medians by weight
is the pivot, and at least a quarter of the open keys lies on the side that cannot hold the cutoff.
The driver sees one row per partition and round. Winners are then sorted by range; the ranges' bounds
are chosen by weight in the same way, from evenly spaced rows of each partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from forecourt.llm import byte_words
from forecourt.llm.arrow_words import slices
from forecourt.llm.frames import column
from forecourt.staging import stage

MOST_BUCKETS = 1 << 20
SPREAD = 100  # rows of a partition that stand for all, where ranges are chosen
RANGES = 4  # per shuffle partition

Key = tuple[int, ...]


def features(df: DataFrame, key: str | None, text: str, buckets: int, most: int) -> DataFrame:
    """key (if named), n_words, n_features, and `buckets`: the bucket of every feature, as bytes.

    Features are the runs of 1 to `most` consecutive words, repeats included.
    """
    if not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"from 1 to {MOST_BUCKETS} buckets")
    kind = _number(buckets)
    keyed = key is not None
    named = [column(df, key).cast("long").alias("key")] if keyed else []
    slim = df.select(*named, F.coalesce(column(df, text).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = byte_words.find(part["text"])
                sums, first = byte_words.run_sums(words, most)
                places = (sums % np.uint32(buckets)).astype(kind)
                at = pa.array((first * kind.itemsize).astype(np.int64))
                found = {"key": part["key"]} if keyed else {}
                found |= {
                    "n_words": np.diff(words.first),
                    "n_features": np.diff(first),
                    "buckets": pa.Array.from_buffers(
                        pa.large_binary(), len(part), [None, at.buffers()[1], pa.py_buffer(places.tobytes())]
                    ).cast(pa.binary()),
                }
                yield pa.record_batch(found)

    schema = "key long, " * keyed + "n_words long, n_features long, buckets binary"
    return slim.mapInArrow(run, schema)


def _number(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def _flat(lists: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch, and where each row's begin; no nulls."""
    if not len(lists):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    at = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]
    data = lists.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return flat.view(kind), (at.astype(np.int64) - at[0]) // kind.itemsize


def bucket_counts(featured: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds; tasks add theirs up before the shuffle."""
    kind = _number(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            flat, _ = _flat(batch["buckets"], kind)
            total += np.bincount(flat, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch({"bucket": some, "n": total[some]})

    counted = featured.select("buckets").mapInArrow(run, "bucket long, n long")
    found = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        found[bucket] = n
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths: the logarithm of how much likelier it is in the target."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float((b + 1) * (s + n)) / float((a + 1) * (t + n))))
            for a, b in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighed(featured: DataFrame, each: np.ndarray, seed: int) -> DataFrame:
    """`featured` with `weight` and `score` in place of the buckets."""
    shared = featured.sparkSession.sparkContext.broadcast(each)
    kind = _number(len(each))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = _flat(batch["buckets"], kind)
            upto = np.concatenate([[0], np.cumsum(shared.value[flat])])
            kept = {c: batch[c] for c in ("key", "n_words", "n_features")}
            yield pa.record_batch(kept | {"weight": upto[at[1:]] - upto[at[:-1]]})

    rows = featured.mapInArrow(run, "key long, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + noise(F.col("key"), seed))


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, by a hash of the seed and the key; a null key is spelled empty."""
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(spelled, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _compared(columns: list[np.ndarray], key: Key) -> np.ndarray:
    """-1, 0 or 1: whether each row is below, at or above the key, column by column."""
    found = np.zeros(len(columns[0]), np.int8)
    for values, one in zip(columns, key, strict=True):
        found = np.where(found, found, (values > one).astype(np.int8) - (values < one))
    return found


def _median(columns: list[np.ndarray]) -> list[int] | None:
    """The lower median of the rows, in order of all columns."""
    n = len(columns[0])
    if not n:
        return None
    at = np.lexsort(columns[::-1])[(n - 1) // 2]
    return [int(c[at]) for c in columns]


def _side(rows: DataFrame, low: Key | None, pivot: Key | None, high: Key | None) -> DataFrame:
    """Per partition, of keys between low and high: numbers and medians of those below and above the
    pivot, and the number of those at it."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            columns = [batch[c].to_numpy() for c in names]
            inside = np.ones(batch.num_rows, bool)
            if low:
                inside &= _compared(columns, low) > 0
            if high:
                inside &= _compared(columns, high) < 0
            parts.append([c[inside] for c in columns])
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(names)
        if not len(columns[0]):
            return
        where = _compared(columns, pivot) if pivot else np.full(len(columns[0]), -1)
        below, above = ([c[where == s] for c in columns] for s in (-1, 1))
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "n_below": len(below[0]),
                    "n_at": int((where == 0).sum()),
                    "n_above": len(above[0]),
                    "below": _median(below),
                    "above": _median(above),
                }
            ],
            pa.schema(
                [(c, pa.int64()) for c in ("n_below", "n_at", "n_above")]
                + [(c, pa.list_(pa.int64())) for c in ("below", "above")]
            ),
        )

    schema = "n_below long, n_at long, n_above long, below array<long>, above array<long>"
    return rows.mapInArrow(run, schema)


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The first median, in order, at which half of all weight is reached."""
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no medians")


def cutoff(rows: DataFrame, k: int) -> Key:
    """The k-th smallest row (from 1) of a frame of whole numbers without nulls, column by column.

    `rows` should be read from files, as each round reads it again.
    """
    low = pivot = high = None
    while True:
        first = rows.columns[0]
        open_ = rows
        if low:
            open_ = open_.filter(F.col(first) >= low[0])
        if high:
            open_ = open_.filter(F.col(first) <= high[0])
        parts = _side(open_, low, pivot, high).collect()
        below, at, above = (sum(p[c] for p in parts) for c in ("n_below", "n_at", "n_above"))
        if not 1 <= k <= below + at + above:
            raise ValueError("there are not so many rows")
        if pivot and below < k <= below + at:
            return pivot
        side = "below" if k <= below else "above"
        if pivot:
            low, high = (low, pivot) if side == "below" else (pivot, high)
            k -= 0 if side == "below" else below + at
        pivot = weighted_median([(tuple(p[side]), p[f"n_{side}"]) for p in parts if p[side]])


ORDER = ("o_score", "o_null", "o_key", "o_features")


def ordered(rows: DataFrame) -> DataFrame:
    """`rows` with the columns that order a draw: highest score first, then smaller key, null last."""
    return rows.withColumns(
        {
            "o_score": -F.col("score"),
            "o_null": F.col("key").isNull().cast("long"),
            "o_key": F.coalesce("key", F.lit(0)),
            "o_features": F.col("n_features"),
        }
    )


def _spread(rows: DataFrame) -> DataFrame:
    """Per partition, up to SPREAD of its rows at even distances in order, with how many each stands for."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch[c].to_numpy() for c in names] for batch in batches]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        if not columns or not len(columns[0]):
            return
        ends = np.unique(-(-np.arange(1, SPREAD + 1) * len(columns[0]) // SPREAD))
        at = np.lexsort(columns[::-1])[ends - 1]
        chosen = {c: v[at] for c, v in zip(names, columns, strict=True)}
        yield pa.record_batch(chosen | {"n": np.diff(ends, prepend=0)})

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"]))


def bounds(rows: DataFrame, ranges: int) -> list[Key]:
    """Last rows of all but the last of some `ranges` ranges of about as many rows each, in order of all columns.

    The driver sees SPREAD rows per partition at most.
    """
    found = sorted(tuple(r) for r in _spread(rows).collect())
    upto = np.cumsum([r[-1] for r in found])
    wanted = np.arange(1, ranges) * (upto[-1] / ranges) if found else []
    return [found[i][:-1] for i in np.unique(np.searchsorted(upto, wanted)) if i < len(found) - 1]


def parted(rows: DataFrame, by: list[str], ends: list[Key]) -> DataFrame:
    """`rows` with `part`, the number of `ends` below the row in order of the columns `by`."""
    shared = rows.sparkSession.sparkContext.broadcast(np.array(ends, np.int64).reshape(-1, len(by)).T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.concatenate([batch[c].to_numpy(), e]) for c, e in zip(by, shared.value, strict=True)]
            order = np.lexsort(columns[::-1])  # a row comes before an end equal to it
            part = np.empty(len(order), np.int64)
            part[order] = np.cumsum(order >= batch.num_rows)
            yield batch.append_column("part", pa.array(part[: batch.num_rows]))

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("part", LongType())]))


def numbered(rows: DataFrame) -> DataFrame:
    """`rows` (read from files) with their `rank` from 1 in ORDER: cut into ranges, sorted and counted per range.

    The ranges' bounds are fixed beforehand, so that rows need not be written to keep their range.
    """
    by = [*ORDER, "tie"]
    rows = rows.withColumn("tie", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    ranges = RANGES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = parted(rows, by, bounds(rows.select(*by), ranges))
    before = Window.orderBy("part")  # over one row per range
    offsets = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", (F.sum("n").over(before) - F.col("n")).alias("earlier")
    )
    within = Window.partitionBy("part").orderBy(*by)
    return (
        ranged.join(F.broadcast(offsets), "part")
        .withColumn("rank", F.col("earlier") + F.row_number().over(within))
        .drop("part", "earlier", "tie")
    )


def resample(
    df: DataFrame,
    target: DataFrame,
    percent: int = 10,
    buckets: int = 10_000,
    most: int = 1,
    min_words: int = 20,
    seed: int = 2024,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """key, n_words, n_features, weight, score and rank of every row of `df`.

    Of the N rows with `min_words` words, the `percent` * N / 100 (rounded down) with the highest scores
    are drawn and ranked from 1, ties to smaller keys, a null key last; other rows have a null
    rank. Rows that share key, weight and features are alike, so it does not matter which of
    them is drawn. `key` must be a whole number. Null and empty texts have no features and weigh 0.
    Without target texts all gains follow from the source alone. An empty `df` gives no rows. A long
    text is one array of buckets. Other columns play no part, whatever their names.
    """
    featured = stage(features(df, key, text, buckets, most), "features")
    source = bucket_counts(featured, buckets)
    wanted = bucket_counts(features(target, None, text, buckets, most), buckets)
    scored = stage(ordered(weighed(featured, gains(source, wanted), seed)), "scored")
    able = F.col("n_words") >= min_words
    k = scored.filter(able).count() * percent // 100
    shown = [F.col("key").alias(key), "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*shown, none)
    last = cutoff(scored.filter(able).select(*ORDER), k)
    upto = F.struct(*ORDER) <= F.struct(*[F.lit(x).cast("long") for x in last])
    ranks = numbered(scored.filter(able & upto))
    drawn = ranks.select(*shown, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
    return drawn.unionByName(scored.filter(~(able & upto)).select(*shown, none))
