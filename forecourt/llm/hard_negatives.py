"""Hard negatives by a secondary-sort shuffle of scored pairs.

Anchors are a stated set of rows and meet all rows in blocks: a task holds a block of rows and streams
all anchors past it, read from the shared folder. What a block cannot win is not sent: of an anchor's same-label
rows its block's best few, and of the others the best few in each positive's window of scores.

The pairs that are sent are packed into keys (anchor, descending score, kind, identifier). They
are partitioned by anchor and sorted within partitions, so an iterator sees an anchor's pairs from
the highest score down: a positive opens a window, rows of other labels that fall into open
windows are emitted until these are full. No anchor's pairs are held; at most `positives` windows are open.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.frames import column
from forecourt.llm.warc import open_store
from forecourt.staging import new_path, stage

BLOCK_VALUES = 4 << 20  # components of a block, and scores of a tile
ANCHORS = 4096  # read at once
POSITIVE, NEGATIVE = 0, 1
NONE = np.iinfo(np.int64).min
MIDDLE = 1 << 63

KEY = struct.Struct(">QQBBQ")  # anchor, descending score, kind, identifier is null, identifier
_PACKED = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("null", "u1"), ("id", ">u8")])


def taking_part(df: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """id, label and v, the floor of scale times each component, of rows that take part.

    Rows with a null label, a null vector, or a null, infinite or undefined component do not.
    """
    rows = df.select(
        column(df, key).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.transform(column(df, vector), lambda x: x.cast("double")).alias("v"),
    ).filter("label is not null and v is not null")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.filter(~odd).withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))


class Vectors:
    """Rows of a batch: numbers, identifiers (a null one apart), labels and vectors.

    Shorter vectors end in zeros.
    """

    def __init__(self, batch: pa.RecordBatch):
        self.at = batch["at"].to_numpy()
        self.null = batch["id"].is_null().to_numpy(zero_copy_only=False)
        self.id = batch["id"].fill_null(0).to_numpy()
        self.label = batch["label"].to_numpy()
        sizes = np.diff(batch["v"].offsets.to_numpy())
        width = int(sizes.max(initial=0))
        flat = batch["v"].flatten().to_numpy()
        if (sizes == width).all():
            self.v = flat.reshape(len(sizes), width)
        else:
            self.v = np.zeros((len(sizes), width), np.int64)
            self.v[np.arange(width) < sizes[:, None]] = flat
        self.largest = max((abs(int(self.v.min(initial=0))), int(self.v.max(initial=0))))


def products(a: Vectors, b: Vectors) -> np.ndarray:
    """Whole inner products of all rows of `a` with all rows of `b`."""
    width = min(a.v.shape[1], b.v.shape[1])
    left, right = a.v[:, :width], b.v[:, :width].T
    bound = a.largest * b.largest * max(1, width)
    if bound < 1 << 53:  # doubles are exact
        return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return left @ right
    exact = left.astype(object) @ right.astype(object)
    exact[a.at[:, None] == b.at[None, :]] = 0  # a row's own score is not asked for
    if exact.size and max(abs(exact.min()), abs(exact.max())) >= 1 << 63:
        raise OverflowError("a score is beyond the range of long")
    return exact.astype(np.int64)


def best(scores: np.ndarray, able: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k highest scores where `able`, ties to earlier columns."""
    n = scores.shape[1]
    k = min(k, n)
    if not n or not len(scores):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if max(abs(int(scores.min())), abs(int(scores.max()))) < (1 << 62) // n:
        ranked = np.where(able, scores * n + (n - 1 - np.arange(n)), NONE)
        at = np.argpartition(ranked, n - k, axis=1)[:, n - k :]
    else:
        order = np.argsort(~scores, axis=1, kind="stable")  # not -x, which the least number has not
        order = np.take_along_axis(
            order, np.argsort(~np.take_along_axis(able, order, 1), axis=1, kind="stable"), 1
        )
        at = order[:, :k]
    row, place = np.nonzero(np.take_along_axis(able, at, 1))
    return row, at[row, place]


def packed(anchor: np.ndarray, score: np.ndarray, kind: int, null: np.ndarray, id_: np.ndarray) -> pa.Array:
    """Keys of pairs as bytes that sort as the pairs do."""
    keys = np.empty(len(anchor), _PACKED)
    keys["anchor"] = anchor
    keys["score"] = np.uint64(MIDDLE - 1) - score.astype(np.uint64)  # modulo 2^64, as below
    keys["kind"], keys["null"] = kind, null
    keys["id"] = id_.astype(np.uint64) + np.uint64(MIDDLE)
    return pa.array([keys[i].tobytes() for i in range(len(keys))], pa.binary())


def unpacked(key: bytes) -> tuple[int, int, int, int | None]:
    """Anchor, score, kind and identifier."""
    anchor, score, kind, null, id_ = KEY.unpack(key)
    return anchor, (MIDDLE - 1) - score, kind, None if null else id_ - MIDDLE


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The lowest and highest score from low to high per cent of a positive's."""
    return -(-low * score // 100), high * score // 100


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows in blocks of about BLOCK_VALUES components, in order of their identifier."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += len(batch["v"].flatten())
        if size >= BLOCK_VALUES:
            yield _sorted(waiting)
            waiting, size = [], 0
    if waiting:
        yield _sorted(waiting)


def _sorted(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    return table.sort_by([("id", "ascending")]).combine_chunks().to_batches()[0] if len(table) else batches[0]


def _streamed(path: str) -> Iterator[pa.RecordBatch]:
    """Rows of a staged table, some at a time, read by the task itself."""
    store, place = open_store(path)
    data = pyarrow.dataset.dataset(place, filesystem=store, format="parquet")
    yield from data.to_batches(batch_size=ANCHORS, batch_readahead=1, fragment_readahead=1)


def _pairs(rows: DataFrame, path: str, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Packed keys of the pairs that a block of rows may win, with the anchors staged at `path`.

    Anchors without a column `windows` get same-label pairs, others those of other labels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            if not batch.num_rows:
                continue
            block = Vectors(batch)
            step = max(1, BLOCK_VALUES // batch.num_rows)
            for some in _streamed(path):
                for start in range(0, some.num_rows, step):
                    part = some.slice(start, step)
                    found = _won(block, part, positives, negatives, low, high)
                    yield pa.record_batch({"key": found})

    return rows.mapInArrow(run, "key binary")


def _won(
    block: Vectors, part: pa.RecordBatch, positives: int, negatives: int, low: int, high: int
) -> pa.Array:
    anchors = Vectors(part)
    scores = products(anchors, block)
    same = anchors.label[:, None] == block.label[None, :]
    if "windows" not in part.schema.names:
        same &= anchors.at[:, None] != block.at[None, :]
        row, col = best(scores, same, positives)
        kind = POSITIVE
    else:
        windows = part["windows"].to_pylist()
        found = []
        for i in range(max(map(len, windows), default=0)):
            bounds = [window(w[i], low, high) if i < len(w) else (1, 0) for w in windows]
            least, most = (np.array(x, np.int64)[:, None] for x in zip(*bounds, strict=True))
            able = ~same & (scores >= least) & (scores <= most)
            found.append(np.stack(best(scores, able, negatives)))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        row, col = pairs
        kind = NEGATIVE
    return packed(anchors.at[row], scores[row, col], kind, block.null[col], block.id[col])


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(pairs: DataFrame) -> RDD:
    """Keys of the pairs, an anchor's in one partition, in order there."""
    keyed = pairs.rdd.map(lambda r: (bytes(r[0]), None))
    anchored = keyed.repartitionAndSortWithinPartitions(
        _tasks(pairs.sparkSession), lambda key: zlib.crc32(key[:8])
    )
    return anchored.map(lambda pair: pair[0])


def first_positives(keys: Iterator[bytes], positives: int) -> Iterator[tuple[int, int | None, int]]:
    """(anchor, positive, score) of each anchor's first `positives` keys."""
    now, n = None, 0
    for anchor, score, _, id_ in map(unpacked, keys):
        if anchor != now:
            now, n = anchor, 0
        if n < positives:
            n += 1
            yield anchor, id_, score


def emitted(
    keys: Iterator[bytes], positives: int, negatives: int, low: int, high: int
) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) of keys in order.

    Of equal scores the positives come first, so a window is open before any score it has room for:
    no window reaches above its positive's score.
    """
    now, open_, seen = None, [], 0
    for anchor, score, kind, id_ in map(unpacked, keys):
        if anchor != now:
            now, open_, seen = anchor, [], 0
        if kind == POSITIVE:
            if seen < positives:
                seen += 1
                open_.append([id_, score, *window(score, low, high), 0])
            continue
        for w in open_:
            if w[2] <= score <= w[3]:
                w[4] += 1
                yield anchor, w[0], w[4], id_, w[1], score
        open_ = [w for w in open_ if w[4] < negatives and w[2] <= score]


def mine(
    df: DataFrame,
    asks: Column,
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """anchor, positive, rank (from 1), negative and both scores, as whole numbers.

    Anchors are the rows for which `asks` (of `id` and `label`) holds; scores are inner products of
    quantised vectors. An anchor's positives are its first `positives` other rows of its label, its
    negatives for one of them the first `negatives` rows of other labels whose score is from `low`
    to `high` per cent of the positive's (`high` up to 100). Higher scores come first, then smaller identifiers, null
    last. Rows that repeat an identifier all take part, and each is an anchor of its own; only the
    anchor's own row is left out. Equal anchors are mined once and come back as often as they are there.
    Shorter vectors end in zeros; an empty one scores 0. Anchors without positives or without rows in
    any window give no rows, and so does an empty table. A score beyond the range of long ends the query.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("windows must lie from 0 to 100 per cent of a positive's score")
    spark = df.sparkSession
    label = column(df, label) if isinstance(label, str) else label
    part = taking_part(df, key, vector, label, scale)
    rows = stage(part.withColumn("at", F.monotonically_increasing_id()), "rows")
    dealt = rows.repartition(_tasks(spark))
    path = new_path(spark, "anchors")
    rows.filter(asks).groupBy("id", "label", "v").agg(
        F.min("at").alias("at"), F.count(F.lit(1)).alias("copies")
    ).write.parquet(path)
    anchors = spark.read.parquet(path)

    near = in_order(_pairs(dealt, path, positives, negatives, low, high))
    found = near.mapPartitions(lambda keys: first_positives(keys, positives))
    known = stage(spark.createDataFrame(found, "at long, positive long, score long", verifySchema=False), "positives")
    windows = known.groupBy("at").agg(F.array_distinct(F.collect_list("score")).alias("windows"))
    asked = new_path(spark, "windows")
    anchors.join(windows, "at").write.parquet(asked)

    others = _pairs(dealt, asked, positives, negatives, low, high)
    opening = known.select("at", "positive", "score").mapInArrow(_opening, "key binary")
    mined = in_order(others.unionByName(opening)).mapPartitions(
        lambda keys: emitted(keys, positives, negatives, low, high)
    )
    schema = "at long, positive long, rank int, negative long, positive_score long, negative_score long"
    named = spark.createDataFrame(mined, schema, verifySchema=False).join(
        anchors.select("at", F.col("id").alias("anchor"), "copies"), "at"
    )
    return named.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "anchor", "positive", "rank", "negative", "positive_score", "negative_score"
    )


def _opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed keys of known positives."""
    for batch in batches:
        null = batch["positive"].is_null().to_numpy(zero_copy_only=False)
        columns = (batch["at"].to_numpy(), batch["score"].to_numpy())
        id_ = batch["positive"].fill_null(0).to_numpy()
        yield pa.record_batch({"key": packed(*columns, POSITIVE, null, id_)})
