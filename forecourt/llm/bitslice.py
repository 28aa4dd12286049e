"""Exact top-k inner products with a bit-sliced index of quantised vectors.

The index has a row per block of candidates. In it, each attribute (component) is stored as
slices: bitmaps over the block's rows, one per binary digit. A query weighs attributes by
whole numbers, so its scores are a sum of slices, each shifted by the digits of its weight; they are
added with bitmap arithmetic (full adders over whole bitmaps) into slices of the scores.
The top rows are then read off from the most significant slice downward, and rows tied at the
boundary are resolved by identifier.

A task takes a block and a chunk of the queries, both read from the shared folder, so neither is
shuffled; with as many blocks as tasks there is one chunk, and every block is read once. Per
query and block at most k rows are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.llm.frames import column
from forecourt.llm.warc import open_store
from forecourt.staging import new_path, stage

BLOCK_ROWS = 65_536
BLOCK_BYTES = 64 << 20  # of a block's slices and vectors
QUERIES = 1024  # read at once
EXACT = 1 << 62  # sums of products below this fit into 64 bits with room to spare

INDEX = "block int, dims int, at binary, ids binary, nulls binary, vectors binary, width int, slices binary"
FOUND = "at long, query long, copies long, key long, score long"


def quantised(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """key and v, the floor of scale times each component, of rows that take part.

    Vectors that are null or hold null, infinite or undefined components take no part.
    """
    rows = df.select(
        column(df, key).cast("long").alias("key"),
        F.transform(column(df, vector), lambda x: x.cast("double")).alias("v"),
    ).filter("v is not null")
    odd = F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return rows.filter(~odd).select(
        "key", F.transform("v", lambda x: F.floor(x * scale)).alias("v")
    )


def _matrix(vectors) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    dims = max((len(v) for v in vectors), default=0)
    if all(len(v) == dims for v in vectors):
        return np.array(list(vectors), np.int64).reshape(len(vectors), dims)
    found = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        found[i, : len(v)] = v
    return found


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.min(initial=0))), int(values.max(initial=0)))


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that has room for them."""
    top = _largest(values)
    kinds = ((1 << 7, np.int8), (1 << 15, np.int16), (1 << 31, np.int32))
    return values.astype(next((kind for limit, kind in kinds if top < limit), np.int64))


def index_block(rows: pd.DataFrame) -> pd.DataFrame:
    """The index row of a block; its rows are numbered by key, a null key last.

    A block whose numbers span more than 62 digits has no slices; its scores are computed as such.
    """
    null = rows["key"].isna().to_numpy()
    ids = rows["key"].astype("Int64").fillna(0).to_numpy(np.int64)
    order = np.lexsort((rows["at"].to_numpy(), ids, null))
    vectors = _matrix(rows["v"].to_list())[order]
    n, dims = vectors.shape
    width, slices = 0, np.zeros((dims, 0, 0), np.uint8)
    if _largest(vectors) < EXACT // 2:
        above = vectors - vectors.min(axis=0)
        width = max(1, int(above.max(initial=0)).bit_length())
        slices = np.zeros((dims, width, -(-n // 64) * 8), np.uint8)
        for d in range(dims):
            for j in range(width):
                bits = np.packbits(above[:, d] >> j & 1, bitorder="little")
                slices[d, j, : len(bits)] = bits
    return pd.DataFrame(
        {
            "block": [rows["block"].iloc[0]],
            "dims": [dims],
            "at": [rows["at"].to_numpy(np.int64)[order].tobytes()],
            "ids": [ids[order].tobytes()],
            "nulls": [null[order].tobytes()],
            "vectors": [_narrow(vectors).tobytes()],
            "width": [width],
            "slices": [slices.tobytes()],
        }
    )


def block_rows(rows: DataFrame) -> int:
    """How many rows a block has at most, so that it stays within its bytes."""
    top = F.array_max(F.transform("v", lambda x: F.abs(x)))
    dims, largest = rows.agg(F.max(F.size("v")), F.max(top)).first()
    digits = int(largest or 0).bit_length() + 1
    bits = max(1, dims or 0) * (digits + 8 * max(1, -(-digits // 8)))
    return max(64, min(BLOCK_ROWS, BLOCK_BYTES * 8 // bits))


def build_index(rows: DataFrame, most: int | None = None) -> tuple[str, int]:
    """Write the index of all of `rows` (at, key, v), a folder per block; returns its path and blocks."""
    blocks = math.ceil(rows.count() / (most or block_rows(rows)))
    path = new_path(rows.sparkSession, "slices")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("at"), F.lit(max(1, blocks))).cast("int"))
    indexed = dealt.groupBy("block").applyInPandas(index_block, INDEX)
    indexed.withColumn("number", F.col("block")).write.partitionBy("block").parquet(path)
    return path, blocks


def _read(path: str) -> Iterator[pa.RecordBatch]:
    """A folder of the index or of queries, read by a task itself; one that is not there is empty."""
    store, place = open_store(path)
    if store.get_file_info(place).type == pa.fs.FileType.NotFound:
        return
    data = pyarrow.dataset.dataset(place, filesystem=store, format="parquet")
    yield from data.to_batches(batch_size=QUERIES, batch_readahead=1, fragment_readahead=1)


class Block:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.null = np.frombuffer(row["nulls"], bool)
        self.at = np.frombuffer(row["at"], np.int64)
        self.by_at = np.argsort(self.at)
        n, dims, width = len(self.ids), row["dims"], row["width"]
        size = len(row["vectors"]) // (n * dims) if dims else 1
        self.vectors = np.frombuffer(row["vectors"], np.dtype(f"i{size}")).reshape(n, dims)
        self.largest = _largest(self.vectors)
        self.sliced = width > 0
        shape = (dims, width, -(-n // 64) if self.sliced else 0)
        self.slices = np.frombuffer(row["slices"], np.uint64).reshape(shape)
        self.complements = ~self.slices
        self.every = np.zeros(-(-n // 64) * 8, np.uint8)
        bits = np.packbits(np.ones(n, np.uint8), bitorder="little")
        self.every[: len(bits)] = bits
        self.every = self.every.view(np.uint64)

    def place(self, at: int) -> int | None:
        """Position of a row of the table, if it is in this block."""
        i = np.searchsorted(self.at, at, sorter=self.by_at)
        found = self.by_at[i] if i < len(self.at) else None
        return int(found) if found is not None and self.at[found] == at else None

    def exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Whole inner products; numbers that may leave 64 bits are multiplied without bounds."""
        dims = min(len(query), self.vectors.shape[1])
        left, right = self.vectors[rows, :dims], query[:dims]
        if self.largest * _largest(right) * max(1, dims) < EXACT:
            return left.astype(np.int64) @ right
        found = left.astype(object) @ right.astype(object)
        if len(found) and max(abs(found.min()), abs(found.max())) >= 1 << 63:
            raise OverflowError("a score is beyond the range of long")
        return found.astype(np.int64)

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the scores less the same number for all rows, least significant first.

        A negative weight counts its absolute value on the complement.
        """
        levels: list[list[np.ndarray]] = []
        for d in np.flatnonzero(query[: len(self.slices)]):
            weight = int(query[d])
            source = self.slices[d] if weight > 0 else self.complements[d]
            weight = abs(weight)
            for i in range(weight.bit_length()):
                if weight >> i & 1:
                    while len(levels) < i + len(source):
                        levels.append([])
                    for j, bits in enumerate(source):
                        levels[i + j].append(bits)
        found, at = [], 0
        while at < len(levels):
            here = levels[at]
            while len(here) > 1:
                if at + 1 == len(levels):
                    levels.append([])
                a, b = here.pop(), here.pop()
                if here:
                    c = here.pop()
                    half = a ^ b
                    carry = half & c
                    carry |= a & b
                    half ^= c
                    here.insert(0, half)
                    levels[at + 1].append(carry)
                else:
                    levels[at + 1].append(a & b)
                    here.append(a ^ b)
            found.append(here[0] if here else np.zeros_like(self.every))
            at += 1
        return found

    def top(self, query: np.ndarray, own: int, k: int) -> np.ndarray:
        """Positions of the k rows with the highest scores but the query's own, ties to smaller ids."""
        mine = self.place(own)
        reach = 2 * self.largest * _largest(query) * max(1, self.vectors.shape[1])
        if not self.sliced or reach >= EXACT:
            others = np.arange(len(self.ids))
            others = others[others != mine] if mine is not None else others
            scores = self.exact(others, query)
            return others[np.argsort(~scores, kind="stable")[:k]]  # ~x falls as x rises
        open_ = self.every.copy()
        if mine is not None:
            open_[mine >> 6] &= ~np.uint64(1 << (mine & 63))
        sure, n_sure = np.zeros_like(open_), 0
        for bits in reversed(self.scores(query)):
            high = open_ & bits
            n = n_sure + int(np.bitwise_count(high).sum())
            if n > k:
                open_ = high
            else:
                sure, n_sure = sure | high, n
                open_ &= ~bits
                if n == k:
                    break
        tied = _positions(open_)[: k - n_sure]
        return np.concatenate([_positions(sure), tied])


def _positions(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def _answers(block: Block, asked: pa.RecordBatch, k: int) -> pa.RecordBatch:
    """The k best rows of a block for each query of a batch."""
    queries = _matrix(asked["v"].to_pylist())
    places, scores = [], []
    for own, query in zip(asked["at"].to_pylist(), queries, strict=True):
        best = block.top(query, own, k)
        places.append(best)
        scores.append(block.exact(best, query))
    row = np.repeat(np.arange(len(places)), [len(p) for p in places])
    place = np.concatenate([np.zeros(0, np.int64), *places]).astype(np.int64)
    found = {c: asked[a].take(pa.array(row)) for c, a in (("at", "at"), ("query", "key"), ("copies", "copies"))}
    found["key"] = pa.array(block.ids[place], mask=block.null[place])
    found["score"] = np.concatenate([np.zeros(0, np.int64), *scores])
    return pa.record_batch(found)


def search(spark: SparkSession, index: str, blocks: int, asked: DataFrame, k: int) -> DataFrame:
    """query, rank (from 1), key and score of each query's k best rows other than its own.

    `asked` has columns at, key, v and copies: queries that are equal are asked once and answered
    `copies` times. With fewer other rows than k all come back. No queries or an empty index give no rows.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, -(-tasks // max(1, blocks)))
    path = new_path(spark, "queries")
    chunk = F.pmod(F.xxhash64("at"), F.lit(chunks)).cast("int")
    asked.withColumn("chunk", chunk).write.partitionBy("chunk").parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None
        for batch in batches:
            for number in batch["id"].to_pylist():
                if held != number // chunks:
                    held, block = number // chunks, None
                    for rows in _read(f"{index}/block={held}"):
                        block = Block(rows.to_pylist()[0])
                if block is not None:
                    for some in _read(f"{path}/chunk={number % chunks}"):
                        yield _answers(block, some, k)

    # A row per block and chunk; those of a block follow each other.
    work = spark.range(0, blocks * chunks, 1, max(1, min(blocks * chunks, 10 * tasks)))
    near = work.mapInArrow(run, FOUND)
    best = Window.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    every = F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
    return ranked.withColumn("copy", every).select("query", "rank", "key", "score")


def nearest(
    df: DataFrame,
    asks: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """query, rank (from 1), key and score of the k best rows of each query.

    Queries are the rows for which `asks` (of `key`) holds, candidates all rows but the query's own;
    rows that repeat a key are rows like any other, each with k places of its own. Ties go to smaller
    keys, null last. Vectors that are null or hold null, infinite or undefined components take no part;
    shorter vectors end in zeros, an empty one scores 0. Numbers too large for bitmap sums are multiplied
    out instead; a score beyond the range of long ends the query. An empty table gives no rows.
    Other columns play no part, whatever their names.
    """
    numbered = quantised(df, key, vector, scale).withColumn("at", F.monotonically_increasing_id())
    rows = stage(numbered, "quantised")
    asked = rows.filter(asks).groupBy("key", "v").agg(
        F.min("at").alias("at"), F.count(F.lit(1)).alias("copies")
    )
    index, blocks = build_index(rows)
    return search(df.sparkSession, index, blocks, asked, k)
