"""Pack token sequences with little padding: shortest pack first over the length histogram.

Documents are cut into pieces of at most `capacity` ids. Packing sees only how many pieces of
each length there are, at most `capacity` numbers, and works on groups of equal packs:
lengths are placed longest first, each into the packs with most room, and a new group is opened
when no pack has room. What it decides is a short table of placements: the pieces of
a length with ranks from a to b go, so many to a pack, into the packs from s on, at an offset. Pieces
are then ranked within their length and find their placement by rank.

Ranks are counted in slices: a length may have any part of all pieces, but a slice of it, by a
uniform hash, has about sqrt(N) at most.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.arrow_words import held, slices
from forecourt.llm.frames import column, text_or_empty
from forecourt.llm.word_ids import WordIds
from forecourt.staging import stage

PLACEMENT = "rank_from long, rank_to long, copies long, sequence long, offset long"
BROADCAST_PLACEMENTS = 200_000

def cut(lists: pa.ListArray, capacity: int) -> dict[str, np.ndarray]:
    """Pieces of each list: its number, start, length, CRC-32 of its ids, and the list's length."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    ids = lists.flatten().to_numpy().astype("<u4")
    total = np.diff(offsets)
    pieces = -(-total // capacity)
    row = np.repeat(np.arange(len(total)), pieces)
    first = np.cumsum(pieces) - pieces
    start = (np.arange(len(row)) - first[row]) * capacity
    length = np.minimum(total[row] - start, capacity)
    begin = offsets[row] + start
    crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin, begin + length, strict=True)]
    return {
        "row": row,
        "start": start,
        "length": length,
        "ids_crc32": np.array(crc, np.int64),
        "doc_tokens": total[row],
    }


def tokenized_pieces(
    df: DataFrame,
    vocabulary_path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    capacity: int = 4096,
) -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens of each piece of each whole text.

    A null text is empty and has the end id only, as one piece. Repeated rows and null keys stay. A
    very long text is encoded whole and gives many pieces; an empty table gives none. Other columns play no
    part, whatever their names.
    """
    with open(vocabulary_path, "rb") as file:
        vocabulary = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = held(("ids", hash(vocabulary.value)), lambda: WordIds(vocabulary.value))
        for batch in batches:
            for part in slices(batch, "text"):
                found = cut(tokenizer.ids(part["text"], end_id), capacity)
                row = pa.array(found.pop("row"))
                yield pa.record_batch({"key": part["key"].take(row), **found})

    slim = df.select(column(df, key).alias("key"), text_or_empty(df, text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return slim.mapInArrow(run, schema)


def placements(histogram: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """(length, rank_from, rank_to, copies, sequence, offset) for all pieces.

    Pieces of `length` with ranks from rank_from up to rank_to, `copies` to a sequence, lie in the
    sequences from `sequence` on, side by side from `offset`.
    """
    open_: list[tuple[int, int, int]] = []  # (-room, first sequence, number of sequences)
    found, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if not open_ or -open_[0][0] < length:
                copies = min(capacity // length, left)
                room, first, packs = capacity, sequences, left // copies
                sequences += packs
            else:
                room, first, packs = heapq.heappop(open_)
                room = -room
                rival = -open_[0][0] if open_ else 0
                copies = max(1, (room - max(rival, 0)) // length)
                copies = min(copies, room // length, max(1, left // packs))
                if left < packs:
                    heapq.heappush(open_, (-room, first + left, packs - left))
                    packs = left
            placed = copies * packs
            found.append((length, rank, rank + placed, copies, first, capacity - room))
            if room > copies * length:
                heapq.heappush(open_, (copies * length - room, first, packs))
            rank += placed
            left -= placed
    return found


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """`pieces` (with a column `length`) with `sequence_id` (gapless from 0) and `offset`.

    Lengths must be from 1 to `capacity`. Columns named sequence_id or offset are replaced. No pieces give
    no rows. Which of equally long pieces comes where is open.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    name = {c: f"c{i}" for i, c in enumerate(kept)}
    rows = stage(
        pieces.select(
            *[column(pieces, c).alias(name[c]) for c in kept],
            column(pieces, "length").cast("long").alias("length"),
        ),
        "pieces",
    )
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}
    if any(not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")

    n_slices = max(1, math.isqrt(sum(histogram.values())))
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    sliced = rows.withColumn("h", place).withColumn(
        "part", F.pmod("h", F.lit(n_slices)).cast("int")
    )
    before = Window.partitionBy("length").orderBy("part")
    earlier = (
        sliced.groupBy("length", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "part", (F.sum("n").over(before) - F.col("n")).alias("earlier"))
    )
    within = Window.partitionBy("length", "part").orderBy("h")
    ranked = sliced.join(earlier, ["length", "part"]).withColumn(
        "rank", F.col("earlier") + F.row_number().over(within) - 1
    )

    by_length: dict[int, list] = {}
    found = placements(histogram, capacity)
    for length, *rest in found:
        by_length.setdefault(length, []).append(tuple(rest))
    table = spark.createDataFrame(
        list(by_length.items()), f"length long, places array<struct<{_fields()}>>"
    )
    if len(found) <= BROADCAST_PLACEMENTS:
        table = F.broadcast(table)
    # Placements of a length come in rank order: the last that begins at or before the rank.
    at = F.size(F.filter("places", lambda p: p.rank_from <= F.col("rank")))
    placed = ranked.join(table, "length").withColumn("p", F.element_at("places", at))
    nth = F.col("rank") - F.col("p.rank_from")
    return placed.select(
        *[F.col(name[c]).alias(c) for c in kept],
        (F.col("p.sequence") + F.floor(nth / F.col("p.copies"))).cast("long").alias("sequence_id"),
        (F.col("p.offset") + nth % F.col("p.copies") * F.col("length")).alias("offset"),
    )


def _fields() -> str:
    return ", ".join(f.replace(" ", ": ") for f in PLACEMENT.split(", "))
