"""Near duplicates by SimHash: tiled exact comparison of fingerprints.

Every text gets a 64-bit fingerprint. Distinct fingerprints are dealt into tiles by the
population counts of their four quarters. Two fingerprints at most r bits apart have
counts that differ by r in sum at most, so other pairs of tiles are skipped; pairs of
tiles that are left are compared in full with numpy's exclusive-or and bit counts. No pair within
the radius is missed. A tile with many fingerprints is cut into blocks, and a task's
pair of blocks sends back a spanning forest of its links, not all its pairs.

There are at most 17^4 tiles, whatever the input; their sizes are the only table broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.arrow_words import slices
from forecourt.llm.components import components
from forecourt.llm.frames import column, text_or_empty
from forecourt.staging import stage

QUARTERS = 4
WIDTH = 64 // QUARTERS + 1  # population counts of a quarter: 0 to 16
BLOCK = 4096  # fingerprints of one side of a comparison
ROWS = 512  # of one side, compared with the other side's block at once
WORDS = 200_000  # held at once of one text


def _hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, some at a time; of the whole if it has fewer words."""
    tail: list[bytes] = []
    some = 0
    rest = text.lower()  # bytes: A to Z only
    while rest:
        words = rest.split(None, WORDS)
        rest = words.pop() if len(words) > WORDS else b""
        words = tail + words
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) if words else np.zeros(0, np.int64)
        starts = np.concatenate([[0], ends[:-1]]) if words else ends
        last = ends[shingle - 1 :] - 1
        if len(last):
            some += len(last)
            digest = xxhash.xxh64_intdigest
            spans = zip(starts[: len(last)].tolist(), last.tolist(), strict=True)
            yield np.array([digest(joined[s:e], 42) for s, e in spans], np.uint64)
        tail = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
    if tail and not some:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), 42)], np.uint64)


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, highest bit first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros(64, np.int64)
    for start in range(0, len(bits), 255):
        total += bits[start : start + 255].sum(axis=0, dtype=np.uint8)
    return total


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint as an unsigned number; zero if there are no words."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in _hashes(text, shingle):
        n += len(hashes)
        ones += _set_bits(hashes)
    if not n:
        return 0
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, key: Column, text: str, shingle: int) -> DataFrame:
    """key and fp (the fingerprint as a signed long) of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [fingerprint(t.as_buffer().to_pybytes(), shingle) for t in part["text"]]
                signed = np.array(found, np.uint64).view(np.int64)
                yield pa.record_batch([part["key"], pa.array(signed)], ["key", "fp"])

    slim = df.select(key.alias("key"), text_or_empty(df, text).alias("text"))
    return slim.mapInArrow(run, f"key {slim.schema['key'].dataType.simpleString()}, fp long")


def _quarter(i: int) -> Column:
    bits = F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))
    return F.bit_count(bits)


def _tile() -> Column:
    """The four population counts as one number."""
    number = _quarter(0)
    for i in range(1, QUARTERS):
        number = number * WIDTH + _quarter(i)
    return number


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of counts within the radius, one of each pair of opposite ones."""
    steps = product(range(-radius, radius + 1), repeat=QUARTERS)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * QUARTERS]


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all values of a and b within the radius; b may be a itself."""
    both = a if b is a else np.concatenate([a, b])
    shift = 0 if b is a else len(a)
    label = np.arange(len(both))
    for start in range(0, len(a), ROWS):
        near = np.bitwise_count(a[start : start + ROWS, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = i + start, j + shift
        while len(i):
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            label = label[label]
            open_ = label[i] != label[j]
            i, j = i[open_], j[open_]
    linked = np.flatnonzero(label != np.arange(len(both)))
    return both[linked], both[label[linked]]


def _compare(radius: int):
    """Rows (first, step, i, j, side, fp) sorted by comparison to the links found in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            cuts = _cuts(table)
            if len(cuts) > 1:
                yield from _links(table, cuts, radius)
                held = table.slice(int(cuts[-1])).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from _links(table, np.append(_cuts(table), table.num_rows), radius)

    return run


def _cuts(table: pa.Table) -> np.ndarray:
    """Where comparisons begin."""
    if not table.num_rows:
        return np.zeros(0, np.int64)
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for name in ("first", "step", "i", "j"):
        values = table[name].to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def _links(table: pa.Table, cuts: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    fp = table["fp"].to_numpy().view(np.uint64)
    side = table["side"].to_numpy()
    us, vs = [], []
    for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        some = fp[start:end]
        n = int(np.count_nonzero(side[start:end] == 0))
        # Side 2 is compared with itself; sides 0 and 1 with each other.
        u, v = (
            _forest(some, some, radius)
            if side[start] == 2
            else _forest(some[:n], some[n:], radius)
        )
        us.append(u)
        vs.append(v)
    if us:
        yield pa.record_batch(
            {
                "u": np.concatenate(us).view(np.int64),
                "v": np.concatenate(vs).view(np.int64),
            }
        )


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) that join all distinct fingerprints `fp` at most `radius` bits apart."""
    tiled = distinct.select("fp", _tile().alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.broadcast(
        stage(sizes.select("tile", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "tiles")
    )
    placed = tiled.join(blocks, "tile").select(
        "fp",
        "tile",
        F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"),
    )
    offsets = [sum(x * WIDTH ** (QUARTERS - 1 - k) for k, x in enumerate(s)) for s in _steps(radius)]
    nearby = F.array(
        *[F.struct(F.lit(o).alias("step"), F.lit(0).alias("side")) for o in offsets],
        *[F.struct(F.lit(o).alias("step"), F.lit(1).alias("side")) for o in offsets if o],
    )
    # Counts beyond a quarter's 0 to 16 would wrap into a neighbour's digit; such a step leads to a
    # tile that is further off or does not exist, which costs a comparison and loses nothing.
    faced = (
        placed.withColumn("near", F.explode(nearby))
        .select(
            "fp",
            "block",
            F.col("near.step").alias("step"),
            F.col("near.side").alias("side"),
            F.when(F.col("near.side") == 0, F.col("tile"))
            .otherwise(F.col("tile") - F.col("near.step"))
            .alias("first"),
            F.when(F.col("near.side") == 0, F.col("tile") + F.col("near.step"))
            .otherwise(F.col("tile") - F.col("near.step"))
            .alias("other"),
        )
        .join(blocks.withColumnRenamed("tile", "other"), "other")
        .withColumn("facing", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    own = F.col("step") == 0
    dealt = (
        faced.select(
            "first",
            "step",
            F.when(own, F.least("block", "facing"))
            .when(F.col("side") == 0, F.col("block"))
            .otherwise(F.col("facing"))
            .alias("i"),
            F.when(own, F.greatest("block", "facing"))
            .when(F.col("side") == 0, F.col("facing"))
            .otherwise(F.col("block"))
            .alias("j"),
            F.when(~own, F.col("side"))
            .when(F.col("block") == F.col("facing"), 2)
            .when(F.col("block") < F.col("facing"), 0)
            .otherwise(1)
            .alias("side"),
            "fp",
        )
        .repartition("first", "step", "i", "j")
        .sortWithinPartitions("first", "step", "i", "j", "side")
    )
    return dealt.mapInArrow(_compare(radius), "u long, v long")


def near_duplicates(
    df: DataFrame, key: str | Column = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """key, fp (signed long) and component (smallest key reachable) of each row.

    Texts lose the case of A to Z and fall into words at ASCII white space. Texts without words,
    null ones among them, have fingerprint zero and link like any other. Equal
    fingerprints are linked. Repeated rows stay. A null key is never the smallest while the
    component has another. A very long text is read in pieces of words. An empty table gives no rows. Other
    columns play no part, whatever their names.
    """
    key = column(df, key) if isinstance(key, str) else key
    marked = stage(fingerprints(df, key, text, shingle), "fingerprints")
    distinct = stage(marked.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    roots = components(links(distinct, radius))
    members = roots.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct()
    )
    least = (
        members.join(distinct, "fp").groupBy("root").agg(F.min("least").alias("component"))
    )
    linked = members.join(least, "root").select("fp", "component")
    named = stage(
        distinct.join(linked, "fp", "left").select(
            "fp", F.coalesce("component", "least").alias("component")
        ),
        "near-groups",
    )
    return marked.join(named, "fp").select("key", "fp", "component")
