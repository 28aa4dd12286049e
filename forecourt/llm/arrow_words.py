"""Texts in Arrow batches as words: each distinct word of a batch is worked on once.

A batch is cut into slices of bounded text size, a slice's texts are split into words and
the words dictionary-encoded, all in Arrow. Python then sees each distinct word of a
slice once and can keep its answer in a bounded cache for later slices and tasks.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
LONGEST = 256  # characters of a key that is kept
ENTRY = 220  # bytes of a kept entry beside its letters
ROOM = 40 << 20
STORED = 4096  # entries at once


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `size` bytes of text each; one longer text makes a run of its own."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    run = (np.cumsum(lengths, dtype=np.int64) - lengths) // size
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(int(start), int(end - start))


def encoded(
    lists: pa.ListArray, fold: Callable[[pa.Array], pa.Array] | None = None
) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Offsets of each text's words, the words as numbers, and the distinct words.

    With `fold`, words are made alike by it first, each distinct one once.
    """
    offsets = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    numbers, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    if fold:
        again = fold(distinct).dictionary_encode()
        numbers, distinct = again.indices.to_numpy(zero_copy_only=False)[numbers], again.dictionary
    return (offsets - offsets[0]).astype(np.int64), numbers, distinct.to_pylist()


def numbered(words: list[str]) -> tuple[np.ndarray, list[str]]:
    """The words as numbers, and the distinct words."""
    number: dict[str, int] = {}
    found = [number.setdefault(w, len(number)) for w in words]
    return np.array(found, np.int64), list(number)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; zero for a text without words."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), values.cumsum(axis=0)])
    return total[offsets[1:]] - total[offsets[:-1]]


def joined(ids: list[bytes], words: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """Each text's ids: those of its words one after the other, given as bytes of 32-bit ids."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(ids), np.int32))
    taken = pa.ListArray.from_arrays(pa.array(starts), values).take(pa.array(words))
    at = taken.offsets.to_numpy() if len(taken) else np.zeros(1, np.int32)
    return pa.ListArray.from_arrays(pa.array(at[offsets]), taken.flatten())


_held: dict = {}


def held(key, make: Callable):
    """What this worker keeps from task to task: the last thing made, under its key.

    Workers serve one operator after the other, and each may fill large caches: memory of the one
    before goes back to the system.
    """
    if key not in _held:
        if _held:
            _held.clear()
            _give_back()
        _held[key] = make()
    return _held[key]


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


class Recent:
    """A cache bounded by bytes: two generations of about `room` bytes at most, the older one dropped in turn.

    `fill` gets the keys that are not known and returns their answers in order. Keys of more than
    LONGEST characters are not kept: whole texts without spaces would fill any cache, and rarely come again.
    """

    def __init__(self, fill: Callable[[list[str]], Iterable], room: int = ROOM):
        self.fill, self.room, self.used = fill, room, 0
        self.young: dict = {}
        self.old: dict = {}

    def answers(self, keys: list[str]) -> list:
        """Answers to distinct keys."""
        young, old = self.young.get, self.old.get
        found = [young(k) for k in keys]
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            unknown = []
            for i in missing:
                found[i] = old(keys[i])
                if found[i] is None:
                    unknown.append(i)
            for i, x in zip(unknown, self.fill([keys[i] for i in unknown]), strict=True):
                found[i] = x
            for start in range(0, len(missing), STORED):
                self._keep({k: found[i] for i in missing[start : start + STORED] if len(k := keys[i]) <= LONGEST})
        return found

    def peek(self, key: str):
        """The answer to a key, if it is kept."""
        found = self.young.get(key)
        return self.old.get(key) if found is None else found

    def _keep(self, some: dict) -> None:
        # An answer is a few bytes per character of its key.
        cost = ENTRY * len(some) + 6 * sum(map(len, some))
        if self.used + cost > self.room:
            self.old, self.young, self.used = self.young, {}, 0
        self.young |= some
        self.used += cost
