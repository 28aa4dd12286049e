"""Words of whole texts, found by byte in an Arrow slice.

A word is a run of ASCII letters and digits and of characters beyond ASCII; A to Z count as a to z.
All other bytes part words. UTF-8 has no ASCII byte inside a longer character, so bytes are enough.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = 0x20
LONG = 64  # bytes; longer words are summed one by one

_LETTERS = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLDED = bytes(b if b in _LETTERS else SPACE for b in bytes(range(256)).lower())

# One step of CRC-32 for each byte; the polynomial is a fixed value.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, np.uint32(0xEDB88320) ^ (_CRC >> 1), _CRC >> 1)


@dataclass(frozen=True)
class Words:
    """Words of a slice's texts: bytes starts[i] to ends[i] of `data` are word i.

    Text t begins at byte texts[t] with two bytes that are not its own, and has the words from
    first[t] up to first[t + 1].
    """

    data: np.ndarray
    raw: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def find(texts: pa.Array) -> Words:
    """The words of each text; a null text has none."""
    padded = pc.binary_join_element_wise("\n", pc.fill_null(texts, ""), "", " ")
    _, offsets, raw = padded.buffers()
    at = np.frombuffer(offsets, np.int32)[padded.offset : padded.offset + len(padded) + 1]
    if not len(padded):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), np.zeros(0, np.uint8), none, none, none, np.zeros(1, np.int64))
    raw = raw.to_pybytes()[at[0] : at[-1]]
    at = at.astype(np.int64) - at[0]
    data = np.frombuffer(raw.translate(_FOLDED), np.uint8)
    inside = data != SPACE
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    first = np.searchsorted(starts, at)
    return Words(data, np.frombuffer(raw, np.uint8), at[:-1], starts, ends, first)


def through(state: np.ndarray, words: Words, number: np.ndarray) -> np.ndarray:
    """CRC-32 states (not inverted) after the words of these numbers, from the states before them."""
    starts = words.starts[number]
    lengths = words.ends[number] - starts
    order = np.argsort(-np.minimum(lengths, LONG + 1).astype(np.int16), kind="stable")
    at, sizes, found = starts[order], lengths[order], state[order]
    long = int(np.searchsorted(-sizes, -LONG))  # sizes fall: how many are above LONG
    for i in range(long):
        piece = words.data[at[i] : at[i] + sizes[i]].tobytes()
        found[i] = ~np.uint32(zlib.crc32(piece, int(~found[i])))
    for k in range(int(sizes[long]) if long < len(sizes) else 0):
        upto = int(np.searchsorted(-sizes, -k))  # words with more than k bytes
        some = found[long:upto]
        byte = words.data[at[long:upto] + k]
        found[long:upto] = _CRC[(some ^ byte) & 0xFF] ^ (some >> np.uint32(8))
    back = np.empty_like(found)
    back[order] = found
    return back


def run_sums(words: Words, most: int) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of every run of 1 to `most` words joined by one space, and each text's first run."""
    n = len(words.starts)
    last = np.repeat(words.first[1:], np.diff(words.first))  # end of the text of each word
    number = np.arange(n)
    begun, state = number, through(np.full(n, 0xFFFFFFFF, np.uint32), words, number)
    sums, owners = [~state], [begun]
    for size in range(2, most + 1):
        whole = begun + size <= last[begun]
        begun, state = begun[whole], state[whole]
        state = _CRC[(state ^ np.uint32(SPACE)) & 0xFF] ^ (state >> np.uint32(8))
        state = through(state, words, begun + size - 1)
        sums.append(~state)
        owners.append(begun)
    every, owner = np.concatenate(sums), np.concatenate(owners)
    if most > 1:
        order = np.argsort(owner, kind="stable")
        every, owner = every[order], owner[order]
    return every, np.searchsorted(owner, words.first)
