"""Merge-type sentencepiece vocabularies: pieces, scores and the agenda that merges symbols.

A text is first written with U+2581 for each space and one such mark in front. Its
characters are the first symbols. All adjacent pairs that form a piece stand on an agenda, a
heap ordered by score and then by position, over a linked list of the symbols; the
best pair is merged, its new neighbours join the agenda, and pairs whose symbols have
changed meanwhile are passed over. Symbols are numbers, and a table built once says for two
of them which piece they form and where it stands on the agenda.

A merge can never cross two characters that stand side by side in no piece. Texts
therefore fall into parts that are merged on their own, and each distinct part
is merged once and kept in a bounded cache.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

MARK = "▁"

WIDTH = 22  # bits of a symbol's number
OUTSIDE = 1 << 21  # numbers of characters without piece begin here
GONE = -1
NEVER = 1 << 62  # the place of a pair that forms no piece
SHORT = 24  # symbols of a part that needs no heap
COMMON = 1024  # characters up to here, and the mark, are looked up in a table of pairs
PLACE_BITS = 32
PLACES = (1 << PLACE_BITS) - 1
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceModel:
    """The vocabulary of a merge-type model, and the library's own processor for checks."""

    def __init__(self, proto: bytes):
        spec = sentencepiece_model_pb2.ModelProto.FromString(proto)
        norm, trainer = spec.normalizer_spec, spec.trainer_spec
        if (
            trainer.model_type != trainer.BPE
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not (norm.add_dummy_prefix and norm.escape_whitespaces)
        ):
            raise ValueError("a BPE model with byte fallback and plain normalisation is needed")
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id = [0] * 256
        self.bytes_of: list[bytes] = []
        self.marked: list[bool] = []
        for i, piece in enumerate(spec.pieces):
            text = b""
            if piece.type == kinds.BYTE:
                code = int(piece.piece[3:5], 16)
                self.byte_id[code], text = i, bytes([code])
            elif piece.type == kinds.NORMAL:
                self.rank[piece.piece] = -piece.score
                self.id[piece.piece] = i
                text = piece.piece.replace(MARK, " ").encode()
            elif piece.type == kinds.UNKNOWN:
                text = trainer.unk_surface.encode()
            elif piece.type != kinds.CONTROL:
                raise ValueError(f"pieces of type {piece.type} are not supported")
            self.bytes_of.append(text)
            self.marked.append(piece.type == kinds.NORMAL and piece.piece[0] == MARK)
        self.end_id = trainer.eos_id
        self.pairs = self._pairs()
        self.linked = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}
        self._linked_pairs()
        self.words_end_at_spaces = not any(
            pair[1] == MARK and pair[0] != MARK for pair in self.linked
        )
        if not self.words_end_at_spaces:
            raise ValueError("pieces that span words are not supported")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)

    def _pairs(self) -> dict[int, int]:
        """For two symbols (as one number) that form a piece: its place on the agenda.

        A symbol is a piece or a single character; characters without piece have numbers of their own.
        Pieces of equal scores share a place. Which piece is formed stands in `formed`.
        """
        order = {score: i for i, score in enumerate(sorted(set(self.rank.values())))}
        self.symbol = {p: i for p, i in self.id.items() if len(p) == 1}
        self.formed: dict[int, int] = {}

        def number(text: str) -> int | None:
            if text in self.id:
                return self.id[text]
            return OUTSIDE + ord(text) if len(text) == 1 else None

        found = {}
        for piece, i in self.id.items():
            for cut in range(1, len(piece)):
                left, right = number(piece[:cut]), number(piece[cut:])
                if left is not None and right is not None:
                    found[left << WIDTH | right] = order[self.rank[piece]] << PLACE_BITS
                    self.formed[left << WIDTH | right] = i
        return found

    def _linked_pairs(self) -> None:
        """Which pairs of characters stand side by side in a piece: a table for the common ones,
        and all of them as sorted numbers."""
        pairs = np.array(sorted(ord(p[0]) << WIDTH | ord(p[1]) for p in self.linked), np.int64)
        self.link_numbers = np.append(pairs, np.int64(-1) & np.int64((1 << 62) - 1))
        self.link_table = np.zeros((COMMON, COMMON), bool)
        for p in self.linked:
            a, b = self._common(ord(p[0])), self._common(ord(p[1]))
            if a is not None and b is not None:
                self.link_table[a, b] = True

    @staticmethod
    def _common(code: int) -> int | None:
        if code == ord(MARK):
            return COMMON - 1
        return code if code < COMMON - 1 else None

    def parts_of(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The words, each with a mark in front, cut wherever neighbouring characters share no piece:
        all parts in a row, and each word's first one (and the end)."""
        marked = [MARK + w.replace(" ", MARK) for w in words]
        whole = "".join(marked)
        code = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int64)
        short = np.where(code == ord(MARK), COMMON - 1, code)
        common = short < COMMON
        common[code == COMMON - 1] = False
        linked = self.link_table[np.where(common, short, 0)[:-1], np.where(common, short, 0)[1:]]
        rare = np.flatnonzero(~(common[:-1] & common[1:]))
        number = code[rare] << WIDTH | code[rare + 1]
        linked[rare] = self.link_numbers[np.searchsorted(self.link_numbers, number)] == number
        heads = np.cumsum([0, *map(len, marked)])
        begins = np.ones(len(code) + 1, bool)
        begins[1:-1] = ~linked
        begins[heads] = True
        at = np.flatnonzero(begins)
        first = np.searchsorted(at, heads)
        at = at.tolist()
        return [whole[a:b] for a, b in zip(at, at[1:])], first

    def merged(self, part: str) -> tuple[list[int], int]:
        """The symbols that remain when the agenda is empty, and how many merges it took."""
        symbol, pairs = self.symbol.get, self.pairs.get
        symbols = [symbol(c) or OUTSIDE + ord(c) for c in part]
        agenda = [
            place | i
            for i, (left, right) in enumerate(zip(symbols, symbols[1:]))
            if (place := pairs(left << WIDTH | right)) is not None
        ]
        if not agenda:
            return symbols, 0
        n, formed = len(symbols), self.formed
        heapify(agenda)
        after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while agenda:
            entry = heappop(agenda)
            i = entry & PLACES
            j, left = after[i], symbols[i]
            if left < 0 or j >= n:
                continue
            both = left << WIDTH | symbols[j]
            if pairs(both) != entry - i:  # one of the two has changed meanwhile
                continue
            left = symbols[i] = formed[both]
            symbols[j] = GONE
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                place = pairs(left << WIDTH | symbols[k])
                if place is not None:
                    heappush(agenda, place | i)
            h = before[i]
            if h >= 0:
                place = pairs(symbols[h] << WIDTH | left)
                if place is not None:
                    heappush(agenda, place | h)
        return [s for s in symbols if s >= 0], merges

    def count(self, part: str) -> int:
        """Number of tokens: initial symbols less merges; a character without piece is its bytes."""
        symbols, merges = self.merged(part)
        unknown = sum(len(chr(s - OUTSIDE).encode()) - 1 for s in symbols if s >= OUTSIDE)
        return len(part) - merges + unknown

    def short(self, part: str) -> list[int]:
        """The symbols that remain of a short part, by an agenda in order of position.

        Taking the least place of a few pairs costs less than keeping a heap of them.
        """
        symbol, pairs, formed = self.symbol.get, self.pairs.get, self.formed
        symbols = [symbol(c) or OUTSIDE + ord(c) for c in part]
        agenda = [pairs(a << WIDTH | b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda and (least := min(agenda)) != NEVER:
            i = agenda.index(least)  # the first of equal ones
            left = symbols[i] = formed[symbols[i] << WIDTH | symbols.pop(i + 1)]
            del agenda[i]
            if i:
                agenda[i - 1] = pairs(symbols[i - 1] << WIDTH | left, NEVER)
            if i < len(agenda):
                agenda[i] = pairs(left << WIDTH | symbols[i + 1], NEVER)
        return symbols

    def ids(self, part: str) -> list[int]:
        symbols = self.short(part) if len(part) <= SHORT else self.merged(part)[0]
        if max(symbols, default=0) < OUTSIDE:
            return symbols
        found: list[int] = []
        for s in symbols:
            found.extend([s] if s < OUTSIDE else [self.byte_id[b] for b in chr(s - OUTSIDE).encode()])
        return found


def segments(texts: pa.Array) -> pa.ListArray:
    """Each text's words by single spaces, without their mark; no nulls in `texts`.

    Spaces that do not stand alone between words stay with the word that follows
    (or at the end), so that a mark in front of every segment gives the marked text. A mark that
    the text itself has is a space. An empty text has no segment.
    """
    lists = pc.split_pattern(texts, " ")
    odd = pc.or_(
        pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")),
        pc.or_(pc.ends_with(texts, " "), pc.equal(texts, "")),
    )
    odd = pc.or_(odd, pc.match_substring(texts, MARK))
    if not pc.any(odd).as_py():
        return lists
    rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    mended = pa.array(
        [_marked(t) for t in texts.take(pa.array(rows)).to_pylist()], pa.list_(pa.string())
    )
    order = np.arange(len(texts))
    order[rows] = len(texts) + np.arange(len(rows))
    return pa.concat_arrays([lists, mended]).take(pa.array(order))


def _marked(text: str) -> list[str]:
    if not text:
        return []
    whole = MARK + text.replace(" ", MARK)
    return [s[1:].replace(MARK, " ") for s in _SEGMENT.findall(whole)]
