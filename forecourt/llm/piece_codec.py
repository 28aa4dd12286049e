"""Encode texts to piece ids and decode ids to texts, for merge-type vocabularies.

Words are encoded once per Arrow slice by the score-ordered agenda; each new
word's ids are compared with the sentencepiece library's, and it must come back from them. Pieces'
texts are compared with the library's once, and words with bytes for a character each. A
difference ends the task. Ids of whole texts are put together from the words' ids.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.arrow_words import ROOM, Recent, encoded, held, joined, numbered, slices
from forecourt.llm.frames import column, text_or_empty
from forecourt.llm.piece_bpe import MARK, PieceModel, segments

def _codec(proto: bytes) -> Codec:
    return held(("codec", hash(proto)), lambda: Codec(PieceModel(proto)))


class Codec:
    def __init__(self, model: PieceModel):
        self.model = model
        self.inner = Recent(self._merged)  # parts that no word begins with
        self.words = Recent(self._encode_new, room=2 * ROOM)  # merging anew costs more than elsewhere
        self.pieces = pa.array(model.bytes_of, pa.binary())
        self.spaced = np.array([*model.marked, False])
        self.bytes = np.zeros(len(self.spaced), bool)
        self.bytes[model.byte_id] = True
        self._spelled()

    def _spelled(self) -> None:
        """Compare each piece's text with the library's: a text of ordinary pieces is theirs in a row."""
        model = self.model
        pieces = list(model.id.values())
        ours = [model.bytes_of[i].decode()[int(model.marked[i]) :] for i in pieces]
        if ours != model.library.decode([[i] for i in pieces]):
            raise RuntimeError("pieces are spelled otherwise by the sentencepiece library")

    def _merged(self, parts: list[str]) -> list[bytes]:
        return [array("i", self.model.ids(p)).tobytes() for p in parts]

    def _part_ids(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts; those that words begin with may be kept as words."""
        found = {p: self.words.peek(p[1:]) if p[0] == MARK else None for p in parts}
        inner = [p for p in parts if p[0] != MARK]
        found |= zip(inner, self.inner.answers(inner), strict=True)
        unknown = [p for p, x in found.items() if x is None]
        found |= zip(unknown, self._merged(unknown), strict=True)
        return list(found.values())

    def _encode_new(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        cut, first = self.model.parts_of(words)
        numbers, known = numbered(cut)
        lists = joined(self._part_ids(known), numbers, first)
        # A lone mark (the empty word) is no text that the library could be given.
        texts = [w for w in words if w]
        ours = [x for x, w in zip(lists.to_pylist(), words, strict=True) if w]
        if ours != self.model.library.encode(texts, num_threads=1):
            raise RuntimeError("ids differ from those of the sentencepiece library")
        # Every word must come back; those with bytes for a character as the library decodes them.
        if not self.decode(lists).equals(pa.array(words, pa.string())):
            raise RuntimeError("words do not come back from their ids")
        offsets, ids = lists.offsets.to_numpy(), lists.flatten().to_numpy()
        odd = np.searchsorted(offsets, np.flatnonzero(self.bytes[ids]), side="right") - 1
        spelled = [words[i] for i in np.unique(odd).tolist()]
        if spelled and spelled != self.model.library.decode(self.model.library.encode(spelled)):
            raise RuntimeError("decoded texts differ from those of the sentencepiece library")
        raw, at = ids.tobytes(), (offsets * 4).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def encode(self, texts: pa.Array, end: bool) -> pa.ListArray:
        """Ids of each text, with the end id if `end`; no nulls in `texts`."""
        offsets, words, distinct = encoded(segments(texts))
        ids = [*self.words.answers(distinct), np.array([self.model.end_id], np.int32).tobytes()]
        if end:
            words = np.insert(words, offsets[1:], len(distinct))
            offsets = offsets + np.arange(len(offsets))
        return joined(ids, words, offsets)

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids, as the library's decode gives it; no nulls."""
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        ids = lists.flatten()
        spelled = self.pieces.take(ids)
        _, at, data = spelled.buffers()
        at = np.frombuffer(at, np.int32)[spelled.offset :][offsets] if len(ids) else offsets * 0
        texts = pa.Array.from_buffers(
            pa.string(), len(lists), [None, pa.py_buffer(at.astype(np.int32)), data]
        )
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:  # byte pieces that spell no character
            raw = texts.view(pa.binary()).to_pylist()
            texts = pa.array([b.decode("utf-8", "replace_each_byte") for b in raw], pa.string())
        first = np.full(len(lists), -1)
        full = offsets[1:] > offsets[:-1]
        first[full] = ids.to_numpy()[offsets[:-1][full]] if len(ids) else 0
        lead = pa.array(self.spaced[first])  # the mark in front of every text is no space
        return pc.if_else(lead, pc.utf8_slice_codeunits(texts, 1), texts)


def _replace_each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


def _register() -> None:
    import codecs

    codecs.register_error("replace_each_byte", _replace_each_byte)


_register()


def encode(
    df: DataFrame,
    model_path: str,
    key: str = "doc_id",
    text: str = "text",
    end: bool = True,
    decoded: bool = False,
) -> DataFrame:
    """key and `ids` (array of int) of each row's whole text, exactly as the library's.

    `decoded` adds the text that `decode` gives for these ids, made by the same worker.
    A null text counts as empty and has the end id only. Repeated rows and null keys stay. A very
    long text is encoded whole, as a slice of its own, and an empty table gives no rows. Other columns
    play no part, whatever their names.
    """
    with open(model_path, "rb") as file:
        proto = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(proto.value)
        for batch in batches:
            for part in slices(batch, "text"):
                found = {"key": part["key"], "ids": codec.encode(part["text"], end)}
                if decoded:
                    found["decoded"] = codec.decode(found["ids"])
                yield pa.record_batch(found)

    slim = df.select(column(df, key).alias("key"), text_or_empty(df, text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    more = ["decoded"] * decoded
    schema = f"key {kind}, ids array<int>" + ", decoded string" * decoded
    return slim.mapInArrow(run, schema).select(F.col("key").alias(key), "ids", *more)


def decode(df: DataFrame, model_path: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """`df` with the text of each row's ids; null ids give the empty text.

    Ids outside the vocabulary end the task. Control ids spell nothing.
    """
    with open(model_path, "rb") as file:
        proto = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(proto.value)
        for batch in batches:
            lists = pc.fill_null(batch[ids], pa.scalar([], batch[ids].type))
            texts = codec.decode(lists.cast(pa.list_(pa.int32())))
            yield pa.record_batch(
                [*(batch[c] for c in batch.schema.names), texts], [*batch.schema.names, output]
            )

    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*df.schema.fields, StructField(output, StringType())])
    return df.mapInArrow(run, schema)
