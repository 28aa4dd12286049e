"""Token counts by heap-and-linked-list byte-pair merging, without making identifiers.

A text's count is its number of initial symbols less the number of merges; a character the
vocabulary lacks counts as its bytes. Words are counted once per Arrow slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.arrow_words import Recent, encoded, held, numbered, slices, sums
from forecourt.llm.frames import column, text_or_empty
from forecourt.llm.piece_bpe import PieceModel, segments

def _counter(proto: bytes) -> Recent:
    """Counts of segments."""
    model = PieceModel(proto)
    parts = Recent(lambda new: [model.count(p) for p in new])

    def fill(words: list[str]) -> list[int]:
        if not words:
            return []
        cut, first = model.parts_of(words)
        numbers, known = numbered(cut)
        each = np.array(parts.answers(known), np.int64)
        return sums(each[numbers], first).tolist()

    return Recent(fill)


def counts(texts: pa.Array, counter: Recent) -> np.ndarray:
    offsets, words, distinct = encoded(segments(texts))
    each = np.array(counter.answers(distinct), np.int64)
    return sums(each[words], offsets)


def count_tokens(
    df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, n_bytes and n_tokens of each row's whole text, as the library for the model counts.

    A null text counts as empty: no bytes, no tokens. Repeated rows and null keys stay as they are.
    No begin or end is counted. A very long text is counted whole, as a slice of its own, and an empty
    table gives no rows. Other columns play no part, whatever their names. The model file is read
    once, on the driver.
    """
    with open(model_path, "rb") as file:
        proto = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = held(("counts", hash(proto.value)), lambda: _counter(proto.value))
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.record_batch(
                    {
                        "key": part["key"],
                        "n_bytes": pc.cast(pc.binary_length(part["text"]), pa.int64()),
                        "n_tokens": counts(part["text"], counter),
                    }
                )

    slim = df.select(column(df, key).alias("key"), text_or_empty(df, text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    return slim.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long").select(
        F.col("key").alias(key), "n_bytes", "n_tokens"
    )
