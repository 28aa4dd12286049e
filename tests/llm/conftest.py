"""Odd tables for every operator, and places to keep them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forecourt.staging import ready

SF = "/root/testdata/sf0.001"
LONG = "Word%d and a few of them. " * 20_000

# Null and empty texts, white space, repeats, ties, special strings, scripts, one very long text.
TEXTS = [
    None,
    "",
    " ",
    "  two  spaces ",
    "plain words here",
    "Plain WORDS here",
    "plain words here",
    "tabs\tand\r\nlines\x0b\x0c",
    "<s> </s> <|endoftext|> <|ENDOFTEXT|>",
    "ÀÉ é é İ Σ",
    "日本語のテキスト 𝒳",
    "123 456 !!",
    "\x00 nul",
    LONG,
]


@pytest.fixture(autouse=True)
def ready_session(spark):
    ready(spark)


@pytest.fixture
def saved(spark, tmp_path):
    """Write a frame as Parquet and read it back."""

    def save(df, name="documents"):
        path = f"{tmp_path}/{name}.parquet"
        df.write.parquet(path)
        return spark.read.parquet(path)

    return save


@pytest.fixture
def odd_docs(spark):
    """Documents with odd texts, a null and a repeated row, and columns that clash with inner ones."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "a") for i, t in enumerate(TEXTS)]
    rows += [(None, None, None, None), rows[4], rows[4]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clashing = "n_chars shard slot key row file fp h part rank stratum digest full keep n grade fits"
    more = clashing.split() + ["length_", "sequence_id", "offset", "start", "place", "c0", "a.b"]
    return df.withColumns({c: F.lit(1) for c in more})


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
