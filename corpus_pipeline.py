"""The corpus pipeline: toxicity, language, exact and near duplicates, packing.

Each stage gets what the stage before kept, as a table read from Parquet, works on all of it, and
returns the columns it got; the last returns packed pieces. Rows are told apart by where they lie
(file and row number), so repeated identifiers or null ones do no harm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import langid, packing, simhash, stream_dedup, toxicity
from forecourt.llm.frames import column, free_name
from forecourt.llm.queries import tokenizer_path
from forecourt.staging import new_path, ready, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHINGLE = 3
RADIUS = 2


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected grade does not reach toxic; null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(toxicity.graded(labels), docs)
    grade = free_name(docs, "grade")
    predict = toxicity.predictor(spark, model)
    found = docs.withColumn(grade, predict(F.col("text").cast("string"))["grade"])
    return found.filter(F.col(grade) == 0).drop(grade)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language.

    Texts without letters (null and empty ones too) go, and texts that even the best language
    explains no better than letter by letter. If no language could be learned, all stay.
    """
    model = langid.fit(docs)
    if not model.texts:
        return docs
    fits = free_name(docs, "fits")
    predict = langid.predictor(spark, model)
    found = docs.withColumn(fits, predict(F.col("text").cast("string"))["fits"])
    return found.filter(F.col(fits)).drop(fits)


def _place(df: DataFrame) -> DataFrame:
    """The columns of a table read from Parquet, then where each row lies."""
    file, row = free_name(df, "file"), free_name(df, "row")
    return df.select(
        *[column(df, c) for c in df.columns],
        F.col("_metadata.file_path").alias(file),
        F.col("_metadata.row_index").alias(row),
    )


def _keep(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of `docs` whose place (file, row) is in `kept`."""
    placed = _place(docs)
    file, row = placed.columns[-2:]
    kept = kept.select(F.col("file").alias(file), F.col("row").alias(row))
    return placed.join(kept, [file, row], "left_semi").select(
        *[column(placed, c) for c in docs.columns]
    )


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest identifier.

    Null and empty texts are equal. A null identifier is smaller than any other; of rows that share one, the
    later file or row stays. Texts are staged with their places first, so the stream meets the
    same files however the table is laid out in folders. An empty table stays empty.
    """
    if docs.isEmpty():
        return docs
    path = new_path(spark, "texts")
    place = F.struct(
        F.col("doc_id").alias("id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    docs.select(place.alias("place"), "text").write.parquet(path)
    found = stream_dedup.dedup(spark, path, key="place")
    kept = found.filter(F.col("row") == F.col("keep"))
    return _keep(docs, kept.select("row.key.file", "row.key.row"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest identifier.

    A null identifier is larger than any other; of rows that share one, the earlier file or row
    stays. Texts without words are near duplicates of each other. An empty table stays empty.
    """
    if docs.isEmpty():
        return docs
    key = F.struct(
        F.col("doc_id").isNull().alias("unknown"),
        F.col("doc_id").alias("id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    found = simhash.near_duplicates(docs, key, shingle=SHINGLE, radius=RADIUS)
    kept = found.filter(F.col("key") == F.col("component")).select("key.file", "key.row")
    return _keep(docs, kept)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, in sequences of at most 4096 ids.

    A null or empty text is one piece, its end id; a long text is cut into several. Repeated rows
    are packed each by itself. An empty table gives no pieces.
    """
    pieces = packing.tokenized_pieces(docs, tokenizer_path("word_bpe_49k.json"))
    return packing.pack(pieces).withColumnRenamed("key", "doc_id")


def _ready(step: Stage) -> Stage:
    """The stage, on a session that has a checkpoint folder and workers that find the library."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ready(spark)
        return step(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _ready(toxicity_stage)),
    ("language", _ready(language_stage)),
    ("exact_dedup", _ready(exact_stage)),
    ("near_dedup", _ready(near_stage)),
    ("packing", _ready(packing_stage)),
]

#: SQL expresses none of the learned stages, nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
