"""Registered queries of the corpus operators: thin readings of the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import (
    bitslice,
    decontaminate,
    hard_negatives,
    langid,
    packing,
    piece_codec,
    resample,
    sharding,
    simhash,
    stream_dedup,
    token_counts,
    toxicity,
    warc,
)
from forecourt.llm.frames import text_or_empty

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of row counts at most one apart, each like the mixture.

    The method cuts by rows and keeps no group together, so equal texts may lie in any shard.
    """
    docs = _table(spark, sf_dir, "documents")
    text = text_or_empty(docs, "text")
    slim = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.interleave(slim, 40).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equal texts."""
    found = stream_dedup.dedup(spark, f"{sf_dir}/documents.parquet")
    return found.select(
        F.col("row.key").alias("doc_id"),
        F.col("keep.key").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the group it belongs to."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select(
        F.col("key").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    predict = langid.predictor(spark, model)
    text = F.col("text").cast("string")
    found = docs.select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), predict(text).alias("p")
    )
    return found.select(
        "doc_id",
        "held_out",
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
    )


def op5_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces in sequences of at most 4096 ids."""
    vocabulary = tokenizer_path("word_bpe_49k.json")
    pieces = packing.tokenized_pieces(_table(spark, sf_dir, "documents"), vocabulary)
    return packing.pack(pieces).withColumnRenamed("key", "doc_id")


def op6_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other rows for every row whose id is divisible by 20."""
    found = bitslice.nearest(_table(spark, sf_dir, "embeddings"), F.col("key") % 20 == 0, k=20)
    return found.select(
        F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score"
    )


def op7_heap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = _table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, tokenizer_path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op8_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back from them."""
    found = warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages")))
    return found.select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    model = tokenizer_path("piece_bpe_32k.model")
    both = piece_codec.encode(_table(spark, sf_dir, "documents"), model, decoded=True)
    spelled = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spelled, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, learned from labelled ones that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    labelled = toxicity.graded(_table(spark, sf_dir, "labels"))
    model = toxicity.fit(labelled.filter(~langid.held_out(F.col("key"))), docs)
    predict = toxicity.predictor(spark, model)
    found = docs.select("doc_id", predict(F.col("text").cast("string")).alias("p"))
    return found.select(
        "doc_id",
        F.col("p.severity").alias("severity"),
        F.col("p.chance").alias("toxic_chance"),
        F.col("p.grade").alias("grade"),
        (F.col("p.grade") > 0).alias("toxic"),
    )


def op11_automaton_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages of benchmark items, and those items."""
    found = decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_median_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance weight and score, and the rank of those drawn."""
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return resample.resample(docs, target).drop("n_words")


def op13_sorted_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 50; some labels are made wrong first."""
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    found = hard_negatives.mine(vectors, F.col("id") % 50 == 0, label)
    return found.withColumnsRenamed(
        {"anchor": "anchor_id", "positive": "positive_id", "negative": "negative_id"}
    )


def all_queries() -> dict[str, Query]:
    return {
        "op1_interleave": op1_interleave,
        "op2_stream_dedup": op2_stream_dedup,
        "op3_simhash": op3_simhash,
        "op4_cross_parsing": op4_cross_parsing,
        "op5_histogram_packing": op5_histogram_packing,
        "op6_bit_sliced": op6_bit_sliced,
        "op7_heap_counts": op7_heap_counts,
        "op8_dictionary_warc": op8_dictionary_warc,
        "op9_piece_codec": op9_piece_codec,
        "op10_ordinal_toxicity": op10_ordinal_toxicity,
        "op11_automaton_decontamination": op11_automaton_decontamination,
        "op12_median_resampling": op12_median_resampling,
        "op13_sorted_negatives": op13_sorted_negatives,
    }


def all_oracles() -> dict[str, str]:
    from forecourt.llm.oracle import ORACLES

    return dict(ORACLES)
