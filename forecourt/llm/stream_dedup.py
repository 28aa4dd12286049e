"""Exact deduplication of a stream of documents with keyed state on disk.

A file stream is folded into state keyed by the digest of the normalised text. State
lives in RocksDB stores, checkpointed to the shared folder, and never expires: per
digest it keeps how many rows had it, the largest identifier, and where that row's
content lies (file and row number). The state is read back with Spark's state reader.

Digests that more than one row has are hits. Whether the texts of a hit are equal is
found by grouping all rows by digest and whole text, combined before the shuffle:
moving every distinct text once costs the same at every size, while moving only texts of hits
needs their digests in every task. A digest with two different texts is split into classes
by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.frames import ascii_lower, column, text_or_empty
from forecourt.staging import new_path, stage

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

#: Many small stores: RocksDB must not reserve 4 MB of disk for each one's manifest.
STATE_CONF = {
    PROVIDER: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(df: DataFrame, text: str) -> Column:
    """The text two rows must share: A-Z lower-cased, null as empty."""
    return ascii_lower(text_or_empty(df, text))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def located(df: DataFrame, key: str, text: str, digest, full: bool = False) -> DataFrame:
    """digest, identifier and content locator of the rows of a Parquet source.

    `full` adds the normalised text itself.
    """
    body = normalised(df, text)
    return df.select(
        digest(body).alias("digest"),
        *[body.alias("full")] * full,
        F.struct(
            column(df, key).alias("key"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ).alias("row"),
    )


def _pattern(path: str) -> str:
    """The path as a pattern that only it matches: streams take single files only by pattern."""
    folder, slash, name = path.rstrip("/").rpartition("/")
    whole = "".join(f"\\{c}" if c in "\\{}[]*?," else c for c in f"{folder}{slash}{name[:-1]}")
    return f"{whole}[{name[-1]}]"


def fold(
    spark: SparkSession,
    path: str,
    key: str,
    text: str,
    digest,
    batch_bytes: int,
    checkpoint: str | None = None,
) -> str:
    """Run the stream over all files under `path`; returns the state's checkpoint folder.

    `batch_bytes` of files go into each micro-batch. The stream ends when it has read the files
    there are; given the checkpoint of an earlier run, it goes on with files that are new.
    """
    schema = spark.read.parquet(path).schema
    checkpoint = checkpoint or new_path(spark, "dedup-state")
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        stream = (
            spark.readStream.schema(schema)
            .option("maxBytesPerTrigger", batch_bytes)
            .parquet(_pattern(path))
        )
        query = (
            located(stream, key, text, digest)
            .groupBy("digest")
            .agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("keep"))
            .writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return checkpoint


def state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, number of rows, and the identifier and locator of the row that stays."""
    stored = spark.read.format("statestore").load(checkpoint)
    count, keep = stored.schema["value"].dataType.names
    return stored.select(
        F.col("key.digest").alias("digest"),
        F.col(f"value.{count}").alias("n"),
        F.col(f"value.{keep}").alias("keep"),
    )


def dedup(
    spark: SparkSession,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    digest=sha256,
    batch_bytes: int = 100_000_000_000,
    checkpoint: str | None = None,
) -> DataFrame:
    """One row per row of the Parquet table at `path`: `row` (key, file, row), digest, keep, n.

    Equal texts form a group; `keep` is its row with the largest key (ties: the later file
    or row), `n` its size. Null and empty texts are equal. A null key is smaller than any other.
    An empty table gives no rows. `digest` maps a text column to a digest column; a weak one
    costs time but no result. A very long text is shuffled whole, once. Other columns play no part,
    whatever their names. With the `checkpoint` of an earlier call, files that were folded then are
    not folded again.
    """
    if spark.read.parquet(path).isEmpty():
        empty = located(spark.read.parquet(path), key, text, digest)
        return empty.withColumns({"keep": F.col("row"), "n": F.lit(1).cast("long")})
    seen = stage(
        state(spark, fold(spark, path, key, text, digest, batch_bytes, checkpoint)), "dedup-seen"
    )
    rows = located(spark.read.parquet(path), key, text, digest)
    joined = rows.join(seen, "digest")

    # Whole texts meet by digest and text, which is combined before the shuffle, so a group of copies sends
    # one text per task. A digest with two of them is split into classes.
    texts = located(spark.read.parquet(path), key, text, digest, full=True)
    distinct = texts.select("digest", "full").distinct()
    clashes = distinct.groupBy("digest").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    clashing = stage(clashes.select("digest"), "dedup-clashes")
    if clashing.isEmpty():
        return joined
    both = texts.join(clashing, "digest", "left_semi")
    classes = both.groupBy("digest", "full").agg(
        F.count(F.lit(1)).alias("n"), F.max("row").alias("keep")
    )
    split = both.join(classes, ["digest", "full"])
    return joined.join(clashing, "digest", "left_anti").unionByName(split.drop("full"))
