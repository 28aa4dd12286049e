"""Registered corpus queries against their SQL; the pipeline against plain steps."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forecourt.llm import simhash
from forecourt.llm.queries import all_oracles, all_queries
from verification.compare import difference

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_matches_its_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    assert difference(all_queries()[name](spark, SF), db, all_oracles()[name]) is None


def test_every_operator_is_registered_once():
    names = list(all_queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (name, step) in enumerate(corpus_pipeline.STAGES[:-1]):
        path = f"{tmp_path}/{i}.parquet"
        step(spark, docs, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns and kept.exceptAll(docs).isEmpty(), name
        assert 0 < kept.count() <= docs.count()
        if name == "exact_dedup":
            lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
            want = docs.groupBy(lower.alias("t")).agg(F.max("doc_id")).drop("t")
            assert sorted(r[0] for r in want.collect()) == sorted(
                r[0] for r in kept.select("doc_id").collect()
            )
        docs = kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}


def test_stages_on_odd_tables(spark, odd_docs, no_docs, tmp_path):
    for i, docs in enumerate((odd_docs, no_docs)):
        for name, step in corpus_pipeline.STAGES:
            path = f"{tmp_path}/{i}-{name}.parquet"
            docs.write.parquet(path)
            before = spark.read.parquet(path)
            docs = step(spark, before, SF)
            if name != "packing":
                assert docs.columns == before.columns
            assert docs.count() <= before.count() or name == "packing"


@pytest.mark.parametrize("folder", ["documents.parquet", "a b,c {d} 50%20.parquet"])
def test_exact_stage_in_any_layout_of_folders(spark, tmp_path, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r[0] for r in docs.groupBy(lower("text")).agg(F.max("doc_id").alias("m")).select("m").collect()}
    docs.write.partitionBy("source").parquet(f"{tmp_path}/by source")
    parted = spark.read.parquet(f"{tmp_path}/by source")
    assert len(parted.inputFiles()) > 1
    flat = tmp_path / folder.replace("{", "(").replace("}", ")")
    docs.write.parquet(str(flat))
    for df in (parted, spark.read.parquet(str(flat))):
        kept = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, df, SF)
        assert kept.columns == df.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def lower(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text if not isinstance(text, str) else F.col(text), F.lit("")), upper, upper.lower())


def test_which_rows_the_duplicate_stages_keep(spark, tmp_path):
    rows = [
        (1, "Same words here"), (5, "same WORDS here"), (None, "same words here"),
        (None, ""), (2, None), (2, ""), (None, None),
        (7, "alone"), (None, "no identifier"), (None, "no identifier"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d.parquet")
    docs = spark.read.parquet(f"{tmp_path}/d.parquet")
    exact, near = (dict(corpus_pipeline.STAGES)[n](spark, docs, SF).collect() for n in ("exact_dedup", "near_dedup"))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in exact) == [
        (False, 2, ""), (False, 5, "same WORDS here"), (False, 7, "alone"), (True, 0, "no identifier"),
    ]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in near) == [
        (False, 1, "Same words here"), (False, 2, ""), (False, 7, "alone"), (True, 0, "no identifier"),
    ]


def test_near_duplicates_caught_by_radius(spark):
    """How many copies with a few changed words each radius finds; the pipeline takes the contract's 2."""
    words = [f"w{i * 7919 % 1000}" for i in range(200)]
    rows = [(0, " ".join(words))]
    for i in range(1, 41):
        rows.append((i, " ".join(f"x{i}" if j == i * 4 else w for j, w in enumerate(words))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    caught = [
        sum(r.component == 0 and r.key > 0 for r in simhash.near_duplicates(docs, shingle=3, radius=r).collect())
        for r in (0, 2, 6, 12)
    ]
    assert caught == sorted(caught) and caught[-1] == 40
