"""Streaming exact deduplication."""

from pyspark.sql import functions as F

from forecourt.llm import stream_dedup


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    """Key that stays and size, by normalised text."""
    found = {}
    for r in rows:
        keys, n = found.get(lower(r.text), ([], 0))
        found[lower(r.text)] = (keys + [r.doc_id] * (r.doc_id is not None), n + 1)
    return {t: (max(k, default=None), n) for t, (k, n) in found.items()}


def check(docs, path, **options):
    rows = docs.collect()
    want = expected(rows)
    got = stream_dedup.dedup(docs.sparkSession, path, **options).collect()
    texts = {r.doc_id: lower(r.text) for r in rows}
    assert sorted(str(r.row.key) for r in got) == sorted(str(r.doc_id) for r in rows)
    for r in got:
        assert (r.keep.key, r.n) == want[texts[r.row.key]]
    assert sum(r.row == r.keep for r in got) == len(want)


def test_odd_tables(spark, saved, odd_docs, no_docs, tmp_path):
    check(saved(odd_docs), f"{tmp_path}/documents.parquet")
    saved(no_docs, "none")
    assert stream_dedup.dedup(spark, f"{tmp_path}/none.parquet").collect() == []


def test_many_micro_batches_and_a_single_file(spark, saved, odd_docs, tmp_path):
    check(saved(odd_docs.repartition(5)), f"{tmp_path}/documents.parquet", batch_bytes=1)
    file = odd_docs.sparkSession.read.parquet(f"{tmp_path}/documents.parquet").inputFiles()[0]
    check(spark.read.parquet(file), file)


def test_equal_digests_of_different_texts_are_told_apart(saved, odd_docs, tmp_path):
    docs = saved(odd_docs)
    weak = lambda text: (F.length(text) % 2).cast("string")
    check(docs, f"{tmp_path}/documents.parquet", digest=weak)


def test_names_that_are_patterns(spark, odd_docs, tmp_path):
    for name in ("a b,c.parquet", "{x}[y]*?.parquet", "50%20.parquet"):
        odd_docs.write.parquet(f"{tmp_path}/{name.replace('*', '+').replace('?', '!')}")
        path = f"{tmp_path}/{name.replace('*', '+').replace('?', '!')}"
        if not any(c in name for c in "{["):  # those Spark's batch reader takes as patterns
            check(spark.read.parquet(path), path)


def test_a_second_run_goes_on_with_new_files(spark, odd_docs, tmp_path):
    path, state = f"{tmp_path}/documents.parquet", f"{tmp_path}/state"
    odd_docs.write.parquet(path)
    check(spark.read.parquet(path), path, checkpoint=state)
    odd_docs.write.mode("append").parquet(path)
    check(spark.read.parquet(path), path, checkpoint=state)


def test_session_settings_come_back(spark, saved, odd_docs, tmp_path):
    before = {k: spark.conf.get(k, None) for k in stream_dedup.STATE_CONF}
    saved(odd_docs)
    stream_dedup.dedup(spark, f"{tmp_path}/documents.parquet")
    assert {k: spark.conf.get(k, None) for k in stream_dedup.STATE_CONF} == before
