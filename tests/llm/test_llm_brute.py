"""Registered queries without SQL against plain Python over whole tables."""

import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forecourt.llm import langid, queries, toxicity
from .test_llm_simhash import brute_fingerprint, brute_groups

SF = "/root/testdata/sf0.001"


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()


def held_out(key):
    return zlib.crc32(str(key).encode()) % 4 == 2


def test_op3_fingerprints_and_groups(spark):
    docs = documents(spark)
    prints = [brute_fingerprint(r.text) for r in docs]
    least = brute_groups(prints)
    want = [(r.doc_id, f"{p:016x}", docs[i].doc_id) for r, p, i in zip(docs, prints, least, strict=True)]
    got = queries.op3_simhash(spark, SF).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == want


def test_op4_parses_every_text_whole(spark):
    docs = documents(spark)
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(rows.filter(~langid.held_out(F.col("doc_id"))))
    automata = {n: langid.SuffixAutomaton(t) for n, t in model.texts.items()}
    got = {r.doc_id: r for r in queries.op4_cross_parsing(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        text = langid.spelled(r.text or "")
        letters = sum(c != " " for c in text)
        found = got[r.doc_id]
        assert found.held_out == held_out(r.doc_id)
        if not letters:
            assert (found.lang_pred, found.score) == ("und", 0)
            continue
        pieces = [text[i : i + langid.PIECE] for i in range(0, len(text), langid.PIECE)]
        cost = {
            n: sum(map(a.phrases, pieces)) * math.log2(model.amount(n)) / letters
            for n, a in automata.items()
        }
        first, second = sorted(cost.values())[:2]
        assert math.isclose(cost[found.lang_pred], first)
        assert math.isclose(found.score, 1 - first / second, abs_tol=1e-12)


def test_op5_every_id_is_packed_once(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packs, pieces = {}, {}
    for r in queries.op5_histogram_packing(spark, SF).collect():
        assert r.length > 0 and r.offset + r.length <= 4096
        packs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert sorted(packs) == list(range(len(packs)))
    for pack in packs.values():
        ends = [0, *(a + n for a, n in sorted(pack))]
        assert [a for a, _ in sorted(pack)] == ends[:-1]
    for r in documents(spark):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        at = 0
        for start, length, crc, total in sorted(pieces.pop(r.doc_id)):
            assert start == at and total == len(ids)
            assert crc == zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    assert not pieces


def test_op7_counts_as_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op7_heap_counts(spark, SF).collect()}
    for r in documents(spark):
        n = len(library.encode(r.text or ""))
        assert got.pop(r.doc_id) == (len((r.text or "").encode()), n, n > 4096)
    assert not got


def plain_prediction(model, text):
    """Severity, chance and grade from the features of a text's words, one by one."""
    known = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    found = {f for word in (text or "").lower().split() for f in toxicity.features(word)}
    score = sum(known.get(f, 0.0) for f in found)
    above = [1 / (1 + math.exp(min(30, max(-30, t - score)))) for t in model.thresholds]
    return sum(above), above[0], sum(p >= 0.5 for p in above)


def test_op10_predictions_follow_the_model(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    labelled = toxicity.graded(spark.read.parquet(f"{sf}/labels.parquet"))
    model = toxicity.fit(labelled.filter(~langid.held_out(F.col("key"))), rows)
    assert len(model.buckets) and (np.diff(model.thresholds) > 0).all() and (model.weights >= 0).all()
    got = {r.doc_id: r for r in queries.op10_ordinal_toxicity(spark, sf).collect()}
    for r in documents(spark, sf):
        severity, chance, grade = plain_prediction(model, r.text)
        found = got.pop(r.doc_id)
        assert math.isclose(found.severity, severity, rel_tol=1e-6, abs_tol=1e-9)
        assert math.isclose(found.toxic_chance, chance, rel_tol=1e-6, abs_tol=1e-9)
        assert (found.grade, found.toxic) == (grade, grade > 0)
    assert not got


def test_op10_sample_has_one_row_per_key(spark):
    docs = spark.createDataFrame([(1, f"text number {i}") for i in range(500)] + [(2, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    table = toxicity.sample(toxicity.graded(labels), docs, "doc_id", "text", 10).toArrow()
    assert table.num_rows == 2 and pa.types.is_list(table.schema.field("features").type)
