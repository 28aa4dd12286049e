"""Token counts and piece ids against the sentencepiece library."""

import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm import arrow_words, piece_codec, token_counts
from forecourt.llm.arrow_words import Recent, slices
from forecourt.llm.piece_bpe import PieceModel

PATH = public_tokenizers.path("piece_bpe_32k.model")
PROTO = open(PATH, "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=PROTO)
CODEC = piece_codec.Codec(PieceModel(PROTO))
COUNTER = token_counts._counter(PROTO)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])) | st.text(" ▁ab.\n"), max_size=5))
def test_any_text_as_the_library_has_it(texts):
    array = pa.array(texts, pa.string())
    ids = CODEC.encode(array, end=True)
    want = [x + [2] for x in LIBRARY.encode(texts)]
    assert ids.to_pylist() == want
    assert CODEC.decode(ids).to_pylist() == [LIBRARY.decode(x) for x in want]
    assert token_counts.counts(array, COUNTER).tolist() == [len(x) - 1 for x in want]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 500), max_size=8), max_size=4))
def test_any_ids_are_decoded_as_the_library_does(ids):
    got = CODEC.decode(pa.array(ids, pa.list_(pa.int32())))
    assert got.to_pylist() == [LIBRARY.decode(x) for x in ids]


def test_tables(odd_docs, no_docs, spark):
    for docs in (odd_docs, spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
        want = [(d, len(t.encode()), len(LIBRARY.encode(t))) for d, t in rows]
        got = token_counts.count_tokens(docs, PATH).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
        coded = piece_codec.encode(docs, PATH)
        texts = piece_codec.decode(coded, PATH).collect()
        want = [(d, LIBRARY.encode(t) + [2]) for d, t in rows]
        assert sorted(str((r.doc_id, list(r.ids))) for r in texts) == sorted(map(str, want))
        assert sorted(r.decoded for r in texts) == sorted(LIBRARY.decode(i) for _, i in want)
    assert token_counts.count_tokens(no_docs, PATH).collect() == []
    assert piece_codec.encode(no_docs, PATH, decoded=True).collect() == []


def test_the_query_derives_its_digests(spark):
    from forecourt.llm.queries import op9_piece_codec

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in op9_piece_codec(spark, "/root/testdata/sf0.001").collect():
        ids = LIBRARY.encode(texts[r.doc_id]) + [2]
        spelled = " ".join(map(str, ids)).encode()
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(spelled).hexdigest()
        decoded = LIBRARY.decode(ids).encode()
        assert r.decoded_sha256 == hashlib.sha256(decoded).hexdigest()


def test_a_difference_from_the_library_is_an_error(monkeypatch):
    codec = piece_codec.Codec(PieceModel(PROTO))
    monkeypatch.setattr(codec.model, "ids", lambda part: [5])
    with pytest.raises(RuntimeError, match="sentencepiece"):
        codec.encode(pa.array(["words"]), end=False)


def test_slices_and_the_bounded_cache():
    batch = pa.record_batch({"text": ["a" * 10, None, "b" * 50, "", "c"]})
    parts = [s["text"].to_pylist() for s in slices(batch, "text", size=20)]
    assert [t for p in parts for t in p] == batch["text"].to_pylist() and len(parts) > 1
    assert list(slices(batch.slice(0, 0), "text")) == []


def test_cache_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(arrow_words, "STORED", 2)
    asked = []
    room = 2 * arrow_words.ENTRY + 30
    cache = Recent(lambda keys: asked.extend(keys) or [k * 2 for k in keys], room=room)
    for keys in (["a", "b"], ["b", "c"], ["a"], ["d", "e", "f", "g"], ["a"]):
        assert cache.answers(keys) == [k * 2 for k in keys]
        assert len(cache.young) <= 2 and len(cache.old) <= 2
    assert asked[:3] == ["a", "b", "c"]
    long = "x" * (arrow_words.LONGEST + 1)
    assert cache.answers([long]) == [long * 2] and long not in cache.young


def test_texts_without_spaces_fill_no_memory():
    """Twenty thousand words of 3,000 characters each, 9 KB in UTF-8."""
    import psutil

    cache = Recent(lambda keys: [k.encode() for k in keys])
    before = psutil.Process().memory_info().rss
    for start in range(0, 20_000, 400):
        cache.answers([chr(0x4E00 + i % 20_000) * 3000 for i in range(start, start + 400)])
    assert psutil.Process().memory_info().rss - before < 200 << 20


@settings(max_examples=200, deadline=None)
@given(st.text("abcdeéöß日本▁ \n", max_size=60))
def test_merging_by_numbers_gives_the_librarys_ids(text):
    parts, _ = CODEC.model.parts_of([text])
    assert "".join(parts) == "▁" + text.replace(" ", "▁")
    assert [i for p in parts for i in CODEC.model.ids(p)] == LIBRARY.encode(text) or not text
    for p in parts:
        assert CODEC.model.short(p) == CODEC.model.merged(p)[0]
