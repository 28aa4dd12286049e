"""Packing by the length histogram, and ids by distinct words."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from forecourt.llm import packing
from forecourt.llm.word_ids import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
WORDS = WordIds(open(PATH, "rb").read())


def library_ids(texts):
    return [e.ids + [2] for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.text(st.characters(exclude_categories=["Cs"]))
        | st.text("ABab '1,.\n\t \x1c\x85")
        | st.text(st.characters(max_codepoint=255))
        | st.sampled_from(["it's 'LL", "a<|endoftext|>b", "<|ENDOFTEXT|>", "<|"]),
        min_size=1,
        max_size=5,
    )
)
def test_any_text_as_the_library_has_it(texts):
    assert WORDS.ids(pa.array(texts, pa.string()), 2).to_pylist() == library_ids(texts)


def test_capitals_without_a_composed_form():
    texts = ["H\u0331alil J\u030cak", "T\u0308 W\u030a\nY\u030a", "h\u0331alil HALIL halil"]
    texts += [f"{chr(c)}{chr(m)}a" for c in range(65, 91) for m in range(0x300, 0x370)]
    assert WORDS.ids(pa.array(texts, pa.string()), 2).to_pylist() == library_ids(texts)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=12))
def test_placements_fill_whole_packs_without_overlap(histogram):
    packs, ranks = {}, {}
    for length, a, b, copies, sequence, offset in packing.placements(histogram, 40):
        ranks.setdefault(length, []).append((a, b))
        for r in range(a, b):
            at = offset + (r - a) % copies * length
            packs.setdefault(sequence + (r - a) // copies, []).append((at, length))
    assert sorted(packs) == list(range(len(packs)))
    for pieces in packs.values():
        end = 0
        for at, length in sorted(pieces):
            assert at == end
            end += length
        assert end <= 40
    for length, n in histogram.items():
        found = sorted(ranks[length])
        assert [a for a, _ in found] == [0] + [b for _, b in found[:-1]] and found[-1][1] == n


def test_little_padding_for_mixed_lengths():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.geometric(1 / 700, 20_000), 4096)
    histogram = dict(zip(*map(list, np.unique(lengths, return_counts=True)), strict=True))
    found = packing.placements(histogram, 4096)
    used = max(s - (a - b) // c for _, a, b, c, s, _ in found)
    assert used >= lengths.sum() / 4096 and lengths.sum() / used / 4096 > 0.995
    assert len(found) < 20_000


def check(docs, capacity):
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    want = sorted(
        (str(d), s, min(capacity, len(i) - s), zlib.crc32(np.array(i[s : s + capacity], "<u4").tobytes()), len(i))
        for (d, _), i in zip(texts, library_ids([t for _, t in texts]), strict=True)
        for s in range(0, len(i), capacity)
    )
    rows = packing.pack(
        packing.tokenized_pieces(docs, PATH, capacity=capacity), capacity
    ).collect()
    got = [(str(r.key), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows]
    assert sorted(got) == want
    packs = {}
    for r in rows:
        packs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(packs) == list(range(len(packs)))
    for pieces in packs.values():
        end = 0
        for at, length in sorted(pieces):
            assert at == end
            end += length
        assert end <= capacity


def test_tables(spark, odd_docs, no_docs):
    check(odd_docs, 4096)
    check(odd_docs, 64)
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), 4096)
    assert packing.pack(packing.tokenized_pieces(no_docs, PATH)).collect() == []


def test_pieces_with_clashing_columns_and_wrong_lengths(spark):
    df = spark.range(50).selectExpr("id", "1 + id % 7 as length", "9 as offset", "9 as part")
    rows = packing.pack(df, 7).collect()
    assert len(rows) == 50 and {r.part for r in rows} == {9}
    with pytest.raises(ValueError, match="lengths"):
        packing.pack(df, 6)
