"""Language identification and toxicity: parsers by brute force, models by held-out rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.llm import langid, toxicity
from forecourt.llm.queries import op4_cross_parsing, op10_ordinal_toxicity


def spelled(n, letters):
    """The n-th word over some letters."""
    return "".join(letters[n // len(letters) ** i % len(letters)] for i in range(4))


def brute_phrases(word, texts):
    i = count = 0
    while i < len(word):
        n = 0
        while i + n < len(word) and any(word[i : i + n + 1] in t for t in texts):
            n += 1
        i, count = i + max(n, 1), count + 1
    return count


def test_automaton_finds_longest_matches():
    rng = random.Random(1)
    for _ in range(1500):
        texts = ["".join(rng.choices("abc ", k=rng.randint(1, 8))) for _ in range(4)]
        word = "".join(rng.choices("abcd ", k=rng.randint(0, 10)))
        automaton = langid.SuffixAutomaton(texts)
        assert automaton.phrases(word) == brute_phrases(word, texts), (word, texts)


def test_parser_by_hand():
    model = langid.learn([("xx", "aba abc"), ("yy", "ddd dede"), ("zz", "12 !")])
    assert list(model.texts) == ["xx", "yy"] and model.texts["xx"] == [" aba abc "]
    parser = langid.Parser(model)
    names, score, fits = parser.predict(pa.array(["aba", "DED 12", "", "5 !", "éééé", "a"]))
    assert names[:4] == ["xx", "yy", "und", "und"]
    assert score[2] == 0 and (score >= 0).all() and (score <= 1).all()
    assert fits.tolist() == [True, True, False, False, False, False]


TEXTS = st.text("abcdE é1.\n日", max_size=40)


@settings(max_examples=150, deadline=None)
@given(
    st.dictionaries(st.sampled_from("xyz"), st.lists(TEXTS, min_size=1, max_size=3), min_size=1),
    st.lists(TEXTS, min_size=1, max_size=5),
    st.sampled_from([5, 2048]),
    st.booleans(),
)
def test_whole_texts_are_parsed_as_by_brute_force(samples, texts, piece, dense):
    """Phrases cross words; the language with the least cost wins, the first one of equal ones."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid, "PIECE", piece)
        patch.setattr(langid, "DENSE", langid.DENSE if dense else 0)
        model = langid.learn([(n, t) for n, some in samples.items() for t in some])
        parser = langid.Parser(model)
        names, score, fits = parser.predict(pa.array(texts, pa.string()))
    for text, name, one, fit in zip(texts, names, score, fits, strict=True):
        whole = langid.spelled(text)
        letters = sum(c != " " for c in whole)
        if not letters or not model.texts:
            assert (name, one, fit) == ("und", 0, False)
            continue
        if whole == "  ":
            whole = " "
        pieces = [whole[i : i + piece] for i in range(0, len(whole), piece)]
        counts = {n: sum(brute_phrases(p, t) for p in pieces) for n, t in model.texts.items()}
        cost = {n: k * np.log2(max(2, model.amount(n))) / letters for n, k in counts.items()}
        least = min(cost.values())
        assert np.isclose(cost[name], least) and fit == (counts[name] <= letters)
        assert name == min(n for n in cost if np.isclose(cost[n], least, rtol=1e-12))
        rest = sorted(cost.values())[1:]
        assert np.isclose(one, 1 - least / max(rest[0], 1e-12) if rest else 1)


def test_many_labels_are_learned_from_smaller_samples(spark):
    rows = [(i, " ".join(spelled(i * 400 + k, "abcdefghij") for k in range(400)), f"l{i}") for i in range(320)]
    rows += [(i, "few words", f"rare{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.texts) == langid.MAX_LANGUAGES and not any(n.startswith("rare") for n in model.texts)
    assert all(0 < model.amount(n) <= langid.LEAST_CHARS + 2 for n in model.texts)
    found = predicted(spark, df.filter("doc_id < 3"), langid.predictor(spark, langid.fit(df, max_languages=5)))
    assert len(found) == 6


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = op4_cross_parsing(spark, sf).join(truth, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def predicted(spark, docs, make):
    return docs.select("doc_id", "text", make(F.col("text")).alias("p")).collect()


def test_odd_tables(spark, odd_docs, no_docs):
    model = langid.fit(odd_docs)
    assert set(model.texts) == {"en"}
    rows = predicted(spark, odd_docs, langid.predictor(spark, model))
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert r.p.lang == ("en" if letters else "und") and r.p.score == float(letters)
    nothing = langid.fit(no_docs)
    assert {r.p.lang for r in predicted(spark, odd_docs, langid.predictor(spark, nothing))} == {"und"}
    assert predicted(spark, no_docs, langid.predictor(spark, model)) == []

    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    graded = toxicity.graded(labels)
    assert sorted(map(tuple, graded.collect())) == [(4, 1), (5, 0)]
    for fitted in (toxicity.fit(graded, odd_docs), toxicity.fit(graded.limit(0), odd_docs)):
        rows = predicted(spark, odd_docs, toxicity.predictor(spark, fitted))
        assert len(rows) == odd_docs.count() and all(0 <= r.p.severity <= 2 for r in rows)
        assert predicted(spark, no_docs, toxicity.predictor(spark, fitted)) == []
    assert {r.p.grade for r in rows} == {0}


def test_languages_of_long_short_repeated_and_null_texts(spark):
    words = lambda letters, n: [spelled(i, letters) for i in range(n)]
    book = " ".join(words("αβγδεζηθ", 3000))
    rows = [(i, f"{book} {i}", "long") for i in range(3)]
    rows += [(i, w, "short") for i, w in enumerate(words("abcdefgh", 600))]
    rows += [(7, None, "short")] * 600 + [(7, "12 !", "short")] * 600
    rows += [(8, "日本" * 5000, "unspaced"), (None, "жзик", "no key")]
    rows += [(9, f"{'1 ' * 9000} {w}", "digits") for w in words("ijklmnop", 50)]
    rows += [(9, "xyz", "copies")] * 3000 + [(9, w, "copies") for w in words("qrstuvwx", 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert set(model.texts) == {"long", "short", "unspaced", "no key", "digits", "copies"}
    learned = {n: set(" ".join(t).split()) for n, t in model.texts.items()}
    assert learned["long"] <= set(words("αβγδεζηθ", 3000)) and model.amount("long") > 15_000
    assert learned["short"] == set(words("abcdefgh", 600))
    assert learned["digits"] == set(words("ijklmnop", 50))
    assert learned["copies"] == {"xyz", *words("qrstuvwx", 900)}
    few = langid.fit(df, sample_chars=400)
    assert set(few.texts) == set(model.texts)
    for name in few.texts:
        # A space is put around each text.
        assert sum(len(t) - 2 for t in few.texts[name]) <= 400
        assert few.amount(name) >= min(model.amount(name), 300)


def test_toxic_rows_that_were_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("toxic").alias("y"))
    found = op10_ordinal_toxicity(spark, sf).join(labels, "doc_id")
    rows = found.filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).collect()
    toxic, clean = [r for r in rows if r.y], [r for r in rows if not r.y]
    assert sum(r.toxic for r in toxic) / len(toxic) > 0.75  # few labels; 0.99 with 15,000
    assert sum(r.toxic for r in clean) / len(clean) < 0.005
    assert np.mean([r.severity for r in toxic]) > 20 * np.mean([r.severity for r in clean])


def test_slopes_of_the_likelihood():
    rng = np.random.default_rng(2)
    grades, score, t = rng.integers(0, 4, 30), rng.normal(0, 1, 30), np.array([-1.0, 0.2, 1.5])

    def loss(t, score):
        p = 1 / (1 + np.exp(t - score[:, None]))
        padded = np.concatenate([np.ones((30, 1)), p, np.zeros((30, 1))], axis=1)
        at = np.arange(30)
        return -np.log(padded[at, grades] - padded[at, grades + 1]).sum(), p

    _, p = loss(t, score)
    d_t, d_score = toxicity._gradient(p, None, grades, 3)
    for k in range(3):
        step = np.eye(3)[k] * 1e-6
        assert np.isclose((loss(t + step, score)[0] - loss(t - step, score)[0]) / 2e-6, d_t[k], atol=1e-4)
    for i in range(5):
        step = np.eye(30)[i] * 1e-6
        slope = (loss(t, score + step)[0] - loss(t, score - step)[0]) / 2e-6
        assert np.isclose(slope, d_score[i], atol=1e-4)
