"""Language identification by cross-parsing with suffix automata.

Per language, a suffix automaton is built over labelled text. A text is parsed into phrases from its
first letter to its last, each phrase the longest stretch that occurs in the language's text, over
words and the spaces between them; the language that needs the fewest phrases, normalised by its
amount of text and the length parsed, wins.

Letters decide: other characters are left out, case is ignored, white space counts as one space.
All texts of an Arrow slice are parsed side by side, one letter of each at a time, with the
automaton's transitions in arrays. So that one long text does not keep the others waiting, texts are
parsed in pieces of PIECE letters: a phrase ends there at the latest.
"""

from __future__ import annotations

import math
import unicodedata
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.arrow_words import held, slices
from forecourt.llm.frames import column

UNKNOWN = "und"
SAMPLE_CHARS = 60_000  # of labelled text per language
SAMPLE_TEXT_CHARS = 6_000  # of one text; longer ones give a stretch of it
TOTAL_CHARS = 600_000  # of all languages: with more than ten, each one's part is smaller,
LEAST_CHARS = 2_000  # but not below this
MAX_LANGUAGES = 300  # those with most labelled text are learned
PIECE = 2048  # letters and spaces parsed in one go
SLICE = 4 << 20  # bytes of text parsed side by side
DENSE = 8 << 20  # entries of a table of transitions, at most

# The characters that are white space.
_SPACES = (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

NO_LETTER, SPACE, FIRST = 0, 1, 2  # codes: a letter that no sample has, a space, and letters of samples


class SuffixAutomaton:
    """All substrings of the words added, as states with one transition per next letter."""

    def __init__(self, words: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        for word in words:
            last = 0
            for letter in word:
                last = self._extend(last, letter)

    def _state(self, length: int, link: int, after: dict[str, int]) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, letter: str, target: int) -> int:
        """The state of the target's shorter strings: the target itself, or a copy of it."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(letter) == target:
            self.next[state][letter] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, letter: str) -> int:
        known = self.next[last].get(letter)
        if known is not None:
            return self._split(last, letter, known)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and letter not in self.next[state]:
            self.next[state][letter] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, letter, self.next[state][letter])
        return new

    def phrases(self, word: str) -> int:
        """How many longest matches the word falls into; an unknown letter is one of its own."""
        count, state, after = 0, 0, self.next
        for letter in word:
            step = after[state].get(letter)
            if step is None and state:
                count += 1
                step = after[0].get(letter)
            if step is None:  # a letter the language does not have
                count += 1
                step = 0
            state = step
        return count + (state != 0)


@dataclass(frozen=True)
class Model:
    """The sample's texts (letters, one space between words and around) by language in name order."""

    texts: dict[str, list[str]]

    def amount(self, language: str) -> int:
        return sum(map(len, self.texts[language]))


def spelled(text: str) -> str:
    """A text's letters in lower case, with one space between its words and around."""
    words = ("".join(filter(str.isalpha, w)) for w in text.lower().split())
    return f" {' '.join(filter(None, words))} "


def learn(samples: Iterable[tuple[str, str]]) -> Model:
    """A model of (language, text) pairs; equal texts of a language count once."""
    texts: dict[str, dict[str, None]] = {}
    for language, text in samples:
        text = spelled(text)
        if text.strip():
            texts.setdefault(language, {})[text] = None
    return Model({n: list(texts[n]) for n in sorted(texts)})


def _stretch(text: Column, most: int) -> Column:
    """The letters of a text and single spaces between its words, `most` characters of them at most.

    A longer text gives whole words from a place that its hash chooses, or, without a space there,
    just characters.
    """
    letters = F.regexp_replace(text, "(?U)[^\\p{L}\\s]+", "")
    spelled = F.trim(F.regexp_replace(letters, "(?U)\\s+", " "))
    n = F.length(spelled)
    start = F.pmod(F.hash(text), F.greatest(n - most, F.lit(0)) + 1) + 1
    piece = F.substring(spelled, start, F.lit(most))
    whole = F.regexp_extract(piece, " (.*) ", 1)
    return F.when(n <= most, spelled).when(whole != "", whole).otherwise(piece)


def _filled(texts: list[tuple[int, str]], sample_chars: int) -> list[str]:
    """In order, the texts that still fit into what is left of `sample_chars`."""
    found, left = [], sample_chars
    for _, text in sorted(texts):
        if len(text) <= left:
            found.append(text)
            left -= len(text)
    return found


def fit(
    df: DataFrame,
    text: str = "text",
    language: str = "lang",
    sample_chars: int = SAMPLE_CHARS,
    max_languages: int = MAX_LANGUAGES,
) -> Model:
    """Learn from a sample of labelled rows: per language, `sample_chars` of letters and spaces at most.

    Distinct texts come in the order of their hash until that is full; of a text with more than
    SAMPLE_TEXT_CHARS a stretch of so many is taken. Rows without label or letters are not learned
    from. Of more than `max_languages` labels those with most text are learned; with more than ten
    labels each one's sample is smaller, TOTAL_CHARS for all together, but LEAST_CHARS at least.
    """
    h = F.shiftrightunsigned(F.xxhash64("text"), 1)
    # Half of all texts have level 0, a quarter level 1, and so on; the least hashes have the highest.
    level = F.floor(-F.log2((h + F.lit(1.0)) / F.lit(2.0**63))).cast("int")
    rows = (
        df.select(
            column(df, language).cast("string").alias("language"),
            column(df, text).cast("string").alias("text"),
        )
        .filter(F.col("language").isNotNull() & F.col("text").rlike("\\p{L}"))
        .select("language", "text", h.alias("h"), level.alias("level"))
    )
    size = F.sum(F.least(F.length("text"), F.lit(SAMPLE_TEXT_CHARS))).alias("size")
    by_level = rows.groupBy("language", "level").agg(size)
    totals = by_level.groupBy("language").agg(F.sum("size").alias("total"))
    largest = totals.orderBy(F.desc("total"), "language").limit(max_languages).select("language")
    sizes: dict[str, dict[int, int]] = {}
    for name, at, n in by_level.join(F.broadcast(largest), "language").collect():
        sizes.setdefault(name, {})[at] = n
    chars = min(sample_chars, max(LEAST_CHARS, TOTAL_CHARS // max(1, len(sizes))))
    most = min(SAMPLE_TEXT_CHARS, chars)

    # The highest level of each language from which on there is enough.
    open_ = {
        name: next((k for k in range(63, 0, -1) if _from(levels, k) >= chars), 0)
        for name, levels in sizes.items()
    }
    sample = []
    while open_:
        least = df.sparkSession.createDataFrame(list(open_.items()), "language string, least int")
        near = (
            rows.join(F.broadcast(least), "language")
            .filter("level >= least")
            .select("language", "h", _stretch(F.col("text"), most).alias("text"))
            .groupBy("language", "h")
            .agg(F.min("text"))
        )
        found: dict[str, list[tuple[int, str]]] = {name: [] for name in open_}
        for name, place, piece in near.collect():
            found[name].append((place, piece))
        short = {}
        for name, texts in found.items():
            n = sum(len(t) for _, t in texts)
            if n < chars and open_[name]:  # copies, or few letters
                fewer = max(1, int(math.log2(chars / max(1, n))))
                short[name] = max(0, open_[name] - fewer)
            else:
                sample += [(name, t) for t in _filled(texts, chars)]
        open_ = short
    return learn(sorted(sample))


def _from(levels: dict[int, int], least: int) -> int:
    return sum(n for at, n in levels.items() if at >= least)


class Transitions:
    """An automaton's transitions in arrays.

    Most states have one transition, kept by state. The others have a row of a table, or, where
    the alphabet is too large for one, sorted numbers of state and letter.
    """

    def __init__(self, automaton: SuffixAutomaton, code: dict[str, int], letters: int):
        after, n = automaton.next, len(automaton.next)
        self.letters = letters
        self.letter, self.target = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        many = [i for i, x in enumerate(after) if len(x) > 1]
        for i, x in enumerate(after):
            if len(x) == 1:
                ((letter, self.target[i]),) = x.items()
                self.letter[i] = code[letter]
        self.root = np.full(letters, -1, np.int32)
        for letter, target in after[0].items():
            self.root[code[letter]] = target
        self.row = np.full(n, -1, np.int32)
        self.table = self.keys = None
        if len(many) * letters <= DENSE:
            self.row[many] = np.arange(len(many))
            self.table = np.full((max(1, len(many)), letters), -1, np.int32)
            for row, i in enumerate(many):
                for letter, target in after[i].items():
                    self.table[row, code[letter]] = target
        else:
            self.row[many] = 0
            pairs = sorted((i * letters + code[x], t) for i in many for x, t in after[i].items())
            self.keys, self.targets = (np.array(c, np.int64) for c in zip(*pairs, strict=True))

    def step(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The state after each letter, -1 where there is none."""
        found = np.where(self.letter[state] == codes, self.target[state], -1)
        row = self.row[state]
        several = np.flatnonzero(row >= 0)
        if self.table is not None:
            found[several] = self.table[row[several], codes[several]]
        elif len(several):
            key = state[several].astype(np.int64) * self.letters + codes[several]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found[several] = np.where(self.keys[at] == key, self.targets[at], -1)
        return found

    def phrases(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many longest matches each piece falls into; `sizes` must not rise."""
        count, state = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int32)
        for i in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -i))  # pieces with more than i letters
            now, here = codes[starts[:n] + i], state[:n]
            then = self.step(here, now)
            ended = np.flatnonzero(then < 0)
            if len(ended):
                again = self.root[now[ended]]
                # The phrase before ends, and a letter that the language lacks is one of its own.
                again[here[ended] == 0] = -1
                count[ended] += (here[ended] != 0).astype(np.int64) + (again < 0)
                then[ended] = np.maximum(again, 0)
            state[:n] = then
        return count + (state != 0)


def _left(codes: np.ndarray, kept: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes that are kept, and where each text's begin among them."""
    before = np.concatenate([[0], np.cumsum(kept, dtype=np.int32)])
    return codes[kept], before[offsets].astype(np.int64)


class Parser:
    def __init__(self, model: Model):
        self.names = list(model.texts)
        alphabet = sorted(set().union(*(set(t) for n in self.names for t in model.texts[n])) - {" "})
        code = {c: i for i, c in enumerate(alphabet, FIRST)} | {" ": SPACE}
        self.letters = len(alphabet) + FIRST
        self.automata = [
            Transitions(SuffixAutomaton(model.texts[n]), code, self.letters) for n in self.names
        ]
        self.weights = np.array([math.log2(max(2, model.amount(n))) for n in self.names])
        # Of every character: its code, or -1 if it is neither letter nor white space.
        self.code = np.full(0x110000, -1, np.int16 if self.letters < 1 << 15 else np.int32)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] == "L":
                self.code[c] = NO_LETTER
        for c, i in code.items():
            self.code[ord(c)] = i
        for c in _SPACES:
            self.code[c] = SPACE

    def codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all texts, each beginning and ending with a space, and where each one's begin."""
        padded = pc.binary_join_element_wise("", pc.utf8_lower(texts), "", " ")
        sizes = pc.utf8_length(padded).to_numpy()
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        # Their text as one string, so that each character is one number.
        whole = "".join(padded.to_pylist()).encode("utf-32-le")
        codes = self.code[np.frombuffer(whole, np.uint32)]
        del padded, whole
        codes, offsets = _left(codes, codes >= 0, offsets)
        # Of spaces in a row the first one stays; every text begins and ends with one.
        kept = np.ones(len(codes), bool)
        kept[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE)
        kept[offsets[:-1]] = True
        return _left(codes, kept, offsets)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score, and whether the winner explains the text; no nulls in `texts`."""
        if not self.names or not len(texts):
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        codes, first = self.codes(texts)
        sizes = np.diff(first)
        letters = np.add.reduceat((codes != SPACE).astype(np.int64), first[:-1])
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = first[owner] + number * PIECE
        lengths = np.minimum(first[owner + 1] - starts, PIECE)
        order = np.argsort(-lengths, kind="stable")
        total = np.zeros((len(texts), len(self.names)), np.int64)
        for i, automaton in enumerate(self.automata):
            found = automaton.phrases(codes, starts[order], lengths[order])
            np.add.at(total[:, i], owner[order], found)
        cost = total * self.weights / np.maximum(letters, 1)[:, None]
        best = cost.argmin(axis=1)
        ranked = np.sort(cost, axis=1)
        if len(self.names) == 1:
            score = np.ones(len(texts))
        else:
            score = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1e-12)
        some = letters > 0
        names = [self.names[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
        fits = some & (total[np.arange(len(texts)), best] <= letters)
        return names, np.where(some, score.clip(0, 1), 0.0), fits


def predictor(spark: SparkSession, model: Model):
    """A function of a text column to struct(lang, score, fits).

    `lang` is a learned language, or und if the text is null or has no letter or nothing was learned.
    `score` is how much fewer phrases the winner needs than the next one, as a part of the latter's;
    0 if und or tied (the first name wins), 1 with a single language. `fits` is false if und, or if
    even the winner needs more phrases than there are letters: no learned language explains the text.
    A long text is parsed whole, and needs some thirty times its size in its worker.
    """
    shared = spark.sparkContext.broadcast(model)
    name = ("languages", uuid.uuid4().hex)

    @F.arrow_udf("lang string, score double, fits boolean")
    def predict(texts: pa.Array) -> pa.Array:
        parser = held(name, lambda: Parser(shared.value))
        batch = pa.record_batch({"text": pc.fill_null(texts, "")})
        parts = [parser.predict(p["text"]) for p in slices(batch, "text", SLICE)]
        columns = [
            pa.array([x for p in parts for x in p[0]], pa.string()),
            pa.array([x for p in parts for x in p[1]], pa.float64()),
            pa.array([x for p in parts for x in p[2]], pa.bool_()),
        ]
        return pa.StructArray.from_arrays(columns, ["lang", "score", "fits"])

    return predict


def held_out(key: Column) -> Column:
    """Every fourth row by a checksum of its key is not learned from; null keys are not either."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(True))
