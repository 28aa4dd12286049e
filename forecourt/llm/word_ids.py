"""Token ids of a vocabulary that drops white space, each distinct word encoded once per slice.

Such a vocabulary's tokens never span white space, so a text's ids are those of its words.
New words of characters below U+0100 are split as the vocabulary says and given to the tokenizers
library's model; its steps before that only lower-case them, as no two of these characters compose
and each has one lower-case form below U+0100. Other new words go through the whole
library as one text with a special token between them, as every stretch between special tokens is
encoded on its own. Texts that hold the start of a special string go to the library whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from forecourt.llm.arrow_words import Recent, encoded, joined

JOINED = 4_000  # words in one call

# The normalisation and the splitting that the argument above rests on.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# The same splitting for printable characters below U+0100 in lower case: letters are a to z, three
# signs, and ß to ÿ but ÷; numbers are digits, superscripts and fractions.
_LETTER, _NUMBER = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
_SHORT = re.compile("[!-~¡-¬®-ÿ]*")
_PLAIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}]+")

# The model sees bytes, written as characters: printable ones as themselves, the others in order
# from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE = {b: chr(b) for b in _SHOWN}
_BYTE |= {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _BYTE)}
_SPELLED = {c: "".join(_BYTE[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}


def _lowered(words: pa.Array) -> pa.Array:
    """Words that are wholly ASCII in lower case.

    Others stay as they are, as normalisation may compose their capitals before it lower-cases.
    """
    ascii_ = pc.equal(pc.binary_length(words), pc.utf8_length(words))
    return pc.if_else(ascii_, pc.ascii_lower(words), words)


class WordIds:
    def __init__(self, vocabulary: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if spec["normalizer"] != NORMALIZER or split["pattern"] != {"Regex": SPLIT}:
            raise ValueError("a vocabulary that lower-cases and drops white space is needed")
        added = spec["added_tokens"][0]
        self.between, self.between_id = added["content"], added["id"]
        self.mark = os.path.commonprefix([t["content"] for t in spec["added_tokens"]])
        if not self.mark:
            raise ValueError("special strings must begin alike")
        self.library = Tokenizer.from_str(vocabulary.decode())
        self.words = Recent(self._new)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.int32) for e in found]

    def _spelled(self, stretches: list[str]) -> list[bytes]:
        """Ids of stretches of lower-case letters, or a number, or other characters."""
        spell = self.library.model.tokenize
        spelled = (s if s.isascii() else s.translate(_SPELLED) for s in stretches)
        return [np.array([t.id for t in spell(s)], np.int32).tobytes() for s in spelled]

    def _new(self, words: list[str]) -> list[bytes]:
        split = {w: _PLAIN.findall(w.lower()) for w in words if _SHORT.fullmatch(w)}
        # Most stretches are words too, with an answer that is kept.
        ids = {s: self.words.peek(s) for parts in split.values() for s in parts}
        unknown = [s for s, x in ids.items() if x is None]
        ids |= zip(unknown, self._spelled(unknown), strict=True)
        found = {w: ids[parts[0]] if len(parts) == 1 else b"".join([ids[s] for s in parts]) for w, parts in split.items()}
        others = [w for w in words if w not in found]
        for start in range(0, len(others), JOINED):
            some = others[start : start + JOINED]
            found |= zip(some, self._one_by_one(some), strict=True)
        return [found[w] for w in words]

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        ids = self._library([self.between.join(words)])[0]
        cuts = np.flatnonzero(ids == self.between_id)
        if len(cuts) != len(words) - 1:
            raise RuntimeError("words do not come back one by one")
        bounds = zip([0, *(cuts + 1)], [*cuts, len(ids)], strict=True)
        return [ids[a:b].tobytes() for a, b in bounds]

    def ids(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """Ids of each text and the end id; no nulls in `texts`."""
        special = pc.match_substring(texts, self.mark)
        plain = pc.if_else(special, "", texts)
        spaced = pc.replace_substring(plain, "\n", " ")
        # A mark between a letter and a space is a stretch of its own: most words come with and without.
        spaced = pc.replace_substring_regex(spaced, "([A-Za-z])([.,;:!?]) ", "\\1 \\2 ")
        offsets, words, distinct = encoded(pc.split_pattern(spaced, " "), _lowered)
        each = [*self.words.answers(distinct), np.array([end_id], np.int32).tobytes()]
        rows = np.flatnonzero(special.to_numpy(zero_copy_only=False))
        each += [x.tobytes() for x in self._library([texts[int(i)].as_py() for i in rows])]
        # After each text's words stands its end; a special text's one empty word is replaced.
        words = words.astype(np.int64)
        words[offsets[rows]] = len(distinct) + 1 + np.arange(len(rows))
        words = np.insert(words, offsets[1:], len(distinct))
        offsets = offsets + np.arange(len(offsets))
        return joined(each, words, offsets)
