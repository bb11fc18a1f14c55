"""Token ids of whole texts with a word cache, for a vocabulary whose words are encoded independently.

Encoding a word costs far more than finding it, so texts are split into the tokenizer's words and these are numbered in
Arrow, and each worker keeps the ids of the words that it has met lately, in a bounded number.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: Words that a worker keeps at most, in each of two generations.
MAX_WORDS = 100_000
#: Bytes of text that are split at a time.
SLICE_BYTES = 4 << 20
#: Texts with this are given to the tokenizer as they are: special tokens are found before any split.
SPECIAL = "<|"
#: Classes and cases of these characters differ between libraries; texts with them are split at white space only, and the
#: tokenizer does the rest.
BEYOND_LATIN = r"[^\x00-\x{24f}]|\x{130}"
#: What ends a run of letters, as the vocabulary file states: contractions, single numbers, runs of other characters.
NOT_LETTERS = r"('s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\p{L}\p{N}\v\x{85}\x{a0}]+)"
#: White space that an ASCII split does not know.
OTHER_SPACE = "[\x85\xa0]"
#: Byte-level vocabularies write printable bytes as their Latin-1 characters, and the others, in order, from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_ALPHABET = {byte: 256 + i for i, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def pack(ids: list[int]) -> bytes:
    """Unsigned 32-bit numbers."""
    return array("I", ids).tobytes()


class Recent(dict):
    """A dictionary that computes missing values and forgets what was not asked for in a whole generation."""

    def __init__(self, compute: Callable[[str], Any], most: int):
        super().__init__()
        self.compute, self.most, self.older = compute, most, {}

    def __missing__(self, key: str) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class CachedTokenizer:
    """Ids of whole texts."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = Recent(self._word, MAX_WORDS)
        self.chunks = Recent(self._whole, MAX_WORDS)

    def _whole(self, text: str) -> bytes:
        return pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        # The steps before the model are done: what is left is to write the word's bytes in the byte alphabet.
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(BYTE_ALPHABET)
        return pack([token.id for token in self.model.tokenize(word)])

    def _latin(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        apart = pc.replace_substring_regex(pc.utf8_lower(texts), NOT_LETTERS, r" \1 ")
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(apart, OTHER_SPACE, " "))
        coded = split.values.dictionary_encode()
        found = [self.words[word] if word else b"" for word in coded.dictionary.to_pylist()]
        lengths = np.fromiter(map(len, found), dtype="int64", count=len(found)) // 4
        ids = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(lengths))).astype("int32"), np.frombuffer(b"".join(found), dtype="uint32"))
        ends = np.concatenate(([0], np.cumsum(lengths[coded.indices.to_numpy()])))[split.offsets.to_numpy()]
        return ids.take(coded.indices).flatten().to_numpy(), ends

    def _other(self, text: str) -> np.ndarray:
        ids = self._whole(text) if SPECIAL in text else b"".join(map(self.chunks.__getitem__, regex.findall(r"[^ \t\n\x0b\x0c\r]+", text)))
        return np.frombuffer(ids, dtype="uint32")

    def of_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, one text after the other; null is the empty text."""
        texts = texts.fill_null("").cast(pa.large_string())
        other = pc.or_(pc.match_substring(texts, SPECIAL), pc.match_substring_regex(texts, BEYOND_LATIN))
        sizes = np.cumsum(pc.binary_length(texts).to_numpy())
        latin, other = pc.if_else(other, "", texts), other.to_numpy(zero_copy_only=False)
        at = 0
        while at < len(texts):
            base = sizes[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(sizes, base + SLICE_BYTES, side="right")))
            ids, ends = self._latin(latin.slice(at, upto - at))
            for i in range(upto - at):
                yield self._other(texts[at + i].as_py()) if other[at + i] else ids[ends[i] : ends[i + 1]]
            at = upto

    def of_text(self, text: str) -> np.ndarray:
        return next(self.of_texts(pa.array([text])))
