"""Token ids by the tokenizers library, with one library call per distinct word.

Both vocabularies cut a text into words before any merge, and no word reaches across a place
where `WordEncoder` cuts. So the ids of a text are those of its words put together, and words
repeat. A text with a character on which Python and the library may disagree, or with the
string of a special token, goes to the library whole. Results are those of
`Tokenizer.encode(text, add_special_tokens=False)` in every case.
"""

from __future__ import annotations

import re
from functools import lru_cache
from struct import pack

import numpy as np

#: Letters whose runs end for certain before the marks in ENDS.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
ENDS = r"\s.,;:!?|*#$%&<>()\""
#: Control and format characters that Unicode tables treat differently as white space.
UNSURE = re.compile(r"[\x1c-\x1f\x85\u180e\u200b-\u200f\u2028\u2029\u2060\ufeff]")
#: Words longer than this are not remembered, nor are more words than that at a time.
LONGEST_WORD, MOST_WORDS = 48, 400_000


class _Memory(dict):
    """Word -> its ids as little-endian 32-bit numbers."""

    def __init__(self, ids_of):
        self.ids_of = ids_of

    def __missing__(self, word: str) -> bytes:
        ids = pack(f"<{len(ids := self.ids_of(word))}I", *ids)
        if len(word) <= LONGEST_WORD:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = ids
        return ids


class WordEncoder:
    """Encodes texts with a tokenizer file, whether or not white space gives tokens there."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # A file may ask for cut or padded results; both are off here.
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        letters = rf"[{LETTERS}]+(?=[{ENDS}]|\Z)"
        self.spaces = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        self.words = re.compile(
            rf" ?{letters}| ?\S+|\s+(?!\S)|\s+" if self.spaces else rf"{letters}|\S+"
        ).findall
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A run of letters is one word to the library; the model itself takes it as symbols,
        # one for each byte, in the case that the normalizer leaves.
        self.letters = re.compile(rf" ?[{LETTERS}]+").fullmatch
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        lower = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        self.symbols = {
            ord(c): as_bytes.pre_tokenize_str(lower(c))[0][0]
            for c in map(chr, range(32, 256))
            if c == " " or self.letters(c)
        }
        self.model = self.tokenizer.model
        self.memory = _Memory(self._ids)

    def _ids(self, word: str) -> list[int]:
        # The greatest of LETTERS is ÿ, and all alphabetic characters up to there are in it.
        if word.lstrip(" ").isalpha() and max(word) <= "ÿ":
            return [t.id for t in self.model.tokenize(word.translate(self.symbols))]
        return self._library(word)

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit numbers; None counts as empty."""
        if not text:
            return b""
        if UNSURE.search(text) or any(token in text for token in self.added):
            return np.array(self._library(text), dtype="<u4").tobytes()
        return b"".join(map(self.memory.__getitem__, self.words(text)))


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder for each tokenizer file and Python worker."""
    return WordEncoder(path)
