"""Token ids of a public tokenizer, word by word with a bounded cache.

The tokenizer's own rules never join text across spaces, tabs or line ends, so
a text's ids are the ids of its words in order.  Prose repeats its words; each
distinct word is encoded once per Python worker.  Words of printable ASCII and
precomposed Latin-1 letters go straight to the tokenizer's BPE model (their
normal form is their lower case); every other word, and any that may hold a
special token, goes through the whole tokenizer.
"""

from __future__ import annotations

import re

import numpy as np

from railtrace.llm.workers import cache, claim

MAX_CACHED_WORDS = 700_000

_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# Fixed value: the pre-tokenizer's pattern, narrowed to the characters of _PLAIN in lower case.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 and up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(128, 256)}


class WordEncoder(dict):
    """Maps a word (UTF-8 bytes without ASCII white space) to its ids as little-endian bytes."""

    def __init__(self, path: str, max_words: int = MAX_CACHED_WORDS):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.max_words = max_words
        self.letters = _byte_letters()

    def __missing__(self, word: bytes) -> bytes:
        out = self._encode(word)
        if len(self) >= self.max_words:
            self.clear()
        self[word] = out
        return out

    def _encode(self, word: bytes) -> bytes:
        text = word.decode()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            pieces = _PIECES.findall(text.lower())
            if len(pieces) > 1:
                return b"".join([self[p.encode()] for p in pieces])
            if pieces[0] != text:
                return self[pieces[0].encode()]
            ids = [t.id for t in self.model.tokenize(text.translate(self.letters))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def ids(self, text: bytes | None) -> bytes:
        """The ids of a whole text, as bytes of ``dtype``; none for null."""
        return b"".join(map(self.__getitem__, text.split())) if text else b""


_ENCODERS: dict[str, WordEncoder] = {}
cache(_ENCODERS.clear)


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    claim("tokens")
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
