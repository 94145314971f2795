"""Encoding with a public tokenizer file, remembering words.

For a tokenizer that splits at white space and drops it, the ids of a text are the ids of its words
in turn. Texts are taken together; each distinct word of them is looked up or encoded once and its ids are laid
out by numpy. The memory has a bound; when full it starts anew, which changes speed only. Where
normalising a word is more than lower-casing it, the word goes to the tokenizer whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from .byte_bpe import byte_letters
from .transducer import ranges

#: Words and pieces remembered by a worker, each, at about 150 bytes.
REMEMBERED = 400_000
#: Words taken together.
TOGETHER = 1 << 18


def _plain(c: str) -> bool:
    """Latin letters and signs that normalising leaves as they are, but for their case."""
    return "\t" <= c <= "\r" or " " <= c <= "~" or "\u00a0" <= c <= "\u024f" or "\u2010" <= c <= "\u2027"


#: Outside these characters normalising may do more than lower-case, or lower-casing may leave them
#: (İ, Ə); ``<|`` may begin the name of a special token.
SIMPLE = "".join(c for c in map(chr, range(0x2028)) if _plain(c) and len(c.lower()) == 1 and _plain(c.lower()))
_NOT_SIMPLE = re.compile(f"[^{re.escape(SIMPLE)}]|<\\|")
#: How a known split pattern acts on lower-cased simple text, in the faster engine.
_FAST = {
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+": (
        "[a-z]+[a-zªµºÀ-ÖØ-öø-ɏ]*|[a-zªµºÀ-ÖØ-öø-ɏ]+|'(?:[stmd]|re|ve|ll)|[0-9²³¹¼-¾]|[^\\sa-zªµºÀ-ÖØ-öø-ɏ0-9²³¹¼-¾]+"
    )
}
_SPACES = re.compile("[\\t-\\r ]+")


class _Memo(dict):
    """Values by key, made when first asked for."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class WordEncoder:
    def __init__(self, path: str, plain_specials: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.model = self.tokenizer.model
        with open(path) as source:
            pattern = json.load(source)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = (re.compile(_FAST[pattern]) if pattern in _FAST else regex.compile(pattern)).findall
        self.letters = {b: c for c, b in byte_letters().items()}
        self.seen, self.seen_pieces = _Memo(self._word), _Memo(self._piece)
        self.odd: set[str] = set()  # words that go to the tokenizer whole

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of one whole text as uint32."""
        return next(self.each([text]))

    def each(self, texts) -> Iterator[np.ndarray]:
        """Ids of every text in turn, as uint32."""
        held: list[str] = []
        sizes: list[int] = []
        for text in texts:
            before = len(held)
            if text:
                held.extend(self._words(text))
            sizes.append(len(held) - before)
            if len(held) >= TOGETHER:
                yield from self._laid_out(held, sizes)
                held, sizes = [], []
        yield from self._laid_out(held, sizes)

    def _words(self, text: str) -> list[str]:
        if not _NOT_SIMPLE.search(text):
            return text.lower().split()
        words = []
        for word in _SPACES.split(text):
            if _NOT_SIMPLE.search(word):
                self.odd.add(word)
                words.append(word)
            else:
                words.extend(word.lower().split())
        return words

    def _laid_out(self, held: list[str], sizes: list[int]) -> Iterator[np.ndarray]:
        coded = pa.array(held, pa.string()).dictionary_encode()
        slots, found = coded.indices.to_numpy(), self._encoded(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool, starts, many = np.frombuffer(b"".join(found), "<u4"), np.cumsum(lengths) - lengths, lengths[slots]
        ids, ends = pool[ranges(starts[slots], many)], np.append(0, np.cumsum(many))
        place = 0
        for size in sizes:
            yield ids[ends[place] : ends[place + size]]
            place += size

    def _encoded(self, words: list[str]) -> list[bytes]:
        for memo in (self.seen, self.seen_pieces):
            if len(memo) + len(words) > REMEMBERED:
                memo.clear()
        found = list(map(self.seen.__getitem__, words))
        self.odd.clear()
        return found

    def _word(self, word: str) -> bytes:
        if word in self.odd:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        pieces = self.pieces(word)
        if len(pieces) == 1:
            return self.seen_pieces[pieces[0]]
        return b"".join(map(self.seen_pieces.__getitem__, pieces))

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()


@lru_cache(maxsize=4)
def word_encoder(path: str, plain_specials: bool = False) -> WordEncoder:
    return WordEncoder(path, plain_specials)


@lru_cache(maxsize=4)
def vocabulary_size(path: str) -> int:
    return word_encoder(path).tokenizer.get_vocab_size(with_added_tokens=True)


def public_vocabulary() -> str:
    """Default vocabulary file; its place is a parameter everywhere."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
