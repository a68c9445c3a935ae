"""Token ids of whole texts, by a tokenizer file for the ``tokenizers`` library."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import functions as F

# What a worker may remember in the current turn, and as much of the one before.
# An entry costs its characters, its ids and about so many bytes beside.
REMEMBERED_BYTES = 48 << 20
ENTRY_BYTES = 180
LONGEST_REMEMBERED = 32  # characters

# Texts on which the way by chunks must agree with the library, or the library does it all.
PROBES = ("The Cat's hat, 12.5% of it!", "Straße ÉÈ naïve A-B a_b", "x" * 40 + " yes", " two  blanks\nline\ttab ")

PUNCTUATION = ".,!?;:*%&$#|"

# Python also splits at these controls, which Unicode does not count as white space.
SEPARATORS = (b"\x1c", b"\x1d", b"\x1e", b"\x1f")


def is_plain(text: str) -> bool:
    """Latin-1 letters are single characters in normal form, and so are their lower cases."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not any(c in raw for c in SEPARATORS)


class Known(dict):
    """Ids by chunk; a chunk that is not there is asked for, once."""

    def __init__(self, ask: Callable[[str], bytes]):
        self.ask = ask

    def __missing__(self, chunk: str) -> bytes:
        return self.ask(chunk)


class WordTokenizer:
    """Ids by white-space separated chunk, each computed once.

    Right for a tokenizer whose tokens never span white space and that drops it, which
    ``word_bpe_49k.json`` does: normalization, splitting and merges then work on each chunk
    alone. Texts whose split may differ between Python and the library go to the library whole, as do all
    texts if the file turns out to be one of another kind.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = False
        self.model = self.library.model
        self.forget()
        # Byte-level BPE writes bytes as characters: printable Latin-1 as itself, others moved up.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in set(own)]
        self.written = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(moved)}
        self.by_chunk = self._agrees()

    def _agrees(self) -> bool:
        self.by_chunk = True
        try:
            return all(self.encode(text) == self.whole(text) for text in PROBES)
        except Exception:  # a model that cannot take single words
            return False
        finally:
            self.forget()

    def forget(self) -> None:
        self.known = Known(self.unknown)
        self.before: dict[str, bytes] = {}
        self.held = 0

    def unknown(self, chunk: str) -> bytes:
        return self.part(chunk, self.chunk)

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def run(self, letters: str) -> bytes:
        """Ids of what is one token of the splitter, in lower case."""
        text = letters if letters.isascii() else "".join(map(self.written.__getitem__, letters.encode()))
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def part(self, part: str, ids) -> bytes:
        found = self.known.get(part)
        if found is None:
            found = self.before.get(part)
            found = ids(part) if found is None else found
            if len(part) <= LONGEST_REMEMBERED:
                self.known[part] = found
                self.held += len(part) + len(found) + ENTRY_BYTES
        return found

    def chunk(self, chunk: str) -> bytes:
        """Letters with or without punctuation behind are two tokens of the splitter at most;
        normalization leaves plain ones as they are but for their case."""
        letters = chunk.rstrip(PUNCTUATION)
        if not letters.isalpha():
            return self.whole(chunk)
        if len(letters) == len(chunk):
            low = chunk.lower()
            return self.run(low) if low == chunk else self.part(low, self.run)
        return self.part(letters.lower(), self.run) + self.part(chunk[len(letters) :], self.run)

    def encode(self, text: str) -> bytes:
        if not self.by_chunk or not is_plain(text):
            return self.whole(text)
        if self.held >= REMEMBERED_BYTES:
            self.known, self.before, self.held = Known(self.unknown), self.known, 0
        return b"".join(map(self.known.__getitem__, text.split()))


_OPEN: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    """One per worker process, so that what it remembers, bounded in bytes, serves all its tasks."""
    if path not in _OPEN:
        _OPEN[path] = WordTokenizer(path)
    return _OPEN[path]


def token_ids(path: str):
    """A column function: text to its ids as little-endian unsigned 32-bit numbers."""

    @F.pandas_udf("binary")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = tokenizer_at(path).encode
        for part in texts:
            yield pd.Series([encode(t) for t in part], dtype=object)

    return ids
