"""Whole texts to token ids with the tokenizers library, a pre-token at a time.

The library takes some microseconds for every pre-token. Most pre-tokens of a
text have been met before, so each worker remembers the ids of those it has
encoded, and finds them with the byte-level pre-tokenizer's own pattern. Texts
with characters whose class could differ between versions of Unicode are cut
before a blank between two characters that are not white space, where a new
pre-token begins whatever follows; parts with such characters are left to the
library.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from array import array
from collections.abc import Iterator

from tokenizers import Tokenizer

CACHE_PIECES = 600_000
CACHE_PARTS = 100_000
CACHE_CHARS = 64
CHUNK_CHARS = 1 << 20

# A blank within a run of white space: splitting there would cut the run.
INNER_BLANK = re.compile(r"\s (?:\s|\Z)")
SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")

# Below this code point the classes of characters have long been the same.
_KNOWN = 0x600
_SPACES = "\t\n\x0b\x0c\r \x85\xa0"


def _classes() -> tuple[str, str, str]:
    """Character sets of the known letters, numbers, and others that are no white space."""
    kinds: dict[str, list[str]] = {"L": [], "N": [], "": []}
    for char in map(chr, range(_KNOWN)):
        kind = unicodedata.category(char)
        if char not in _SPACES and kind != "Cn":
            kinds.get(kind[0], kinds[""]).append(re.escape(char))
    return tuple("".join(chars) for chars in kinds.values())


_LETTERS, _NUMBERS, _OTHERS = _classes()
KNOWN = re.compile(f"[{_LETTERS}{_NUMBERS}{_OTHERS}{_SPACES}]*")
# The pattern of byte-level pre-tokenizers, over known characters. Fixed values.
PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[{_OTHERS}]+"
    rf"|[{_SPACES}]+(?=[{_SPACES}]|\Z)|[{_SPACES}]+"
)


def _byte_letters() -> list[str]:
    """The character that stands for each byte: itself if it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


_LETTER_OF = _byte_letters()


class Encoder(dict):
    """Maps a pre-token of known characters to its ids, as little-endian uint32.

    Holds up to CACHE_PIECES pre-tokens, and beside them up to CACHE_PARTS parts of
    texts that the library has encoded; when they are full, further ones are
    encoded each time. ``encode`` gives the ids of a whole text.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = self.tokenizer.model.tokenize
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content for token in added]
        self.parts: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        spelt = "".join(map(_LETTER_OF.__getitem__, piece.encode()))
        ids = array("I", [t.id for t in self.merge(spelt)]).tobytes()
        if len(self) < CACHE_PIECES and len(piece) <= CACHE_CHARS:
            self[piece] = ids
        return ids

    def _known(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, PIECES.findall(text)))

    def _part(self, text: str) -> bytes:
        if KNOWN.fullmatch(text):
            return self._known(text)
        ids = self.parts.get(text)
        if ids is None:
            found = [t.id for piece, _ in self.pieces(text) for t in self.merge(piece)]
            ids = array("I", found).tobytes()
            if len(self.parts) < CACHE_PARTS and len(text) <= CACHE_CHARS:
                self.parts[text] = ids
        return ids

    def _chunks(self, text: str) -> Iterator[str]:
        """A text in parts of about CHUNK_CHARS, cut where a pre-token surely begins."""
        at = 0
        while cut := SAFE_CUT.search(text, at + CHUNK_CHARS):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str) -> bytes:
        """Ids of the whole text, as ``encode(text, add_special_tokens=False)`` gives them."""
        if any(token in text for token in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        found = []
        for chunk in self._chunks(text):
            if KNOWN.fullmatch(chunk):
                found.append(self._known(chunk))
            else:
                found += map(self._part, SAFE_CUT.split(chunk))
        return b"".join(found)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for this tokenizer file."""
    return Encoder(path)
