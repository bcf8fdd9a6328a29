"""SentencePiece encoding with spans, and decoding (operator 13).

A text is normalised first: at every place the longest prefix that the model's
compiled character map knows is replaced, and for every normalised character the
byte of the source it comes from is kept. The normalised text is cut where no
piece of the vocabulary can reach across, each part is merged as the model's
scores say, and every piece is projected back to a span of bytes of the source.
A worker remembers the parts it has met.
"""

from __future__ import annotations

import functools
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from wordloom.llm.common import id_and_text

SPACE = "▁"  # stands for a blank in pieces. Fixed value.
CACHE_PARTS = 600_000
CACHE_PART_CHARS = 64
SHORT_PART_CHARS = 128
NEVER = -float("inf")
OUT_CHARS = 1 << 20  # characters of the texts of one batch of results
# Types of pieces in a model file. Fixed values.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6

ENCODED = ("doc_id bigint, ids array<int>, begins array<int>, ends array<int>, decoded string")
_INTS = pa.list_(pa.int32())
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", _INTS), ("begins", _INTS),
                      ("ends", _INTS), ("decoded", pa.string())])


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a message in protocol-buffer wire format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = number() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """A compiled character map: a double-array trie of byte strings and their replacements."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]
        self.known: dict[str, bool] = {}

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _step(self, node: int, char: str) -> tuple[int, int | None] | None:
        """The node after a character, and the value of the key that ends there."""
        value = None
        for byte in char.encode():
            unit = self.units[node ^ byte]
            if unit & 0x800000FF != byte:
                return None
            node ^= byte ^ self._offset(unit)
            value = self.units[node] & 0x7FFFFFFF if unit & 256 else None
        return node, value

    def begins_key(self, char: str) -> bool:
        """Whether any key begins with this character."""
        found = self.known.get(char)
        if found is None:
            found = self.known[char] = bool(self.units) and (
                self._step(self._offset(self.units[0]), char) is not None
            )
        return found

    def longest(self, text: str, at: int) -> tuple[str, int] | None:
        """Replacement and characters of the longest key at a place, if there is one."""
        node, end, best = self._offset(self.units[0]), at, None
        while end < len(text) and (found := self._step(node, text[end])):
            node, value = found
            end += 1
            if value is not None:
                best = value, end - at
        if best is None:
            return None
        stop = self.texts.index(b"\0", best[0])
        return self.texts[best[0] : stop].decode(), best[1]


class Normalizer:
    """The model's normaliser, with the source byte of every normalised character."""

    def __init__(self, model: bytes) -> None:
        spec = b"".join(v for k, v in message_fields(model) if k == 3)
        fields = dict(message_fields(spec))
        self.map = CharacterMap(fields.get(2) or b"\0\0\0\0")
        self.add_prefix = bool(fields.get(3, 1))
        self.squeeze = bool(fields.get(4, 1))
        self.blank = SPACE if fields.get(5, 1) else " "

    def _replaced(self, text: str) -> tuple[str, np.ndarray]:
        """The text after the map, and the source character of each of its characters."""
        chars = [c for c in set(text) if self.map.begins_key(c)]
        if not chars:
            return text, np.arange(len(text) + 1)
        parts, places, done = [], [], 0
        starters = re.compile("[" + "".join(map(re.escape, chars)) + "]")
        while found := starters.search(text, done):
            at = found.start()
            new, size = self.map.longest(text, at) or (text[at], 1)
            parts += [text[done:at], new]
            places += [np.arange(done, at), np.full(len(new), at)]
            done = at + size
        parts.append(text[done:])
        places.append(np.arange(done, len(text) + 1))
        return "".join(parts), np.concatenate(places)

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its characters and its end a byte of the source."""
        if not text:
            return "", np.zeros(1, np.int64)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        widths = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000).astype(np.int64)
        byte_of = np.concatenate(([0], np.cumsum(widths)))
        new, place = self._replaced(text)
        if self.squeeze:
            kept = np.frombuffer(new.encode("utf-32-le"), "<u4") != 32
            if not kept.any():
                return "", byte_of[:1]
            kept[1:] |= kept[:-1]  # of a run of blanks the first stays, in front none
            new = re.sub(" +", " ", new.lstrip(" "))
            place = place[np.append(np.flatnonzero(kept), len(kept))]
        if self.add_prefix:
            new, place = " " + new, np.insert(place, 0, place[0])
        new = new.replace(" ", self.blank)
        if self.squeeze:
            new = new.rstrip(self.blank)
            place = place[: len(new) + 1]
        return new, byte_of[place]


class Encoder(dict):
    """Maps a part of a normalised text to its ids and its pieces' numbers of characters.

    Both are little-endian 32-bit integers. Of a character that is spelt in byte
    pieces only the last one has the character.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = self.model.serialized_model_proto()
        self.normalize = Normalizer(proto)
        pieces = [dict(message_fields(v)) for k, v in message_fields(proto) if k == 1]
        kinds = {piece.get(3, _NORMAL) for piece in pieces}
        trainer = dict(message_fields(b"".join(v for k, v in message_fields(proto) if k == 2)))
        if trainer.get(3) != 2 or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only BPE models without user-defined or unused pieces are read")
        self.ids, self.scores, self.bytes = {}, {}, {}
        self.unknown = 0
        for k, piece in enumerate(pieces):
            text, kind = piece[1].decode(), piece.get(3, _NORMAL)
            if kind == _NORMAL:
                self.ids[text] = k
                self.scores[text] = float(np.frombuffer(piece[2], "<f4")[0])
            elif kind == _BYTE:
                self.bytes[int(text[1:-1], 16)] = k
            elif kind == _UNKNOWN:
                self.unknown = k
        self.neighbours = {a + b for text in self.ids for a, b in zip(text, text[1:])}
        blank = self.normalize.blank
        inner = any(pair[0] != blank and pair[1] == blank for pair in self.neighbours)
        # A piece has blanks at its front only, so a text can be cut before each run of them.
        pattern = f"(?s:.+)" if inner else f"{blank}*[^{blank}]+|{blank}+"
        self.parts = re.compile(pattern).findall

    def _merged(self, part: str) -> list[str]:
        """Pieces of a part: the neighbours of highest score are merged first, the left of equals."""
        if len(part) > SHORT_PART_CHARS:
            return self._merged_long(part)
        symbols, score = list(part), self.scores.get
        scores = [score(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while scores and (best := max(scores)) > NEVER:
            k = scores.index(best)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = score(symbols[k - 1] + symbols[k], NEVER)
            if k < len(scores):
                scores[k] = score(symbols[k] + symbols[k + 1], NEVER)
        return symbols

    def _merged_long(self, part: str) -> list[str]:
        """The same with a heap, whose work grows with n log n."""
        symbols: list[str] = list(part)
        n, scores = len(symbols), self.scores
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, int]] = []

        def meet(left: int, right: int) -> None:
            if left >= 0 and right < n:
                both = symbols[left] + symbols[right]
                if (score := scores.get(both)) is not None:
                    heapq.heappush(heap, (-score, left, right, len(both)))

        for k in range(n - 1):
            meet(k, k + 1)
        while heap:
            _, left, right, size = heapq.heappop(heap)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            symbols[left], symbols[right] = a + b, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            meet(before[left], left)
            meet(left, after[left])
        return [s for s in symbols if s]

    def _coded(self, part: str) -> tuple[bytes, bytes]:
        ids, sizes = [], []
        for piece in self._merged(part):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
                sizes.append(len(piece))
            elif self.bytes:
                spelt = [self.bytes[b] for b in piece.encode()]
                ids += spelt
                sizes += [0] * (len(spelt) - 1) + [1]
            elif ids and ids[-1] == self.unknown:  # unknown neighbours are one piece
                sizes[-1] += 1
            else:
                ids.append(self.unknown)
                sizes.append(1)
        return array("i", ids).tobytes(), array("i", sizes).tobytes()

    def _kept(self, part: str, value: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
        if len(self) < CACHE_PARTS and len(part) <= CACHE_PART_CHARS:
            self[part] = value
        return value

    def __missing__(self, part: str) -> tuple[bytes, bytes]:
        if not self.bytes:
            return self._kept(part, self._coded(part))
        # No merge joins two characters that are neighbours in no piece.
        pairs = self.neighbours
        cuts = [k for k in range(1, len(part)) if part[k - 1 : k + 1] not in pairs]
        if not cuts:
            return self._kept(part, self._coded(part))
        found = [self[part[a:b]] for a, b in zip([0, *cuts], [*cuts, len(part)])]
        return self._kept(part, tuple(map(b"".join, zip(*found, strict=True))))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a whole text, and the first byte and the end of each in the source."""
        normal, source = self.normalize(text)
        if not normal:
            return np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int32)
        parts = self.parts(normal) if self.bytes else [normal]
        ids, sizes = map(b"".join, zip(*map(self.__getitem__, parts), strict=True))
        places = np.cumsum(np.frombuffer(sizes, "<i4"), dtype=np.int64)
        sizes = np.frombuffer(sizes, "<i4")
        # A byte piece without its character ends where it begins.
        begins = source[places - sizes]
        return np.frombuffer(ids, "<i4"), begins.astype(np.int32), source[places].astype(np.int32)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for this model file."""
    return Encoder(path)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array(np.concatenate(arrays), pa.int32()))


def encode_and_decode(
    docs: DataFrame,
    model: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """ENCODED: for every row its ids, their spans in the UTF-8 source, and what they decode to.

    ``model`` is a sentencepiece BPE model file that every executor can read; no
    begin or end ids are added and nothing is sampled. A null text is empty and
    has no ids; repeated rows come back repeated; null ids are kept; an empty
    table gives an empty result. Every row stands alone: nothing is shuffled, and
    a task holds the results of OUT_CHARS characters and at least one whole text.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)

        def rows(ids: list[int | None], found: list[tuple]) -> pa.RecordBatch:
            codes, begins, ends = map(list, zip(*found, strict=True))
            decoded = coder.model.decode([c.tolist() for c in codes], num_threads=1)
            return pa.record_batch([pa.array(ids, pa.int64()), _lists(codes), _lists(begins),
                                    _lists(ends), pa.array(decoded, pa.string())],
                                   schema=_ENCODED)

        for batch in batches:
            ids, found, chars = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text"), strict=True):
                whole = text.as_py()
                ids.append(doc_id)
                found.append(coder.encode(whole))
                chars += len(whole)
                if chars >= OUT_CHARS:
                    yield rows(ids, found)
                    ids, found, chars = [], [], 0
            if ids:
                yield rows(ids, found)

    return id_and_text(docs, id_column, text_column).mapInArrow(encode, ENCODED)
