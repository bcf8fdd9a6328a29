"""Byte-level BPE by a global distinct-word shuffle (operator 5).

Tasks cut their documents into pre-tokens. A block of documents keeps, for every
position, which of the block's distinct words stands there, and sends each
distinct word once to the shard that its hash names. A shard meets its words from
all blocks, encodes each distinct one once and answers every block with the ids
of the words it sent. Blocks then reassemble their documents by position, and
decode the ids against the token-byte table.

A word that is everywhere reaches its shard once per block, so no key is hot.
What moves is one compressed row per block and shard, not a row per token.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import (
    gathered,
    id_and_text,
    list_ends,
    pack_numbers,
    pack_strings,
    shuffle_partitions,
    stored,
    unpack_numbers,
    unpack_strings,
)
from wordloom.llm.encoder import INNER_BLANK, SAFE_CUT

BLOCK_CHARS = 32 << 20
LEVEL = 9
REMEMBERED = 1_000_000  # words whose ids a task keeps
_OF_DOCUMENTS = -1  # the shard number of a block's own row

BLOCKS = "block bigint, shard int, doc_ids array<bigint>, n_words array<bigint>, data binary"
ANSWERS = "block bigint, shard int, data binary"
ENCODED = "doc_id bigint, n_tokens bigint, ids binary, decoded binary"


class Words(dict):
    """Codes of a block's distinct words; maps a piece of text to its words' codes."""

    def __init__(self, pattern: str) -> None:
        super().__init__()
        self.matches = regex.compile(pattern).findall
        self.codes: dict[str, int] = {}

    def _codes(self, text: str) -> bytes:
        codes = self.codes
        found = [codes.setdefault(word, len(codes)) for word in self.matches(text)]
        return np.array(found, "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        value = self[piece] = self._codes(" " + piece)
        return value

    def of(self, text: str) -> bytes:
        """Codes of all matches in a text, by position.

        The text is taken piece by piece, a blank before each but the first; a
        blank between two characters that are not white space always begins a
        match.
        """
        if INNER_BLANK.search(text):
            first, *rest = SAFE_CUT.split(text)
            pieces = [piece[1:] for piece in rest]
        else:
            first, *pieces = text.split(" ")
        return self._codes(first) + b"".join(map(self.__getitem__, pieces))


def block_rows(batches: Iterator[pa.RecordBatch], pattern: str, shards: int) -> Iterator[tuple]:
    """BLOCKS: for each block a row of its documents, and one per shard of its words."""
    block, chars, words, docs = TaskContext.get().partitionId() << 32, 0, Words(pattern), []

    def rows() -> Iterator[tuple]:
        codes = np.frombuffer(b"".join(c for _, c in docs), "<u4")
        # Frequent words get small numbers, which compress best.
        counts = np.bincount(codes, minlength=len(words.codes))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        known = list(words.codes)
        texts = [known[k].encode() for k in order.tolist()]
        shard_of = np.fromiter((xxhash.xxh3_64_intdigest(w) % shards for w in texts),
                               np.int64, len(texts))
        shard_data = pack_numbers(shard_of, LEVEL)
        yield (block, _OF_DOCUMENTS, [i for i, _ in docs], [len(c) // 4 for _, c in docs],
               len(shard_data).to_bytes(8, "little") + shard_data
               + pack_numbers(rank[codes], LEVEL))
        by_shard = np.argsort(shard_of, kind="stable")
        cuts = np.searchsorted(shard_of[by_shard], np.arange(shards + 1))
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            inside = by_shard[cuts[shard] : cuts[shard + 1]].tolist()
            yield block, shard, None, None, pack_strings([texts[k] for k in inside], LEVEL)

    for batch in batches:
        for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")),
                                strict=True):
            docs.append((doc_id, words.of(text)))
            chars += len(text)
            if chars >= BLOCK_CHARS:
                yield from rows()
                block, chars, words, docs = block + 1, 0, Words(pattern), []
    if docs:
        yield from rows()


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)


_BLOCKS = pa.schema([("block", pa.int64()), ("shard", pa.int32()),
                     ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())),
                     ("data", pa.binary())])
_ANSWERS = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("data", pa.binary())])
_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                      ("ids", pa.binary()), ("decoded", pa.binary())])


@functools.lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=_ranks(path),
                             special_tokens={})


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: all bytes end to end, and where each id's bytes end."""
    of = {rank: token for token, rank in _ranks(path).items()}
    tokens = [of.get(k, b"") for k in range(max(of) + 1)]
    return (np.frombuffer(b"".join(tokens), np.uint8),
            list_ends(np.fromiter(map(len, tokens), np.int64, len(tokens))))


def answers(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[tuple]:
    """ANSWERS to packs of words that come sorted by shard: for each pack the ids of its words.

    A distinct word is encoded once, at its shard's first pack that has it. Packs
    stream by; the task remembers one shard's words, and starts afresh beyond
    REMEMBERED of them, so that its memory is bounded whatever the corpus.
    """
    encode, ids_of, of = _encoding(path, pattern).encode_ordinary, {}, None
    for batch in batches:
        for block, shard, data in zip(*(batch.column(c) for c in ("block", "shard", "data")),
                                      strict=True):
            if of != (of := shard.as_py()) or len(ids_of) > REMEMBERED:
                ids_of = {}
            found = []
            for word in unpack_strings(data.as_py()):
                ids = ids_of.get(word)
                if ids is None:
                    ids = ids_of[word] = encode(word.decode())
                found.append(ids)
            sizes = pack_numbers(np.fromiter(map(len, found), np.uint64, len(found)), LEVEL)
            flat = pack_numbers(np.array([i for ids in found for i in ids], np.uint64), LEVEL)
            yield block.as_py(), of, len(sizes).to_bytes(8, "little") + sizes + flat


def reassembled(blocks: pa.Table, replies: pa.Table, path: str) -> Iterator[tuple]:
    """ENCODED rows of one block."""
    order = np.argsort(replies.column("shard").to_numpy(), kind="stable").tolist()
    data = replies.column("data").to_pylist()
    sizes, flat = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
    for reply in (data[k] for k in order):
        at = 8 + int.from_bytes(reply[:8], "little")
        sizes.append(unpack_numbers(reply[8:at]).astype(np.int64))
        flat.append(unpack_numbers(reply[at:]).astype(np.uint32))
    word_ends, word_ids = list_ends(np.concatenate(sizes)), np.concatenate(flat)
    table, token_ends = token_bytes(path)
    for row in blocks.to_pylist():
        at = 8 + int.from_bytes(row["data"][:8], "little")
        # Answers come by shard; within a shard in the order of the words' numbers.
        by_shard = np.argsort(unpack_numbers(row["data"][8:at]), kind="stable")
        place = np.empty(len(by_shard), np.int64)
        place[by_shard] = np.arange(len(by_shard))
        codes, at = place[unpack_numbers(row["data"][at:]).astype(np.int64)], 0
        for doc_id, n_words in zip(row["doc_ids"], row["n_words"], strict=True):
            ids = gathered(word_ids, word_ends, codes[at : at + n_words])
            decoded = gathered(table, token_ends, ids)  # the join with the token-byte table
            yield doc_id, len(ids), ids.astype("<u4").tobytes(), decoded.tobytes()
            at += n_words


def encode_and_decode(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """ENCODED: for every row its ids (little-endian uint32) and the bytes they decode to.

    ``ranks`` is a tiktoken rank file that every executor can read; each match
    of ``pattern`` is encoded separately, without special tokens. A null text is
    empty and has no ids; repeated rows come back repeated; null ids are kept;
    an empty table gives an empty result. A block holds BLOCK_CHARS characters
    and at least one whole document.
    """
    shards = shuffle_partitions(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in block_rows(batches, pattern, shards):
            yield from _table([row], _BLOCKS).to_batches()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in answers(batches, ranks, pattern):
            yield from _table([row], _ANSWERS).to_batches()

    def reassemble(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        return _table(list(reassembled(blocks, replies, ranks)), _ENCODED)

    rows = id_and_text(docs, id_column, text_column).mapInArrow(cut, BLOCKS)
    blocks = stored(rows, "word-blocks")
    packs = blocks.where(F.col("shard") != _OF_DOCUMENTS).select("block", "shard", "data")
    replies = packs.repartition(shards, "shard").sortWithinPartitions("shard", "block").mapInArrow(
        answer, ANSWERS)
    documents = blocks.where(F.col("shard") == _OF_DOCUMENTS)
    return documents.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        reassemble, ENCODED
    )
