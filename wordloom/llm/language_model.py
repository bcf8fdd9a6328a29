"""Language-model scores by a weighted backoff automaton (operator 8).

The model is a bigram model over all training texts. Words seen before another
word are states; a state has an arc for each of its n-grams and a failure arc to
the root, which knows every word and the unknown one. One traversal from left to
right carries the state and adds up log-probabilities:

    root    p(w)   = (c(w) - d) / N, or d * V / N for the unknown word
    state u p(w|u) = (c(u, w) - D) / c(u) + D * T(u) / c(u) * p(w)

T(u) is the number of different words seen after u, so the failure arc of u
weighs D * T(u) / c(u): a state that has seen little backs off nearly always, one
that is always followed by the same word hardly ever. Each distribution sums to
one over the known words and the unknown one. d and D are the shares
n1 / (n1 + 2 * n2) of the words and of the pairs seen once and twice.

No task holds the whole model. A block of documents sends each of its distinct
n-grams once, with its count, to the shard that the n-gram's hash names; shards
add the counts of all blocks and answer each block with the totals it asked
for, and with those alone the block builds the part of the automaton that its
documents can reach. For T a shard also names one block as the owner of each
pair; every block counts the pairs it owns by their first word, and those counts
are added up in shards of words in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import (
    mixed,
    pack_numbers,
    rolling,
    shuffle_partitions,
    stored,
    unpack_numbers,
    words_of,
)

BLOCK_TOKENS = 1 << 20
MERGE_KEYS = 1 << 18  # n-grams of blocks that a shard adds up at once, at least
CONTEXT = 3  # stands for the counts T beside those of n-grams of one and two words
# Hashes of what no word can be: the start and the end of a text.
START, END = mixed(np.array([0x5354415254, 0x454E44], np.uint64))

_TEXTS = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
    ("n_words", pa.list_(pa.int64())), ("codes", pa.binary()), ("words", pa.binary())])
_COUNTS = pa.schema([("block", pa.int64()), ("ngram", pa.int32()), ("shard", pa.int32()),
                     ("keys", pa.binary()), ("counts", pa.binary())])
_TOTALS = pa.schema([
    ("block", pa.int64()), ("ngram", pa.int32()), ("shard", pa.int32()), ("totals", pa.binary()),
    ("owned", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64()), ("once", pa.int64()), ("twice", pa.int64())])
_SCORES = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
    ("score", pa.float64())])

TEXTS = ("block bigint, doc_ids array<bigint>, train array<boolean>, n_words array<bigint>, "
         "codes binary, words binary")
COUNTS = "block bigint, ngram int, shard int, keys binary, counts binary"
TOTALS = ("block bigint, ngram int, shard int, totals binary, owned binary, "
          "tokens bigint, types bigint, once bigint, twice bigint")
SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
          "train_tokens bigint, base_score double, score double")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.record_batch(arrays, schema=schema)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return pack_numbers(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(data), dtype=np.uint64)


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of TEXTS: documents as numbers of the block's distinct words."""
    block, size, docs = TaskContext.get().partitionId() << 32, 0, []

    def row() -> pa.RecordBatch:
        words, codes = np.unique(np.concatenate([h for *_, h in docs]), return_inverse=True)
        return _batch([(block, [d[0] for d in docs], [d[1] for d in docs],
                        [len(d[2]) for d in docs], pack_numbers(codes), _pack_sorted(words))],
                      _TEXTS)

    for batch in batches:
        for doc_id, train, text in zip(*(batch.column(c).to_pylist()
                                         for c in ("doc_id", "train", "text")), strict=True):
            hashes = words_of(text.encode().lower())[0]  # of bytes: A to Z only
            docs.append((doc_id, train, hashes))
            size += len(hashes) + 1
            if size >= BLOCK_TOKENS:
                yield row()
                block, size, docs = block + 1, 0, []
    if docs:
        yield row()


class Block:
    """A block's n-grams. Words are numbered by hash; then come the start and the end."""

    def __init__(self, row: dict) -> None:
        self.doc_ids, self.train = row["doc_ids"], row["train"]
        self.words = np.concatenate((_unpack_sorted(row["words"]), [START, END]))
        start, end = len(self.words) - 2, len(self.words) - 1
        lengths = np.array(row["n_words"], np.int64)
        codes, at = unpack_numbers(row["codes"]).astype(np.int64), np.cumsum(lengths)
        # Every document with its start before and its end behind.
        marked = np.insert(codes, np.repeat(np.concatenate(([0], at)), 2)[1:-1],
                           np.tile([start, end], len(lengths)))
        inner = marked[1:] != start
        self.before, self.tokens = marked[:-1][inner], marked[1:][inner]
        self.lengths = lengths + 1
        self.in_training = np.repeat(np.array(self.train, bool), self.lengths)
        self.pairs, self.pair_of = np.unique(
            mixed(rolling_pairs(self.words[self.before], self.words[self.tokens])),
            return_inverse=True,
        )

    def pair_words(self) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the first and the second word of each distinct pair."""
        first = np.unique(self.pair_of, return_index=True)[1]
        return self.before[first], self.tokens[first]

    def counts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """n, ascending hashes and training counts of the block's distinct n-grams.

        A word's count as a context is its count as a token; the start is
        counted once a document.
        """
        seen = np.bincount(self.tokens, self.in_training, len(self.words)).astype(np.int64)
        seen[-2] = sum(self.train)
        order = np.argsort(self.words, kind="stable")
        yield 1, self.words[order], seen[order]
        pairs = np.bincount(self.pair_of, self.in_training, len(self.pairs))
        yield 2, self.pairs, pairs.astype(np.int64)


def rolling_pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of each pair of hashes."""
    return rolling(np.stack((first, second), axis=1).ravel(), 2)[::2]


def _shard_rows(
    block: int, n: int, keys: np.ndarray, counts: np.ndarray, shards: int
) -> Iterator[tuple]:
    """COUNTS of ascending keys. Shards own equal ranges of hashes, so keys are cut in place."""
    bounds = np.array([(k << 64) // shards for k in range(shards)], np.uint64)
    cuts = np.append(np.searchsorted(keys, bounds), len(keys))
    for shard in np.flatnonzero(np.diff(cuts)).tolist():
        a, b = cuts[shard], cuts[shard + 1]
        yield block, n, shard, _pack_sorted(keys[a:b]), pack_numbers(counts[a:b])


def count_rows(row: dict, shards: int) -> Iterator[tuple]:
    """COUNTS of one block: a row for each n and shard that owns some of its n-grams."""
    for n, keys, counts in Block(row).counts():
        yield from _shard_rows(row["block"], n, keys, counts, shards)


def _in_order(replies: pa.Table, column: str) -> list[bytes]:
    return [r[column] for r in sorted(replies.to_pylist(), key=lambda r: r["shard"])]


def context_rows(row: dict, replies: pa.Table, shards: int) -> Iterator[tuple]:
    """COUNTS of one block's words as contexts: how many of the pairs it owns each begins."""
    block = Block(row)
    owned = [unpack_numbers(data) for data in _in_order(replies, "owned")]
    first = block.pair_words()[0][np.concatenate(owned) > 0]
    begun = np.bincount(first, minlength=len(block.words))
    order = np.argsort(block.words, kind="stable")
    yield from _shard_rows(row["block"], CONTEXT, block.words[order], begun[order], shards)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    sums = np.zeros(len(keys), np.uint64)
    np.add.at(sums, place, np.concatenate([c for _, c in parts]))
    return keys, sums


def total_rows(table: pa.Table) -> Iterator[tuple]:
    """TOTALS of one shard: a row for each asking block, and one of the shard's own sums.

    The rows stay packed and are unpacked one at a time, first to add up, then to
    answer. Beside them a task holds the shard's distinct n-grams, and while it
    adds up no more than three times as many.
    """
    order = np.argsort(table.column("block").to_numpy(), kind="stable")
    n, shard = table.column("ngram")[0].as_py(), table.column("shard")[0].as_py()

    def unpacked() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for k in order.tolist():
            yield (table.column("block")[k].as_py(),
                   _unpack_sorted(table.column("keys")[k].as_py()),
                   unpack_numbers(table.column("counts")[k].as_py()))

    known, totals, waiting, size = np.empty(0, np.uint64), np.empty(0, np.uint64), [], 0
    for _, keys, counts in unpacked():
        waiting.append((keys, counts))
        size += len(keys)
        if size > len(known) + MERGE_KEYS:
            known, totals = _summed([(known, totals), *waiting])
            waiting, size = [], 0
    known, totals = _summed([(known, totals), *waiting])
    del waiting
    # A pair's owner is the first of the blocks that have it in training texts.
    free = np.ones(len(known), bool)
    for block, keys, counts in unpacked():
        place = np.searchsorted(known, keys)
        owner = None
        if n == 2:
            mine = free[place] & (counts > 0)
            free[place[mine]] = False
            owner = pack_numbers(mine.astype(np.uint64))
        yield block, n, shard, pack_numbers(totals[place]), owner, None, None, None, None
    real = totals[known != START] if n == 1 else totals
    yield (None, n, shard, None, None, int(real.sum()), int((real > 0).sum()),
           int((real == 1).sum()), int((real == 2).sum()))


def discount(once: int, twice: int) -> float:
    """What is taken off every count, from how many things were seen once and twice."""
    return min(once / (once + 2 * twice), 0.95) if once else 0.5


class Automaton:
    """The states and arcs that a block's documents can reach."""

    def __init__(self, block: Block, seen: np.ndarray, pair_seen: np.ndarray, begun: np.ndarray,
                 sums: dict[int, dict]) -> None:
        words, pairs = sums[1], sums[2]
        tokens, off = words["tokens"], discount(words["once"], words["twice"])
        if tokens:
            unknown = off * words["types"] / tokens
            root = np.where(seen > 0, (seen - off) / tokens, unknown)
            root[-2] = 1.0  # nothing leads to the start
        else:
            root = np.ones(len(seen))  # nothing is known: all is the unknown word
        off = discount(pairs["once"], pairs["twice"])
        left = np.ones(len(seen))  # a word that was never seen is as good as the root
        np.divide(off * begun, seen, out=left, where=begun > 0)
        self.root, self.fail = np.log10(root).tolist(), np.log10(left).tolist()
        self.size = len(seen)
        u, w = block.pair_words()
        found = np.flatnonzero(pair_seen > 0)
        u, w, c = u[found], w[found], pair_seen[found]
        weights = np.log10((c - off) / seen[u] + left[u] * root[w])
        self.arcs = dict(zip((u * self.size + w).tolist(), weights.tolist(), strict=True))

    def score(self, tokens: list[int], start: int) -> float:
        """log10 probability of a text: one traversal that carries the state."""
        arcs, root, fail, size = self.arcs, self.root, self.fail, self.size
        total, state = 0.0, start
        for token in tokens:
            weight = arcs.get(state * size + token)
            total += fail[state] + root[token] if weight is None else weight
            state = token
        return total


def score_rows(row: dict, replies: pa.Table, sums: dict[int, dict]) -> Iterator[tuple]:
    """SCORES of one block, given the totals of its n-grams and the sums over all shards."""
    block, seen = Block(row), {}
    by_shard = sorted(replies.to_pylist(), key=lambda r: r["shard"])
    for n in (1, 2, CONTEXT):
        parts = [unpack_numbers(r["totals"]) for r in by_shard if r["ngram"] == n]
        seen[n] = np.concatenate(parts).astype(np.float64)
    order = np.argsort(block.words, kind="stable")
    words, begun = np.empty(len(block.words)), np.empty(len(block.words))
    words[order], begun[order] = seen[1], seen[CONTEXT]
    tokens, types = sums[1]["tokens"], sums[1]["types"]
    automaton = Automaton(block, words, seen[2], begun, sums)
    known = words[block.tokens]
    base = np.log10((known + 0.5) / (tokens + 0.5 * (types + 1)))
    starts = np.cumsum(block.lengths) - block.lengths
    base_scores = np.add.reduceat(base, starts).tolist()
    n_known = np.add.reduceat((known > 0).astype(np.int64), starts).tolist()
    numbers = block.tokens.tolist()
    for k, (doc_id, train) in enumerate(zip(block.doc_ids, block.train, strict=True)):
        at, length = int(starts[k]), int(block.lengths[k])
        yield (doc_id, not train, length, n_known[k], tokens, base_scores[k],
               automaton.score(numbers[at : at + length], automaton.size - 2))


def in_training(doc_id: Column) -> Column:
    """Whether a document is learnt from: crc32 of its id as text, modulo 5, is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 1, F.lit(True))


def scored(
    docs: DataFrame,
    train: Column | None = None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """SCORES for every row, learnt from the rows where ``train`` holds.

    ``train`` defaults to ``in_training`` of the id; a null counts as training.
    Words are runs of bytes other than blank and controls 9 to 13, with A to Z in
    lower case; each text ends with an end token. ``base_score`` is that of
    single words with half a count added. A null text is empty and has the end
    token only; repeated rows count and come back repeatedly; without training
    rows every word is the unknown one, of probability one at the root; an empty
    table gives no rows. A block holds BLOCK_TOKENS and at least one whole text.
    """
    shards = shuffle_partitions(docs.sparkSession)
    if train is None:
        train = in_training(docs[id_column])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _batch(list(count_rows(row, shards)), _COUNTS)

    def add_up(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(list(total_rows(table)), _TOTALS)])

    rows = docs.select(
        docs[id_column].cast("bigint").alias("doc_id"),
        F.coalesce(train, F.lit(True)).alias("train"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )
    blocks = stored(rows.mapInArrow(text_blocks, TEXTS), "lm-texts")
    totals = stored(
        blocks.mapInArrow(count, COUNTS).groupBy("ngram", "shard").applyInArrow(add_up, TOTALS),
        "lm-totals",
    )
    own = totals.where("block is null").groupBy("ngram").agg(
        *(F.sum(c).alias(c) for c in ("tokens", "types", "once", "twice")))
    # Two rows at most.
    sums = {n: dict.fromkeys(("tokens", "types", "once", "twice"), 0) for n in (1, 2)}
    sums |= {r["ngram"]: r.asDict() for r in own.collect()}

    def contexts(block: pa.Table, replies: pa.Table) -> pa.Table:
        found = [r for row in block.to_pylist() for r in context_rows(row, replies, shards)]
        return pa.Table.from_batches([_batch(found, _COUNTS)])

    def score(block: pa.Table, replies: pa.Table) -> pa.Table:
        found = [r for row in block.to_pylist() for r in score_rows(row, replies, sums)]
        return pa.Table.from_batches([_batch(found, _SCORES)])

    # Both meetings with the replies share one shuffle of the blocks.
    by_block = blocks.groupBy("block")
    owners = totals.where("ngram = 2 and block is not null").select("block", "shard", "owned")
    begun = by_block.cogroup(owners.groupBy("block")).applyInArrow(contexts, COUNTS)
    begun = begun.groupBy("ngram", "shard").applyInArrow(add_up, TOTALS)
    replies = totals.unionByName(begun).where("block is not null").select(
        "block", "ngram", "shard", "totals")
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(score, SCORES)
