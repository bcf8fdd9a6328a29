"""Packing along a space-filling curve (operator 9).

Each document's ids are hashed into a vector, which a fixed random matrix
projects to a few dimensions; the Hilbert key of that point orders the
documents, so texts that use like tokens become neighbours. Documents are laid
end to end in that order and cut every SEQUENCE tokens: no sequence but the
last has any padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import id_and_text, shuffle_partitions, stored
from wordloom.llm.encoder import encoder

SEQUENCE = 2048
HASHED_DIMENSIONS = 256
DIMENSIONS = 4
BITS = 12
SEED = 20


def projection() -> np.ndarray:
    """HASHED_DIMENSIONS x DIMENSIONS, blind to what all documents share."""
    matrix = np.random.default_rng(SEED).standard_normal((HASHED_DIMENSIONS, DIMENSIONS))
    return matrix - matrix.mean(axis=0)


def hashed_vector(ids: np.ndarray) -> np.ndarray:
    """Unit vector of the square roots of the hashed token counts."""
    slots = (ids * np.uint32(2654435761)) >> np.uint32(24)
    counts = np.bincount(slots, minlength=HASHED_DIMENSIONS)
    return np.sqrt(counts / max(1, len(ids)))


def cells(points: np.ndarray) -> np.ndarray:
    """Points to integer cells 0 .. 2**BITS - 1 along each axis, fine near the middle."""
    share = 0.5 + np.arctan(4 * points) / np.pi
    return np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of each row of cells.

    The transform turns cells into the curve's bits axis by axis, all rows at
    once: undo the rotations from the highest bit down, Gray-decode, interleave.
    """
    x = grid.astype(np.int64).copy()
    axes = x.shape[1]
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = q - 1
        for axis in range(axes):
            flip = (x[:, axis] & q) != 0
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, axis]) & low)
            x[:, 0] ^= np.where(flip, low, swap)
            x[:, axis] ^= swap
    for axis in range(1, axes):
        x[:, axis] ^= x[:, axis - 1]
    turn = np.zeros(len(x), np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[:, axes - 1] & q, q - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = (key << 1) | ((x[:, axis] >> b) & 1)
    return key


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``row_id, doc_id, n_tokens, curve, ids``, a stored row for each document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, end = encoder(tokenizer).encode, end_id.to_bytes(4, "little")
        matrix = projection()
        for batch in batches:
            ids = [to_ids(text) + end for text in batch.column("text").to_pylist()]
            vectors = [hashed_vector(np.frombuffer(x, "<u4")) for x in ids]
            keys = hilbert_keys(cells(np.array(vectors).reshape(-1, HASHED_DIMENSIONS) @ matrix))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array(keys, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "curve", "ids"],
            )

    rows = docs.mapInArrow(encode, "doc_id bigint, n_tokens bigint, curve bigint, ids binary")
    return stored(rows.withColumn("row_id", F.monotonically_increasing_id()), "tokens")


def curve_starts(tokens: DataFrame) -> DataFrame:
    """``row_id, global_start``: tokens before each document along the curve.

    Only ids, keys and counts are range-sorted. Ties on the curve are broken by
    row, so any number of equal documents is split between tasks. Each task adds
    up its own range; the ranges' totals, one row each, are then added up.
    """

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, total = TaskContext.get().partitionId(), 0
        for rows in batches:
            ends = total + rows["n_tokens"].cumsum()
            yield pd.DataFrame({
                "row_id": rows["row_id"], "part": part,
                "n_tokens": rows["n_tokens"], "part_start": ends - rows["n_tokens"],
            })
            total = int(ends.iloc[-1]) if len(rows) else total

    partitions = shuffle_partitions(tokens.sparkSession)
    order = ["curve", "row_id"]
    ranged = tokens.select("row_id", "curve", "n_tokens").repartitionByRange(partitions, *order)
    schema = "row_id bigint, part int, n_tokens bigint, part_start bigint"
    within = stored(ranged.sortWithinPartitions(*order).mapInPandas(add_up, schema), "curve")
    totals = within.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")
    )
    # As many rows as there are partitions.
    return within.join(F.broadcast(bases), "part").select(
        "row_id", (F.col("base") + F.col("part_start")).alias("global_start")
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    *,
    sequence: int = SEQUENCE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of ``sequence`` tokens.

    ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: the piece
    holds ``length`` of the document's ``doc_tokens`` ids from ``start`` on, as
    little-endian uint32, and lies at ``offset`` of its sequence. Every id, the
    end id of each document included, lies in exactly one piece. Only the last
    sequence can be shorter than ``sequence``.

    A null text is empty and has its end id; repeated rows are packed as often
    as they occur; null ids are kept; an empty table gives no pieces. The ids
    are shuffled once, to meet their place.
    """
    tokens = token_table(id_and_text(docs, id_column, text_column), tokenizer, end_id)
    # The same plan at every size: the starts grow with the documents.
    placed = tokens.join(curve_starts(tokens).hint("merge"), "row_id")
    first = F.floor(F.col("global_start") / sequence)
    last = F.floor((F.col("global_start") + F.col("n_tokens") - 1) / sequence)
    pieces = placed.select(
        "*", F.explode(F.sequence(first, last)).alias("sequence_id")
    ).withColumn(
        "start",
        F.greatest(F.lit(0), F.col("sequence_id") * sequence - F.col("global_start")),
    ).withColumn("offset", F.col("global_start") + F.col("start") - F.col("sequence_id") * sequence)
    length = F.least(F.col("n_tokens") - F.col("start"), sequence - F.col("offset"))
    return pieces.withColumn("length", length).select(
        "doc_id", "start", "length",
        F.substring("ids", (4 * F.col("start") + 1).cast("int"),
                    (4 * F.col("length")).cast("int")).alias("ids"),
        F.col("n_tokens").alias("doc_tokens"), "sequence_id", "offset",
    )
