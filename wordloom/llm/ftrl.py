"""Logistic regression over hashed binary features by FTRL-proximal.

Every weight has its own learning rate, which falls with the squared gradients
it has met, and L1 keeps a weight at exactly zero until enough evidence has
gathered, so what is left is a short list of weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import pack_numbers, unpack_numbers

ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 6.0, 0.1, 3
NEVER = -20.0  # log-odds where there was nothing to learn from
LIMIT = 35.0
SLOT_BITS = 26  # of the slots that tell which features can be left out
CLASS_SHARE = 16  # a sample has this part of each class, if there is so much of it


@dataclass
class Sparse:
    """Weights other than zero, by feature, and the log-odds without any feature."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self, size: int) -> np.ndarray:
        table = np.zeros(size)
        table[self.features] = self.weights
        return table

    def odds(self, found: np.ndarray) -> float:
        """Log-odds of a row of features in any order, a repeated one counted once."""
        if not len(self.features) or not len(found):
            return self.bias
        place = np.searchsorted(self.features, found)
        place[place == len(self.features)] = 0
        hit = np.unique(place[self.features[place] == found])
        return float(self.weights[hit].sum()) + self.bias


def probability(log_odds: np.ndarray | float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -LIMIT, LIMIT)))


def fit(rows: list[np.ndarray], labels: np.ndarray, size: int, l1: float = L1) -> Sparse:
    """Weights learnt from rows of distinct feature numbers below ``size``, in the given order."""
    if not len(rows):
        return Sparse(np.empty(0, np.int64), np.empty(0), NEVER)
    # The last place is that of the bias, which has no penalty.
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    penalty = np.full(size + 1, l1)
    penalty[size] = 0.0

    def weights(zs: np.ndarray, ns: np.ndarray, penalties: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - penalties, 0)
        return -shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2)

    places = [np.append(row, row.dtype.type(size)) for row in rows]
    for _ in range(EPOCHS):
        for at, label in zip(places, labels.tolist(), strict=True):
            zs, ns = z[at], n[at]
            w = weights(zs, ns, penalty[at])
            gradient = float(probability(w.sum())) - label
            grown = ns + gradient * gradient
            z[at] = zs + gradient - (np.sqrt(grown) - np.sqrt(ns)) / ALPHA * w
            n[at] = grown
    final = weights(z, n, penalty)
    kept = np.flatnonzero(final[:size])
    return Sparse(kept, final[kept], float(final[size]))


def numbered(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A row's features as their places among the ascending ``keys``, without the others."""
    place = np.searchsorted(keys, row)
    known = place < len(keys)
    known[known] = keys[place[known]] == row[known]
    return place[known].astype(np.int32)


def numbered_rows(rows: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """All features of the rows, ascending, and the rows as their places."""
    keys = np.unique(np.concatenate(rows)) if rows else np.empty(0, np.int64)
    return keys, [numbered(keys, row) for row in rows]


def rows_to_matter(l1: float) -> int:
    """The least number of rows with a feature that can give it a weight.

    A gradient is below one, so a feature in no more than l1 / EPOCHS rows never
    gets past the penalty; leaving such features out changes no weight.
    """
    return int(l1 // EPOCHS) + 1


def fit_keys(rows: list[np.ndarray], labels: np.ndarray, l1: float = L1) -> Sparse:
    """``fit`` for rows of distinct 64-bit features."""
    every, counts = np.unique(np.concatenate(rows) if rows else np.empty(0, np.int64),
                              return_counts=True)
    keys = every[counts >= rows_to_matter(l1)]
    return fit_numbered(keys, [numbered(keys, row) for row in rows], labels, l1)


def fit_numbered(
    keys: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, l1: float = L1
) -> Sparse:
    """``fit`` for rows of places among ``keys``."""
    found = fit(rows, labels, len(keys), l1)
    return Sparse(keys[found.features], found.weights, found.bias)


def labelled_sample(
    labels: DataFrame, ids: DataFrame, label_column: str, id_column: str, most: int
) -> DataFrame:
    """``doc_id, label, turn`` of at most ``most`` labelled ids that are in ``ids``.

    Those with the smallest hash of the id, so the sample does not depend on the
    order of the rows; ``turn`` is that hash. A scarce class (labels above 0, and
    all others) goes first with up to a share 1 / CLASS_SHARE of the sample. An id
    labelled both ways has the larger label; null ids and labels are left out.
    ``ids`` has distinct values of doc_id.
    """
    known = labels.select(
        labels[id_column].cast("bigint").alias("doc_id"),
        labels[label_column].cast("int").alias("label"),
    ).dropna()
    one = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    here = one.join(ids, "doc_id", "left_semi")
    here = here.select("doc_id", "label", F.xxhash64("doc_id").alias("turn"))
    positive = F.col("label") > 0
    first = [here.where(c).orderBy("turn", "doc_id").limit(most) for c in (positive, ~positive)]
    # At most 2 * most rows of three numbers are left for the window.
    place = F.row_number().over(Window.partitionBy(positive).orderBy("turn", "doc_id"))
    ranked = first[0].unionByName(first[1]).withColumn("late", place > max(1, most // CLASS_SHARE))
    return ranked.orderBy("late", "turn", "doc_id").limit(most).drop("late")


def row_hash(*columns: str) -> Column:
    """Says which of the rows of an id is learnt from: the one where it is least."""
    return F.xxhash64(*columns, *(F.col(c).isNull() for c in columns)).alias("pick")


def least_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose ``pick`` is less than that of all earlier rows of their ``doc_id``.

    So a task passes on few of the rows of a repeated id, and holds one number for
    each id of the sample.
    """
    least: dict[int, int] = {}
    for batch in batches:
        chosen = []
        for k, (doc_id, pick) in enumerate(zip(batch.column("doc_id").to_pylist(),
                                               batch.column("pick").to_pylist(), strict=True)):
            if pick < least.get(doc_id, 1 << 63):
                least[doc_id] = pick
                chosen.append(k)
        yield batch.take(pa.array(chosen, pa.int64()))


def fit_in_one_task(
    features: DataFrame, train, schema: str
) -> DataFrame:
    """``train`` (table -> table) over one row per id of a bounded sample, in one task.

    Of several rows of an id that with the least ``pick`` is kept, before the rows
    meet in one place.
    """
    others = [c for c in features.columns if c not in ("doc_id", "pick")]
    one = features.groupBy("doc_id").agg(F.min(F.struct("pick", *others)).alias("kept"))
    return one.select("doc_id", *(f"kept.{c}" for c in others)).groupBy(F.lit(0).alias("sample")).applyInArrow(
        lambda _, table: train(table.sort_by([("turn", "ascending"), ("doc_id", "ascending")])),
        schema,
    )


def frequent_keys(packed_rows: list[bytes], least: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The features that ``least`` rows have, ascending, and the rows as their places.

    Empties ``packed_rows``. Rows are unpacked one at a time, twice. First each row
    adds one to the slots of its features; a slot has at least as many rows as
    each of its features, so features of emptier slots can be left out at once,
    and only the others are held and counted exactly.
    """
    slots = np.zeros(1 << SLOT_BITS, np.uint8)
    place = lambda row: row & np.int64(len(slots) - 1)
    for data in packed_rows:
        at = place(unpack_numbers(data).astype(np.int64))
        slots[at] = np.minimum(slots[at], 254) + 1
    held = []
    while packed_rows:
        row = unpack_numbers(packed_rows.pop()).astype(np.int64)
        held.append(row[slots[place(row)] >= min(least, 255)])
    held.reverse()
    del slots
    every = np.concatenate(held) if held else np.empty(0, np.int64)
    every.sort()
    new = np.ones(len(every), bool)
    np.not_equal(every[1:], every[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    keys = every[starts[np.diff(starts, append=len(every)) >= least]]
    del every, new, starts
    for k, row in enumerate(held):
        held[k] = numbered(keys, row)
    return keys, held


def sparse_fit(sample: DataFrame, l1: float = L1) -> Sparse:
    """``fit_keys`` over rows of a bounded sample: doc_id, turn, label, packed features.

    One task makes the fit. Its rows come as a stream in the order of ``turn`` and
    stay packed until the features of too few rows are known; further rows of an
    id are passed over.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed_rows, labels, last = [], [], None
        for batch in batches:
            for doc_id, label, data in zip(
                    *(batch.column(c) for c in ("doc_id", "label", "features")), strict=True):
                if last != (last := doc_id.as_py()):
                    packed_rows.append(data.as_py())
                    labels.append(label.as_py())
        if labels:
            keys, rows = frequent_keys(packed_rows, rows_to_matter(l1))
            found = fit_numbered(keys, rows, np.array(labels, np.float64), l1)
            yield pa.record_batch(
                [pa.array([found.features.tolist()], pa.list_(pa.int64())),
                 pa.array([found.weights.tolist()], pa.list_(pa.float64())),
                 pa.array([found.bias])], names=["features", "weights", "bias"])

    stream = sample.repartition(1).sortWithinPartitions("turn", "doc_id")
    model = stream.mapInArrow(
        train, "features array<bigint>, weights array<double>, bias double").first()
    if model is None:
        return fit_keys([], np.empty(0), l1)
    return Sparse(np.array(model["features"], np.int64), np.array(model["weights"]),
                  model["bias"])


def packed(batches: list[np.ndarray]) -> pa.Array:
    """Feature lists as compressed binary values."""
    return pa.array([pack_numbers(x.astype(np.uint64)) for x in batches], pa.binary())


def unpacked(column: pa.ChunkedArray) -> Iterator[np.ndarray]:
    for value in column.to_pylist():
        yield unpack_numbers(value).astype(np.int64)
