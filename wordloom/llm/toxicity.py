"""Toxicity by FTRL-proximal logistic regression (operator 10).

Features are the hashes of a text's words, pairs of neighbouring words and pairs
with one word between them, each counted once. A feature is its whole 64-bit
hash: in fewer buckets a very long text would hit many weights by collision.
Words are lower-cased runs of characters other than blanks and ASCII
punctuation. What is learnt is a short list of weights, sent to every task that
scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import ftrl
from wordloom.llm.common import mixed, rolling, stored, words_of

MAX_LABELLED = 16_384  # ids learnt from; a bound on the fit, not on what is scored
TOXIC_AT = 0.3
_GAP = np.uint64(0xC2B2AE3D27D4EB4F)  # tells pairs with a gap from neighbours
_BLANKED = bytes(
    32 if b < 128 and not chr(b).isalnum() else b for b in range(256)
)


def _hashes(text: str | None) -> np.ndarray:
    words = words_of((text or "").encode().lower().translate(_BLANKED))[0]
    skipped = mixed(words[:-2] * _GAP + words[2:])
    return np.concatenate((words, rolling(words, 2), skipped)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """Distinct features of a whole text, ascending."""
    return np.unique(_hashes(text))


def fitted(docs: DataFrame, labels: DataFrame, label_column: str = "toxic") -> ftrl.Sparse:
    """Weights learnt from at most MAX_LABELLED labelled documents, one for each id.

    ``docs`` has doc_id and text, ``labels`` doc_id and the label. Without any
    labelled document nothing counts as toxic.
    """
    ids = docs.select("doc_id").dropna().distinct()
    sample = stored(ftrl.labelled_sample(labels, ids, label_column, "doc_id", MAX_LABELLED),
                    "toxicity-sample")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ftrl.least_rows(batches):
            found = ftrl.packed([features(t) for t in batch.column("text").to_pylist()])
            kept = ["doc_id", "turn", "label"]
            yield pa.record_batch([*(batch.column(c) for c in kept), found],
                                  names=[*kept, "features"])

    # The sample has at most MAX_LABELLED rows of three numbers, and so has the
    # list of the row of each id that is learnt from.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(
        "doc_id", ftrl.row_hash("text"), "turn", "label", "text")
    least = rows.groupBy("doc_id").agg(F.min("pick").alias("pick"))
    chosen = rows.join(F.broadcast(least), ["doc_id", "pick"]).mapInArrow(
        extract, "doc_id bigint, turn bigint, label int, features binary")
    return ftrl.sparse_fit(chosen)


def score_column(text: Column, model: ftrl.Sparse) -> Column:
    """Probability that a text is toxic; an empty or null text has the bias only."""

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            odds = np.array([model.odds(_hashes(t)) for t in texts], np.float64)
            yield pd.Series(ftrl.probability(odds))

    return F.pandas_udf(scores, "double")(text)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; such labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scored(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Only texts and the labels of rows that are not held out are used. ``labels``
    has the id as ``doc_id``, whatever ``id_column`` of ``docs`` is, and the label.
    Null texts are empty; repeated rows come back repeated, and of the rows of a
    labelled id the one with the least hash of the text is learnt from; an empty
    table gives no rows; without labels all scores are next to zero. Scoring is
    row by row, over whole texts.
    """
    rows = docs.select(
        docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].cast("string").alias("text")
    )
    model = fitted(rows, labels.where(~held_out(labels["doc_id"])), label_column)
    score = score_column(F.col("text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score.alias("score")).withColumn(
        "predicted", (F.col("score") >= TOXIC_AT).cast("int")
    )
