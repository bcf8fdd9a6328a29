"""Quality classifier by co-training (operator 4).

Two classifiers look at separate views of a document: one at its text (words
and their shapes), one at its metadata alone (language, source and stated size).
Over some rounds each labels the documents of an unlabelled pool it is surest of by
its calibrated odds, of either class as many as the class's share among the
labels asks for, and the other learns from those. Then each view's log-odds are calibrated on labelled
documents neither has learnt from. Given the class the views are taken as
independent, as co-training has it, so the calibrated log-odds of a document are
added up, less those of the class itself, which both contain. A feature of the
text is its whole 64-bit hash, so that very long texts do not hit weights by
collision.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import ftrl
from wordloom.llm.common import mixed, rolling, unused, words_of

MAX_LABELLED = 8_192  # ids learnt from and calibrated on; a bound on the fit alone
MAX_POOL = 8_192  # unlabelled documents that get pseudo-labels; a bound on the fit alone
TEXT_L1 = 2.0
ROUNDS = 4
SURE = 0.95  # a pseudo-label's least probability
SHARE_PER_ROUND = 0.1  # of the pool that a view may label in a round
CALIBRATION_SHARE = 5  # every fifth labelled document calibrates
KEEP_AT = 0.5
RIDGE = 1.0
CALIBRATION_RIDGE = 5.0  # keeps the slope of a view small that a few rows speak for
ROUND_RIDGE = 0.01  # that of the odds by which pseudo-labels are chosen
LANG_SLOTS, SOURCE_SLOTS = 8, 16

# Classes of bytes: letters by case, digits, the rest as it is. Non-ASCII letters count as a.
_CLASS = bytes(
    ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57
    else ord("a") if 97 <= b <= 122 or b >= 128 else b
    for b in range(256)
)
_RUN = re.compile(rb"([^\s])\1+")


def _text_hashes(text: str | None) -> np.ndarray:
    data = (text or "").encode()
    shapes = words_of(_RUN.sub(rb"\1", data.translate(_CLASS)))[0]
    words = words_of(data.lower())[0]
    return np.concatenate((mixed(words), shapes, rolling(shapes, 2))).astype(np.int64)


def text_features(text: str | None) -> np.ndarray:
    """Distinct features: lower-cased words, shapes of words, pairs of shapes.

    A shape has one character for each run of a class: "Hello," is "Aa,".
    """
    return np.unique(_text_hashes(text))


SIZE_SLOTS = 24
NUMBERS = 1 + SIZE_SLOTS


def metadata_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """The size and its power of two, then language and source by hash.

    Nothing here is measured on the text. A null size, language or source is a
    value of its own.
    """
    size = max(0, n_chars or 0)
    slots = np.zeros(SIZE_SLOTS + LANG_SLOTS + SOURCE_SLOTS)
    slots[SIZE_SLOTS - 1 if n_chars is None else min(size.bit_length(), SIZE_SLOTS - 2)] = 1
    slots[SIZE_SLOTS + xxhash.xxh3_64_intdigest(repr(lang)) % LANG_SLOTS] = 1
    slots[SIZE_SLOTS + LANG_SLOTS + xxhash.xxh3_64_intdigest(repr(source)) % SOURCE_SLOTS] = 1
    return np.concatenate(([np.log1p(size)], slots))


@dataclass
class Metadata:
    """Ridge logistic regression over standardised metadata features."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def fit(cls, rows: np.ndarray, labels: np.ndarray) -> Metadata:
        mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
        x = np.column_stack(((rows - mean) / scale, np.ones(len(rows))))
        return cls(mean, scale, _ridge(x, labels, RIDGE))

    def odds(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -20, 20)
        return x @ self.weights[:-1] + self.weights[-1]


def _ridge(x: np.ndarray, labels: np.ndarray, ridge: float, steps: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps; the last column has no penalty."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = ftrl.probability(x @ w)
        slope = x.T @ (p - labels) + penalty * w
        bend = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def calibrated(
    odds: np.ndarray, labels: np.ndarray, ridge: float = CALIBRATION_RIDGE
) -> tuple[float, float]:
    """Slope and offset that turn log-odds into calibrated ones (never reversed)."""
    # Smoothed targets keep the slope finite where the classes are far apart.
    up, down = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    slope, offset = _ridge(np.column_stack((odds, np.ones(len(odds)))), target, ridge)
    return max(0.0, float(slope)), float(offset)


@dataclass
class Model:
    """Both views and their calibration."""

    text: ftrl.Sparse
    metadata: Metadata
    text_scale: tuple[float, float]
    metadata_scale: tuple[float, float]
    prior: float = 0.0  # log-odds of the class, which both views contain

    def odds(self, text: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        a, b = self.text_scale
        c, d = self.metadata_scale
        return (a * text + b) + (c * self.metadata.odds(metadata) + d) - self.prior


def _text_odds(model: ftrl.Sparse, rows: list[np.ndarray]) -> np.ndarray:
    return np.array([model.odds(row) for row in rows], np.float64)


def cotrain(texts: list[np.ndarray], metadata: np.ndarray, labels: np.ndarray) -> Model | None:
    """A model from rows whose label is 1, 0 or, for the pool, below 0.

    None unless both labels occur among the rows to learn from.
    """
    known = np.flatnonzero(labels >= 0)
    held, train = known[::CALIBRATION_SHARE], np.setdiff1d(known, known[::CALIBRATION_SHARE])
    if len(set(labels[train].tolist())) < 2:
        return None
    pool = np.flatnonzero(labels < 0)
    keys, texts = ftrl.numbered_rows(texts)
    # Each view learns from the labelled rows and from what the other has labelled.
    for_text, for_metadata = (train, labels[train]), (train, labels[train])
    share = float(labels[train].mean())
    most = max(2, int(SHARE_PER_ROUND * len(pool)))
    good = min(max(1, round(share * most)), most - 1)

    def fit() -> tuple[ftrl.Sparse, Metadata]:
        at, y = for_text
        return (ftrl.fit([texts[k] for k in at], y, len(keys), TEXT_L1),
                Metadata.fit(metadata[for_metadata[0]], for_metadata[1]))

    def surest(odds: np.ndarray, held_odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the pool that are SURE by calibrated odds, the classes by their shares.

        A view that knows little is sure of little, and one that is sure of a
        single class labels none, so that no round shifts the balance.
        """
        slope, offset = calibrated(held_odds, labels[held], ROUND_RIDGE)
        order, p = np.argsort(-odds, kind="stable"), ftrl.probability(slope * odds + offset)
        up = [k for k in order[:good] if p[k] >= SURE]
        down = [k for k in order[::-1][: most - good] if p[k] <= 1 - SURE]
        part = min(len(up) / good, len(down) / (most - good))
        up, down = up[: round(part * good)], down[: round(part * (most - good))]
        return np.array(up + down, np.int64), np.repeat([1.0, 0.0], [len(up), len(down)])

    by_text, by_metadata = fit()
    for _ in range(ROUNDS):
        if not len(pool):
            break
        in_text = lambda at: _text_odds(by_text, [texts[k] for k in at])  # noqa: B023, E731
        a, a_labels = surest(in_text(pool), in_text(held))
        b, b_labels = surest(by_metadata.odds(metadata[pool]), by_metadata.odds(metadata[held]))
        if not len(a) + len(b):
            break
        for_metadata = (np.append(for_metadata[0], pool[a]), np.append(for_metadata[1], a_labels))
        for_text = (np.append(for_text[0], pool[b]), np.append(for_text[1], b_labels))
        pool = np.delete(pool, np.union1d(a, b))
        by_text, by_metadata = fit()
    y = labels[held]
    up = float(y.sum())
    return Model(
        ftrl.Sparse(keys[by_text.features], by_text.weights, by_text.bias), by_metadata,
        calibrated(_text_odds(by_text, [texts[k] for k in held]), y),
        calibrated(by_metadata.odds(metadata[held]), y),
        float(np.log((up + 1) / (len(y) - up + 1))),
    )


MODEL = (
    "features array<bigint>, weights array<double>, bias double, mean array<double>, "
    "scale array<double>, metadata_weights array<double>, scales array<double>, prior double"
)
_LISTS = pa.list_(pa.float64())
_MODEL = pa.schema([
    ("features", pa.list_(pa.int64())), ("weights", _LISTS), ("bias", pa.float64()),
    ("mean", _LISTS), ("scale", _LISTS), ("metadata_weights", _LISTS), ("scales", _LISTS),
    ("prior", pa.float64())])


def fitted(docs: DataFrame, labels: DataFrame, label_column: str = "quality") -> Model | None:
    """The model of a bounded sample, or None where two labels are not to be had.

    ``docs`` has doc_id, text, lang, source and n_chars, ``labels`` doc_id and
    the label. Learns from at most MAX_LABELLED labelled ids of ``docs`` and a pool of
    at most MAX_POOL others, those with the smallest hash of their id, and of several
    rows of an id from the one with the least hash.
    """
    ids = docs.select("doc_id").dropna().distinct()
    labelled = ftrl.labelled_sample(labels, ids, label_column, "doc_id", MAX_LABELLED)
    others = ids.join(
        labels.select(labels["doc_id"].cast("bigint").alias("doc_id")), "doc_id", "left_anti"
    )
    turn = F.xxhash64("doc_id")
    pool = others.select("doc_id", F.lit(-1).alias("label"), turn.alias("turn")).orderBy(
        "turn", "doc_id").limit(MAX_POOL)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ftrl.least_rows(batches):
            rows = list(zip(*(batch.column(c).to_pylist()
                              for c in ("text", "lang", "source", "n_chars")), strict=True))
            kept = ["doc_id", "pick", "turn", "label"]
            yield pa.record_batch(
                [*(batch.column(c) for c in kept),
                 ftrl.packed([text_features(r[0]) for r in rows]),
                 pa.array([metadata_features(*r[1:]) for r in rows], pa.list_(pa.float64()))],
                names=[*kept, "text", "metadata"],
            )

    def train(table: pa.Table) -> pa.Table:
        metadata = np.array(table.column("metadata").to_pylist(), np.float64)
        model = cotrain(list(ftrl.unpacked(table.column("text"))), metadata,
                        table.column("label").to_numpy().astype(np.float64))
        if model is None:
            return _MODEL.empty_table()
        row = (model.text.features, model.text.weights, model.text.bias, model.metadata.mean,
               model.metadata.scale, model.metadata.weights,
               np.array([*model.text_scale, *model.metadata_scale]), model.prior)
        return pa.table([pa.array([x], f.type) for x, f in zip(row, _MODEL, strict=True)], _MODEL)

    # At most MAX_LABELLED + MAX_POOL rows of three numbers.
    chosen = F.broadcast(labelled.select("doc_id", "label", "turn").unionByName(pool))
    columns = ("text", "lang", "source", "n_chars")
    rows = docs.join(chosen, "doc_id").select(
        "doc_id", ftrl.row_hash(*columns), "turn", "label", *columns
    ).mapInArrow(extract, "doc_id bigint, pick bigint, turn bigint, label int, text binary, "
                          "metadata array<double>")
    row = ftrl.fit_in_one_task(rows, train, MODEL).first()
    if row is None:
        return None
    array = lambda name: np.array(row[name], np.float64)
    scales = row["scales"]
    return Model(
        ftrl.Sparse(np.array(row["features"], np.int64), array("weights"), row["bias"]),
        Metadata(array("mean"), array("scale"), array("metadata_weights")),
        (scales[0], scales[1]), (scales[2], scales[3]), row["prior"],
    )


def score_column(
    text: Column, lang: Column, source: Column, n_chars: Column, model: Model | None
) -> Column:
    """Probability of good quality; without a model 1, so that nothing is rejected."""
    if model is None:
        return F.lit(1.0)

    def scores(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.Series]:
        for texts, langs, sources, sizes in batches:
            sizes = [None if pd.isna(n) else int(n) for n in sizes]
            rows = [metadata_features(*r) for r in zip(langs, sources, sizes, strict=True)]
            text_odds = [model.text.odds(_text_hashes(t)) for t in texts]
            metadata = np.array(rows).reshape(len(rows), -1)
            yield pd.Series(ftrl.probability(model.odds(np.array(text_odds), metadata))
                            if rows else np.empty(0))

    return F.pandas_udf(scores, "double")(text, lang, source, n_chars)


def with_scores(
    docs: DataFrame, labels: DataFrame, *, label_column: str = "quality", name: str = "quality_score"
) -> DataFrame:
    """``docs`` and the score as column ``name``, learnt from ``labels``.

    ``docs`` has doc_id, text, lang, source and n_chars, any of which may be null.
    Every row is scored by itself, over its whole text; repeated rows score
    alike; an empty table gives no rows. Null labels are left out; where labels
    of both kinds are missing every score is 1. A column called ``name`` is
    replaced, all others stay.
    """
    plain = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        *(docs[c].cast("string").alias(c) for c in ("text", "lang", "source")),
        docs["n_chars"].cast("bigint").alias("n_chars"),
    )
    model = fitted(plain, labels, label_column)
    score = score_column(docs["text"].cast("string"), docs["lang"].cast("string"),
                         docs["source"].cast("string"), docs["n_chars"].cast("bigint"), model)
    return docs.withColumn(name, score)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score KEEP_AT or more; columns as before."""
    name = unused(docs, "quality")
    return with_scores(docs, labels, name=name).where(F.col(name) >= KEEP_AT).drop(name)
