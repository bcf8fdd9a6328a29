"""Threshold-scaled document fingerprints (operator 2).

A fingerprint retains every hash of a five-word shingle that lies below a fixed
fraction of the hash range. Whatever the sizes of two texts, the same hashes
survive in both, so shared and own shingles can be estimated from the retained
ones, containment of a short text in a long one included; and the fingerprint
of a union is the union of the fingerprints. The fraction is the same for all
texts. Of m shingles about m / 2 are retained, so the error of an estimate
falls with the square root of the smaller number of shingles.

A shingle's hash has 40 bits. As a string: 16 hex digits of the text's own hash,
a colon, and in base 64 five bytes for each retained shingle hash, ascending.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import id_and_text, shingles, shuffle_partitions, words_of

FRACTION = 1 / 2  # of all shingle hashes that are retained
HASH_BITS = 40
NO_ID = -(1 << 63)  # where rows without an id are placed: first

COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def fingerprint(text: str | None, fraction: float = FRACTION) -> str:
    data = (text or "").encode()
    hashes = np.unique(shingles(words_of(data)[0]) >> np.uint64(64 - HASH_BITS))
    below = hashes[: np.searchsorted(hashes, np.uint64(fraction * 2**HASH_BITS))]
    return f"{xxhash.xxh3_64_intdigest(data):016x}:{_coded(below)}"


def _coded(hashes: np.ndarray) -> str:
    rows = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BITS // 8 :]
    return base64.b64encode(rows.tobytes()).decode()


def retained(mark: str) -> np.ndarray:
    """The retained shingle hashes of a fingerprint, ascending."""
    data = np.frombuffer(base64.b64decode(mark.partition(":")[2]), np.uint8)
    rows = data.reshape(-1, HASH_BITS // 8)
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, 8 - HASH_BITS // 8 :] = rows
    return wide.view(">u8").ravel().astype(np.uint64)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def likeness(mark: str, other: str) -> float:
    """Estimated share of common shingles among all shingles of both texts.

    1 for equal fingerprints. Where neither text retained a hash the texts' own
    hashes decide: 1 if equal, else 0.
    """
    if mark == other:
        return 1.0
    a, b = retained(mark), retained(other)
    both = _shared(a, b)
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


def containment(mark: str, other: str) -> float:
    """Estimated share of the first text's shingles that the other text has."""
    a, b = retained(mark), retained(other)
    return _shared(a, b) / len(a) if len(a) else float(mark == other)


def merged(marks: list[str]) -> str:
    """Fingerprint of the texts' shingles together; its own hash is that of the marks."""
    hashes = np.unique(np.concatenate([retained(m) for m in marks] or [np.empty(0, np.uint64)]))
    own = xxhash.xxh3_64_intdigest("".join(sorted({m.partition(":")[0] for m in marks})))
    return f"{own:016x}:{_coded(hashes)}"


def fingerprint_column(text: Column) -> Column:
    """Fingerprints of a text column; a null text is empty."""

    def marks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t) for t in texts], dtype=object)

    return F.pandas_udf(marks, "string")(text)


def range_starts(rows: DataFrame, partitions: int) -> list[tuple[int, int]]:
    """The first ``place, tie`` of each range when rows are cut evenly by both.

    Reads those columns. The list has at most ``partitions`` pairs.
    """
    ranged = rows.select("place", "tie").repartitionByRange(partitions, "place", "tie")
    starts = ranged.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min(F.struct("place", "tie")).alias("first"))
    return sorted((r["first"]["place"], r["first"]["tie"])
                  for r in starts.select("first").distinct().collect())


def with_next(rows: DataFrame, compare, schema: str) -> DataFrame:
    """``compare`` over (doc_id, text, next text) of all rows in ascending id order.

    Every range of ids, and within an id of the texts' hashes, is one partition,
    sorted; the first document of the following range is also sent to its end, so
    that each document meets its successor and every text is shuffled once. After
    the last comes the first.
    """
    rows = rows.withColumn("place", F.coalesce("doc_id", F.lit(NO_ID))).withColumn(
        "tie", F.xxhash64("text"))
    starts = range_starts(rows, shuffle_partitions(rows.sparkSession))
    parts = max(1, len(starts))

    def parts_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for places, ties in batches:
            targets = []
            for at in zip(places.tolist(), ties.tolist(), strict=True):
                p = bisect.bisect_right(starts, at) - 1
                targets.append([p] if starts[p] != at else [p, p - parts if p == 0 else -p])
            yield pd.Series(targets)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return compare(_pairs(batches))

    # An entry p >= 0 is the row's own range; -p says that it also ends range p - 1.
    targets = F.pandas_udf(parts_of, "array<bigint>")("place", "tie")
    sent = rows.withColumn("target", F.explode(targets))
    own = F.col("target") >= 0
    sent = sent.withColumn("own", own).withColumn(
        "part", F.when(own, F.col("target")).otherwise(-F.col("target") - 1).cast("int")
    )
    order = [F.col("own").desc(), "place", "tie", "text"]
    return (
        sent.select("doc_id", "text", "place", "tie", "own", "part")
        .repartitionById(parts, "part")
        .sortWithinPartitions(*order)
        .select("doc_id", "text", "own")
        .mapInArrow(pairs, schema)
    )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of (doc_id, text, next text), a list per batch."""
    before = None
    for batch in batches:
        found = []
        for doc_id, text, own in zip(*(batch.column(c).to_pylist()
                                       for c in ("doc_id", "text", "own")), strict=True):
            if before:
                found.append((*before, text))
            before = (doc_id, text) if own else None
        yield found


def compared_with_edits(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """COMPARED: each document's fingerprint beside those of two other texts.

    The edited text has the last quarter of the code points, rounded down,
    replaced by the first as many (or all) of the next document in ascending id
    order; after the last comes the first. ``near_edited`` and ``near_next`` are
    the fingerprint's likeness to the edited text's and to the next document's.

    A null text is empty; the edited text of an empty text is empty. Rows
    without an id come first; rows of one id follow in the order of a hash of
    the text; a lone document is its own next; an empty table gives no rows.
    """

    def compare(batches: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in COMPARED.split(", ")]
        types = (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())
        last, mark = None, ""  # the next document's fingerprint is used again
        for pairs in batches:
            rows = []
            for doc_id, text, after in pairs:
                own = mark if last is text else fingerprint(text)
                cut = len(text) // 4
                edited = text[: len(text) - cut] + after[:cut]
                changed, following = fingerprint(edited), fingerprint(after)
                rows.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                             own, changed, likeness(own, changed), likeness(own, following)))
                last, mark = after, following
            if rows:
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=names,
                )

    return with_next(id_and_text(docs, id_column, text_column), compare, COMPARED)
