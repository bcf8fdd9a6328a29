"""How the sources of a language differ in their terms (operator 11).

Every term that enough documents of a language have is a row of counts by
source. The difference of two sources is the sum, over all kept terms, of the
distance of their smoothed shares. Nearly all counts are zero, so the sum is
taken as if all were and then corrected:

    sum |p - q| = V |p0 - q0|
        + sum over terms of the one source  (|p - q0| - |p0 - q0|)
        + sum over terms of the other       (|p0 - q| - |p0 - q0|)
        + sum over terms of both            (|p - q| - |p - q0| - |p0 - q| + |p0 - q0|)

where p0 and q0 are the shares of a term that does not occur. The last line comes
from a frequent-pattern tree: a term's nonzero counts in the order of the
sources are a path, equal paths are one with a multiplicity, and paths with a
common beginning share its nodes. A pair correction is made once for a node and
an ancestor, times the number of terms that pass the node.

Paths are counted and range-sorted by Spark. Sorted paths share their beginnings
with their neighbours, so each task builds the trees of blocks of its own range;
where a range or a block ends, a node is made again with the rest of its
multiplicity, which leaves the sums as they are. All numbers are integers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import shuffle_partitions, stored

# Fixed values of the measure.
MIN_DOCUMENTS, SCALE, SMOOTHING, TERM_RANKS = 30, 1_000_000_000, 5, 50
# Of UTF-8: every byte of a character beyond ASCII is above 7F.
TERMS = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
BLOCK_TERMS = 400_000  # distinct terms a task holds before it passes them on
BLOCK_CELLS = 1 << 21  # paths of one tree times the length of the longest

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                     ("n", pa.int64()), ("docs", pa.int64())])
CORRECTIONS = "lang string, a string, b string, value decimal(38,0)"
_CORRECTIONS = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()),
                          ("value", pa.decimal128(38, 0))])
ROWS = "lang string, source string, part string, item string, value bigint, rank int"


# --- counts ------------------------------------------------------------------


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """COUNTS of blocks of documents. A group also has a row without a term."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            k = len(docs) + 1
            columns = [
                pa.repeat(lang, k), pa.repeat(source, k),
                pa.array([None, *docs], pa.binary()).cast(pa.string()),
                pa.array([0, *map(n.__getitem__, docs)], pa.int64()),
                pa.array([0, *docs.values()], pa.int64()),
            ]
            yield pa.record_batch(columns, schema=_COUNTS)

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(),
                                      batch.column("source").to_pylist(), texts, strict=True):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            size -= len(docs)
            found = TERMS.findall(text.as_py().lower())  # of bytes: A to Z only
            n.update(found)
            docs.update(set(found))
            size += len(docs)
            if size >= BLOCK_TERMS:
                yield from rows()
                groups, size = {}, 0
    yield from rows()


def term_counts(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """COUNTS by group and term; the row of a group without a term has zeros."""
    words = lambda name: F.coalesce(
        docs[columns.get(name, name)].cast("string"), F.lit("")).alias(name)
    blocks = docs.select(words("lang"), words("source"), words("text")).mapInArrow(
        _term_counts, COUNTS)
    # Counted by source first: a frequent term of a language is many keys.
    return blocks.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"),
                                                        F.sum("docs").alias("docs"))


# --- the tree ----------------------------------------------------------------


def tree_nodes(paths: list[list[int]], times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Item, parent and multiplicity of the nodes of the tree of sorted paths.

    ``paths`` are lists of item numbers. A parent is a node's number, of the
    first node of a path -1. Parents come before their children.
    """
    lengths = np.fromiter(map(len, paths), np.int64, len(paths))
    width = int(lengths.max(initial=0))
    table = np.full((len(paths), width), -1, np.int64)
    table[np.arange(width) < lengths[:, None]] = np.concatenate(
        [np.asarray(p, np.int64) for p in paths]) if width else []
    shared = np.zeros(table.shape, bool)
    shared[1:] = np.logical_and.accumulate(table[1:] == table[:-1], axis=1)
    new = ~shared & (table >= 0)
    numbers = np.where(new, np.cumsum(new.ravel()).reshape(new.shape), 0) - 1
    # A shared place has the node of the last path that made one there.
    node = np.maximum.accumulate(numbers, axis=0)
    weight = np.zeros(int(new.sum()), np.int64)
    inside = table >= 0
    np.add.at(weight, node[inside], np.broadcast_to(times[:, None], table.shape)[inside])
    parent = np.full(table.shape, -1, np.int64)
    parent[:, 1:] = node[:, :-1]
    return table[new], parent[new], weight


def pair_sums(items: np.ndarray, parent: np.ndarray, weight: np.ndarray, source: np.ndarray,
              share: np.ndarray, zero: np.ndarray, sources: int) -> np.ndarray:
    """Sums of the corrections of both counts, by number of the two sources.

    Each node meets each of its ancestors once; all nodes climb together. A term
    adds at most 4 * SCALE to a pair, so sums stay below 2**63 for 10**9 terms.
    """
    sums = np.zeros(sources * sources, np.int64)
    node, above = np.arange(len(items)), parent
    while (at := np.flatnonzero(above >= 0)).size:
        node, above = node[at], above[at]
        x, y = items[node], items[above]
        p, q, p0, q0 = share[x], share[y], zero[x], zero[y]
        value = abs(p - q) - abs(p - q0) - abs(p0 - q) + abs(p0 - q0)
        np.add.at(sums, source[x] * sources + source[y], weight[node] * value)
        above = parent[above]
    return sums.reshape(sources, sources)


def _block_corrections(lang: str, paths: list[list[tuple]], times: list[int]) -> Iterator[tuple]:
    """CORRECTIONS of one block of sorted paths of (source, n, share, zero)."""
    numbers: dict[tuple, int] = {}
    coded = [[numbers.setdefault(item, len(numbers)) for item in path] for path in paths]
    names = sorted({item[0] for item in numbers})
    place = {name: k for k, name in enumerate(names)}
    source = np.array([place[item[0]] for item in numbers], np.int64)
    share, zero = (np.array([item[k] for item in numbers], np.int64) for k in (2, 3))
    items, parent, weight = tree_nodes(coded, np.array(times, np.int64))
    sums = pair_sums(items, parent, weight, source, share, zero, len(names))
    sums += sums.T
    for a, b in zip(*np.nonzero(np.triu(sums, 1))):
        yield lang, names[a], names[b], int(sums[a, b])


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lang, paths, times, width = None, [], [], 0

    def rows() -> Iterator[pa.RecordBatch]:
        found = list(_block_corrections(lang, paths, times)) if paths else []
        if found:
            a, b, c, values = zip(*found)
            yield pa.record_batch(
                [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c, pa.string()),
                 pa.array(values, pa.int64()).cast(pa.decimal128(38, 0))], schema=_CORRECTIONS)

    for batch in batches:
        for of_lang, path, n in zip(*(batch.column(c).to_pylist()
                                      for c in ("lang", "path", "times")), strict=True):
            longest = max(width, len(path))
            if lang != of_lang or longest * (len(paths) + 1) > BLOCK_CELLS:
                yield from rows()
                lang, paths, times, longest = of_lang, [], [], len(path)
            paths.append([(i["source"], i["n"], i["share"], i["zero"]) for i in path])
            times.append(n)
            width = longest
    yield from rows()


# --- the audit ---------------------------------------------------------------


def divergence(
    docs: DataFrame,
    *,
    columns: dict[str, str] | None = None,
    min_documents: int = MIN_DOCUMENTS,
    term_ranks: int = TERM_RANKS,
) -> DataFrame:
    """ROWS: how far each source of a language is from the others, and in which terms.

    Part ``pair`` has a row for every other source of the language, part ``term``
    the ``term_ranks`` terms that the source has more of than its language. Terms
    are those of ``min_documents`` documents of the language. Null text, lang and source are empty strings; documents without terms still make
    their group occur; repeated rows count repeatedly; equal values are ranked by
    item in UTF-8 order; an empty table gives no rows. ``columns`` maps lang,
    source and text to other names; other columns are not looked at.
    """
    counts = stored(term_counts(docs, columns or {}), "term-counts")
    groups_seen = counts.where("term is null").select("lang", "source")
    present = counts.where("term is not null")
    kept = present.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n"))
    kept = kept.where(F.col("docs") >= min_documents).select("lang", "term", "all_n")
    rows = stored(present.join(kept, ["lang", "term"]).select(
        "lang", "source", "term", "n", "all_n"), "kept-counts")
    langs = rows.groupBy("lang", "term").agg(F.max("all_n").alias("all_n")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("all_n").alias("lang_n"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
    groups = groups_seen.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stored(groups.select(
        "lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("source_n", "terms", "lang_n"))
    ).withColumn("zero", F.when(F.col("terms") > 0, _quotient(F.lit(0), "source_n")).otherwise(0)),
        "groups")
    shares = stored(
        rows.join(groups, ["lang", "source"])
        .withColumn("share", _quotient(F.col("n"), "source_n"))
        .withColumn("lang_share", _quotient(F.col("all_n"), "lang_n"))
        .select("lang", "source", "term", "n", "share", "zero", "lang_share"), "shares")
    return _pairs(shares, groups).unionByName(_terms(shares, term_ranks))


def _quotient(count: Column, total: str) -> Column:
    """The smoothed share of a count, in whole SCALE parts and one more."""
    wide = "decimal(28,0)"
    up = (F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")).cast(wide)
    down = (F.col(total) + SMOOTHING * F.col("terms")).cast(wide)
    return F.call_function("div", up, down) + 1


def _terms(shares: DataFrame, ranks: int) -> DataFrame:
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = shares.where("share > lang_share").select(
        "lang", "source", F.col("term").alias("item"),
        (F.col("share") - F.col("lang_share")).alias("value"))
    ranked = more.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= ranks)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    wide = "decimal(38,0)"
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"))
    # Terms of one source, by share: so many of a kind meet every other source once.
    kinds = shares.groupBy("lang", "source", "share", "zero").agg(F.count("*").alias("times"))
    one = kinds.join(other, "lang").where("source <> item")
    change = F.abs(F.col("share") - F.col("other_zero")) - F.abs(F.col("zero") - F.col("other_zero"))
    singles = one.groupBy("lang", "source", "item").agg(
        F.sum((F.col("times") * change).cast(wide)).alias("value"))
    item = F.struct("source", "n", "share", "zero")
    paths = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(item)).alias("path"))
    paths = paths.groupBy("lang", "path").agg(F.count("*").alias("times"))
    parts = shuffle_partitions(shares.sparkSession)
    # Ranges are drawn by the first counts of a path, and a hash for paths that begin alike.
    # As a sort key a path orders its counts one by one, so beginnings are neighbours.
    at = lambda k: (F.get("path", F.lit(k))["source"], F.get("path", F.lit(k))["n"])
    ranges = [F.col("lang"), *at(0), *at(1), F.xxhash64("path")]
    ordered = paths.repartitionByRange(parts, *ranges).sortWithinPartitions("lang", "path")
    both = ordered.mapInArrow(_corrections, CORRECTIONS)
    ways = lambda df, a, b: df.select("lang", F.col(a).alias("source"), F.col(b).alias("item"), "value")
    base = groups.join(other, "lang").where("source <> item").select(
        "lang", "source", "item",
        (F.col("terms") * F.abs(F.col("zero") - F.col("other_zero"))).cast(wide).alias("value"))
    every = base
    for part in (ways(singles, "source", "item"), ways(singles, "item", "source"),
                 ways(both, "a", "b"), ways(both, "b", "a")):
        every = every.unionByName(part)
    summed = every.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(first).alias("rank"))
