"""Near-duplicates by BagMinHash (operator 3).

A text is the bag of its five-word shingles; two texts are near-duplicates if the
weighted Jaccard similarity of their bags is SIMILARITY or more.

Signatures. The weight axis of a shingle is cut into the dyadic intervals [0, 1),
[1, 2), [2, 4), [4, 8) ... Every shingle and interval has a Poisson process of
its own, whose rate is the interval's length, and each of its points has a
component of the signature and a place in the interval. A point counts for a
text if its place lies below the shingle's count. A component's value is the
earliest point that counts, so two texts agree in a component with exactly the
probability of their weighted Jaccard similarity. Processes are followed in time
only as far as components are still open, so a long text costs little more than
its number of shingles.

Links. Bands of components put texts into buckets. Each text is first compared,
by exact multiset overlap, with the smallest text of the buckets it shares most
often; that ties most groups together without any pair of their other members.
In buckets that still hold several components each text is then compared with a
hub: the text with the most others in its buckets, which is the original of many
copies that are like it but not like each other. Where a bucket holds several
components even then, the texts outside its largest component are compared with
all others of the bucket block by block, so no link between different texts is
lost, no task ever holds more than two blocks, and texts of one component are
not compared again.

Equal texts are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import mixed, rolling, shingles, stored, unused, words_of
from wordloom.llm.components import components, joined_components

SIMILARITY = 0.8
BANDS, ROWS = 32, 6
SIZE = BANDS * ROWS
BLOCK_TEXTS = 256
TOGETHER = 1 << 17  # shingles followed together, a matter of speed and memory alone
_NEXT = np.uint64(0xD1342543DE82EF95)  # steps of the counters. Any odd numbers do.
_COPY = np.uint64(0xAF251AF3B0F025B5)


def bag(text: str) -> np.ndarray:
    """Shingles of a text with repetition, ascending."""
    return np.sort(shingles(words_of(text.encode())[0]))


def as_set(shingled: np.ndarray) -> np.ndarray:
    """A bag as a set: the k-th copy of a shingle is an element of its own, ascending.

    Overlap of two such sets is the multiset overlap of the bags.
    """
    if not len(shingled):
        return shingled
    new = np.append(True, shingled[1:] != shingled[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    copy = np.arange(len(shingled), dtype=np.uint64) - first.astype(np.uint64)
    return np.sort(mixed(shingled + copy * _COPY))


def _uniform(state: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1]."""
    return ((mixed(state) >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)


def signatures(bags: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """For each bag, none empty, the hash of the earliest point of each component.

    All bags are followed together: one round moves every process that still has
    a point within its bag's horizon, and a bag's horizon is doubled as long as
    one of its components is open. A component's value names the point, so it
    does not depend on which bags are followed together.
    """
    found = [np.unique(bag, return_counts=True) for bag in bags]
    values = np.concatenate([v for v, _ in found])
    counts = np.concatenate([c for _, c in found]).astype(np.int64)
    of = np.repeat(np.arange(len(bags)), [len(v) for v, _ in found])
    # Intervals [0, 1), [1, 2), [2, 4) ... as far as a weight reaches.
    parts, low, width, level = [], 0, 1, 0
    while len(inside := np.flatnonzero(counts > low)):
        seeds = mixed(values[inside] ^ mixed(np.full(1, level, np.uint64)))
        parts.append((seeds, np.full(len(inside), low), np.full(len(inside), width),
                      counts[inside], of[inside]))
        low, width, level = low + width, max(1, low + width), level + 1
    state, lows, widths, weights, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
    rates = widths.astype(np.float64) * size
    times = -np.log(_uniform(state)) / rates
    best = np.full(len(bags) * size, np.inf)
    point = np.zeros(len(bags) * size, np.uint64)
    horizon = (np.log(size) + 3) / np.array([len(bag) for bag in bags], np.float64)
    while True:
        due = np.flatnonzero(times <= horizon[owner])
        while len(due):
            drawn = mixed(state[due] + _COPY)
            place = lows[due] + (drawn >> np.uint64(40)).astype(np.int64) % widths[due]
            counted = place < weights[due]
            here, at = due[counted], drawn[counted]
            slot = owner[here] * size + ((at & np.uint64(0xFFFFFFFF)).astype(np.int64) * size >> 32)
            np.minimum.at(best, slot, times[here])
            first = times[here] == best[slot]
            point[slot[first]] = at[first]
            state[due] += _NEXT
            times[due] -= np.log(_uniform(state[due])) / rates[due]
            due = due[times[due] <= horizon[owner[due]]]
        still = (best.reshape(len(bags), size) > horizon[:, None]).any(axis=1)
        if not still.any():
            return mixed(point).reshape(len(bags), size)
        horizon[still] *= 2


def signature(shingled: np.ndarray, size: int = SIZE) -> np.ndarray:
    return signatures([shingled], size)[0]


def band_keys(texts: list[str]) -> list[list[int]]:
    """For each text a hash of each band of its signature; none without words."""
    keys: list[list[int]] = [[] for _ in texts]
    waiting: list[tuple[int, np.ndarray]] = []
    width = ROWS + 1

    def finish() -> None:
        rows = signatures([bag for _, bag in waiting]).reshape(-1, BANDS, ROWS)
        numbers = np.broadcast_to(np.arange(BANDS, dtype=np.uint64)[None, :, None],
                                  (len(waiting), BANDS, 1))
        numbered = np.concatenate((numbers, rows), axis=2).ravel()
        hashed = rolling(numbered, width)[::width].view(np.int64).reshape(-1, BANDS)
        for (k, _), own in zip(waiting, hashed.tolist(), strict=True):
            keys[k] = own
        waiting.clear()

    size = 0
    for k, text in enumerate(texts):
        if len(shingled := bag(text)):
            waiting.append((k, shingled))
            size += len(shingled) + SIZE
        if size >= TOGETHER:
            finish()
            size = 0
    if waiting:
        finish()
    return keys


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags given as sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def _marked(rows: DataFrame) -> DataFrame:
    """``row, doc_id, digest, bands``: a stored row for each document."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(batch.column("text").to_pylist())
            yield pa.record_batch(
                [batch.column("row"), batch.column("doc_id"), batch.column("digest"),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["row", "doc_id", "digest", "bands"],
            )

    numbered = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text",
        F.md5(F.col("text").cast("binary")).alias("digest"),
    )
    return stored(
        numbered.mapInArrow(mark, "row bigint, doc_id bigint, digest string, bands array<bigint>"),
        "bags",
    )


def _shared_buckets(nodes: DataFrame) -> DataFrame:
    """``key, node, least, n, members`` of all buckets with two or more texts."""
    entries = nodes.select("node", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(
        F.min("node").alias("least"), F.count("*").alias("n"),
        # A check sum of the members: buckets of the same texts are looked at once.
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"),
    ).where("n > 1")
    # Stored, so that the join meets plain shuffles and can split a hot bucket.
    return stored(entries.join(stored(buckets, "bucket-sizes"), "key"), "buckets")


def _bags_of(rows: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, bag`` of the wanted nodes, stored; texts meet them by id and digest.

    Only one of any number of equal texts has the id of its node, so no digest is hot.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [as_set(bag(t)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("node"), pa.array(bags, pa.binary())],
                                  names=["node", "bag"])

    ids = nodes.join(wanted, "node", "left_semi").select("node", "digest", "doc_id")
    texts = rows.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("digest"))
    same = (texts["digest"] == ids["digest"]) & texts["doc_id"].eqNullSafe(ids["doc_id"])
    found = texts.join(ids, same).select("node", "text")
    bags = found.mapInArrow(cut, "node bigint, bag binary")
    # Repeated rows have the same id and text.
    return stored(bags.dropDuplicates(["node"]), "bags-of-nodes")


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bags are similar."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (batch.column(c).to_pylist() for c in ("bag_a", "bag_b"))
            keep = [similarity(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= SIMILARITY
                    for x, y in zip(*sides, strict=True)]
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column("a").filter(mask), batch.column("b").filter(mask)],
                                  names=["a", "b"])

    of = lambda side: bags.select(F.col("node").alias(side), F.col("bag").alias(f"bag_{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "bag_a", "bag_b").mapInArrow(
        verify, "a bigint, b bigint"
    )


def _star_pairs(buckets: DataFrame) -> DataFrame:
    """For each text the least text of its buckets that it shares most buckets with."""
    shared = buckets.where("node != least").groupBy("node", "least").agg(F.count("*").alias("n"))
    best = shared.groupBy("node").agg(
        F.max(F.struct(F.col("n"), (-F.col("least")).alias("minus"))).alias("best")
    )
    return best.select(F.col("node").alias("a"), (-F.col("best.minus")).alias("b"))


def _with_components(buckets: DataFrame, known: DataFrame) -> DataFrame:
    """``buckets`` and the component of each text, as far as it is tied to others."""
    return buckets.join(known, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _mixed(placed: DataFrame) -> DataFrame:
    """The entries of buckets of several components, of equal buckets those of one."""
    mixed_keys = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.first("n").alias("n"), F.first("members").alias("members"),
    ).where("low != high")
    once = stored(
        mixed_keys.groupBy("n", "members").agg(F.min("key").alias("key")).select("key"), "mixed")
    return placed.join(once, "key", "left_semi")


def _hub_pairs(entries: DataFrame) -> DataFrame:
    """For each text the hub that it shares most buckets with, of another component.

    The hub of a bucket is its text with the most other texts in all its buckets.
    """
    busy = entries.groupBy("node").agg(F.sum("n").alias("busy"))
    known = entries.join(stored(busy, "busy"), "node")
    hubs = known.groupBy("key").agg(
        F.max_by(F.struct("node", "component"), F.struct("busy", (-F.col("node")).alias("minus")))
        .alias("hub")
    ).select("key", F.col("hub.node").alias("hub"), F.col("hub.component").alias("of"))
    met = entries.join(stored(hubs, "hubs"), "key").where("component != of")
    shared = met.groupBy("node", "hub").agg(F.count("*").alias("times"))
    best = shared.groupBy("node").agg(
        F.max_by("hub", F.struct("times", (-F.col("hub")).alias("minus"))).alias("b"))
    return best.select(F.col("node").alias("a"), "b")


def block_links(table: pa.Table) -> pa.Table:
    """Links that tie together what is not yet tied, within one or between two blocks.

    An inverted index of the elements counts the overlap of one text with all
    others at once; a pair is emitted if it is similar and its ends are not
    connected so far.
    """
    nodes = table.column("node").to_numpy()
    part, component = table.column("part").to_numpy(), table.column("component").to_numpy()
    bags = [np.frombuffer(b, np.uint64) for b in table.column("bag").to_pylist()]
    sizes = np.array([len(b) for b in bags])
    owner = np.repeat(np.arange(len(bags)), sizes)
    codes = np.unique(np.concatenate(bags), return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    ends = np.cumsum(np.bincount(codes))
    parent = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    two_blocks = len(np.unique(part)) > 1
    at, links = 0, []
    for i in range(len(bags)):
        own = codes[at : at + sizes[i]]
        at += sizes[i]
        begins = np.where(own > 0, ends[own - 1], 0)
        lengths = ends[own] - begins
        before = np.cumsum(lengths) - lengths
        places = np.repeat(begins - before, lengths) + np.arange(int(lengths.sum()))
        overlap = np.bincount(owner[order[places]], minlength=len(bags))
        like = overlap >= SIMILARITY * (sizes[i] + sizes - overlap)
        like[: i + 1] = False
        if two_blocks:
            like &= part != part[i]
        for j in np.flatnonzero(like).tolist():
            a, b = root(int(component[i])), root(int(component[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(nodes[i]), int(nodes[j])))
    columns = zip(*links, strict=True) if links else ([], [])
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])


def _met_blocks(entries: DataFrame) -> DataFrame:
    """``key, one, two, node, component, part``: each text once for every two blocks that meet.

    The texts of a bucket's largest component, and its others, are dealt into
    blocks of some BLOCK_TEXTS by hash; blocks of the others are numbered first.
    Two blocks meet if one of them is of the others.
    """
    sizes = entries.groupBy("key", "component").agg(F.count("*").alias("size"))
    sizes = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("size", "component")).alias("largest"),
        F.max("size").alias("most"), F.sum("size").alias("all"))
    blocks = lambda n: F.ceil(n / BLOCK_TEXTS).cast("int")
    cut = entries.join(stored(sizes, "largest"), "key").select(
        "key", "node", "component", (F.col("component") == F.col("largest")).alias("in_largest"),
        blocks(F.col("all") - F.col("most")).alias("rest"), blocks(F.col("most")).alias("main"),
    )
    place = lambda n: F.pmod(F.xxhash64("node", "key"), n).cast("int")
    part = F.when(F.col("in_largest"), F.col("rest") + place(F.col("main"))).otherwise(
        place(F.col("rest")))
    meets = F.when(F.col("in_largest"), F.col("rest")).otherwise(F.col("rest") + F.col("main"))
    met = cut.withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), meets - 1)))
    return met.select("key", "node", "component", "part",
                      F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))


def _remaining_links(entries: DataFrame, bags: DataFrame) -> DataFrame:
    """Links between different components within any bucket; a group is two blocks."""
    return _met_blocks(entries).join(bags, "node").groupBy("key", "one", "two").applyInArrow(
        block_links, "a bigint, b bigint"
    )


def _classed(rows: DataFrame) -> DataFrame:
    """``row, doc_id, digest, class`` of ``rows`` (doc_id, text)."""
    marked = _marked(rows)
    # The row with the smallest id stands for all equal texts.
    first = marked.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    ).select("digest", F.col("first.row").alias("node"))
    nodes = stored(
        marked.join(first.select("node"), marked["row"] == F.col("node"), "left_semi")
        .withColumnRenamed("row", "node"),
        "nodes",
    )
    buckets = _shared_buckets(nodes.where(F.size("bands") > 0))
    bags = _bags_of(rows, nodes, buckets.select("node").distinct())
    stars = stored(_verified(_star_pairs(buckets), bags), "star-links")
    known = stored(components(stars), "components")
    open_buckets = stored(_mixed(_with_components(buckets, known)), "open-buckets")
    hubs = stored(_verified(_hub_pairs(open_buckets), bags), "hub-links")
    known = stored(joined_components(known, hubs), "components")
    # Buckets that are no longer mixed are left out; the others are few.
    left = open_buckets.drop("component")
    left = stored(_mixed(_with_components(left, known)), "open-buckets")
    more = stored(_remaining_links(left, bags), "block-links")
    tied = joined_components(known, more)
    of_node = nodes.select("node", "digest").join(tied, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("class")
    )
    return marked.select("row", "doc_id", "digest").join(of_node, "digest")


def _plain(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        docs[id_column].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )


def near_duplicates(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, class_id, class_size``: a row for each row of ``docs``.

    ``class_id`` is the smallest id among all rows whose texts are tied to this
    one by links of similarity SIMILARITY or more, directly or through others;
    ``class_size`` is the number of those rows. Texts of fewer than five words
    are one shingle; texts without words are tied to equal texts only. A null
    text is empty. Rows without an id take part; a class without any id has a
    null class_id. Repeated rows count. An empty table gives no rows.
    """
    classed = stored(_classed(_plain(docs, id_column, text_column)), "classes")
    # Stored, so that the join meets plain shuffles and can split a hot class.
    classes = stored(classed.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")
    ), "class-sizes")
    return classed.join(classes, "class").select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each class of near-duplicates; columns as before.

    That of the smallest id; a row without an id only where no other has one. Of
    rows that agree in id and text any one stays.
    """
    classed = stored(_classed(_plain(docs, id_column, text_column)), "classes")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("one")
    own_id, own_digest, own_times = (unused(docs, c) for c in ("id", "digest", "times"))
    chosen = classed.groupBy("class").agg(one).select(
        F.col("one.doc_id").alias(own_id), F.col("one.digest").alias(own_digest)
    )
    # How often the chosen rows occur; only those that repeat are looked at again.
    times = classed.groupBy(F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest")).agg(
        F.count("*").alias(own_times))
    chosen = stored(chosen.join(
        times, chosen[own_id].eqNullSafe(times["of_id"]) & (chosen[own_digest] == times["of_digest"])
    ).select(own_id, own_digest, own_times), "chosen")
    digest = F.md5(F.coalesce(docs[text_column].cast("string"), F.lit("")).cast("binary"))
    same = docs[id_column].cast("bigint").eqNullSafe(F.col(own_id)) & (digest == F.col(own_digest))
    once = docs.join(chosen.where(F.col(own_times) == 1), same)
    often = docs.join(chosen.where(F.col(own_times) > 1), same).dropDuplicates([own_id, own_digest])
    return once.unionByName(often).drop(own_id, own_digest, own_times)
