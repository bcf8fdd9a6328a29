import random
from collections import Counter

import numpy as np
import pytest

from wordloom.llm import bagminhash
from wordloom.llm.components import components


def bag(text):
    words = (text or "").encode().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def alike(a, b):
    both = sum((a & b).values())
    return both >= 0.8 * (sum(a.values()) + sum(b.values()) - both)


def brute_force(rows):
    """Class of each row position: union of all similar or equal pairs."""
    bags = [bag(t) for t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i] or "") == (rows[j] or "")
            if same or bags[i] and bags[j] and alike(bags[i], bags[j]):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(7)
    for _ in range(12):
        base = rng.integers(0, 2**63, 40, dtype=np.uint64)
        a_counts, b_counts = rng.integers(0, 9, 40), rng.integers(0, 9, 40)
        keep = rng.random(40) < 0.6
        b_counts[keep] = a_counts[keep]
        a, b = np.sort(np.repeat(base, a_counts)), np.sort(np.repeat(base, b_counts))
        true = np.minimum(a_counts, b_counts).sum() / np.maximum(a_counts, b_counts).sum()
        size = 4000
        found = np.mean(bagminhash.signature(a, size) == bagminhash.signature(b, size))
        assert found == pytest.approx(true, abs=4 * (0.25 / size) ** 0.5)
        sets = bagminhash.as_set(a), bagminhash.as_set(b)
        assert bagminhash.similarity(*sets) == pytest.approx(true)


def test_texts_followed_together_or_alone(monkeypatch):
    texts = [t or "" for t in copies(random.Random(1))] + ["a b c d e f g " * 3000]
    together = bagminhash.band_keys(texts)
    monkeypatch.setattr(bagminhash, "TOGETHER", 1)
    assert bagminhash.band_keys(texts) == together
    assert [len(k) for k in together] == [bagminhash.BANDS if t.split() else 0 for t in texts]


def copies(rng):
    """Texts with groups of near copies, chains, shared passages and repeats within."""
    word = lambda: f"w{rng.randrange(4000)}"
    texts = []
    for _ in range(12):
        words = [word() for _ in range(rng.choice([30, 80, 200]))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(12)):
            changed = list(words)
            for _ in range(rng.randrange(1, 6)):
                changed[rng.randrange(len(changed))] = word()
            texts.append(" ".join(changed))
            if rng.random() < 0.3:
                words = changed  # a chain
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randrange(5, 80))) for _ in range(25)]
    texts += ["spam and eggs now here " * n for n in (20, 21, 26, 40)]
    return texts + ["", " ", None, "\n", "one", "one", "One", "a b", "a b c d e", "a b c d e"]


@pytest.mark.parametrize("block", [256, 4])
def test_classes_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(bagminhash, "BLOCK_TEXTS", block)
    texts = copies(random.Random(block))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = bagminhash.near_duplicates(docs).collect()
    expected = brute_force(texts)
    groups = {}
    for i, c in enumerate(expected):
        groups.setdefault(c, []).append(i)
    wanted = {i: (min(g), len(g)) for g in groups.values() for i in g}
    assert {r.doc_id: (r.class_id, r.class_size) for r in rows} == wanted
    kept = sorted(r.doc_id for r in bagminhash.keep_one(docs).collect())
    assert kept == sorted(min(g) for g in groups.values())


def test_awkward_rows(awkward, nothing):
    rows = bagminhash.near_duplicates(awkward).collect()
    texts = [(r.doc_id, r.text) for r in awkward.collect()]
    assert len(rows) == len(texts)
    expected = brute_force([t for _, t in texts])
    sizes = Counter(expected)
    assert sorted(r.class_size for r in rows) == sorted(sizes[c] for c in expected)
    kept = bagminhash.keep_one(awkward)
    assert kept.columns == awkward.columns and kept.where("doc_id is null").count() == 1
    assert kept.count() == len(sizes)
    assert bagminhash.near_duplicates(nothing).count() == 0
    assert bagminhash.keep_one(nothing).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 180)] + [(7, k) for k in range(200, 300)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    rng.shuffle(links)
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    parent = {n: n for link in links for n in link}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    expected = {n: root(n) for a, b in links if a != b for n in (a, b)}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_joined_by_further_links(spark):
    """The same as all links at once: new nodes, joined components, links within one."""
    from wordloom.llm.components import joined_components

    rng = random.Random(6)
    first = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    more = [(rng.randrange(90), rng.randrange(90)) for _ in range(25)] + [(95, 96), (97, 97)]
    df = lambda rows: spark.createDataFrame(rows, "a long, b long")
    known = components(df(first))
    for links in (more, more[:1], []):
        found = [tuple(r) for r in joined_components(known, df(links)).collect()]
        wanted = [tuple(r) for r in components(df([*first, *links])).collect()]
        assert sorted(found) == sorted(wanted)


def variants(n, words=100, changed=2):
    """A text and copies of it that are like it but, most of them, not like each other."""
    rng = random.Random(n)
    base = [f"b{k}" for k in range(words)]
    texts = []
    for _ in range(n):
        own = list(base)
        for place in rng.sample(range(5, words - 5), changed):
            own[place] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(own))
    return texts, " ".join(base)


def test_copies_that_are_not_like_each_other_meet_at_their_hub(spark, monkeypatch):
    """Block comparisons stay few: the original, not the least text, ties the copies."""
    texts, original = variants(1500)
    bags = [bagminhash.as_set(bagminhash.bag(t)) for t in texts[:60]]
    apart = [bagminhash.similarity(a, b) < 0.8 for i, a in enumerate(bags) for b in bags[:i]]
    assert sum(apart) > 0.7 * len(apart)
    assert all(bagminhash.similarity(bagminhash.as_set(bagminhash.bag(original)), b) >= 0.8 for b in bags)
    met = []
    plain = bagminhash._met_blocks

    def counted(entries):
        found = plain(entries)
        met.append(found.count())
        return found

    monkeypatch.setattr(bagminhash, "_met_blocks", counted)
    docs = spark.createDataFrame(list(enumerate([*texts, original])), "doc_id long, text string")
    rows = bagminhash.near_duplicates(docs.repartition(4)).collect()
    # All that share a band with the original; of 1500 nearly every one does.
    keys = bagminhash.band_keys([*texts, original])
    tied = [k for k, own in enumerate(keys) if set(own) & set(keys[-1])]
    assert len(tied) >= 1498
    assert {r.class_id for r in rows if r.doc_id in tied} == {min(tied)}
    # Only the buckets of a text that missed the original are looked at, each text once:
    # of the 48,000 entries of all buckets a small part.
    assert met[0] < 48_000 / 4


def test_blocks_meet_where_a_link_may_be_missing(spark, monkeypatch):
    """Every two texts of different components of a bucket meet in some group, others need not."""
    monkeypatch.setattr(bagminhash, "BLOCK_TEXTS", 3)
    rng = random.Random(5)
    entries = [(key, node, component) for key, n in ((1, 40), (2, 7), (3, 2))
               for node, component in ((k + 100 * key, 0 if rng.random() < 0.7 else k) for k in range(n))]
    df = spark.createDataFrame(entries, "key long, node long, component long")
    groups = {}
    for r in bagminhash._met_blocks(df).collect():
        groups.setdefault((r.key, r.one, r.two), []).append((r.node, r.component, r.part))
    pairs = {(a[0], b[0]) for g in groups.values() for a in g for b in g
             if a[2] != b[2] or len({x[2] for x in g}) == 1}
    for key, a, x in entries:
        for other, b, y in entries:
            if key == other and x != y:
                assert (a, b) in pairs or (b, a) in pairs
    assert max(map(len, groups.values())) <= 20


def test_recall_of_links_at_the_threshold():
    """Pairs of similarity 0.8 to 0.85 share a band nearly always: 1 - (1 - 0.8 ** 6) ** 32."""
    rng = random.Random(11)
    texts, pairs = [], 0
    for _ in range(150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        other = list(words)
        at = rng.randrange(10, 160)
        for k in range(at, at + 17):
            other[k] = f"y{rng.randrange(10**6)}"
        a, b = " ".join(words), " ".join(other)
        x, y = (bagminhash.as_set(bagminhash.bag(t)) for t in (a, b))
        if bagminhash.similarity(x, y) >= 0.8:
            texts += [a, b]
            pairs += 1
    keys = bagminhash.band_keys(texts)
    caught = sum(bool(set(keys[2 * k]) & set(keys[2 * k + 1])) for k in range(pairs))
    assert pairs > 100 and caught / pairs > 0.99


def test_hot_nodes_can_be_split(spark):
    """One node with nearly all edges: the join with stored minima is split between tasks."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        from wordloom.llm import components as c

        # Many neighbours that are larger than the hot node 5, itself tied to node 1.
        edges = c.stored(spark.range(10, 60_000).selectExpr("id as u", "5L as v").unionByName(
            spark.sql("select 5L as u, 1L as v")), "edges")
        moved = c._large_star(edges)
        rows = moved.collect()
        plan = moved._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {r.v for r in rows} == {1} and len(rows) == 59_991
    assert "SortMergeJoin(skew=true)" in plan


def test_clashing_names_of_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f", "x", 5), (2, "a b c d e f", "y", 6), (2, "a b c d e f", "y", 6)],
        "doc_id long, text string, digest string, times long")
    for extra in ("__id", "__digest", "id", "ID_", "__times"):
        docs = docs.withColumn(extra, docs["doc_id"])
    kept = bagminhash.keep_one(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
