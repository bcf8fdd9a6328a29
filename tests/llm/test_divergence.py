"""Source divergence against sums over all terms."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from wordloom.llm import divergence as d

WORDS = ["der", "the", "of", "Éa", "ÉA", "中文", "x", "X", "naïve", "long word", "a\x00b", "Zz"]


def terms(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[a-z\u0080-\U0010ffff]+", text)


def expected(rows, least, ranks=50):
    """Rows from (lang, source, text), by the definition."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = set()
    for lang in {r[0] for r in rows}:
        docs, by_source = Counter(), {}
        for _, source, text in (r for r in rows if r[0] == lang):
            docs.update(set(terms(text)))
            by_source.setdefault(source, Counter()).update(terms(text))
        kept = [t for t in docs if docs[t] >= least]
        total = sum(by_source.values(), Counter())

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in by_source.items()}, shares(total)
        for source, counts in by_source.items():
            pairs = [(-sum(abs(p[source][t] - p[o][t]) for t in kept), o.encode(), o)
                     for o in by_source if o != source]
            more = [(q[t] - p[source][t], t.encode(), t) for t in kept
                    if counts[t] and p[source][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", more, ranks)):
                for rank, (value, _, item) in enumerate(sorted(items)[:most], 1):
                    found.add((lang, source, part, item, -value, rank))
    return found


def found(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    rows = [(rng.choice(["en", "de", "", None]), rng.choice(["a", "b", "c", "é", "", None]),
             " ".join(rng.choices(WORDS, k=rng.randrange(30)))) for _ in range(300)]
    rows += [("en", "hot", "the of of " * 50)] * 100
    rows += [("en", "empty", None), ("xx", "only", "rare"), ("xx", "other", ""), ("yy", "alone", None)]
    return rows


@pytest.mark.parametrize("least", [1, 5, 30, 10_000])
def test_against_all_terms(spark, texts, least):
    df = spark.createDataFrame([(1, *r, "x", 7) for r in texts],
                               "doc_id long, lang string, source string, text string, term string, n long")
    assert found(d.divergence(df, min_documents=least)) == expected(texts, least)


def test_small_blocks(spark, texts, monkeypatch):
    """Blocks of a few terms and paths: nodes are made again, sums stay."""
    monkeypatch.setattr(d, "BLOCK_TERMS", 3)
    batches = [b for b in spark.createDataFrame(texts, "lang string, source string, text string")
               .fillna("").toArrow().to_batches()]
    whole = Counter()
    for batch in d._term_counts(iter(batches)):
        for lang, source, term, n, docs in zip(*(c.to_pylist() for c in batch.columns)):
            whole[lang, source, term] += n
    wanted = Counter()
    for lang, source, text in texts:
        for t in terms(text):
            wanted[lang or "", source or "", t] += 1
    assert {k: v for k, v in whole.items() if v} == dict(wanted)


@pytest.mark.parametrize("cells", [1, 40, 1 << 21])
def test_tree_against_all_pairs_of_counts(monkeypatch, cells):
    import pyarrow as pa

    monkeypatch.setattr(d, "BLOCK_CELLS", cells)
    rng = random.Random(7)
    zero = {s: rng.randrange(1, 50) for s in "abcdef"}
    paths = Counter()
    for _ in range(400):
        paths[tuple((s, n, 40 + 10 * n, zero[s]) for s in sorted(rng.sample("abcdef", rng.randrange(1, 7)))
                    for n in [rng.randrange(1, 4)])] += rng.randrange(1, 4)
    wanted = Counter()
    for path, times in paths.items():
        for x in path:
            for y in path:
                if x[0] < y[0]:
                    p, q, p0, q0 = x[2], y[2], x[3], y[3]
                    wanted[x[0], y[0]] += times * (
                        abs(p - q) - abs(p - q0) - abs(p0 - q) + abs(p0 - q0))
    names = ("source", "n", "share", "zero")
    rows = [{"lang": "en", "path": [dict(zip(names, i)) for i in path], "times": n}
            for path, n in sorted(paths.items())]
    summed = Counter()
    for batch in d._corrections(iter(pa.Table.from_pylist(rows).to_batches())):
        for _, a, b, value in zip(*(c.to_pylist() for c in batch.columns)):
            summed[a, b] += int(value)
    assert {k: v for k, v in summed.items() if v} == {k: v for k, v in wanted.items() if v}


def test_paths_share_nodes():
    paths = [[0, 1, 2], [0, 1, 3], [0, 4], [5]]
    items, parent, weight = d.tree_nodes(paths, np.array([2, 3, 1, 1]))
    assert items.tolist() == [0, 1, 2, 3, 4, 5]
    assert parent.tolist() == [-1, 0, 1, 1, 0, -1]
    assert weight.tolist() == [6, 5, 2, 3, 1, 1]


def test_awkward(awkward, nothing):
    rows = [(r.lang, r.source, r.text) for r in awkward.collect()]
    assert found(d.divergence(awkward, min_documents=2)) == expected(rows, 2)
    assert d.divergence(nothing).collect() == []


def test_counts_beyond_64_bits_are_exact(spark):
    """Shares of counts whose product with the scale does not fit a bigint."""
    big = 4_000_000_000_000_000_000
    df = spark.createDataFrame([(big, big // 3, 7)], "n long, source_n long, terms long")
    row = df.select(d._quotient(df["n"], "source_n").alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 5) // (big // 3 + 35)
