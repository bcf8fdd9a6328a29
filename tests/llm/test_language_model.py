import math
import re
import zlib
from collections import Counter

import pytest

from wordloom.llm import language_model

E, S = "<end>", "<start>"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), E]


def brute_force(rows):
    """Scores from word and pair counts in plain dictionaries."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    words, pairs, before = Counter(), Counter(), Counter()
    for i, text in rows:
        if not held(i):
            t = tokens_of(text)
            words.update(t)
            pairs.update(zip([S, *t], t))
            before.update([S, *t[:-1]])
    n, v = sum(words.values()), len(words)
    once = sum(c == 1 for c in words.values())
    twice = sum(c == 2 for c in words.values())
    d = min(once / (once + 2 * twice), 0.95) if once else 0.5
    root = lambda w: ((words[w] - d) / n if words[w] else d * v / n) if n else 1.0
    after = Counter(u for u, _ in pairs)
    ones, twos = (sum(c == k for c in pairs.values()) for k in (1, 2))
    off = min(ones / (ones + 2 * twos), 0.95) if ones else 0.5

    def likelihood(u, w):
        if not before[u]:
            return root(w)
        own = max(pairs[u, w] - off, 0) / before[u]
        return own + off * after[u] / before[u] * root(w)

    out = []
    for i, text in rows:
        t = tokens_of(text)
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        score = sum(math.log10(likelihood(u, w)) for u, w in zip([S, *t], t))
        out.append((i, held(i), len(t), sum(words[w] > 0 for w in t), n, base, score))
    return out, likelihood, root, words, pairs


def key(row):
    return (str(row[0]), row[2], round(row[6], 4))


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_against_brute_force(awkward, real, monkeypatch, size):
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", size)
    monkeypatch.setattr(language_model, "MERGE_KEYS", size // 2)
    for docs in (awkward, real.where("doc_id < 80") if size == 40 else real):
        docs = docs.coalesce(3)
        expected, *_ = brute_force([(r.doc_id, r.text) for r in docs.collect()])
        found = sorted((tuple(r) for r in language_model.scored(docs).collect()), key=key)
        assert len(found) == len(expected)
        for a, b in zip(found, sorted(expected, key=key)):
            assert a[:5] == b[:5]
            assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_probabilities_sum_to_one(real):
    _, likelihood, root, words, pairs = brute_force([(r.doc_id, r.text) for r in real.collect()])
    assert sum(map(root, words)) + root("never seen") == pytest.approx(1)
    for u in [S, "the", "never seen", *sorted({u for u, _ in pairs})[:40:4]]:
        total = sum(likelihood(u, w) for w in words) + likelihood(u, "never seen")
        assert total == pytest.approx(1)


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    """By much: the states count. 0.3 of log10 a token on a tenth of the bench table."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in language_model.scored(docs).collect() if r.held_out]
    gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
    assert rows and gain > 0.3


def test_a_repeated_passage_is_known(spark):
    """What occurs once elsewhere in training scores far above new text of the same words."""
    import random

    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=120)) for _ in range(200)]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    for i in held[::2]:
        texts[i] = texts[next(k for k in range(i + 1, 400) if k % 200 not in held) % 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.score / r.n_tokens for r in language_model.scored(docs).collect()}
    assert min(found[i] for i in held[::2]) > max(found[i] for i in held[1::2]) + 0.2


def test_nothing_to_learn_from(spark, nothing):
    from pyspark.sql import functions as F

    assert language_model.scored(nothing).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = language_model.scored(docs, F.lit(False)).collect()
    assert [(r.train_tokens, r.n_known, r.score) for r in rows] == [(0, 0, 0.0)] * 2
