import hashlib
import random

import pytest

from wordloom.llm import sketches


def shingle_set(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def true_likeness(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def in_order(docs):
    return sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_documents_meet_their_next(spark, real, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = real.repartition(4).drop("n_chars")
        rows = in_order(docs)
        found = {r.doc_id: r for r in sketches.compared_with_edits(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == len(rows)
    errors = []
    for row, after in zip(rows, rows[1:] + rows[:1]):
        text, k = row.text, len(row.text) // 4
        edited = text[: len(text) - k] + after.text[:k]
        r = found[row.doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == sketches.fingerprint(text)
        assert r.edited_fingerprint == sketches.fingerprint(edited)
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if len(shingle_set(text)) > 100:
            errors += [r.near_edited - true_likeness(text, edited),
                       r.near_next - true_likeness(text, after.text)]
    assert max(map(abs, errors)) < 0.3 and abs(sum(errors) / len(errors)) < 0.01


def test_awkward_rows(awkward, nothing, spark):
    rows = sketches.compared_with_edits(awkward).collect()
    assert len(rows) == awkward.count()
    counts = {}
    for r in awkward.collect():
        counts.setdefault(r.doc_id, []).append(sketches.fingerprint(r.text))
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r.fingerprint)
        if r.n_chars == 0:
            assert r.near_edited == 1.0
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in counts.items()}
    assert sketches.compared_with_edits(nothing).count() == 0
    lone = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    assert [r.near_next for r in sketches.compared_with_edits(lone).collect()] == [1.0]


def test_estimates():
    rng = random.Random(1)
    long = [f"w{rng.randrange(10**6)}" for _ in range(20000)]
    text, part, other = " ".join(long), " ".join(long[5000:6000]), "x y z w v " * 100
    mark, inner = sketches.fingerprint(text), sketches.fingerprint(part)
    assert sketches.containment(inner, mark) == 1.0
    assert abs(sketches.likeness(inner, mark) - true_likeness(part, text)) < 0.02
    assert sketches.likeness(mark, sketches.fingerprint(other)) < 0.01
    kept = sketches.retained(mark)
    assert abs(len(kept) / len(shingle_set(text)) - sketches.FRACTION) < 0.02
    both = sketches.merged([inner, sketches.fingerprint(other)])
    assert set(sketches.retained(both)) == set(sketches.retained(inner)) | set(
        sketches.retained(sketches.fingerprint(other)))


def test_very_short_texts():
    assert sketches.likeness(sketches.fingerprint(""), sketches.fingerprint(None)) == 1.0
    for a, b in (("x", "y"), ("", "a b")):
        assert sketches.likeness(sketches.fingerprint(a), sketches.fingerprint(b)) == 0.0


def test_fingerprint_column(awkward):
    rows = awkward.select("text", sketches.fingerprint_column(awkward["text"]).alias("mark"))
    for r in rows.collect():
        assert r.mark == sketches.fingerprint(r.text)


@pytest.mark.parametrize("n, most", [(8, 0.4), (16, 0.25), (60, 0.12), (252, 0.06), (256, 0.06),
                                     (257, 0.06), (258, 0.06), (2000, 0.025)])
def test_estimates_are_unbiased_at_every_size(n, most):
    """One fraction for all texts: the mean error is next to zero, the spread falls with size."""
    rng = random.Random(n)
    errors, shares = [], []
    for k in range(100):
        words = [f"v{rng.randrange(10**6)}" for _ in range(n)]
        near = words[: n - n // 4] + [f"w{rng.randrange(10**6)}" for _ in range(n // 4)]
        a, b = " ".join(words), " ".join(near)
        x, y = sketches.fingerprint(a), sketches.fingerprint(b)
        errors.append(sketches.likeness(x, y) - true_likeness(a, b))
        shares.append(len(sketches.retained(x)) / len(shingle_set(a)))
    assert sum(e * e for e in errors) ** 0.5 / 10 < most
    assert abs(sum(errors) / len(errors)) < most / 3
    assert abs(sum(shares) / len(shares) - sketches.FRACTION) < 0.1


def test_merged_is_the_fingerprint_of_the_union_at_every_size():
    rng = random.Random(5)
    for n in (1, 4, 5, 30, 128, 129, 250, 256, 257, 300, 5000):
        parts = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(n)) for _ in range(3)]
        union = sketches.merged([sketches.fingerprint(p) for p in parts])
        # The same shingles as one list, made without the fingerprints of the parts.
        hashes = {h >> 24 for p in parts
                  for h in sketches.shingles(sketches.words_of(p.encode())[0]).tolist()}
        assert sketches.retained(union).tolist() == sorted(h for h in hashes if h < 1 << 39)
        again = sketches.merged([union, sketches.fingerprint(parts[0])])
        assert sketches.retained(again).tolist() == sketches.retained(union).tolist()


def test_a_fingerprint_is_shorter_than_its_text(real):
    texts = [r.text for r in real.collect() if len(r.text.split()) > 30]
    sizes = [len(sketches.fingerprint(t)) / len(t) for t in texts]
    assert sum(sizes) / len(sizes) < 0.75


def test_a_short_text_meets_a_long_one():
    rng = random.Random(9)
    errors, missed = [], 0
    for _ in range(200):
        words = [f"v{rng.randrange(10**6)}" for _ in range(2000)]
        at = rng.randrange(1900)
        part, whole = " ".join(words[at : at + 12]), " ".join(words)
        x, y = sketches.fingerprint(part), sketches.fingerprint(whole)
        errors.append(sketches.likeness(x, y) - true_likeness(part, whole))
        missed += sketches.containment(x, y) < 1
        assert sketches.retained(sketches.merged([x, y])).tolist() == sketches.retained(y).tolist()
    assert max(map(abs, errors)) < 0.02 and missed / 200 < 0.03
