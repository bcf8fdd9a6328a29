import zlib

import numpy as np
import pytest

from wordloom.llm import ftrl, toxicity


def test_fit_is_ftrl_proximal():
    """The vectorised update against one weight at a time."""
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 30, 8)) for _ in range(200)]
    labels = np.array([float(3 in r) for r in rows])
    z, n = {}, {}

    def weight(i, l1):
        shrunk = max(abs(z.get(i, 0.0)) - l1, 0.0) * np.sign(z.get(i, 0.0))
        return -shrunk / ((1.0 + n.get(i, 0.0) ** 0.5) / ftrl.ALPHA + ftrl.L2)

    l1 = {**{i: 0.5 for i in range(30)}, "bias": 0.0}
    for _ in range(ftrl.EPOCHS):
        for row, y in zip(rows, labels):
            at = [*row.tolist(), "bias"]
            w = {i: weight(i, l1[i]) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for i in at:
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - old**0.5) / ftrl.ALPHA * w[i]
    found = ftrl.fit(rows, labels, 30, 0.5)
    dense = found.dense(30)
    for i in range(30):
        assert dense[i] == pytest.approx(weight(i, 0.5), abs=1e-9)
    assert found.bias == pytest.approx(weight("bias", 0.0))
    assert dense.argmax() == 3


def test_features():
    a = toxicity.features("You, IDIOT! go")
    assert a.tolist() == toxicity.features("you idiot go").tolist()
    assert len(a) == 6 and len(toxicity.features("a b c")) == 6
    assert set(toxicity.features("a c b")) != set(toxicity.features("a b c"))
    assert len(toxicity.features(None)) == len(toxicity.features("  ,, ")) == 0


def test_held_out_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.scored(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    wrong = sum(r.predicted != r.toxic for r in rows)
    caught = sum(r.predicted and r.toxic for r in rows) / max(1, sum(r.toxic for r in rows))
    assert wrong / len(rows) < 0.08 and caught > 0.6  # learnt from some 300 documents


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2 if i % 5 else None, "x") for i in range(20)] + [(None, 1, 1, "x"), (3, 0, 0, "x")],
        "doc_id long, quality int, toxic int, text string")
    found = toxicity.scored(awkward, labels)
    rows = found.collect()
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored(nothing, labels).count() == 0
    blank = toxicity.scored(awkward, labels.limit(0)).collect()
    assert len(blank) == awkward.count() and max(r.score for r in blank) < 1e-6


def test_very_long_texts_score_by_what_they_say(spark):
    """Many clean documents as one text are clean, as are many unknown words; toxic ones toxic."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fitted(docs, labels.where(~toxicity.held_out(labels["doc_id"])))
    score = toxicity.score_column(docs["text"], model).alias("score")
    known = docs.select("doc_id", "text", score).join(labels, "doc_id").orderBy("doc_id").collect()
    clean = [r.text for r in known if r.toxic == 0 and r.score < 0.05]
    bad = [r.text for r in known if r.toxic == 1 and r.score > 0.6]
    rng = np.random.default_rng(6)
    texts, toxic = [], []
    for n in (50_000, 200_000):
        unknown = " ".join(f"qz{k}" for k in rng.integers(0, 1 << 40, n).tolist())
        texts += [unknown, f"{unknown} {' '.join(bad[:40])}"]
        toxic += [0, 1]
        for pool, label in ((clean, 0), (bad, 1)):
            joined, size = [], 0
            while size < n:
                joined.append(pool[rng.integers(len(pool))])
                size += len(joined[-1].split())
            texts.append("\n".join(joined))
            toxic.append(label)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = rows.select("doc_id", toxicity.score_column(rows["text"], model).alias("score"))
    scores = [r.score for r in found.orderBy("doc_id").collect()]
    assert [int(s >= toxicity.TOXIC_AT) for s in scores] == toxic


def test_rare_features_are_left_out_without_a_difference():
    rng = np.random.default_rng(8)
    rows = [np.unique(rng.zipf(1.3, 12) % 500) for _ in range(300)]
    labels = np.array([float(3 in r) for r in rows])
    for l1 in (0.5, 2.0, 6.0):
        all_kept, found = ftrl.fit(rows, labels, 500, l1), ftrl.fit_keys(rows, labels, l1)
        assert found.features.tolist() == all_kept.features.tolist()
        assert found.weights.tolist() == pytest.approx(all_kept.weights.tolist())
        for row in rows[:20]:
            known = all_kept.dense(500)[row].sum() + all_kept.bias
            assert found.odds(np.repeat(row, 2)[::-1]) == pytest.approx(known)


def test_a_repeated_id_is_learnt_from_once(spark, real, real_sf):
    """Rows of one labelled id, equal ones and others, against one row of it."""
    labels = spark.read.parquet(f"{real_sf}/labels.parquet")
    docs = real.select("doc_id", "text").join(labels.select("doc_id"), "doc_id", "left_semi")
    hot = docs.join(labels.where("toxic = 0"), "doc_id").orderBy("doc_id").first().doc_id
    others = [(hot, f"you idiot {k % 50}") for k in range(2000)]
    rows = spark.createDataFrame(others, "doc_id long, text string")
    least = rows.unionByName(docs.where(docs["doc_id"] == hot)).orderBy(
        ftrl.row_hash("text")).limit(1)
    found = toxicity.fitted(docs.unionByName(rows).repartition(5), labels)
    expected = toxicity.fitted(
        docs.where(docs["doc_id"] != hot).unionByName(least), labels)
    assert found.features.tolist() == expected.features.tolist()
    assert found.weights.tolist() == expected.weights.tolist() and found.bias == expected.bias


@pytest.mark.parametrize("bits", [0, 5, 26])
def test_the_streamed_fit_is_the_fit_of_all_features(spark, monkeypatch, bits):
    """With slots that hold many features or one, and with repeated rows: the same weights."""
    monkeypatch.setattr(ftrl, "SLOT_BITS", bits)
    rng = np.random.default_rng(9)
    rows = [np.unique(rng.zipf(1.3, 12) % 700 - 350) for _ in range(400)]
    labels = [int(3 in r or -7 in r) for r in rows]
    sample = [(i, 1000 - i, y, ftrl.packed([r])[0].as_py())
              for i, (r, y) in enumerate(zip(rows, labels))]
    df = spark.createDataFrame(sample + sample[:50], "doc_id long, turn long, label int, features binary")
    for l1 in (0.5, 6.0):
        found = ftrl.sparse_fit(df, l1)
        wanted = ftrl.fit_keys(rows[::-1], np.array(labels[::-1], float), l1)
        assert found.features.tolist() == wanted.features.tolist()
        assert found.weights.tolist() == wanted.weights.tolist() and found.bias == wanted.bias
    none = ftrl.sparse_fit(df.limit(0))
    assert len(none.features) == 0 and none.bias == ftrl.NEVER


def test_scores_against_a_plain_model(spark, real, real_sf):
    """Features, fit and scores without hashes of numpy: words, pairs and skip pairs as text."""
    import re

    labels = spark.read.parquet(f"{real_sf}/labels.parquet")
    found = {r.doc_id: r for r in toxicity.scored(real, labels).collect()}
    texts = {r.doc_id: r.text for r in real.collect()}

    def named(text):
        words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", "".join(
            chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        return sorted({*words, *(f"{a} {b}" for a, b in zip(words, words[1:])),
                       *(f"{a} _ {b}" for a, b in zip(words, words[2:]))})

    known = {}
    for r in labels.collect():
        if r.doc_id in texts and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            known[r.doc_id] = max(r.toxic, known.get(r.doc_id, 0))
    ids = spark.createDataFrame([(i,) for i in known], "doc_id long")
    order = [r.doc_id for r in ftrl.labelled_sample(labels, ids, "toxic", "doc_id", 10**6)
             .orderBy("turn", "doc_id").collect()]
    z, n = {}, {}

    def weight(i):
        l1 = 0.0 if i is None else ftrl.L1
        shrunk = max(abs(z.get(i, 0.0)) - l1, 0.0) * np.sign(z.get(i, 0.0))
        return -shrunk / ((ftrl.BETA + n.get(i, 0.0) ** 0.5) / ftrl.ALPHA + ftrl.L2)

    features = {i: [*named(t), None] for i, t in texts.items()}
    for _ in range(ftrl.EPOCHS):
        for i in order:
            w = {f: weight(f) for f in features[i]}
            g = 1 / (1 + np.exp(-sum(w.values()))) - known[i]
            for f in features[i]:
                old = n.get(f, 0.0)
                n[f] = old + g * g
                z[f] = z.get(f, 0.0) + g - (n[f] ** 0.5 - old**0.5) / ftrl.ALPHA * w[f]
    for i in texts:
        score = 1 / (1 + np.exp(-sum(map(weight, features[i]))))
        assert found[i].score == pytest.approx(score, abs=1e-9)
