import math

import numpy as np
import pytest

from wordloom.llm import cotraining, ftrl


def test_views():
    of = lambda t: set(cotraining.text_features(t).tolist())
    assert of("HELLO,") != of("Hello,") and len(of("HELLO,") & of("Hello,")) == 1
    assert len(cotraining.text_features(None)) == 0
    m = cotraining.metadata_features(None, None, None)
    assert len(m) == cotraining.NUMBERS + cotraining.LANG_SLOTS + cotraining.SOURCE_SLOTS
    assert np.isfinite(m).all()
    assert np.isfinite(cotraining.metadata_features("en", "s", -5)).all()
    sizes = [cotraining.metadata_features("en", "s", n)[1:25].argmax() for n in (None, 0, 1, 900, 1 << 40)]
    assert len(set(sizes)) == 5


def test_views_teach_each_other():
    """With few labels, pseudo-labels of one view let the other learn."""
    rng = np.random.default_rng(0)
    n = 3000
    y = (rng.random(n) < 0.7).astype(float)
    metadata = np.column_stack((y + rng.normal(0, 0.25, n), rng.normal(0, 1, n)))
    # One of many words says the class; few labelled rows hold any given word.
    texts = [np.unique(np.append(rng.integers(2000, 9000, 5), (1000 if v else 0) + rng.integers(0, 60)))
             for v in y]
    labels = np.where(np.arange(n) < 60, y, -1.0)
    model = cotraining.cotrain(texts, metadata, labels)
    alone = cotraining.cotrain(texts[:60], metadata[:60], labels[:60])
    right = lambda m: np.mean((cotraining._text_odds(m.text, texts[60:]) > 0) == (y[60:] > 0))
    assert right(model) > right(alone) + 0.05
    odds = model.odds(cotraining._text_odds(model.text, texts), metadata)
    assert np.mean((odds > 0) == (y > 0)) > 0.93


def test_calibration():
    rng = np.random.default_rng(3)
    odds = rng.normal(0, 2, 20000)
    labels = (rng.random(20000) < ftrl.probability(2 * odds + 1)).astype(float)
    slope, offset = cotraining.calibrated(odds, labels)
    assert slope == pytest.approx(2, abs=0.15) and offset == pytest.approx(1, abs=0.15)
    assert cotraining.calibrated(-odds, labels)[0] == 0.0


def test_junk_goes_and_good_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    # Half of the labels are learnt from, the other half is what is measured.
    scored = cotraining.with_scores(docs, labels.where("doc_id % 2 = 0"))
    rows = scored.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    kept = lambda q: np.mean([r.quality_score >= cotraining.KEEP_AT for r in rows if r.quality == q])
    assert scored.count() == docs.count()
    assert kept(1) > 0.97 and kept(0) < 0.4


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(i, i % 2 if i % 5 else None, i % 2, "x") for i in range(20)] + [(None, 1, 1, "x"), (3, 0, 0, "x")],
        "doc_id long, quality int, toxic int, text string")
    scored = cotraining.with_scores(awkward, labels)
    assert scored.columns == [*awkward.columns, "quality_score"]
    rows = scored.collect()
    assert len(rows) == awkward.count() and all(0 <= r.quality_score <= 1 for r in rows)
    assert cotraining.keep_good(awkward, labels).columns == awkward.columns
    assert cotraining.with_scores(nothing, labels).count() == 0
    assert cotraining.keep_good(awkward, labels.limit(0)).count() == awkward.count()


def test_very_long_texts_are_judged_by_what_they_say(spark):
    """A good text stays good and a bad one bad, whatever their length."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = cotraining.fitted(docs, labels)
    rows = docs.join(labels, "doc_id").orderBy("doc_id").collect()
    good = [r.text for r in rows if r.quality == 1]
    bad = [r.text for r in rows if r.quality == 0]
    rng = np.random.default_rng(2)

    def odds(pool, n, tail=""):
        joined, size = [], 0
        while size < n:
            joined.append(pool[rng.integers(len(pool))])
            size += len(joined[-1].split())
        found = cotraining.text_features("\n".join([*joined, tail]))
        return cotraining._text_odds(model.text, [found])[0]

    # Words that no document has say nothing: the log-odds stay what they were.
    unknown = "\n".join(f"zq{k}zq" for k in rng.integers(0, 1 << 40, 400_000).tolist())
    for pool, sign in ((good, 1), (bad, -1)):
        for n in (2_000, 20_000):
            state = rng.bit_generator.state
            alone = odds(pool, n, "zq1zq\nzq2zq")
            rng.bit_generator.state = state
            assert odds(pool, n, unknown) == pytest.approx(alone, abs=4)
    assert odds(good, 200_000) > 5 and odds(bad, 2_000) < 0


def test_a_repeated_id_is_learnt_from_once(spark, real, real_sf, monkeypatch):
    labels = spark.read.parquet(f"{real_sf}/labels.parquet")
    hot = labels.where("quality = 0").orderBy("doc_id").first().doc_id
    again = spark.range(500).select("id").crossJoin(real.where(real["doc_id"] == hot)).drop("id")
    model = cotraining.fitted(real.unionByName(again).repartition(5), labels)
    expected = cotraining.fitted(real, labels)
    assert model.text.features.tolist() == expected.text.features.tolist()
    assert model.text.weights.tolist() == expected.text.weights.tolist()
    assert model.metadata.weights.tolist() == expected.metadata.weights.tolist()


def test_labels_of_other_documents_use_up_nothing(spark, real, real_sf, monkeypatch):
    """The sample is of the documents that are there, and has both classes."""
    labels = spark.read.parquet(f"{real_sf}/labels.parquet")
    strangers = spark.range(10**6, 10**6 + 3000).selectExpr(
        "id as doc_id", "1 as quality", "0 as toxic")
    every = labels.select("doc_id", "quality", "toxic").unionByName(strangers)
    monkeypatch.setattr(cotraining, "MAX_LABELLED", 30)
    expected, found = cotraining.fitted(real, labels), cotraining.fitted(real, every)
    assert expected is not None and found is not None
    assert found.text.features.tolist() == expected.text.features.tolist()
    assert found.text.weights.tolist() == expected.text.weights.tolist()


def test_a_sample_keeps_a_scarce_class(spark):
    labels = spark.range(5000).selectExpr("id as doc_id", "if(id in (7, 8), 0, 1) as quality")
    ids = spark.range(4000).selectExpr("id as doc_id")
    rows = ftrl.labelled_sample(labels, ids, "quality", "doc_id", 64).collect()
    assert len(rows) == 64 and {r.doc_id for r in rows if r.label == 0} == {7, 8}
    assert max(r.doc_id for r in rows) < 4000
    # Where no class is scarce, those of the smallest hashes.
    halves = spark.range(5000).selectExpr("id as doc_id", "id % 2 as quality")
    least = halves.selectExpr("doc_id", "xxhash64(doc_id) as h").orderBy("h").limit(64).collect()
    rows = ftrl.labelled_sample(
        halves, halves.select("doc_id"), "quality", "doc_id", 64).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in least}


def plain_solve(a, b):
    """Gaussian elimination on lists."""
    n = len(b)
    rows = [[*r, v] for r, v in zip(a, b)]
    for i in range(n):
        best = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[best] = rows[best], rows[i]
        for r in range(i + 1, n):
            f = rows[r][i] / rows[i][i]
            rows[r] = [x - f * y for x, y in zip(rows[r], rows[i])]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (rows[i][n] - sum(rows[i][k] * out[k] for k in range(i + 1, n))) / rows[i][i]
    return out


def plain_logistic(xs, ys, ridge):
    """Newton steps on lists; the last column has next to no penalty."""
    k = len(xs[0])
    w, penalty = [0.0] * k, [ridge] * (k - 1) + [1e-6]
    for _ in range(25):
        ps = [1 / (1 + math.exp(-max(-35, min(35, sum(a * b for a, b in zip(x, w)))))) for x in xs]
        slope = [sum((p - y) * x[i] for p, y, x in zip(ps, ys, xs)) + penalty[i] * w[i] for i in range(k)]
        bend = [[sum((p * (1 - p) + 1e-6) * x[i] * x[j] for p, x in zip(ps, xs))
                 + (penalty[i] if i == j else 0) for j in range(k)] for i in range(k)]
        step = plain_solve(bend, slope)
        w = [a - b for a, b in zip(w, step)]
        if max(map(abs, step)) < 1e-8:
            break
    return w


def plain_ftrl(rows, ys):
    """Weights by feature, one at a time."""
    z, n = {}, {}

    def weight(i):
        l1 = 0.0 if i is None else cotraining.TEXT_L1
        v = z.get(i, 0.0)
        shrunk = math.copysign(max(abs(v) - l1, 0.0), v)
        return -shrunk / ((ftrl.BETA + n.get(i, 0.0) ** 0.5) / ftrl.ALPHA + ftrl.L2)

    for _ in range(ftrl.EPOCHS):
        for row, y in zip(rows, ys):
            w = {i: weight(i) for i in [*row, None]}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - y
            for i in w:
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - old**0.5) / ftrl.ALPHA * w[i]
    return lambda row: sum(weight(i) for i in [*row, None])


def test_one_round_against_a_plain_model(monkeypatch):
    """Fits, choice of pseudo-labels, second fits and calibration, on lists and dictionaries."""
    monkeypatch.setattr(cotraining, "ROUNDS", 1)
    monkeypatch.setattr(cotraining, "SURE", 0.7)
    rng = np.random.default_rng(11)
    n, known = 160, 60
    y = (rng.random(n) < 0.7).astype(float)
    metadata = np.column_stack((y + rng.normal(0, 0.4, n), rng.normal(0, 1, n)))
    texts = [np.unique(np.append(rng.integers(200, 260, 5), (100 if v else 0) + rng.integers(0, 9)))
             for v in y]
    labels = np.where(np.arange(n) < known, y, -1.0)
    model = cotraining.cotrain(texts, metadata, labels)

    held = list(range(0, known, cotraining.CALIBRATION_SHARE))
    train = [k for k in range(known) if k not in held]
    pool = list(range(known, n))
    rows = [t.tolist() for t in texts]

    def by_metadata(at, ys):
        cols = list(zip(*(metadata[k].tolist() for k in at)))
        mean = [sum(c) / len(c) for c in cols]
        scale = [(sum((v - m) ** 2 for v in c) / len(c)) ** 0.5 + 1e-9 for c, m in zip(cols, mean)]
        x = lambda k: [max(-20, min(20, (v - m) / s)) for v, m, s in zip(metadata[k].tolist(), mean, scale)]
        w = plain_logistic([[*x(k), 1.0] for k in at], ys, cotraining.RIDGE)
        return lambda k: sum(a * b for a, b in zip([*x(k), 1.0], w))

    def calibrate(odds, ridge=cotraining.CALIBRATION_RIDGE):
        up = sum(y[k] for k in held)
        down = len(held) - up
        target = [(up + 1) / (up + 2) if y[k] else 1 / (down + 2) for k in held]
        slope, offset = plain_logistic([[odds(k), 1.0] for k in held], target, ridge)
        return lambda k: max(0.0, slope) * odds(k) + offset

    def surest(odds):
        share = sum(y[k] for k in train) / len(train)
        most = max(2, int(cotraining.SHARE_PER_ROUND * len(pool)))
        good = min(max(1, round(share * most)), most - 1)
        order, sure = sorted(pool, key=lambda k: -odds(k)), calibrate(odds, cotraining.ROUND_RIDGE)
        p = lambda k: 1 / (1 + math.exp(-sure(k)))
        up = [k for k in order[:good] if p(k) >= 0.7]
        down = [k for k in order[::-1][: most - good] if p(k) <= 0.3]
        part = min(len(up) / good, len(down) / (most - good))
        return up[: round(part * good)], down[: round(part * (most - good))]

    ys = [y[k] for k in train]
    text = plain_ftrl([rows[k] for k in train], ys)
    of_text = surest(lambda k: text(rows[k]))
    of_metadata = surest(by_metadata(train, ys))
    assert all(of_text) and all(of_metadata)  # each view labels some of either class
    more = lambda found: ([*train, *found[0], *found[1]], [*ys, *[1.0] * len(found[0]), *[0.0] * len(found[1])])
    at, labelled = more(of_metadata)
    text = plain_ftrl([rows[k] for k in at], labelled)
    meta = by_metadata(*more(of_text))

    a, b = calibrate(lambda k: text(rows[k])), calibrate(meta)
    up = sum(y[k] for k in held)
    prior = math.log((up + 1) / (len(held) - up + 1))
    found = model.odds(cotraining._text_odds(model.text, texts), metadata)
    assert found.tolist() == pytest.approx([a(k) + b(k) - prior for k in range(n)], abs=1e-6)


def test_clashing_names_of_columns(spark, real, real_sf):
    labels = spark.read.parquet(f"{real_sf}/labels.parquet")
    docs = real.withColumn("quality", real["doc_id"]).withColumn("__quality", real["doc_id"])
    kept = cotraining.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert all(r.quality == r["__quality"] == r.doc_id for r in kept.collect())
