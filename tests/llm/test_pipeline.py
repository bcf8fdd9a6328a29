"""The corpus pipeline, stage by stage, against brute force."""

import zlib

import numpy as np
import pytest
from test_bagminhash import brute_force
from test_repetition import expected as rules
from tokenizers import Tokenizer

import corpus_pipeline
from wordloom.llm import cotraining, repetition


@pytest.fixture(scope="module")
def stages(spark, real_sf):
    """Input and result of every stage, as rows."""
    docs = spark.read.parquet(f"{real_sf}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, real_sf), name)
        found.append(docs)
    return found


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_the_stages_are_those_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "near_dedup", "curve_packing"]


def test_rows_pass_through_unchanged(stages):
    for before, after in zip(stages[:3], stages[1:4]):
        assert after.columns == stages[0].columns
        rows = by_id(before)
        assert all(rows[i] == r for i, r in by_id(after).items())


def test_rules(stages):
    assert set(by_id(stages[1])) == {i for i, r in by_id(stages[0]).items() if rules(r.text)[-1]}


def test_classifier(stages, spark, real_sf):
    labels = spark.read.parquet(f"{real_sf}/labels.parquet")
    scored = cotraining.with_scores(stages[1], labels)
    good = {r.doc_id for r in scored.collect() if r.quality_score >= cotraining.KEEP_AT}
    assert set(by_id(stages[2])) == good
    quality = {r.doc_id: r.quality for r in labels.collect()}
    clean = [i for i in by_id(stages[1]) if quality.get(i) == 1]
    assert len(good & set(clean)) >= 0.97 * len(clean)


def test_near_duplicates(stages):
    rows = sorted(by_id(stages[2]).items())
    classes = brute_force([r.text for _, r in rows])
    first = {}
    for (i, _), c in zip(rows, classes):
        first.setdefault(c, i)
    assert set(by_id(stages[3])) == set(first.values())


def test_packing(stages):
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    pieces = {}
    for p in stages[4].collect():
        pieces.setdefault(p.doc_id, []).append((p.start, bytes(p.ids)))
    rows = by_id(stages[3])
    assert set(pieces) == set(rows)
    for i, r in rows.items():
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        joined = b"".join(x for _, x in sorted(pieces[i]))
        assert zlib.crc32(joined) == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_run_gives_the_rows_of_the_last_stage(stages, spark, real_sf):
    run = corpus_pipeline.run(spark, real_sf)
    assert run.columns == stages[4].columns
    # Where a document is cut depends on its place, not on the run; its ids do not.
    def ids(df):
        pieces = {}
        for r in df.collect():
            pieces.setdefault(r.doc_id, []).append((r.start, r.doc_tokens, bytes(r.ids)))
        return {i: (p[0][1], b"".join(x for *_, x in sorted(p))) for i, p in pieces.items()}

    assert ids(run) == ids(stages[4])
    placed = sorted((r.sequence_id, r.offset, r.length) for r in run.collect())
    ends = [0, *np.cumsum([length for *_, length in placed]).tolist()]
    assert [s * 2048 + o for s, o, _ in placed] == ends[:-1]
    assert repetition.keep_unrepetitive(stages[1]).count() == stages[1].count()


def test_awkward_documents(spark, awkward, nothing, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)],
                                   "doc_id long, quality int, toxic int")
    for name, docs in (("some", awkward), ("none", nothing)):
        docs.select(columns).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() > 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
