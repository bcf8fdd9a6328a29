import re

from wordloom.llm import repetition


def expected(text):
    """The measures, word by word, without hashes."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, chars = len(words), sum(map(len, words))
    lines, seen, dup_lines, line_chars = text.split("\n"), set(), 0, 0
    for line in lines:
        inner = re.findall(r"[^\x20\x09-\x0D]+", line)
        if inner and line in seen:
            dup_lines += 1
            line_chars += sum(map(len, inner))
        seen.add(line)
    covered = []
    repeat = 0
    for k in range(5, 11):
        seen, later, count = set(), set(), {}
        for i in range(n - k + 1):
            gram = tuple(words[i : i + k])
            count.setdefault(gram, []).append(i)
            if gram in seen:
                later.update(range(i, i + k))
            seen.add(gram)
        covered.append(sum(len(words[i]) for i in later))
        if k == 5:
            repeat = len({j for at in count.values() if len(at) > 1
                          for i in at for j in range(i, i + 5)})
    failed = n < 10 or 100 * repeat > 20 * n
    bad = 100 * line_chars > 20 * chars or any(
        100 * c > most * chars for c, most in zip(covered, (15, 14, 13, 12, 11, 10))
    )
    return (n, chars, sum(text.count(c) for c in "#*$%&|<>"), dup_lines, repeat, line_chars,
            covered, failed, not failed and not bad)


def test_against_word_by_word(awkward, real):
    for docs in (awkward, real):
        texts = {(r.doc_id, r.text): expected(r.text) for r in docs.collect()}
        rows = repetition.with_measures(docs).select("doc_id", "text", "rules").collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert tuple(r.rules) == texts[r.doc_id, r.text], r.doc_id


def test_report_and_filter(awkward, nothing):
    report = repetition.quality_report(awkward)
    assert report.columns[:3] == ["doc_id", "n_words", "word_chars"]
    kept = repetition.keep_unrepetitive(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == report.where("kept").count() > 0
    assert repetition.keep_unrepetitive(nothing).count() == 0


def test_word_longer_than_a_chunk(monkeypatch):
    import numpy as np

    from wordloom.llm import common

    text = b"aa " + b"x" * 100 + b" bb aa " + b"cc " * 40
    whole = common.words_of(text)
    monkeypatch.setattr(common, "CHUNK_BYTES", 16)
    common._power_tables.cache_clear()
    cut = common.words_of(text)
    common._power_tables.cache_clear()
    assert [tuple(x) for x in zip(whole[1], whole[2])] == [tuple(x) for x in zip(cut[1], cut[2])]
    long = 1
    assert (np.delete(whole[0], long) == np.delete(cut[0], long)).all()
