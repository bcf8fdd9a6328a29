"""Quality rules by repetition coverage (operator 6).

Rolling hashes of several n-gram lengths find the windows of words that occur
again in the same text; what counts is the share of the text's characters that
lie in such repeats, and in repeated lines.

Words are runs of characters other than blank and the ASCII controls 9 to 13.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import BLANKS, rolling, unused, words_of

# Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
BASE_NGRAM = 5
MAX_REPEAT_PERCENT = 20

# Largest share, in percent, of a text's word characters that may lie in
# repeated n-grams, by n, and in repeated lines. An n-gram's first occurrence
# is no repeat.
MAX_NGRAM_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
MAX_LINE_PERCENT = 20

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, dup_line_chars bigint, "
    "dup_ngram_chars array<bigint>, base_failed boolean, kept boolean"
)


def _without(data: bytes, dropped: bytes) -> int:
    """Length of ``data`` when the given ASCII bytes are dropped."""
    return len(data.translate(None, dropped))


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in a window of ``n`` words that begins at one of ``starts``."""
    steps = np.zeros(words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + n, -1)
    return np.cumsum(steps[:-1]) > 0


def _repeats(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of windows found before, and of windows found twice or more."""
    ordered = np.sort(windows)
    if not (ordered[1:] == ordered[:-1]).any():
        return (none := np.empty(0, np.int64)), none
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    later = order[1:][same]
    return later, np.union1d(later, order[:-1][same])


def _code_points(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points of each word: its bytes that do not continue a code point."""
    first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(first, dtype=np.int64)))
    return before[ends] - before[starts]


def _line_repeats(text: str) -> tuple[int, int]:
    """Number of lines with a word that equal an earlier line, and their word characters."""
    seen, count, chars = set(), 0, 0
    for line in text.split("\n"):
        if line in seen:
            inner = line.encode().translate(None, BLANKS).decode()
            if inner:
                count += 1
                chars += len(inner)
        else:
            seen.add(line)
    return count, chars


def measure(text: str | None) -> tuple:
    """The values of MEASURES for one text."""
    text = text or ""
    data = text.encode()
    hashes, starts, ends = words_of(data)
    n_words = len(hashes)
    word_chars = len(text) - (len(data) - _without(data, BLANKS))
    n_symbols = len(data) - _without(data, SYMBOLS)
    dup_lines, line_chars = _line_repeats(text)
    ngram_chars, repeat_words = [0] * len(MAX_NGRAM_PERCENT), 0
    lengths = None
    for k, n in enumerate(sorted(MAX_NGRAM_PERCENT)):
        later, twice = _repeats(rolling(hashes, n))
        if not len(later):
            break  # a longer repeat would hold a shorter one
        if lengths is None:
            lengths = _code_points(data, starts, ends)
        if n == BASE_NGRAM:
            repeat_words = int(_covered(twice, n, n_words).sum())
        ngram_chars[k] = int(lengths[_covered(later, n, n_words)].sum())
    base_failed = n_words < MIN_WORDS or 100 * repeat_words > MAX_REPEAT_PERCENT * n_words
    repetitive = 100 * line_chars > MAX_LINE_PERCENT * word_chars or any(
        100 * chars > MAX_NGRAM_PERCENT[n] * word_chars
        for n, chars in zip(sorted(MAX_NGRAM_PERCENT), ngram_chars, strict=True)
    )
    return (
        n_words, word_chars, n_symbols, dup_lines, repeat_words, line_chars,
        ngram_chars, base_failed, not (base_failed or repetitive),
    )


def _measure_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in MEASURES.split(", ")]
    for texts in batches:
        yield pd.DataFrame([measure(t) for t in texts], columns=names)


def with_measures(docs: DataFrame, text_column: str = "text", name: str = "rules") -> DataFrame:
    """``docs`` and a struct column ``name`` of the fields in MEASURES.

    A narrow, row-wise step: whole texts, no shuffle. ``dup_ngram_chars`` has
    one entry for each length in MAX_NGRAM_PERCENT, ascending. A null or empty
    text has no words and fails the base rule. A column called ``name`` is
    replaced; all others stay, and repeated rows stay repeated.
    """
    measures = F.pandas_udf(_measure_batches, MEASURES)
    return docs.withColumn(name, measures(docs[text_column].cast("string")))


def keep_unrepetitive(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes all rules; columns as before."""
    rules = unused(docs, "rules")
    judged = with_measures(docs, text_column, rules)
    return judged.where(F.col(rules)["kept"]).drop(rules)


def quality_report(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` and every measure, a row for each row of ``docs``.

    ``dup_ngram_chars`` is spread over columns ``dup_5gram_chars`` and so on.
    """
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    by_n = [
        F.col("dup_ngram_chars")[k].alias(f"dup_{n}gram_chars")
        for k, n in enumerate(sorted(MAX_NGRAM_PERCENT))
    ]
    return with_measures(rows).select("doc_id", "rules.*").select("*", *by_n).drop("dup_ngram_chars")
