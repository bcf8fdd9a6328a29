"""Small tables with the awkward rows that every operator must take."""

import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"

WORDS = "der the of andere naïve 中文 мир x1 long-word, and, it's 𠀀a stop. Ω".split()


def some_text(rng, n):
    """Words with odd blanks between them, some lines repeated."""
    blanks = [" ", " ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\xa0", "   ", " \n "]
    return "".join(rng.choice(WORDS) + rng.choice(blanks) for _ in range(n))


def awkward_texts():
    rng = random.Random(5)
    long_text = " ".join(f"w{rng.randrange(5000)}" for _ in range(60_000))
    return [
        None, "", " ", "\n\n", "one", "a b c d e", "\x85  x　", "x" * 3000,
        "same line here\n" * 30, long_text, long_text + " end", "<|endoftext|> and <|endoftext|>",
        "tab\tthen   blanks \n\n  end  ", "é \U0001f600\U0001f600  'll we'll 12345",
        *[some_text(rng, n) for n in (3, 8, 20, 50, 120, 300)],
        "one", "one", "a b c d e",
        # Words that differ in characters of code zero only.
        "\0", "\0\0 \0", " ".join("a" + "\0" * (k % 5) + "b" * (k // 5) for k in range(15)),
        "x\0 x y\0\0 x\0 x y\0 " * 3,
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    rows = [
        (i, t, None if i % 3 else "en", f"s{i % 2}", None if i % 4 else len(t or ""),
         True, 0.5, i, "x")
        for i, t in enumerate(awkward_texts())
    ]
    rows += [(5, "again five", "de", None, 3, False, 0.1, 1, "y"), rows[6], rows[6]]
    rows += [(None, "no id " * 9, None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "kept boolean, score double, start long, length string",
    )


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def real_sf():
    return SF


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
