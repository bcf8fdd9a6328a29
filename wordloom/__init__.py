"""Word analytics over extracted web text, written as Spark DataFrame code.

Every operator is a function from DataFrames to a DataFrame built from
Spark's own expressions, so Catalyst sees one plan per query.
"""

from wordloom.operators.analysis import (
    corpus_summary,
    final_ranking,
    with_categories,
    without_stop_words,
)
from wordloom.operators.cleaning import clean_words, drop_header_lines
from wordloom.operators.counting import word_counts
from wordloom.operators.lengths import length_stats, lengths_ascending
from wordloom.operators.letters import (
    first_letters,
    letter_counts,
    letter_percentages,
    letter_total,
    letters_with_total,
)
from wordloom.operators.ranking import top_words
from wordloom.plans.pipeline import run_pipeline

__all__ = [
    "clean_words",
    "corpus_summary",
    "drop_header_lines",
    "final_ranking",
    "first_letters",
    "length_stats",
    "lengths_ascending",
    "letter_counts",
    "letter_percentages",
    "letter_total",
    "letters_with_total",
    "run_pipeline",
    "top_words",
    "with_categories",
    "without_stop_words",
    "word_counts",
]
