"""The six jobs one by one, each from text directories to a text directory.

For running a single job on text results, of this engine or of another one in
the same format. ``run_pipeline`` runs all six over tables instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordloom import fixed_values as fixed
from wordloom.operators.analysis import corpus_summary, final_ranking, one_row_per_word
from wordloom.operators.cleaning import clean_words
from wordloom.operators.counting import word_counts
from wordloom.operators.lengths import length_stats
from wordloom.operators.letters import letter_counts, letters_with_total
from wordloom.operators.ranking import top_words
from wordloom.session import own_session, settings_for, words_in_files
from wordloom.sinks import tables, text
from wordloom.sources import words as readers
from wordloom.sources.lines import read_lines, spread
from wordloom.sources.manifest import list_files

OPEN_FILES = 64  # of a task that writes folders; beyond them it sorts


def clean_text(
    spark: SparkSession,
    raw: str,
    output: str,
    min_length: int = fixed.MIN_WORD_LENGTH,
    partitions: int | None = None,
    by_file: bool = False,
) -> None:
    """Raw lines to one ``word<TAB>`` line per occurrence.

    ``partitions`` deals the raw lines over that many tasks first. ``by_file``
    writes a folder for each raw file, named by the hash of its path, so that
    ``stored_length_stats`` knows which file a word is from. A task reads few raw
    files and keeps its output files open, so the words need no sort by file.
    """
    spark = own_session(spark)
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    with settings_for(spark):
        kept = ["part"] if by_file else []
        lines = spread(read_lines(spark, raw).select("line", *kept), partitions)
        words = clean_words(lines, min_length)
        text.write_lines(text.word_lines(words, kept=kept), output, folders=kept)


def _stored_words(spark: SparkSession, words: str) -> DataFrame:
    """Words of a stage-1 directory."""
    return readers.first_words(read_lines(spark, words).select("line"))


def count_words(spark: SparkSession, words: str, output: str) -> None:
    """Word lines to ``word<TAB>count``. The words are read once."""
    spark = own_session(spark)
    with settings_for(spark, words_in_files(list_files(spark, words))):
        text.write_lines(text.count_lines(word_counts(_stored_words(spark, words))), output)


def word_length_stats(
    spark: SparkSession,
    raw: str,
    output: str,
    min_length: int = fixed.MIN_WORD_LENGTH,
    partitions: int | None = None,
) -> None:
    """Raw lines to length statistics; the partitions are the raw files.

    From the raw lines: word lines tell which file a word is from only if they
    were written with ``by_file``. The shuffle has a row per file and length.
    """
    spark = own_session(spark)
    with settings_for(spark):
        lines = spread(read_lines(spark, raw).select("line", "part"), partitions)
        stats = length_stats(clean_words(lines, min_length), "part")
        text.write_lines(text.length_lines(stats), output)


def stored_length_stats(spark: SparkSession, words: str, output: str) -> None:
    """Word lines that were written with ``by_file`` to length statistics."""
    spark = own_session(spark)
    lines = spark.read.schema("value string, part bigint").text(words)
    bag = readers.first_words(lines.withColumnRenamed("value", "line"))
    text.write_lines(text.length_lines(length_stats(bag, "part")), output)


def alphabet_distribution(spark: SparkSession, words: str, output: str) -> None:
    """Word lines to letter counts and their total. The words are read once."""
    spark = own_session(spark)
    with settings_for(spark, words_in_files(list_files(spark, words))):
        letters = letter_counts(word_counts(_stored_words(spark, words)))
        text.write_lines(text.letter_lines(letters_with_total(letters)), output)


def top_n_words(
    spark: SparkSession, counts: str, output: str, n: int = fixed.TOP_N
) -> None:
    """``word<TAB>count`` lines to the ``n`` most frequent; bad lines are skipped."""
    counted = readers.lenient_counts(read_lines(spark, counts))
    text.write_lines(text.top_lines(top_words(counted, n)), output)


def rank_words(spark: SparkSession, counts: str, output: str) -> None:
    """``word<TAB>count`` lines to the same lines, all of them, most frequent first.

    Part files follow one another in that order; bad lines are skipped.
    """
    spark = own_session(spark)
    with settings_for(spark, words_in_files(list_files(spark, counts))):
        counted = readers.lenient_counts(read_lines(spark, counts))
        text.write_lines(text.ranked_lines(counted), output)


def stored_ranking(
    count_lines: DataFrame, top_lines: DataFrame, min_count: int = fixed.MIN_COUNT
) -> DataFrame:
    """The final ranking from stored counts and a stored top list, both as lines.

    Stop words are skipped before their number is looked at; any other count that
    is no whole number fails. Of several counts of a word the largest holds.
    """
    counts = readers.strict_counts(count_lines, skip=fixed.STOP_WORDS)
    return final_ranking(
        one_row_per_word(counts), readers.marked_words(top_lines), min_count=min_count
    )


def final_analysis(
    spark: SparkSession,
    counts: str,
    top: str,
    output: str,
    min_count: int = fixed.MIN_COUNT,
) -> None:
    """Word counts and top words to final rows and a summary; see ``stored_ranking``."""
    spark = own_session(spark)
    count_lines = read_lines(spark, counts).select("line")
    work = tables.work_path(spark, output)
    try:
        # A line has one of the words that the counts are shuffled by.
        with settings_for(spark, words_in_files(list_files(spark, counts))):
            ranking = stored_ranking(
                count_lines, read_lines(spark, top).select("line"), min_count
            )
            ranking = tables.write_table(ranking, f"{work}/ranking")
            text.write_lines(text.final_lines(ranking, corpus_summary(ranking)), output)
    finally:
        tables.delete_path(spark, work)
