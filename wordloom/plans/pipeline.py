"""All six jobs over one directory of raw text."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession

from wordloom import fixed_values as fixed
from wordloom.operators.analysis import corpus_summary, final_ranking
from wordloom.operators.cleaning import clean_words
from wordloom.operators.counting import word_counts
from wordloom.operators.lengths import length_stats
from wordloom.operators.letters import letter_counts, letters_with_total
from wordloom.operators.ranking import top_words
from wordloom.session import own_session, settings_for
from wordloom.sinks import tables, text
from wordloom.sources.lines import read_lines, spread
from wordloom.sources.manifest import require_input


def run_pipeline(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    layout: str = "text",
    top_n: int = fixed.TOP_N,
    min_length: int = fixed.MIN_WORD_LENGTH,
    min_count: int = fixed.MIN_COUNT,
    stop_words: Iterable[str] | DataFrame = fixed.STOP_WORDS,
    compression: str = "none",
    sorted_words: bool = False,
    partitions: int | None = None,
    by_file: bool = False,
) -> dict[str, str]:
    """Write the six stage directories; returns stage name -> path.

    The raw text is read and cleaned once, into a table of word occurrences;
    counts and lengths come from that table, everything else from the counts.
    Stages that do not need one another are written at the same time.

    ``layout="parquet"`` leaves these tables as the stage directories (the last
    one has ``ranking`` and ``summary``). ``layout="text"`` keeps them in a work
    folder during the run and writes ``key<TAB>value`` text, ``compression``
    being a codec such as gzip. ``sorted_words`` sorts the word occurrences
    within each part file, as all other text is. ``partitions`` deals the raw
    lines over that many tasks first, for inputs of a few files that cannot be
    split.

    The partitions of ``avg_per_partition`` are the raw input files. Each word
    carries its file as ``part``, a 64-bit hash: a path next to every word would
    cost more to write than the words. ``by_file`` keeps it in the text of the
    first stage too, as a folder for each raw file, so that
    ``stages.stored_length_stats`` can run on that text alone.

    Every stage is written beside its place and takes it when it is finished. The
    first stage that fails ends the run: running jobs are cancelled, no further
    one starts, and the stages that are not finished keep what was there before.
    Settings are those of a session of the run's own.
    """
    if layout not in ("text", "parquet"):
        raise ValueError(f"unknown layout: {layout}")
    require_input(spark, input_path)
    spark = own_session(spark)
    base = output_path.rstrip("/")
    paths = {stage: f"{base}/{stage}" for stage in fixed.STAGE_DIRS}
    as_text = layout == "text"
    new = f"{base}/_new-{uuid.uuid4().hex}"
    work = tables.work_path(spark, base) if as_text else new
    cleaned, counted, lengths, alphabet, topped, final = fixed.STAGE_DIRS
    at_once = _AtOnce(spark)

    def table(df: DataFrame, name: str) -> DataFrame:
        at_once.check()
        return tables.write_table(df, f"{work}/{name}")

    def finished(stage: str) -> None:
        at_once.check()
        tables.replace_path(spark, f"{new}/{stage}", paths[stage])

    def stage_table(df: DataFrame, stage: str) -> DataFrame:
        """A table that later stages read; in the Parquet layout it is the stage."""
        stored = table(df, stage)
        if as_text:
            return stored
        finished(stage)
        return tables.read_table(spark, df.schema, paths[stage])

    def write(stage: str, lines: DataFrame, folders: list[str] | None = None) -> None:
        if as_text:
            at_once.check()
            text.write_lines(lines, f"{new}/{stage}", compression, folders)
            finished(stage)

    def write_words() -> None:
        kept = ["part"] if by_file else []
        write(cleaned, text.word_lines(words, sorted_words, kept), kept)

    def write_lengths() -> None:
        write(lengths, text.length_lines(stage_table(length_stats(words, "part"), lengths)))

    def write_letters() -> None:
        letters = stage_table(letters_with_total(letter_counts(counts)), alphabet)
        write(alphabet, text.letter_lines(letters))

    def write_final() -> None:
        top = stage_table(top_words(counts, top_n), topped)
        write(topped, text.top_lines(top))
        ranked = final_ranking(counts, top, stop_words, min_count)
        ranking = table(ranked, f"{final}/ranking")
        summary = table(corpus_summary(ranking), f"{final}/summary")
        if as_text:
            write(final, text.final_lines(ranking, summary))
        else:
            finished(final)

    try:
        with settings_for(spark):
            lines = spread(read_lines(spark, input_path).select("line", "part"), partitions)
            words = stage_table(clean_words(lines, min_length), cleaned)
        # The number of rows of a table of Parquet files is in their footers.
        with settings_for(spark, words.count()):
            counts = stage_table(word_counts(words), counted)
            at_once.run(write_final, write_lengths, write_letters, write_words,
                        lambda: write(counted, text.count_lines(counts)))
    finally:
        tables.delete_path(spark, new)
        if as_text:
            tables.delete_path(spark, work)
    return paths


class _AtOnce:
    """Runs jobs in threads of the driver until the first of them fails."""

    def __init__(self, spark: SparkSession) -> None:
        self.context = spark.sparkContext
        self.tag = f"wordloom-{uuid.uuid4().hex}"
        self.failed = threading.Event()

    def check(self) -> None:
        """Called before each step: no step starts once another job has failed."""
        if self.failed.is_set():
            raise RuntimeError("another stage of the run has failed")

    def _tagged(self, job: Callable[[], None]) -> None:
        self.context.addJobTag(self.tag)
        try:
            job()
        finally:
            self.context.removeJobTag(self.tag)

    def run(self, *jobs: Callable[[], None]) -> None:
        """Raises the first error when all jobs have ended; what still ran is cancelled."""
        with ThreadPoolExecutor(len(jobs)) as pool:
            started = [pool.submit(self._tagged, job) for job in jobs]
            done, running = wait(started, return_when=FIRST_EXCEPTION)
            errors = [job.exception() for job in done if job.exception()]
            if errors:
                self.failed.set()
                while running:
                    self.context.cancelJobsWithTag(self.tag)
                    running = wait(running, timeout=0.1).not_done
                raise errors[0]
