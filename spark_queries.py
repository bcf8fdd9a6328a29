"""The engine's operators as queries over the test tables.

Each function takes (spark, sf_dir) and returns a DataFrame. Two corpora are
used: the lines of ``documents``, and crawl records made of ``pages`` so that
every cleaning rule has something to do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom import fixed_values as fixed
from wordloom.functions import text
from wordloom.operators import (
    analysis,
    cleaning,
    counting,
    lengths,
    letters,
    ranking,
    reports,
)
from wordloom.plans import stages
from wordloom.plans.pipeline import run_pipeline
from wordloom.session import own_session
from wordloom.sinks import tables
from wordloom.sinks import text as rendered
from wordloom.sources import lines, manifest, words

Query = Callable[[SparkSession, str], DataFrame]


# Declared, so that planning a query reads no file footers.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    read = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    return read.select(*columns)


# --- corpora ---------------------------------------------------------------


def document_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents", *columns, "text")
    return lines.split_lines(texts)


def crawl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, line``: each page as a crawl record, headers first."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    page_id = F.col("page_id").cast("string")
    # Names of crawl headers, and words that only look like them.
    record = F.concat_ws(
        "\n",
        F.lit("WARC/1.0"),
        F.lit("WARC-Type: conversion"),
        F.concat(F.lit(" WARC-Target-URI: "), "url"),
        F.lit("Content-Type: text/plain"),
        F.concat(F.lit("content-length: "), F.length("html").cast("string")),
        F.lit("Software-Info: crawler"),
        F.concat(F.lit("Extracted-Date: "), page_id),
        F.concat(F.lit("warcinfo: "), page_id),
        F.concat(F.lit("warcinfo:kept"), page_id),
        F.lit("content-language: kept"),
        F.lit("ROBOTS: classic"),
        F.concat(F.lit("isPartOf: "), "url"),
        F.lit("operator: nobody"),
        F.lit("Publisher: nobody"),
        F.lit("description: dropped"),
        F.lit("a description: kept"),
        F.lit("   "),
        F.concat(
            F.lit("see "), "url", F.lit(" or mail user"), page_id,
            F.lit("@example.com now"),
        ),
        F.col("html"),
    )
    return lines.split_lines(pages.select("page_id", record.alias("text")))


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every table that holds text."""
    parts = [
        table(spark, sf_dir, name, column).toDF("text")
        for name, column in (
            ("documents", "text"),
            ("pages", "html"),
            ("conversations", "text"),
            ("benchmark", "text"),
        )
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return lines.split_lines(first)


# Rows of a table whose lines make one raw file.
ROWS_PER_FILE = {"documents": 2000, "pages": 500, "conversations": 5000, "benchmark": 100}
KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id",
        "benchmark": "item_id"}
PACKED = ("pages", "benchmark")  # their files are compressed


def raw_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The lines of every text table as raw files, plain and gzip; returns ``folder``.

    A file has the lines of a range of rows and lies in a folder ``raw_file=…``
    that names it, since Spark chooses the names of the files themselves.
    """
    for name, rows in ROWS_PER_FILE.items():
        column = "html" if name == "pages" else "text"
        of = F.concat_ws("-", F.lit(name), F.expr(f"{KEYS[name]} div {rows}").cast("string"))
        texts = table(spark, sf_dir, name, of.alias("raw_file"), F.col(column).alias("text"))
        split = lines.split_lines(texts).select("raw_file", "line").repartition("raw_file")
        codec = "gzip" if name in PACKED else "none"
        split.write.partitionBy("raw_file").mode("append").option("compression", codec).text(folder)
    return folder


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``raw_file, line, part`` of such a folder."""
    name = F.regexp_extract("file", "raw_file=([^/]+)/", 1)
    return lines.read_lines(spark, folder).select(name.alias("raw_file"), "line", "part")


def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.word_counts(cleaning.clean_words(document_lines(spark, sf_dir)))


def document_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letters.letter_counts(document_counts(spark, sf_dir))


def document_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = document_counts(spark, sf_dir)
    return analysis.final_ranking(counts, ranking.top_words(counts))


def count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts as lines, well formed or not depending on the word's length."""
    counts = analysis.with_categories(document_counts(spark, sf_dir))
    is_a = lambda name: F.col("category") == name
    cnt = F.col("cnt").cast("string")
    line = (
        F.when(is_a("SHORT"), F.concat_ws("\t", "word", cnt))
        .when(is_a("MEDIUM"), F.concat("word", F.lit("\t+"), cnt, F.lit(" ")))
        .when(is_a("LONG"), F.concat(F.lit(" "), "word", F.lit("\t "), cnt))
        .otherwise(F.col("word"))
    )
    return counts.select(line.alias("line"))


def loose_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, and for short words also numbers that are none."""
    counts = analysis.with_categories(document_counts(spark, sf_dir))
    bad = F.array(*map(F.lit, ("5x", "5.0", "+", "9223372036854775808")))
    wrong = counts.where(F.col("category") == "SHORT").select(
        F.explode(F.transform(bad, lambda n: F.concat_ws("\t", "word", n))).alias("line")
    )
    return count_lines(spark, sf_dir).unionByName(wrong)


def repeated_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word twice, with its count and with its length; stop words with no number."""
    counts = analysis.with_categories(document_counts(spark, sf_dir))
    is_stop = F.lower("word").isin(list(fixed.STOP_WORDS))
    numbers = F.array(F.col("cnt").cast("string"), F.col("length").cast("string"))
    number = F.when(is_stop, F.lit("many")).otherwise(F.col("number"))
    return counts.withColumn("number", F.explode(numbers)).select(
        F.concat_ws("\t", "word", number).alias("line")
    )


# --- cleaning --------------------------------------------------------------


def drop_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_header_lines(crawl_lines(spark, sf_dir))


def _per_line(step: Callable[[str], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return crawl_lines(spark, sf_dir).select("page_id", step("line").alias("line"))

    return query


def _bag(words_of: DataFrame) -> DataFrame:
    return counting.word_counts(words_of).withColumnRenamed("cnt", "n")


def clean_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bag(cleaning.clean_words(document_lines(spark, sf_dir)))


def clean_crawl_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bag(cleaning.clean_words(crawl_lines(spark, sf_dir).select("line")))


def first_token_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bag(words.first_words(document_lines(spark, sf_dir)))


# --- counts, lengths, letters ------------------------------------------------


def corpus_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.word_counts(cleaning.clean_words(all_lines(spark, sf_dir)))


def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    bag = cleaning.clean_words(document_lines(spark, sf_dir, "source"))
    return lengths.length_stats(bag, "source")


def lengths_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.lengths_ascending(length_stats(spark, sf_dir))


def letter_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letters.letter_total(document_letters(spark, sf_dir))


def letters_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letters.letters_with_total(document_letters(spark, sf_dir))


def letter_percentage(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = letters.letter_percentages(document_letters(spark, sf_dir))
    return shares.select("kind", "letter", "pct")


def first_letters_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letters.first_letters(document_letters(spark, sf_dir))


def first_letters_a_to_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letters.first_letters_between(document_letters(spark, sf_dir), "a", "e")


# --- ranking and analysis ----------------------------------------------------


def top_n_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_words(document_counts(spark, sf_dir))


def top_100_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_words(document_counts(spark, sf_dir), 100)


def top_20_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_words(document_counts(spark, sf_dir), 20)


def all_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counting.word_counts(cleaning.clean_words(all_lines(spark, sf_dir)))
    return ranking.ranked_words(counts, tables.shared_folder(spark, "ranks"))


def stop_word_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.without_stop_words(document_counts(spark, sf_dir))


def word_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = document_counts(spark, sf_dir)
    return analysis.with_categories(counts).select("word", "length", "category")


def final_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.corpus_summary(document_ranking(spark, sf_dir))


# --- stored results ----------------------------------------------------------


def lenient_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.lenient_counts(loose_count_lines(spark, sf_dir))


def strict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.strict_counts(count_lines(spark, sf_dir))


def marked_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.marked_words(count_lines(spark, sf_dir))


def stored_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = ranking.top_words(document_counts(spark, sf_dir), 100)
    top_lines = rendered.top_lines(top).select(F.concat_ws("\t", "key", "value").alias("line"))
    return stages.stored_ranking(repeated_count_lines(spark, sf_dir), top_lines)


def word_lines_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    bag = cleaning.clean_words(document_lines(spark, sf_dir))
    return rendered.word_lines(bag).groupBy("key", "value").agg(F.count("*").alias("n"))


def count_lines_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.count_lines(document_counts(spark, sf_dir))


def top_lines_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.top_lines(ranking.top_words(document_counts(spark, sf_dir)))


def word_count_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.csv_lines(rendered.word_count_rows(document_counts(spark, sf_dir)))


def top_words_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = ranking.top_words(document_counts(spark, sf_dir))
    return rendered.csv_lines(rendered.top_rows(top))


def length_stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.length_lines(length_stats(spark, sf_dir))


def letters_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.letter_lines(letters_with_total(spark, sf_dir))


def final_ranking_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.ranking_lines(document_ranking(spark, sf_dir))


def final_summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.summary_lines(final_summary(spark, sf_dir))


# --- files and whole runs ----------------------------------------------------


def file_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, lines that are neither blank nor headers, and words of every raw file."""
    read = raw_lines(spark, raw_files(spark, sf_dir, tables.shared_folder(spark, "raw")))
    content = text.is_content_line("line").cast("int")
    by_file = read.groupBy("raw_file").agg(
        F.count("*").alias("n_lines"), F.sum(content).alias("n_content"))
    words_of = cleaning.clean_words(read.select("raw_file", "line"))
    n_words = words_of.groupBy("raw_file").agg(F.count("*").alias("n_words"))
    return by_file.join(n_words, "raw_file", "left").na.fill(0, "n_words")


def input_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and sizes of the plain raw files."""
    files = manifest.list_files(
        spark, raw_files(spark, sf_dir, tables.shared_folder(spark, "raw")))
    packed = F.col("file").rlike("raw_file=(" + "|".join(PACKED) + ")-")
    return manifest.input_inventory(files.where(~packed))


def file_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length statistics by raw file, made from the raw files and from stage-1 text alone."""
    base = tables.shared_folder(spark, "lengths")
    raw = raw_files(spark, sf_dir, f"{base}/raw")
    stages.clean_text(spark, raw, f"{base}/words", by_file=True)
    stages.word_length_stats(spark, raw, f"{base}/of_raw")
    stages.stored_length_stats(spark, f"{base}/words", f"{base}/of_words")
    parts = [
        _stored_pairs(spark, f"{base}/{way}").select(F.lit(way).alias("made"), "key", "value")
        for way in ("of_raw", "of_words")
    ]
    return parts[0].unionByName(parts[1])


def _stored_pairs(spark: SparkSession, folder: str) -> DataFrame:
    fields = F.split("line", "\t", 2)
    return lines.read_lines(spark, folder).select(
        fields[0].alias("key"), fields[1].alias("value"))


def all_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six text outputs of a whole run over raw files, and how often each line is there."""
    base = tables.shared_folder(spark, "run")
    raw = raw_files(spark, sf_dir, f"{base}/raw")
    found = [
        _stored_pairs(spark, path).groupBy("key", "value").agg(F.count("*").alias("n"))
        .select(F.lit(stage).alias("stage"), "key", "value", "n")
        for stage, path in run_pipeline(spark, raw, f"{base}/out").items()
    ]
    first, *rest = found
    for df in rest:
        first = first.unionByName(df)
    return first


def total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all words most frequent first, and neighbours out of order within and between files."""
    base = tables.shared_folder(spark, "total-order")
    counts = counting.word_counts(cleaning.clean_words(all_lines(spark, sf_dir)))
    rendered.write_lines(rendered.count_lines(counts), f"{base}/counts")
    stages.rank_words(spark, f"{base}/counts", f"{base}/ranked")
    # Files by name, within a file by place: a row before another one is no less frequent.
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    fields = F.split("value", "\t", 2)
    placed = spark.read.text(f"{base}/ranked").select(
        F.col("_metadata.file_name").alias("file"), at.alias("at"),
        F.struct((-fields[1].cast("bigint")).alias("minus"), fields[0].alias("word")).alias("key"))
    in_file = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    within = placed.withColumn("wrong", (in_file > F.col("key")).cast("int")).groupBy("file").agg(
        F.count("*").alias("n"), F.sum("wrong").alias("wrong"),
        F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last"))
    # One row for each part file.
    between = F.lag("last").over(Window.orderBy("file")) > F.col("first")
    return within.withColumn("between", between.cast("int")).agg(
        F.sum("n").alias("n_lines"), F.coalesce(F.sum("wrong"), F.lit(0)).alias("within_files"),
        F.coalesce(F.sum("between"), F.lit(0)).alias("between_files"))


def key_runs(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """``file, at, key, n``: the runs of lines of equal keys of every part file, by place.

    Lines are counted by split and key where they are read, so a sorted file leaves a
    row per key. In files where a key comes back after others every line is a run.
    """
    file, pos = F.col("_metadata.file_name"), F.monotonically_increasing_id()
    block, key = F.col("_metadata.file_block_start"), F.substring_index("value", "\t", 1)
    place = (file.alias("file"), block.alias("block"), pos.alias("pos"), key.alias("key"))
    lines_of = spark.read.text(path)
    runs = tables.write_table(lines_of.select(*place).groupBy("file", "block", "key").agg(
        F.min("pos").alias("pos"), F.max("pos").alias("last"), F.count("*").alias("n")), folder)
    broken = runs.where(F.col("last") - F.col("pos") + 1 != F.col("n")).select("file").distinct()
    names = [row.file for row in broken.collect()]  # of part files
    single = lines_of.where(file.isin(names)).select(*place).withColumn("n", F.lit(1).cast("bigint"))
    whole = runs.where(~F.col("file").isin(names)).drop("last")
    return whole.unionByName(single).select("file", F.struct("block", "pos").alias("at"), "key", "n")


def part_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the sorted outputs, and neighbours in a part file that are out of order."""
    base = tables.shared_folder(spark, "run")
    raw = raw_files(spark, sf_dir, f"{base}/raw")
    paths = run_pipeline(spark, raw, f"{base}/out", sorted_words=True)
    found = []
    for stage in (fixed.STAGE_DIRS[k] for k in (0, 1, 5)):
        runs = key_runs(spark, paths[stage], f"{base}/runs/{stage}")
        before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
        found.append(runs.select(
            F.lit(stage).alias("stage"), "n", (before > F.col("key")).alias("wrong")))
    first, *rest = found
    for df in rest:
        first = first.unionByName(df)
    wrong = F.coalesce(F.col("wrong").cast("int"), F.lit(0))
    return first.groupBy("stage").agg(F.sum("n").alias("n_lines"), F.sum(wrong).alias("inversions"))


# --- manifests and inputs ----------------------------------------------------


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id", "url").toDF("file_id", "path")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per page, which the manifest knows, and per document, which it does not."""
    pages = table(spark, sf_dir, "pages", "url")
    documents = table(spark, sf_dir, "documents", "doc_id", "source")
    of_documents = F.concat(
        F.lit("/data/"), "source", F.lit("-"), F.col("doc_id").cast("string"),
        F.lit(".txt"),
    )
    return pages.select(
        F.concat(F.lit("/data/"), text.base_name("url")).alias("file")
    ).unionByName(documents.select(of_documents.alias("file")))


def manifest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.sample_manifest(_manifest(spark, sf_dir)).toDF("page_id", "url")


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of several files, with blank lines, numbered over many splits."""
    folder = tables.shared_folder(spark, "manifest")
    paths = table(spark, sf_dir, "pages", "page_id", "url").orderBy("page_id")
    blank = F.when(F.col("page_id") % 3 == 0, F.array(F.lit(" "), F.col("url"), F.lit("")))
    rows = F.explode(F.coalesce(blank, F.array(F.concat(F.lit(" "), "url", F.lit("\t")))))
    paths.select(rows.alias("value")).write.text(folder)
    small = own_session(spark)
    small.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    return manifest.read_manifest(small, folder)


def manifest_file_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.with_file_ids(_files(spark, sf_dir), _manifest(spark, sf_dir))


def manifest_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.unmatched_files(_files(spark, sf_dir), _manifest(spark, sf_dir))


# --- reports -----------------------------------------------------------------


def report_top_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_words(document_counts(spark, sf_dir), 10)


def report_length_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.length_table(document_counts(spark, sf_dir))


def report_top_100_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_share(document_counts(spark, sf_dir), 100)


def report_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.vocabulary_report(document_counts(spark, sf_dir))


def report_most_frequent_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letters.most_frequent_letters(document_letters(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "drop_headers": drop_headers,
    "trim_lines": _per_line(text.trim_blanks),
    "strip_urls": _per_line(text.strip_urls),
    "strip_emails": _per_line(text.strip_emails),
    "strip_entities": _per_line(text.strip_entities),
    "normalize_letters": _per_line(text.normalize_letters),
    "clean_words": clean_words,
    "clean_crawl_words": clean_crawl_words,
    "first_token_words": first_token_words,
    "word_count": document_counts,
    "corpus_word_count": corpus_word_count,
    "length_stats": length_stats,
    "lengths_sorted": lengths_sorted,
    "letter_distribution": document_letters,
    "letter_total": letter_total,
    "letters_with_total": letters_with_total,
    "letter_percentage": letter_percentage,
    "first_letters_sorted": first_letters_sorted,
    "first_letters_a_to_e": first_letters_a_to_e,
    "top_n_words": top_n_words,
    "top_20_words": top_20_words,
    "top_100_words": top_100_words,
    "all_ranks": all_ranks,
    "stop_word_filter": stop_word_filter,
    "word_categories": word_categories,
    "final_ranking": document_ranking,
    "final_summary": final_summary,
    "lenient_counts": lenient_counts,
    "strict_counts": strict_counts,
    "marked_words": marked_words,
    "stored_ranking": stored_ranking,
    "word_lines_text": word_lines_text,
    "count_lines_text": count_lines_text,
    "top_lines_text": top_lines_text,
    "word_count_csv": word_count_csv,
    "top_words_csv": top_words_csv,
    "length_stats_text": length_stats_text,
    "letters_text": letters_text,
    "final_ranking_text": final_ranking_text,
    "final_summary_text": final_summary_text,
    "file_line_counts": file_line_counts,
    "input_inventory": input_inventory,
    "file_length_stats": file_length_stats,
    "all_stages": all_stages,
    "part_order": part_order,
    "total_order": total_order,
    "manifest_lines": manifest_lines,
    "manifest_sample": manifest_sample,
    "manifest_file_ids": manifest_file_ids,
    "manifest_unmatched": manifest_unmatched,
    "report_top_10": report_top_10,
    "report_length_table": report_length_table,
    "report_top_100_share": report_top_100_share,
    "report_vocabulary": report_vocabulary,
    "report_most_frequent_letters": report_most_frequent_letters,
}
