"""Times the headline queries and the whole pipeline; prints one JSON line.

BENCH_SF_DIR  directory of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up (default 3)
BENCH_COPIES  copies of the text, each with a vocabulary of its own, for the runs of

A test table is one file with one row group, so one task reads it. Every query is
timed twice: on the tables as they come (``queries``, ``value``), and on the text
tables written out again as one file per core (``queries_dealt_out``); dealing
them out is timed on its own (``deal_out``) and part of neither. The whole runs
read the raw lines of the dealt-out tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from spark_queries import QUERIES, SCHEMAS, all_lines  # noqa: E402

from wordloom import run_pipeline  # noqa: E402
from wordloom.session import builder  # noqa: E402

HEADLINE = (
    "clean_words",
    "clean_crawl_words",
    "corpus_word_count",
    "length_stats",
    "letter_distribution",
    "top_n_words",
    "final_ranking",
    "final_summary",
    "report_length_table",
    "report_top_100_share",
    "report_vocabulary",
)


def seconds(run, times: int) -> float:
    run()
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def copied(lines: DataFrame, copies: int) -> DataFrame:
    """The lines ``copies`` times; the letters are rotated by the copy's number."""
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    line = F.col("line")
    for k in range(1, copies):
        turned = alphabet[k % 26 :] + alphabet[: k % 26]
        line = F.when(F.col("copy") == k, F.translate("line", alphabet, turned)).otherwise(line)
    numbered = lines.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return numbered.select(line.alias("line"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        builder("wordloom-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{work}/checkpoint")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def headline(tables: str) -> dict[str, float]:
        write = lambda name: QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        return {name: seconds(lambda: write(name), runs) for name in HEADLINE}

    taken = headline(sf_dir)

    tables = f"{work}/tables"
    start = time.perf_counter()
    for name in SCHEMAS:
        whole = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        whole.repartition(int(cpus)).write.parquet(f"{tables}/{name}.parquet")
    deal_out = round(time.perf_counter() - start, 3)
    dealt_out = headline(tables)

    raw = f"{work}/raw"
    copied(all_lines(spark, tables), copies).write.text(raw)
    size = sum(e.stat().st_size for e in os.scandir(raw) if e.name.startswith("part-"))
    for layout in ("parquet", "text"):
        taken[f"all_stages_{layout}"] = seconds(
            lambda: run_pipeline(spark, raw, f"{work}/{layout}", layout), runs
        )
    spark.stop()

    megabytes = size / 2**20
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries and pipeline runs",
                "value": round(sum(taken.values()), 3),
                "unit": "sec",
                "queries": taken,
                "sf": os.path.basename(sf_dir),
                "queries_dealt_out": dealt_out,
                "deal_out": deal_out,
                "text_tables_in_files": int(cpus),
                "all_stages_copies": copies,
                "all_stages_input_mb": round(megabytes, 1),
                "all_stages_text_mb_per_sec": round(megabytes / taken["all_stages_text"], 1),
            }
        )
    )


if __name__ == "__main__":
    main()
