"""The same results as DuckDB SQL, written step by step.

Independent of the engine's code: patterns, word list and formats are spelled
out here again.
"""

from __future__ import annotations

# The stop words.
STOP_WORDS = """
the be to of and a in that have i it for not on with he as you do at this but
his by from they we say her she or an will my one all would there their what so
up out if about who get which go me when make can like time no just him know
""".split()

_STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)
_BLANKS = " || ".join(f"chr({i})" for i in range(1, 33))
_SPLIT = r"'\r\n|\r|\n'"

DOCUMENT_LINES = f"""
SELECT source, unnest(regexp_split_to_array(text, {_SPLIT})) AS line FROM documents
"""

# Names of crawl headers, and words that only look like them.
CRAWL_LINES = f"""
SELECT page_id, unnest(regexp_split_to_array(concat_ws(chr(10),
    'WARC/1.0',
    'WARC-Type: conversion',
    ' WARC-Target-URI: ' || url,
    'Content-Type: text/plain',
    'content-length: ' || length(html),
    'Software-Info: crawler',
    'Extracted-Date: ' || page_id,
    'warcinfo: ' || page_id,
    'warcinfo:kept' || page_id,
    'content-language: kept',
    'ROBOTS: classic',
    'isPartOf: ' || url,
    'operator: nobody',
    'Publisher: nobody',
    'description: dropped',
    'a description: kept',
    '   ',
    'see ' || url || ' or mail user' || page_id || '@example.com now',
    html), {_SPLIT})) AS line
FROM pages
"""

ALL_LINES = f"""
SELECT unnest(regexp_split_to_array(text, {_SPLIT})) AS line FROM (
    SELECT text FROM documents UNION ALL SELECT html FROM pages
    UNION ALL SELECT text FROM conversations UNION ALL SELECT text FROM benchmark)
"""

# The cleaning patterns.
URL = r"'https?://[^\s]+|www\.[^\s]+'"
EMAIL = r"'[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}'"
ENTITY = r"'&[a-zA-Z]+;|&#[0-9]+;'"
NORMALIZED = r"regexp_replace(lower({}), '[^\p{{L}}\s]+', ' ', 'g')"


def content(lines: str) -> str:
    """The lines that are neither blank nor headers. The header names."""
    return rf"""
SELECT * EXCLUDE (t) FROM (SELECT *, trim(line, {_BLANKS}) AS t FROM ({lines}))
WHERE t <> ''
  AND NOT regexp_matches(t, '^(WARC/|WARC-|Content-|Software-|Extracted-)')
  AND NOT regexp_matches(lower(t),
        '^(robots:|ispartof:|operator:|publisher:|description:)')
  AND NOT (regexp_full_match(t, '[A-Za-z][A-Za-z0-9_-]*:\s[^\n]*')
           AND (lower(split_part(t, ':', 1)) LIKE 'warc%'
                OR lower(split_part(t, ':', 1)) IN ('content-type', 'content-length')))
"""


def bag(lines: str, keep: str = "") -> str:
    """One row per word occurrence."""
    cleaned = "line"
    for pattern in (URL, EMAIL, ENTITY):
        cleaned = f"regexp_replace({cleaned}, {pattern}, '', 'g')"
    return rf"""
SELECT {keep} word FROM (
    SELECT {keep} unnest(regexp_split_to_array({NORMALIZED.format(cleaned)}, '\s+')) AS word
    FROM ({content(lines)}))
WHERE length(word) >= 2
"""


def counts(lines: str, name: str = "cnt") -> str:
    return f"SELECT word, count(*) AS {name} FROM ({bag(lines)}) GROUP BY word"


COUNTS = counts(DOCUMENT_LINES)

LENGTH_STATS = f"""
SELECT length, sum(n)::BIGINT AS cnt, sum(n)::DOUBLE / count(*) AS avg_per_partition,
       count(*) AS parts
FROM (SELECT source, length(word)::INTEGER AS length, count(*) AS n
      FROM ({bag(DOCUMENT_LINES, "source,")}) GROUP BY ALL)
GROUP BY length
"""

# The kinds of letter counts, here and in the total.
LETTERS = f"""
SELECT kind, letter, sum(cnt)::BIGINT AS cnt FROM (
    SELECT 'FIRST' AS kind, substr(word, 1, 1) AS letter, cnt FROM ({COUNTS})
    UNION ALL
    SELECT 'CHAR' AS kind, unnest(regexp_extract_all(word, '\\p{{L}}')) AS letter, cnt
    FROM ({COUNTS}))
GROUP BY kind, letter
"""

LETTERS_WITH_TOTAL = f"""
WITH l AS ({LETTERS})
SELECT kind, letter, cnt FROM l
UNION ALL
SELECT 'TOTAL_CHARS', NULL, coalesce(sum(cnt), 0)::BIGINT FROM l
"""


def top(n: int) -> str:
    return f"""
SELECT (row_number() OVER (ORDER BY cnt DESC, word))::INTEGER AS rank, word, cnt
FROM (SELECT * FROM ({COUNTS}) ORDER BY cnt DESC, word LIMIT {n})
"""


# Names and bounds of the categories.
CATEGORIES = f"""
SELECT word, cnt, length(word)::INTEGER AS length,
       CASE WHEN length(word) <= 3 THEN 'SHORT' WHEN length(word) <= 7 THEN 'MEDIUM'
            WHEN length(word) <= 12 THEN 'LONG' ELSE 'VERY_LONG' END AS category
FROM ({COUNTS})
"""

RANKING = f"""
SELECT c.word, c.cnt, c.length, c.category, t.word IS NOT NULL AS top_n
FROM ({CATEGORIES}) c LEFT JOIN ({top(1000)}) t ON c.word = t.word
WHERE lower(c.word) NOT IN ({_STOP_LIST}) AND c.cnt > 0
  AND (t.word IS NOT NULL OR c.cnt >= 10)
"""

SUMMARY = f"""
WITH r AS ({RANKING})
SELECT coalesce(sum(cnt), 0)::BIGINT AS total_word_occurrences,
       count(*) AS unique_words,
       CASE WHEN count(*) > 0 THEN sum(cnt)::DOUBLE / count(*) END AS avg_frequency,
       coalesce((SELECT length FROM r GROUP BY length
                 ORDER BY count(*) DESC, length LIMIT 1), 0) AS most_common_length
FROM r
"""


def two_decimals(numerator: str, denominator: str) -> str:
    """A quotient with two decimals, halves rounded up, in whole numbers."""
    hundredths = f"((200 * {numerator} + {denominator}) // (2 * {denominator}))"
    return f"({hundredths} // 100) || '.' || lpad(({hundredths} % 100)::VARCHAR, 2, '0')"


COUNT_LINES = f"""
SELECT CASE category WHEN 'SHORT' THEN word || chr(9) || cnt
            WHEN 'MEDIUM' THEN word || chr(9) || '+' || cnt || ' '
            WHEN 'LONG' THEN ' ' || word || chr(9) || ' ' || cnt
            ELSE word END AS line
FROM ({CATEGORIES})
"""

LOOSE_COUNT_LINES = f"""
SELECT line FROM ({COUNT_LINES}) UNION ALL
SELECT word || chr(9) || unnest(['5x', '5.0', '+', '9223372036854775808']) AS line
FROM ({CATEGORIES}) WHERE category = 'SHORT'
"""


def fields(lines: str) -> str:
    return f"""
SELECT split_part(t, chr(9), 1) AS word, substr(t, strpos(t, chr(9)) + 1) AS number,
       contains(t, chr(9)) AS has_number
FROM (SELECT trim(line, {_BLANKS}) AS t FROM ({lines})) WHERE t <> ''
"""


_FIELDS = fields(COUNT_LINES)

STORED_RANKING = f"""
SELECT c.word, c.cnt, c.length, c.category, t.word IS NOT NULL AS top_n
FROM (SELECT word, greatest(cnt, length)::BIGINT AS cnt, length, category
      FROM ({CATEGORIES})) c
     LEFT JOIN ({top(100)}) t ON c.word = t.word
WHERE lower(c.word) NOT IN ({_STOP_LIST}) AND (t.word IS NOT NULL OR c.cnt >= 10)
"""

_NAME = "regexp_extract({}, '[^/]+$')"
_FILES = f"""
SELECT '/data/' || {_NAME.format('url')} AS file FROM pages
UNION ALL SELECT '/data/' || source || '-' || doc_id || '.txt' FROM documents
"""
_IDS = f"""
SELECT {_NAME.format('url')} AS name, max(page_id) AS file_id FROM pages
GROUP BY 1 HAVING {_NAME.format('url')} <> ''
"""
_NAMED_FILES = f"SELECT {_NAME.format('file')} AS name, file FROM ({_FILES})"


# The lines of every text table with the name of the raw file they are written to.
RAW_LINES = " UNION ALL ".join(
    f"""SELECT '{name}-' || ({key} // {rows}) AS source,
       unnest(regexp_split_to_array({column}, {_SPLIT})) AS line FROM {name}"""
    for name, key, column, rows in (
        ("documents", "doc_id", "text", 2000), ("pages", "page_id", "html", 500),
        ("conversations", "conv_id", "text", 5000), ("benchmark", "item_id", "text", 100))
)


def over_files(statement: str) -> str:
    """A statement over the raw files instead of the lines of the documents."""
    return statement.replace(DOCUMENT_LINES, RAW_LINES)


def per_line(expression: str) -> str:
    return f"SELECT page_id, {expression} AS line FROM ({CRAWL_LINES})"


ORACLE: dict[str, str] = {
    "drop_headers": content(CRAWL_LINES),
    "trim_lines": per_line(f"trim(line, {_BLANKS})"),
    "strip_urls": per_line(f"regexp_replace(line, {URL}, '', 'g')"),
    "strip_emails": per_line(f"regexp_replace(line, {EMAIL}, '', 'g')"),
    "strip_entities": per_line(f"regexp_replace(line, {ENTITY}, '', 'g')"),
    "normalize_letters": per_line(NORMALIZED.format("line")),
    "clean_words": counts(DOCUMENT_LINES, "n"),
    "clean_crawl_words": counts(CRAWL_LINES, "n"),
    "first_token_words": rf"""
SELECT word, count(*) AS n
FROM (SELECT regexp_extract(trim(line, {_BLANKS}), '^\S+') AS word
      FROM ({DOCUMENT_LINES}))
WHERE word <> '' GROUP BY word""",
    "word_count": COUNTS,
    "corpus_word_count": counts(ALL_LINES),
    "length_stats": f"SELECT length, cnt, avg_per_partition FROM ({LENGTH_STATS})",
    "lengths_sorted": f"""
SELECT length, cnt, avg_per_partition FROM ({LENGTH_STATS}) ORDER BY length""",
    "letter_distribution": LETTERS,
    "letter_total": f"""
SELECT coalesce(sum(cnt), 0)::BIGINT AS total_chars FROM ({LETTERS})""",
    "letters_with_total": LETTERS_WITH_TOTAL,
    "letter_percentage": f"""
SELECT kind, letter,
       100::DOUBLE * cnt / (sum(cnt) OVER (PARTITION BY kind))::BIGINT AS pct
FROM ({LETTERS})""",
    "first_letters_sorted": f"""
SELECT letter, cnt FROM ({LETTERS}) WHERE kind = 'FIRST' ORDER BY cnt DESC, letter""",
    "first_letters_a_to_e": f"""
SELECT letter, cnt FROM ({LETTERS})
WHERE kind = 'FIRST' AND letter BETWEEN 'a' AND 'e' ORDER BY letter""",
    "top_n_words": top(1000),
    "top_20_words": top(20),
    "top_100_words": top(100),
    "stop_word_filter": f"""
SELECT word, cnt FROM ({COUNTS}) WHERE lower(word) NOT IN ({_STOP_LIST})""",
    "word_categories": f"SELECT word, length, category FROM ({CATEGORIES})",
    "final_ranking": RANKING,
    "final_summary": SUMMARY,
    "lenient_counts": rf"""
SELECT word, cnt FROM (
    SELECT word, number, has_number, try_cast(number AS BIGINT) AS cnt
    FROM ({fields(LOOSE_COUNT_LINES)}))
WHERE has_number AND regexp_full_match(number, '[+-]?[0-9]+') AND cnt IS NOT NULL""",
    "strict_counts": f"""
SELECT word, trim(number, {_BLANKS})::BIGINT AS cnt FROM ({_FIELDS})
WHERE has_number""",
    "marked_words": f"SELECT word, true AS top_n FROM ({_FIELDS})",
    "stored_ranking": STORED_RANKING,
    "word_lines_text": f"""
SELECT word AS key, '' AS value, count(*) AS n FROM ({bag(DOCUMENT_LINES)}) GROUP BY word""",
    "count_lines_text": f"SELECT word AS key, cnt::VARCHAR AS value FROM ({COUNTS})",
    "top_lines_text": f"""
SELECT word AS key, cnt::VARCHAR AS value FROM ({top(1000)}) ORDER BY rank""",
    "word_count_csv": f"SELECT word || ',' || cnt AS line FROM ({COUNTS})",
    "top_words_csv": f"""
SELECT rank || ',' || word || ',' || cnt AS line FROM ({top(1000)}) ORDER BY rank""",
    # Keys, field names and formats of the rendered lines, here and below.
    "length_stats_text": f"""
SELECT length::VARCHAR AS key,
       'count=' || cnt || ', avg_per_partition=' || {two_decimals('cnt', 'parts')} AS value
FROM ({LENGTH_STATS})""",
    "letters_text": f"""
SELECT concat_ws('_', kind, letter) AS key, cnt::VARCHAR AS value
FROM ({LETTERS_WITH_TOTAL})""",
    "final_ranking_text": f"""
SELECT word AS key, 'count=' || cnt || ', length=' || length
       || ', category=' || category || ', topN=' || top_n AS value
FROM ({RANKING})""",
    "final_summary_text": f"""
SELECT '### SUMMARY_STATISTICS ###' AS key,
       concat_ws(', ', 'total_word_occurrences=' || total_word_occurrences,
           'unique_words=' || unique_words,
           CASE WHEN unique_words > 0 THEN 'avg_frequency=' ||
               {two_decimals('total_word_occurrences', 'unique_words')} END,
           'most_common_length=' || most_common_length) AS value
FROM ({SUMMARY})""",
    "manifest_sample": """
SELECT page_id, url FROM pages ORDER BY md5(url || '42'), url, page_id LIMIT 100""",
    "manifest_file_ids": f"""
SELECT f.name, f.file, i.file_id, 'data-' || i.file_id AS data_name
FROM ({_NAMED_FILES}) f LEFT JOIN ({_IDS}) i ON f.name = i.name""",
    "manifest_unmatched": f"""
SELECT f.name, f.file FROM ({_NAMED_FILES}) f
WHERE NOT EXISTS (SELECT 1 FROM ({_IDS}) i WHERE i.name = f.name)""",
    "report_top_10": top(10),
    "report_length_table": f"""
SELECT length, cnt, 100::DOUBLE * cnt / (sum(cnt) OVER ())::BIGINT AS pct FROM (
    SELECT CASE WHEN length(word) >= 9 THEN '9+' ELSE length(word)::VARCHAR END AS length,
           sum(cnt)::BIGINT AS cnt
    FROM ({COUNTS}) GROUP BY 1)""",
    "report_top_100_share": f"""
SELECT top_cnt, all_cnt, 100::DOUBLE * top_cnt / all_cnt AS pct FROM (
    SELECT (SELECT sum(cnt)::BIGINT FROM ({top(100)})) AS top_cnt,
           (SELECT sum(cnt)::BIGINT FROM ({COUNTS})) AS all_cnt)""",
    "report_vocabulary": f"""
SELECT count(*) FILTER (cnt = 1) AS words_once, count(*) AS unique_words,
       sum(cnt)::BIGINT AS total_words,
       sum(length(word) * cnt)::DOUBLE / sum(cnt)::BIGINT AS avg_word_length,
       100::DOUBLE * count(*) / sum(cnt)::BIGINT AS richness_pct
FROM ({COUNTS})""",
    "report_most_frequent_letters": f"""
SELECT kind, letter, cnt FROM (
    SELECT *, row_number() OVER (PARTITION BY kind ORDER BY cnt DESC, letter) AS r
    FROM ({LETTERS})) WHERE r = 1""",
}

# Of results over documents, and of whole runs over raw files.
# Names of the stage directories.
_STAGES = {
    "stage1_cleaned": "word_lines_text",
    "stage2_wordcount": "count_lines_text",
    "stage3_wordlength": "length_stats_text",
    "stage4_alphabet": "letters_text",
    "stage5_topn": "top_lines_text",
    "stage6_final": "final_ranking_text",
}
_WHOLE_RUN = " UNION ALL ".join(
    f"SELECT '{stage}' AS stage, key, value, {'n' if name == 'word_lines_text' else '1::BIGINT'} AS n "
    f"FROM ({ORACLE[name]})"
    for stage, name in [*_STAGES.items(), ("stage6_final", "final_summary_text")]
)

ORACLE |= {
    "all_ranks": f"""
SELECT row_number() OVER (ORDER BY cnt DESC, word) AS rank, word, cnt FROM ({counts(ALL_LINES)})""",
    "all_stages": over_files(_WHOLE_RUN),
    "total_order": f"""
SELECT count(*) AS n_lines, 0::BIGINT AS within_files, 0::BIGINT AS between_files
FROM ({counts(ALL_LINES)})""",
    "part_order": f"""
SELECT stage, sum(n)::BIGINT AS n_lines, 0::BIGINT AS inversions FROM ({over_files(_WHOLE_RUN)})
WHERE stage IN ('stage1_cleaned', 'stage2_wordcount', 'stage6_final') GROUP BY stage""",
    "file_length_stats": f"""
SELECT made, key, value FROM ({over_files(ORACLE["length_stats_text"])})
CROSS JOIN (VALUES ('of_raw'), ('of_words')) AS ways(made)""",
    "input_inventory": f"""
SELECT files, bytes, bytes / 1048576::DOUBLE AS mb, bytes / 1073741824::DOUBLE AS gb FROM (
    SELECT count(DISTINCT source) AS files, sum(octet_length(encode(line)) + 1)::BIGINT AS bytes
    FROM ({RAW_LINES}) WHERE source LIKE 'documents-%' OR source LIKE 'conversations-%')""",
    "file_line_counts": f"""
WITH raw AS ({RAW_LINES}),
content AS (SELECT source, count(*) AS n FROM ({content("SELECT * FROM raw")}) GROUP BY source),
words AS (SELECT source, count(*) AS n FROM ({bag("SELECT * FROM raw", "source,")}) GROUP BY source)
SELECT r.source AS raw_file, r.n AS n_lines, coalesce(c.n, 0) AS n_content,
       coalesce(w.n, 0) AS n_words
FROM (SELECT source, count(*) AS n FROM raw GROUP BY source) r
     LEFT JOIN content c USING (source) LEFT JOIN words w USING (source)""",
    "manifest_lines": f"""
SELECT row_number() OVER (ORDER BY page_id) - 1 AS file_id, trim(url, {_BLANKS}) AS path
FROM pages WHERE trim(url, {_BLANKS}) <> ''""",
}
