"""Results are only right if these stay exactly as they are.

Everything here is data (patterns, word lists, limits, names and output
formats). How the values are applied is decided in the other modules.
"""

# What is removed from a line before it is cut into words.
URL = r"https?://[^\s]+|www\.[^\s]+"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
ENTITY = r"&[a-zA-Z]+;|&#[0-9]+;"
NON_LETTERS = r"[^\p{L}\s]+"

# Lines that are crawl headers, not text.
HEADER_PREFIXES = ("WARC/", "WARC-", "Content-", "Software-", "Extracted-")
HEADER_PREFIXES_ANY_CASE = (
    "robots:", "ispartof:", "operator:", "publisher:", "description:",
)
FIELD_NAME_PREFIX = "warc"
FIELD_NAMES = ("content-type", "content-length")

# Words left out of the final ranking.
STOP_WORDS = tuple(
    """
    the be to of and a in that have i
    it for not on with he as you do at
    this but his by from they we say her she
    or an will my one all would there their
    what so up out if about who get which go
    me when make can like time no just him know
    """.split()
)

# Limits.
MIN_WORD_LENGTH = 2
TOP_N = 1000
MIN_COUNT = 10
CATEGORY_MAX_LENGTH = (("SHORT", 3), ("MEDIUM", 7), ("LONG", 12))
CATEGORY_BEYOND = "VERY_LONG"
SAMPLE_SIZE = 100
SAMPLE_SEED = 42

# Names and formats of the written results.
STAGE_DIRS = (
    "stage1_cleaned",
    "stage2_wordcount",
    "stage3_wordlength",
    "stage4_alphabet",
    "stage5_topn",
    "stage6_final",
)
LENGTH_STATS_FORMAT = "count=%d, avg_per_partition=%.2f"
FINAL_ROW_FORMAT = "count=%d, length=%d, category=%s, topN=%s"
SUMMARY_KEY = "### SUMMARY_STATISTICS ###"
SUMMARY_TOTAL_FORMAT = "total_word_occurrences=%d"
SUMMARY_UNIQUE_FORMAT = "unique_words=%d"
SUMMARY_AVERAGE_FORMAT = "avg_frequency=%.2f"
SUMMARY_LENGTH_FORMAT = "most_common_length=%d"
TOTAL_CHARS_KEY = "TOTAL_CHARS"
DATA_FILE_PREFIX = "data-"
