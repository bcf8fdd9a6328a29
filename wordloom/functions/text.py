"""Column functions on lines and words.

All of them are built-in Spark expressions. Regular expressions are Java's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom import fixed_values as fixed

# Java's String.trim() strips every character up to and including the blank.
_BLANKS = "".join(map(chr, range(0x21)))
_BLANK = r"[\x00-\x20]"

# A field line must have something other than blanks after "name: ", and no
# line separator in it (U+0085, U+2028 and U+2029 can occur inside a line).
_FIELD_TEXT = (
    r"\s[^\n\r\u0085\u2028\u2029]*"
    r"[^\x00-\x20\u0085\u2028\u2029][\x00-\x20]*\z"
)

_HEADER = (
    f"(?:{'|'.join(fixed.HEADER_PREFIXES)}"
    f"|(?i:{'|'.join(fixed.HEADER_PREFIXES_ANY_CASE)})"
    f"|(?i:{fixed.FIELD_NAME_PREFIX}[a-z0-9_-]*|{'|'.join(fixed.FIELD_NAMES)}):"
    f"{_FIELD_TEXT})"
)

# One pattern for "not blank and not a header": a line is decoded once.
_CONTENT_LINE = rf"\A{_BLANK}*+(?!{_HEADER})[^\x00-\x20]"

# The mail pattern tries every character of a run as a start and rescans the
# run each time: quadratic on a long unbroken token. A mail address found at
# any character of a run is also found at the run's first one (or where the
# previous match ended), so trying only there gives the same matches.
# Written out: the first run is possessive, the rest is as in fixed.EMAIL.
_MAIL_START = r"(?:(?<![a-zA-Z0-9._%+-])|\G)"
_EMAIL_LINEAR = _MAIL_START + r"[a-zA-Z0-9._%+-]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"

_BMP_LETTER = r"[\p{L}&&[^\x{10000}-\x{10FFFF}]]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _remove(c: Column, pattern: str, *markers: str) -> Column:
    """Delete the matches of ``pattern``; lines without a marker skip the regex.

    Every match must contain one of the ``markers``. Looking for them is a byte
    scan, far cheaper than decoding the line and running the pattern.
    """
    possible = F.lit(False)
    for marker in markers:
        possible = possible | c.contains(marker)
    return F.when(possible, F.regexp_replace(c, pattern, "")).otherwise(c)


def trim_blanks(c: Column | str) -> Column:
    """Strip all characters <= U+0020 from both ends (Spark's trim: blanks only)."""
    return F.btrim(_col(c), F.lit(_BLANKS))


def is_content_line(c: Column | str) -> Column:
    """True for a line that is neither blank nor a crawl header."""
    return _col(c).rlike(_CONTENT_LINE)


def strip_urls(c: Column | str) -> Column:
    return _remove(_col(c), fixed.URL, "://", "www.")


def strip_emails(c: Column | str) -> Column:
    return _remove(_col(c), _EMAIL_LINEAR, "@")


def strip_entities(c: Column | str) -> Column:
    return _remove(_col(c), fixed.ENTITY, "&")


def normalize_letters(c: Column | str) -> Column:
    """Lower-case; every run of neither letters nor white space becomes a blank."""
    return F.regexp_replace(F.lower(_col(c)), fixed.NON_LETTERS, " ")


def letter_runs(c: Column | str) -> Column:
    """Array of the maximal runs of letters, lower-cased.

    The same words as ``normalize_letters`` cut at white space, in one regex
    pass. Lower-casing comes first and sees the whole line: a final sigma
    depends on what follows it.
    """
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"\p{L}+"), F.lit(0))


def first_tokens(c: Column | str) -> Column:
    """Array of the text before the first white space of the trimmed line; empty if blank."""
    return F.regexp_extract_all(trim_blanks(c), F.lit(r"\A\S+"), F.lit(0))


def utf16_length(c: Column | str) -> Column:
    """Length in UTF-16 units; pure ASCII needs no re-encoding."""
    c = _col(c)
    return F.when(F.octet_length(c) == F.length(c), F.length(c)).otherwise(
        F.shiftright(F.octet_length(F.encode(c, "UTF-16BE")), 1)
    )


def has_min_length(c: Column | str, n: int) -> Column:
    """``utf16_length(c) >= n``; long enough in characters is long enough."""
    c = _col(c)
    return (F.length(c) >= n) | (utf16_length(c) >= n)


def is_bmp_letter(c: Column | str) -> Column:
    """True for a single letter up to U+FFFF; letters beyond do not count."""
    return _col(c).rlike(_BMP_LETTER)


def word_category(length: Column | str) -> Column:
    """SHORT, MEDIUM, LONG or VERY_LONG."""
    length = _col(length)
    (name, limit), *rest = fixed.CATEGORY_MAX_LENGTH
    category = F.when(length <= limit, name)
    for name, limit in rest:
        category = category.when(length <= limit, name)
    return category.otherwise(fixed.CATEGORY_BEYOND)


def base_name(path: Column | str) -> Column:
    """Last component of a path, '' if the path ends with a slash."""
    return F.regexp_extract(_col(path), r"[^/]+\z", 0)
