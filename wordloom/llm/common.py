"""Helpers that several operators share: columns, stored tables, hashes of words."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sinks.tables import shared_folder, write_table

BLANKS = b" \t\n\x0b\x0c\r"  # what separates words. Fixed values.
_BLANK_BYTES = [bytes([b]) for b in BLANKS]
_IS_BLANK = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(BLANKS, np.uint8))
CHUNK_BYTES = 1 << 20
# Odd 64-bit constants of the splitmix finalizer. Fixed values.
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def id_and_text(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id bigint, text string`` of any table; a null text is empty.

    Other columns are left behind, so their names cannot clash with results.
    """
    return docs.select(
        docs[id_column].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, upper and lower case being one."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions the session asks for; adaptive runs may use fewer."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors share; see ``shared_folder``."""
    return shared_folder(spark, f"llm/{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks that read the table, and
    work with side effects or a high price is not run again.
    """
    return write_table(df, work_folder(df.sparkSession, name))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of each 64-bit value over all of them."""
    x = values + _STEP
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for every window of ``n`` word hashes."""
    count = len(hashes) - n + 1
    if count <= 0:
        return hashes[:0]
    value = hashes[:count].copy()
    for k in range(1, n):
        value *= _STEP
        value += hashes[k : k + count]
    return mixed(value)


def _powers(base: int) -> np.ndarray:
    table = np.full(CHUNK_BYTES, base, np.uint64)
    table[0] = 1
    return np.cumprod(table)


@functools.cache
def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, by position."""
    return _powers(int(_STEP)), _powers(pow(int(_STEP), -1, 1 << 64))


def _chunk_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(data, np.uint8)
    if len(codes) > CHUNK_BYTES:  # a single word of more than a chunk
        start = len(data) - len(data.lstrip(BLANKS))
        end = len(data.rstrip(BLANKS))
        digest = xxhash.xxh3_64_intdigest(data[start:end])
        return np.array([digest], np.uint64), np.array([start]), np.array([end])
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = ~_IS_BLANK[codes]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    powers, inverses = _power_tables()
    sums = np.zeros(len(codes) + 1, np.uint64)
    # Byte plus one: a byte of zero adds its power too.
    np.cumsum((codes + np.uint64(1)) * powers[: len(codes)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverses[starts]), starts, ends


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte and end of every word of a text, in order.

    Words are runs of bytes other than BLANKS. The hash of a word is its
    polynomial in an odd base modulo 2**64, its coefficients the bytes plus one,
    made by one cumulative sum over the text, then mixed. Callers take words of
    equal hashes as equal. Long texts are taken in chunks that end at a blank, so
    memory does not grow with the text beyond what is returned.
    """
    found, at = [], 0
    while at < len(data) or not found:
        end = at + CHUNK_BYTES
        if end < len(data):
            cut = max(data.rfind(b, at, end) for b in _BLANK_BYTES)
            if cut < at:  # the word goes on: up to the next blank
                cut = min((c for b in _BLANK_BYTES if (c := data.find(b, end)) >= 0),
                          default=len(data))
            end = max(cut, at + 1)
        hashes, starts, ends = _chunk_words(data[at:end])
        found.append((hashes, starts + at, ends + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


SHINGLE_WORDS = 5


def shingles(hashes: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all windows of ``n`` words; fewer words make one shingle, none no shingle."""
    return rolling(hashes, min(n, len(hashes))) if len(hashes) else hashes


def output_stream(uri: str) -> pyarrow.NativeFile:
    """A new file in a store that all executors reach, for a task to write."""
    store, path = pyarrow.fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)  # not by the name


def input_file(uri: str) -> pyarrow.NativeFile:
    """Such a file, open for reads of byte ranges."""
    store, path = pyarrow.fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def pack_numbers(values: np.ndarray, level: int = 3) -> bytes:
    """Unsigned numbers below 2**64, compressed a byte plane at a time."""
    table = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = np.ascontiguousarray(table[:, :width].T).tobytes()
    head = len(values).to_bytes(8, "little") + bytes([width])
    return head + zstandard.ZstdCompressor(level=level).compress(planes)


def unpack_numbers(data: bytes) -> np.ndarray:
    count, width = int.from_bytes(data[:8], "little"), data[8]
    table = np.zeros((count, 8), np.uint8)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[9:]), np.uint8)
    table[:, :width] = planes.reshape(width, count).T
    return table.view("<u8").ravel()


def pack_strings(values: list[bytes], level: int = 3) -> bytes:
    """Byte strings, compressed; their number is bounded by the caller's block."""
    sizes = pack_numbers(np.fromiter(map(len, values), np.uint64, len(values)))
    body = zstandard.ZstdCompressor(level=level).compress(b"".join(values))
    return len(sizes).to_bytes(8, "little") + sizes + body


def unpack_strings(data: bytes) -> list[bytes]:
    at = 8 + int.from_bytes(data[:8], "little")
    ends = np.cumsum(unpack_numbers(data[8:at])).tolist()
    body = zstandard.ZstdDecompressor().decompress(data[at:])
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def gathered(flat: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The lists numbered ``chosen``, end to end; list k of ``flat`` ends before ``ends[k + 1]``.

    ``ends`` begins with 0 and is made once for all calls: a call's work is what it returns.
    """
    starts = ends[chosen]
    wanted = ends[chosen + 1] - starts
    before = np.cumsum(wanted) - wanted
    return flat[np.repeat(starts - before, wanted) + np.arange(int(wanted.sum()))]


def list_ends(sizes: np.ndarray) -> np.ndarray:
    """The ``ends`` of ``gathered`` for lists of these sizes."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
