"""Words, shingles and windows of texts as arrays of 64-bit hashes.

All functions work on one document at a time, inside a task. Spaces are the six
of ASCII (0x20 and 0x09 to 0x0D), which is also what ``bytes.split`` takes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache, wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Odd, and 3 modulo 8, so that differences of its powers lose few low bits.
BASE = 0x9E3779B97F4A7C1B
BASE_INVERSE = pow(BASE, -1, 1 << 64)
KNOWN_WORDS = 200_000
BATCH_BYTES = "2m"


def text_key(text: Column | str = "text") -> Column:
    """Tells rows with one doc_id but different texts apart."""
    text = F.col(text) if isinstance(text, str) else text
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the text's key, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       text_key(F.col("text").cast("string")).alias("k"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of our own that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    mark = "_fl"
    while any(f"{mark}_{name}" in taken for name in names):
        mark += "_"
    return [f"{mark}_{name}" for name in names]


class WordHashes(dict):
    """Word to hash; emptied when full, so that memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 48:
            self[word] = found
        return found


@cache
def known_words() -> WordHashes:
    """One per Python worker."""
    return WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(known_words().__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 4096), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 1 << 20:
            _powers[base] = have
    return have[:n]


class Spans:
    """Hashes of any stretch of a sequence in constant time, from prefix sums."""

    def __init__(self, hashes: np.ndarray):
        self.n = len(hashes)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(hashes * powers(BASE, self.n), out=self.sums[1:])
        self.down = powers(BASE_INVERSE, self.n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(value + (end - start).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))

    def windows(self, length: int) -> np.ndarray:
        if self.n < length:
            return np.zeros(0, np.uint64)
        value = (self.sums[length:] - self.sums[: self.n - length + 1]) * self.down[: self.n - length + 1]
        return mix(value + np.uint64(length * 0x9FB21C651E98DF25 & (1 << 64) - 1))


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """The distinct shingles, sorted. A shorter text is one shingle as a whole."""
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(Spans(word_hashes(words)).windows(min(size, len(words))))


def column_bytes(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    """The texts of a batch, one at a time."""
    column = batch.column(batch.schema.get_field_index(name))
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return (value.as_py() for value in column)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, jobs hand long texts to Python in batches of few bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def keep_batches_small(spark: SparkSession) -> None:
    """The same from now on, for frames that run after their operator has returned."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def forgetful(run):
    """A map over batches after which its task remembers nothing: workers are used again."""

    @wraps(run)
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            forget()

    return mapped


def forget() -> None:
    """Empties what this worker remembers, and gives its memory back to the system."""
    known_words().clear()
    _powers.clear()
    pa.default_memory_pool().release_unused()
    _trim()(0)


@cache
def _trim():
    """What gives free memory back to the system, where the C library can."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return int


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def record_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows to batches of bounded length."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema
    )
