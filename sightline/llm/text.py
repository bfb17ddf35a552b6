"""Helpers for the text operators: folds, Arrow blocks of bounded size, words as codes.

Words are maximal runs without the characters x20 and x09 to x0D.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
MAX_CHARS = 4_000_000
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def hashed_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About `rows` rows of `df` (all, if there are no more), chosen by a hash of `key`.

    One count job; the same rows are chosen on every run and after every retry.
    """
    total = df.count()
    if total <= rows:
        return df
    limit = int(rows / total * (1 << 30))
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1 << 30)) < limit)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Send at most `rows` rows at once to Python, for operators on whole texts.

    Spark bounds Arrow batches by rows and not by bytes; its 10,000 texts may be of any size together.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def blocks(
    batches: Iterable[pa.RecordBatch], column: str = "text", max_chars: int = MAX_CHARS
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold at most `max_chars` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + max_chars, "right")))
            yield batch.slice(start, end - start)
            start = end


def joined_blocks(
    batches: Iterable[pa.RecordBatch], column: str = "text", max_chars: int = MAX_CHARS
) -> Iterator[pa.RecordBatch]:
    """Like `blocks`, with rows of neighbouring batches put together as far as they fit."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            end = int(np.searchsorted(ends, before + max_chars - size, "right"))
            if end > start or not held:
                end = max(end, start + 1)
                held.append(batch.slice(start, end - start))
                size += int(ends[end - 1] - before)
                start = end
            if start < len(ends):
                yield pa.concat_batches(held) if len(held) > 1 else held[0]
                held, size = [], 0
    if held:
        yield pa.concat_batches(held) if len(held) > 1 else held[0]


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of the texts (null: none) as codes, each text's first and last place, distinct words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.flatten()
    offsets = offsets - offsets[0]
    filled = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False), dtype=np.int64)])
    encoded = words.filter(filled).dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), kept[offsets], encoded.dictionary


def hash_words(words: Iterable[str], n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)


def mix(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit hash of several, sensitive to their order."""
    out = np.full(len(parts[0]), 0x9E3779B97F4A7C15, np.uint64)
    for part in parts:
        out = (out ^ part) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(32))


def row_of(offsets: np.ndarray) -> np.ndarray:
    """For each element the number of the row it lies in."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
