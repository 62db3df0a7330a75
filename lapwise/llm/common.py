"""What several operators of this folder need: shipping the package, staging, byte arithmetic on texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lapwise.session import shared_folder, ship, stage

__all__ = ["stage", "stage_large", "ship", "table", "digest", "utf8_bytes", "parted", "joined", "PrefixHash", "word_bounds", "mix"]

#: Texts are handled in lots of about so many bytes, so that arrays of a lot stay small.
LOT_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage_large(df: DataFrame, label: str, group_bytes: int = 32 << 20, **options: str) -> DataFrame:
    """`stage` for a table whose rows are megabytes each: small row groups, as a reader holds one of them."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).option("parquet.block.size", group_bytes).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def digest(text: Column) -> Column:
    """Equal for equal texts; a missing text has its own value."""
    return F.coalesce(F.md5(F.encode(text, "UTF-8")), F.lit("missing"))


def utf8_bytes(text: Column) -> Column:
    """Length in UTF-8 bytes, 0 for a missing text."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def lots(sizes: Iterable[int], most: int = LOT_BYTES) -> Iterator[slice]:
    """Consecutive rows of at most `most` bytes together, or one longer row."""
    start = total = place = 0
    for place, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(start, place)
            start, total = place, 0
        total += size
        total = max(total, 1)
    if total:
        yield slice(start, place + 1)


def parted(batches, rows: int = 512):
    """Batches of few rows, so that a worker holds a few texts or sets as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and where each text starts (one more entry: the end)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer(b"".join(texts), np.uint8), starts


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


_powers: list[np.ndarray] = []


def _power_tables(length: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the longest text so far."""
    if not _powers or len(_powers[0]) < length:
        length = max(length, 2 * LOT_BYTES)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            powers = np.full(length, base, np.uint64)
            powers[0] = 1
            tables.append(np.cumprod(powers))
        _powers[:] = tables
    return _powers


class PrefixHash:
    """Polynomial hashes modulo 2**64 of any stretch of a byte array, from one running sum."""

    def __init__(self, data: np.ndarray) -> None:
        up, self._down = _power_tables(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self._sums[1:])

    def rolling(self, length: int) -> np.ndarray:
        """One value for each start of a stretch of `length` bytes."""
        count = len(self._sums) - length
        return mix((self._sums[length:] - self._sums[:count]) * self._down[:count])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])


#: 1 for the bytes of words once A-Z are lowered: digits, a-z and everything beyond ASCII.
_WORD = np.zeros(256, np.bool_)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of lowered bytes, and how many words each text has.

    A word is a run of digits, a-z and bytes beyond ASCII; texts are cut at `starts`.
    """
    inside = _WORD[data]
    before = np.zeros(len(data) + 1, np.bool_)
    before[1:] = inside
    before[starts] = False
    opens = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, np.bool_)
    after[:-1] = inside
    after[starts] = False
    closes = np.flatnonzero(inside & ~after[1:]) + 1
    counts = np.diff(np.searchsorted(opens, starts))
    return opens, closes, counts
