"""Intermediate tables in the shared folder, and blocks of texts from Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet in the shared folder and read again.

    This cuts the lineage: a lost executor costs no more than the tasks that run on it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in df.columns:
        name = f"{name}_"
    return name


def row_key(*columns: str) -> Column:
    """Tells rows apart by these columns, so that a null or repeated id does no harm."""
    return F.xxhash64(*[F.col(c) for c in columns])


#: Bits of a filter of 64-bit hashes per hash, and the fewest and most in all (128 KB to 128 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 1 << 20, 1 << 30


def filter_bits(count: int) -> int:
    """The size of a filter of so many hashes, a power of two."""
    return min(max(1 << (BITS_EACH * count).bit_length(), LEAST_BITS), MOST_BITS)


def bit_filter(rows: DataFrame, column: str) -> np.ndarray:
    """One bit per hash, by its lowest bits, in a filter sized by the counted rows; rows of 4 KB reach the driver.

    What it lets through by chance has to be told apart by a join afterwards.
    """
    size = filter_bits(rows.count())
    spot = F.pmod(column, F.lit(size)) + 1
    bits = np.zeros(size // 8, np.uint8)
    parts = rows.groupBy(F.bitmap_bucket_number(spot).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("m"))
    for r in parts.collect():
        own = np.frombuffer(bytes(r["m"]), np.uint8)
        bits[(r["b"] - 1) * 4096:(r["b"] - 1) * 4096 + len(own)] = own
    return bits


def has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    spot = (hashes % np.uint64(8 * len(bits))).astype(np.int64)
    return (bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    array = pc.fill_null(column.cast(pa.large_string()), "")
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text stands alone, and whole."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last
