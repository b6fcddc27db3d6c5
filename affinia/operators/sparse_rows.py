"""A sparse matrix as rows of compressed entries, with a table that says where a row lies.

Entries are put into one global order by row and column and cut into chunks of equal
length, whatever the length of a row; a row with very many entries spans chunks, and many
short rows share one. A chunk holds its row numbers, the place at which each begins, and
the columns and values in order. The offset table gives the first and last chunk of a row,
so that a few rows are read from a few chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators.indexing import dense_index
from affinia.operators.sizes import broadcast_if_small
from affinia.session import cut_lineage

#: Entries of a chunk.
ENTRIES = 1 << 16
CHUNK = "chunk bigint, rows array<bigint>, starts array<int>, columns array<bigint>, values array<double>"


@dataclass
class SparseRows:
    """``chunks``: chunk, rows, starts, columns, values; ``offsets``: row, first, last (chunk), entries."""

    chunks: DataFrame
    offsets: DataFrame


def _one(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


def _compress(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("_at")
    row = table.column("row").to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    return pa.table({
        "chunk": pa.array([key[0].as_py()], pa.int64()), "rows": _one(row[starts], pa.int64()),
        "starts": _one(starts.astype(np.int32), pa.int32()), "columns": _one(table.column("column").to_numpy(), pa.int64()),
        "values": _one(table.column("value").to_numpy(zero_copy_only=False), pa.float64())})


def build(cells: DataFrame, row: str, column: str, value: str, entries: int = ENTRIES) -> SparseRows:
    """From one cell per row and column. Rows and columns are 64-bit numbers; cells without one are left out."""
    held = cells.select(F.col(row).cast("bigint").alias("row"), F.col(column).cast("bigint").alias("column"),
                        F.col(value).cast("double").alias("value")).where("row is not null and column is not null")
    placed = dense_index(held, F.asc("row"), F.asc("column"), name="_at").withColumn("chunk", F.floor(F.col("_at") / entries))
    placed = cut_lineage(placed.select("chunk", "_at", "row", "column", "value"))
    offsets = placed.groupBy("row").agg(F.min("chunk").alias("first"), F.max("chunk").alias("last"), F.count("*").alias("entries"))
    return SparseRows(cut_lineage(placed.groupBy("chunk").applyInArrow(_compress, CHUNK)), cut_lineage(offsets))


def _entries(chunk: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple(chunk.column(c)[at].values.to_numpy(zero_copy_only=False) for c in ("rows", "starts", "columns", "values"))


def unpack(chunks: DataFrame) -> DataFrame:
    """(row, column, value) of all chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows, starts, columns, values = _entries(batch, at)
                sizes = np.diff(np.append(starts, len(columns)))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rows, sizes)), pa.array(columns), pa.array(values)],
                                                 names=["row", "column", "value"])

    return chunks.mapInArrow(run, "row bigint, column bigint, value double")


def read_rows(matrix: SparseRows, wanted: DataFrame, row: str = "row") -> DataFrame:
    """(row, column, value) of the wanted rows, from the chunks that hold them and from no others."""
    asked = wanted.select(F.col(row).cast("bigint").alias("row")).distinct()
    spans = matrix.offsets.join(broadcast_if_small(cut_lineage(asked)), "row", "left_semi")
    # A chunk holds at most as many rows as it has entries.
    each = spans.select("row", F.explode(F.sequence("first", "last")).alias("chunk")).groupBy("chunk").agg(
        F.sort_array(F.collect_set("row")).alias("wanted"))
    joined = matrix.chunks.join(broadcast_if_small(cut_lineage(each)), "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows, starts, columns, values = _entries(batch, at)
                ends = np.append(starts[1:], len(columns))
                place = np.searchsorted(rows, batch.column("wanted")[at].values.to_numpy())
                sizes = ends[place] - starts[place]
                inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[place], sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(rows[place], sizes)), pa.array(columns[inside]), pa.array(values[inside])],
                    names=["row", "column", "value"])

    return joined.mapInArrow(run, "row bigint, column bigint, value double")


def transpose(matrix: SparseRows, entries: int = ENTRIES) -> SparseRows:
    """Columns as rows; one range sort of the entries."""
    return build(unpack(matrix.chunks), "column", "row", "value", entries)
