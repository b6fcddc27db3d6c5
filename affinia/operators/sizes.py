"""Broadcasts behind a measured size, and scans of few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of a table of numbers, strings, bytes and flat arrays, counted and not estimated."""
    fixed, parts = 0, []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(field.name), F.lit(0)) + 16)
        elif kind.startswith("array"):
            parts.append(F.greatest(F.size(field.name), F.lit(0)) * 8 + 16)
        else:
            fixed += 8
    each = sum(parts, F.lit(fixed))
    return df.agg(F.coalesce(F.sum(each.cast("bigint")), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only where the measured bytes allow it; else the join may shuffle.

    For tables that are cheap to read twice, such as checkpointed dictionaries.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a scan dealt out again where it has fewer splits than there are cores.

    For heavy work per row, such as tokenising. A large table has far more splits than
    cores, and then nothing is moved.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
