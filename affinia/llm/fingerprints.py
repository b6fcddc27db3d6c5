"""Document fingerprints by a threshold-scaled sketch.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range, so its
size follows the text's, two of them merge by union, and a small document can be looked
for in a large one. Short texts would keep next to nothing: at least the ``FLOOR``
smallest hashes stay, which merges in the same way.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.hashing import STEP, mix

#: Bytes of a shingle, the kept fraction of all 32-bit hashes, and the least kept.
SHINGLE, FRACTION, FLOOR = 16, 1 / 32, 16
_CUT = int(FRACTION * 2**32)


def sketch(data: bytes) -> np.ndarray:
    """The kept shingle hashes of a text's UTF-8 bytes, ascending; a shorter text is one shingle."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint32)
    if n < SHINGLE:
        data = data.ljust(SHINGLE, b"\0") + bytes([n])
        n = len(data)
        view = np.frombuffer(data[:SHINGLE], "<u8")
        hashes = mix(mix(view[:1] * STEP + np.uint64(n)) + view[1:2])
    else:
        raw = np.frombuffer(data, np.uint8)
        eights = np.lib.stride_tricks.as_strided(raw, (n - 7, 8), (1, 1)).copy().view("<u8").ravel()
        hashes = mix(mix(eights[:n - 15] * STEP) + eights[8:])
    # Hashes far above the floor cannot stay: only few are sorted.
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    low = short[short < max(_CUT, min(2**32 - 1, 2**32 * 8 * FLOOR // len(short)))]
    kept = np.unique(low)
    if len(kept) < FLOOR:
        kept = np.unique(short)
    within = int(np.searchsorted(kept, _CUT))
    return kept[:max(within, FLOOR)]


def covered(kept: np.ndarray) -> int:
    """Below this hash a fingerprint holds all the hashes of its text."""
    return 2**32 if len(kept) < FLOOR else max(_CUT, int(kept[-1]) + 1)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fingerprint of both texts' shingles together."""
    kept = np.union1d(a, b)
    kept = kept[kept < min(covered(a), covered(b))]
    return kept[:max(int(np.searchsorted(kept, _CUT)), FLOOR)]


def _common(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    top = min(covered(a), covered(b))
    a, b = a[a < top], b[b < top]
    return len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the shingle sets; 1 for two empty texts."""
    both, na, nb = _common(a, b)
    return both / (na + nb - both) if na + nb else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has too; 1 if a is empty."""
    both, na, _ = _common(a, b)
    return both / na if na else 1.0


def to_text(kept: np.ndarray) -> str:
    return kept.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
          "within_edited", "within_next", "within_both"]
_SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, within_edited double, within_next double, within_both double")
_TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 5]


def _row(doc_id, text: str, own: np.ndarray, following: str, after: np.ndarray) -> tuple:
    n = len(text)
    size = n // 4
    edited = (text[:n - size] + following[:size]).encode()
    other = sketch(edited)
    return (doc_id, n, hashlib.sha256(edited).hexdigest(), to_text(own), to_text(other), likeness(own, other),
            likeness(own, after), containment(own, other), containment(own, after), containment(own, merge(other, after)))


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ranges in order, each range ended by the text that follows its last row."""
    held = None
    for batch in batches:
        out = []
        for doc_id, text, end in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            text = text.as_py()
            own = sketch(text.encode())
            if held is not None:
                out.append(_row(*held, text, own))
            held = None if end else (doc_id, text, own)
        columns = list(zip(*out)) if out else [[]] * len(_NAMES)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def _ranged(rows: DataFrame, parts: int) -> DataFrame:
    """The rows with ``range``, whose order is that of the rows: by id, without an id by hash.

    The splitters are quantiles of the ids, at most ``parts`` numbers, and are looked up by
    binary search. Ids that are one number as a double share a range.
    """
    named = rows.where("doc_id is not null").select(F.col("doc_id").cast("double").alias("d"))
    cuts = named.approxQuantile("d", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else []
    splits = [-math.inf, *sorted({*cuts} or {0.0}), math.inf]
    seek = Bucketizer(splits=splits, inputCol="_d", outputCol="_spot")
    spots = seek.transform(rows.withColumn("_d", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
    by_hash = F.least(F.floor((F.col("hash") / 2.0**64 + 0.5) * parts), F.lit(parts - 1))
    spot = F.when(F.col("doc_id").isNull(), by_hash).otherwise(F.col("_spot") + parts)
    return spots.withColumn("range", spot.cast("int")).drop("_d", "_spot")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likeness.

    The edited text of a document has its last quarter (floor of its code points / 4)
    replaced by as many first code points of the next document in ascending doc_id, the
    first one following the last. ``near_edited`` compares its fingerprint with the
    edited text's, ``near_next`` with the next document's. ``within_edited`` and
    ``within_next`` are the shares of the document's shingles that these two hold,
    ``within_both`` the share that their merged fingerprint holds.

    Texts travel once, to ranges of ids cut at fixed splitters. The first text of each
    range, known by its id alone, is sent to the end of the range before it, so that
    nothing has to be written in between; of the ids themselves only the splitters and
    each range's first one reach the driver.

    Null texts count as empty, with empty fingerprints; two empty texts have likeness 1,
    an empty and another one 0. Rows without an id come first, in the order of a hash of
    their texts; rows of equal ids follow each other in the order of their texts. A single
    document follows itself. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    parts = max(rows.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = _ranged(rows, parts)
    # At most two rows per partition: the lowest id, or hash, of each range that has any.
    lowest = sorted(
        rows.where("doc_id is not null").groupBy("range").agg(F.min("doc_id").alias("low")).collect()
        + rows.where("doc_id is null").groupBy("range").agg(F.min("hash").alias("low")).collect())
    before = [(r["range"], r["low"], lowest[k - 1]["range"]) for k, r in enumerate(lowest)]
    first = F.broadcast(spark.createDataFrame(before, "range int, low bigint, before int"))
    heads = rows.join(first, "range").where(F.coalesce("doc_id", "hash") == F.col("low"))
    heads = heads.groupBy("before").agg(F.min("text").alias("text")).select(
        F.lit(None).cast("bigint").alias("doc_id"), "text", F.lit(None).cast("bigint").alias("hash"),
        F.col("before").alias("range"), F.lit(True).alias("end"))
    dealt = rows.withColumn("end", F.lit(False)).unionByName(heads)
    dealt = dealt.repartitionById(parts, F.pmod("range", F.lit(parts)))
    ordered = dealt.sortWithinPartitions("range", "end", F.asc_nulls_first("doc_id"), "hash", "text")
    return ordered.select("doc_id", "text", "end").mapInArrow(_in_order, _SCHEMA)
