"""Reading with a side output of what could not be read: file, reason and count per reject.

Lines are parsed by Spark and keep their file and text, so a malformed one can be shown.
For Parquet a probe counts the rows that every file's footer promises, which reads no
data; a file that gives fewer, or whose footer cannot be read at all, is a reject.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from affinia import schemas
from affinia.operators.sizes import broadcast_if_small

CORRUPT = "_corrupt_record"
#: Files up to this size are opened whole to see why they gave no row.
PROBE_BYTES = 1 << 28


@dataclass
class Checked:
    """``rows`` that were read, ``rejects`` (file, reason, records, sample) and the counts of both.

    ``counts`` is filled by the first action on ``rows``: read and rejected.
    """

    rows: DataFrame
    rejects: DataFrame
    counts: Observation

    def write_rejects(self, path: str) -> None:
        self.rejects.write.mode("errorifexists").parquet(path)


def _as_rejects(bad: DataFrame) -> DataFrame:
    """One row per file and reason, with one of its records."""
    return bad.groupBy("file", "reason").agg(F.count("*").alias("records"), F.min("record").alias("sample"))


def checked_lines(spark: SparkSession, path: str, schema: str, required: list[str]) -> Checked:
    """JSON lines under a schema; a line has to be an object whose required fields are set.

    Blank lines are neither rows nor rejects.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))
    parsed = lines.where(F.trim("record") != "").withColumn("_r", F.from_json(
        "record", f"{schema}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    missing = [F.when(F.col(f"_r.{name}").isNull(), F.lit(f"no {name}")) for name in required]
    reason = F.coalesce(F.when(F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull(), F.lit("malformed")), *missing)
    marked = parsed.withColumn("reason", reason)
    counts = Observation()
    seen = marked.observe(counts, F.count_if(F.col("reason").isNull()).alias("read"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))
    names = spark.createDataFrame([], schema).columns
    rows = seen.where(F.col("reason").isNull()).select(*[F.col(f"_r.{n}").alias(n) for n in names])
    return Checked(rows, _as_rejects(marked.where(F.col("reason").isNotNull())), counts)


def checked_scene_product(spark: SparkSession, path: str) -> Checked:
    """(product, scene, bbox) of JSON lines, with the lines that are none."""
    return checked_lines(spark, path, schemas.SCENE_PRODUCT, ["product", "scene"])


def _why_unread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The reason for files that promised no row; none for a sound file without rows."""
    for batch in batches:
        reasons = []
        for content in batch.column("content"):
            try:
                promised = pq.read_metadata(io.BytesIO(content.as_py() or b"")).num_rows
                reasons.append(None if promised == 0 else "unreadable rows")
            except (pa.ArrowException, OSError, EOFError):
                reasons.append("unreadable file")
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(reasons, pa.string())], names=["file", "reason"])


def checked_parquet(spark: SparkSession, paths: str | list[str], schema: str) -> Checked:
    """Rows of Parquet files under a schema, with files that are none, files cut short and rows without any field.

    What a damaged file still gives is kept; a file without a byte is no reject, as Spark
    does not list it and it holds nothing. ``records`` counts lost rows where the footer
    says how many there should be, and is null for a file without a footer.
    """
    paths = [paths] if isinstance(paths, str) else paths
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true")
    held = reader.parquet(*paths).select("*", F.col("_metadata.file_path").alias("_file"))
    fields = [c for c in held.columns if c != "_file"]
    nothing = ~F.greatest(*[F.col(f"`{c}`").isNotNull() for c in fields]) if len(fields) > 1 else F.col(f"`{fields[0]}`").isNull()
    counts = Observation()
    seen = held.observe(counts, F.count_if(~nothing).alias("read"), F.count_if(nothing).alias("rejected"))
    rows = seen.where(~nothing).select(*[F.col(f"`{c}`") for c in fields])

    # No column is asked for, so only footers are read.
    promised = reader.parquet(*paths).select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("promised"))
    # Counted by what the rows hold, as a bare count would be taken from the footers again.
    given = held.groupBy(F.col("_file").alias("file")).agg(
        (F.count_if(nothing) + F.count_if(~nothing)).alias("given"), F.count_if(nothing).alias("empty"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    # File names are few beside rows, but their number has no bound of its own.
    listed = files.select(F.col("path").alias("file"), "length")
    known = listed.join(broadcast_if_small(promised), "file", "left").join(broadcast_if_small(given), "file", "left")
    short = known.where(F.col("promised") > F.coalesce("given", F.lit(0))).select(
        "file", F.lit("unreadable rows").alias("reason"), (F.col("promised") - F.coalesce("given", F.lit(0))).alias("records"))
    empty = known.where(F.col("empty") > 0).select("file", F.lit("no field set").alias("reason"), F.col("empty").alias("records"))
    silent = known.where(F.col("promised").isNull()).select("file", "length")
    large = silent.where(F.col("length") > PROBE_BYTES).select("file", F.lit("unreadable file").alias("reason"))
    suspects = files.where(F.col("length") <= PROBE_BYTES).join(
        broadcast_if_small(silent.select(F.col("file").alias("path"))), "path", "left_semi")
    why = suspects.select("path", "content").mapInArrow(_why_unread, "file string, reason string").where("reason is not null")
    unread = why.unionByName(large).withColumn("records", F.lit(None).cast("bigint"))
    rejects = short.unionByName(empty).unionByName(unread).withColumn("sample", F.lit(None).cast("string"))
    return Checked(rows, rejects, counts)


def checked_typed(spark: SparkSession, paths: str | list[str], kind: str) -> Checked:
    """Records of one kind under its fixed schema, and what was left out."""
    return checked_parquet(spark, paths, schemas.RECORD_KINDS[kind])


def summary(rejects: DataFrame) -> DataFrame:
    """(reason, files, records): what a job may log or stop at."""
    return rejects.groupBy("reason").agg(F.countDistinct("file").alias("files"), F.sum("records").alias("records"))
