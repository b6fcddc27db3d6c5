"""Tables that streams keep up to date, in versions.

A table is cut into a fixed number of buckets by the hash of some of its columns. A batch
writes a small part for each bucket it touches and then commits a manifest, which lists the
parts of every bucket, by renaming one file; a version exists with its manifest or not at
all. A bucket that has gathered several parts is compacted by the batch that touches it
next: its rows are merged into one part, and rows marked as deleted go. So what a reader
has to open is bounded by the number of buckets, however many batches there were.

Readers resolve a manifest once and read the parts that it names. Parts are only removed
once no kept version names them, so a reader may stay on a version while later ones come.
A batch that is run again after it was committed changes nothing; one that failed before
leaves parts that no version names, which a later commit removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

#: Buckets of a table, parts a bucket gathers before it is compacted, and versions whose parts are kept.
BUCKETS, PARTS, KEPT = 16, 4, 4
DELETED = "deleted"
#: The column that parts are cut by; no table may have one of this name.
SPOT = "table_bucket"

Merge = Callable[[DataFrame], DataFrame]


class Folder:
    """Small files of a shared folder, through the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.jvm = path.rstrip("/"), spark._jvm
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Writes beside the name and renames, so that the file is there whole or not at all."""
        part = self._at(f"_{uuid.uuid4().hex}.part")
        stream = self.fs.create(part)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.fs.mkdirs(self._at(name).getParent())
        self.fs.delete(self._at(name), False)
        if not self.fs.rename(part, self._at(name)):
            raise OSError(f"could not commit {name}")

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


@dataclass
class Version:
    number: int
    batch: int
    buckets: int
    #: Folder names of the parts, by bucket.
    parts: dict[int, list[str]] = field(default_factory=dict)
    #: What a batch has to know of all earlier ones, in a few numbers.
    meta: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"number": self.number, "batch": self.batch, "buckets": self.buckets, "parts": self.parts, "meta": self.meta})

    @staticmethod
    def of(text: str) -> Version:
        held = json.loads(text)
        return Version(held["number"], held["batch"], held["buckets"], {int(b): p for b, p in held["parts"].items()}, held["meta"])


class StateTable:
    """Rows merged by key, under ``path``.

    ``merge`` makes one row per key out of several, in any order and any grouping (latest
    row, sum, bitwise or). Rows with a true ``deleted`` column are left out when read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, bucket_by: list[str], merge: Merge,
                 buckets: int = BUCKETS, parts: int = PARTS, kept: int = KEPT):
        self.spark, self.path, self.bucket_by, self.merge = spark, path.rstrip("/"), bucket_by, merge
        self.schema = spark.createDataFrame([], schema).schema
        self.buckets, self.most_parts, self.kept = buckets, parts, kept
        self.folder = Folder(spark, path)

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self.folder.names("_versions") if n.startswith("v") and n.endswith(".json"))

    def version(self, number: int | None = None) -> Version | None:
        """The named version, or the latest."""
        numbers = self.versions()
        if not numbers:
            return None
        return Version.of(self.folder.read(f"_versions/v{numbers[-1] if number is None else number}.json"))

    def bucket(self, count: int | None = None):
        return F.pmod(F.xxhash64(*[F.col(c) for c in self.bucket_by]), F.lit(count or self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Which buckets the rows fall into; at most as many numbers as there are buckets."""
        count = (self.version() or Version(0, -1, self.buckets)).buckets
        return sorted(r[0] for r in rows.select(self.bucket(count).alias("b")).distinct().collect())

    def paths(self, version: Version, only: Iterable[int] | None = None) -> list[str]:
        wanted = version.parts if only is None else [b for b in only if b in version.parts]
        return [f"{self.path}/data/{part}/{SPOT}={b}" for b in sorted(wanted) for part in version.parts[b]]

    def raw(self, version: Version | None, only: Iterable[int] | None = None) -> DataFrame:
        """Rows as written, of the named buckets or of all."""
        paths = self.paths(version, only) if version else []
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, number: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """One row per key as of a version; the parts are fixed now, whatever is committed later."""
        version = self.version(number)
        rows = self.raw(version, only)
        if version and any(len(p) > 1 for b, p in version.parts.items() if only is None or b in only):
            # A part has one row per key, so buckets of one part need no merging.
            rows = self.merge(rows).select(*self.schema.names)
        return rows.where(~F.coalesce(DELETED, F.lit(False))) if DELETED in self.schema.names else rows

    def apply(self, delta: DataFrame, batch: int, meta: dict | None = None, merged: bool = False) -> Version:
        """Commits a batch's rows as the next version; a batch that is in already stays as it is.

        ``merged`` rows have one row per key already.
        """
        now = self.version() or Version(0, -1, self.buckets)
        if now.batch >= batch:
            return now
        rows = delta.select(*self.schema.names) if merged else self.merge(delta.select(*self.schema.names)).select(*self.schema.names)
        rows = rows.withColumn(SPOT, self.bucket(now.buckets))
        parts = {b: list(p) for b, p in now.parts.items()}
        if all(len(p) < self.most_parts for p in parts.values()):
            # No bucket is to be compacted, so the rows are written as they come and not held before.
            name = f"{batch}-{uuid.uuid4().hex}"
            self._write(rows, name)
            for b in self._written(name):
                parts.setdefault(b, []).append(name)
        else:
            parts = self._merged(now, rows.persist(), batch)
        after = Version(now.number + 1, batch, now.buckets, {b: p for b, p in parts.items() if p}, meta if meta is not None else now.meta)
        self.folder.put(f"_versions/v{after.number}.json", after.text())
        self._clean(after)
        return after

    def _merged(self, now: Version, rows: DataFrame, batch: int) -> dict[int, list[str]]:
        """The parts after a batch of persisted rows; full buckets among those it touches are compacted."""
        try:
            touched = sorted(r[0] for r in rows.select(SPOT).distinct().collect())
            full = [b for b in touched if len(now.parts.get(b, [])) >= self.most_parts]
            parts = {b: list(p) for b, p in now.parts.items()}
            if touched:
                name = f"{batch}-{uuid.uuid4().hex}"
                fresh = rows.where(~F.col(SPOT).isin(full)) if full else rows
                if len(full) < len(touched):
                    self._write(fresh, name)
                    for b in touched:
                        if b not in full:
                            parts.setdefault(b, []).append(name)
            if full:
                name = f"{batch}-{uuid.uuid4().hex}"
                both = self.raw(now, full).unionByName(rows.where(F.col(SPOT).isin(full)).drop(SPOT))
                merged = self.merge(both).select(*self.schema.names)
                if DELETED in self.schema.names:
                    merged = merged.where(~F.coalesce(DELETED, F.lit(False)))
                self._write(merged.withColumn(SPOT, self.bucket(now.buckets)), name)
                written = self._written(name)
                for b in full:
                    parts[b] = [name] if b in written else []
        finally:
            rows.unpersist()
        return parts

    def _written(self, name: str) -> list[int]:
        """The buckets that a part has rows of."""
        return sorted(int(n.split("=")[1]) for n in self.folder.names(f"data/{name}") if n.startswith(f"{SPOT}="))

    def _write(self, rows: DataFrame, name: str) -> None:
        # One file per bucket, so that a reader opens as many files as the manifest names.
        rows.repartition(SPOT).write.partitionBy(SPOT).parquet(f"{self.path}/data/{name}")

    def _clean(self, after: Version) -> None:
        """Drops versions beyond those kept, and parts that no kept version names."""
        numbers = self.versions()
        kept = [Version.of(self.folder.read(f"_versions/v{n}.json")) for n in numbers[-self.kept:]]
        named = {p for v in kept for parts in v.parts.values() for p in parts}
        for n in numbers[:-self.kept]:
            self.folder.remove(f"_versions/v{n}.json")
        for name in self.folder.names("data"):
            if name not in named and int(name.split("-")[0]) <= after.batch:
                self.folder.remove(f"data/{name}")


def read_parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a table's latest version, not merged; empty where nothing was written yet."""
    table = StateTable(spark, path, schema, [], lambda rows: rows)
    return table.raw(table.version())


def latest_by(key: list[str], ts: str) -> Merge:
    return lambda rows: latest_rows(rows, key, ts)


def sum_by(key: list[str], *columns: str) -> Merge:
    return lambda rows: rows.groupBy(*key).agg(*[F.sum(c).alias(c) for c in columns])


def latest_rows(parts: DataFrame, key: list[str], ts: str) -> DataFrame:
    """The latest row per key of a log of rows."""
    others = [c for c in parts.columns if c not in (*key, ts)]
    last = parts.groupBy(*key).agg(F.max(F.struct(ts, *others)).alias("_l"))
    return last.select(*key, "_l.*")


def each_batch(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None],
               available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Start ``step`` on every micro-batch, over what is there now or at an interval."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def append_to(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True,
              interval: str = "1 minute") -> StreamingQuery:
    """Append finished rows of a stream to a parquet folder."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
