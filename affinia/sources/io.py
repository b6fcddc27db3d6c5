"""Readers and writers of pages, records, playlists, pairs, tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia import schemas
from affinia.functions.keys import image_key_to_url


def read_pages_xml(spark: SparkSession, path: str) -> DataFrame:
    """Page rows of a wiki XML dump, plain or compressed; pages are split by their row tag."""
    raw = spark.read.format("xml").option("rowTag", "page").schema(schemas.PAGE_XML).load(path)
    revision = F.transform("revision", lambda r: F.struct(
        r["id"].alias("id"), r["parentid"].alias("parentid"), r["timestamp"].alias("timestamp"),
        r["contributor"].alias("contributor"), r["minor"].isNotNull().alias("minor"),
        r["model"].alias("model"), r["format"].alias("format"), r["sha1"].alias("sha1"),
        r["text"]["_VALUE"].alias("text"),
    ))
    return raw.select(
        "title", "ns", "id", F.col("redirect._title").alias("redirect_title"), revision.alias("revision")
    )


def read_typed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Records of one kind under its fixed schema; unreadable files and null rows are dropped."""
    schema = schemas.RECORD_KINDS[kind]
    df = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path)
    return drop_null_records(df)


def drop_null_records(df: DataFrame) -> DataFrame:
    """Rows where at least one field is set."""
    return df.dropna(how="all")


def write_typed(df: DataFrame, path: str, parts: int | None = None, codec: str = "zstd") -> None:
    out = df if parts is None else df.coalesce(parts)
    out.write.mode("errorifexists").option("compression", codec).parquet(path)


def read_playlists(spark: SparkSession, path: str) -> DataFrame:
    """(file, pl, num_tracks, pos, track_uri, artist_uri, album_uri) of playlist JSON files."""
    raw = spark.read.schema(schemas.PLAYLIST_FILE).option("multiLine", "true").json(path)
    lists = raw.select(F.col("_metadata.file_path").alias("file"), F.posexplode("playlists").alias("pl", "_p"))
    tracks = lists.select(
        "file", "pl", F.col("_p.num_tracks").alias("num_tracks"), F.posexplode("_p.tracks").alias("pos", "_t")
    )
    return tracks.select("file", "pl", "num_tracks", "pos", "_t.track_uri", "_t.artist_uri", "_t.album_uri")


def write_examples(examples: DataFrame, path: str, slice_by: str = "slice") -> None:
    """Example rows, one folder per input slice; rows are sent to their slice's writer first."""
    examples.repartition(slice_by).write.mode("errorifexists").partitionBy(slice_by).parquet(path)


def read_examples(spark: SparkSession, path: str, slices: str | None = None) -> DataFrame:
    """Example rows; ``slices`` is a regular expression on the slice that prunes folders."""
    df = spark.read.parquet(path)
    return df if slices is None else df.where(F.col("slice").cast("string").rlike(slices))


def read_scene_product(spark: SparkSession, path: str) -> DataFrame:
    """(product, scene, bbox) of JSON lines."""
    return spark.read.schema(schemas.SCENE_PRODUCT).option("mode", "DROPMALFORMED").json(path)


def read_key_value(spark: SparkSession, path: str, value_type: str, form: str = "parquet") -> DataFrame:
    """(key, value) rows of a catalogue, dictionary, track store or vector table.

    ``parquet`` and ``lines`` (one JSON object {key, value} per line) split over tasks;
    ``object`` imports a file that is a single JSON object, one task per file.
    """
    if form == "parquet":
        return spark.read.schema(f"key string, value {value_type}").parquet(path)
    if form == "lines":
        return spark.read.schema(f"key string, value {value_type}").json(path)
    whole = spark.read.option("wholetext", "true").text(path)
    parsed = F.from_json("value", f"map<string,{value_type}>")
    return whole.select(F.explode(parsed).alias("key", "value"))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """(word): the distinct non-empty lines."""
    return spark.read.text(path).where(F.length("value") > 0).select(F.col("value").alias("word")).distinct()


def list_valid_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of files that hold something; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length").where(F.col("length") > 0)


def recommendation_rows(recs: DataFrame, query: str = "query", item: str = "item") -> DataFrame:
    """(query, rank, score, item, url): ranked rows with the image url of the item."""
    return recs.select(query, "rank", "score", item, image_key_to_url(F.col(item)).alias("url"))


def write_recommendations(recs: DataFrame, path: str) -> None:
    """Ranked rows, sorted by query within each file for lookups by range."""
    recommendation_rows(recs).repartitionByRange("query").sortWithinPartitions("query", "rank").write.mode(
        "errorifexists"
    ).parquet(path)


def read_event_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming rows of the parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def snapshot_as_of(log: DataFrame, keys: list[str], ts: str, day: str) -> DataFrame:
    """State of a table at the end of a day: the last record per key; ties take the largest row."""
    end = F.date_add(F.lit(day).cast("date"), 1).cast(log.schema[ts].dataType)
    others = [c for c in log.columns if c not in (*keys, ts)]
    last = log.where(F.col(ts) < end).groupBy(*keys).agg(F.max(F.struct(ts, *others)).alias("_l"))
    return last.select(*keys, "_l.*")


def snapshot_delta(log: DataFrame, ts: str, day: str) -> DataFrame:
    """Records added on a day; a plain range, so it reaches the scan."""
    kind, start = log.schema[ts].dataType, F.lit(day).cast("date")
    return log.where((F.col(ts) >= start.cast(kind)) & (F.col(ts) < F.date_add(start, 1).cast(kind)))


def write_popularity_table(events: DataFrame, path: str, n: int | None = None) -> None:
    """(item, times_chosen), all or only the top n."""
    counts = events.groupBy("item").agg(F.count("*").alias("times_chosen"))
    if n is not None:
        counts = counts.orderBy(F.desc("times_chosen"), F.asc("item")).limit(n)
    counts.write.mode("errorifexists").parquet(path)


def scan_tables_sql(spark: SparkSession, tables: dict[str, DataFrame], sql: str) -> DataFrame:
    """A SQL query over named tables."""
    return spark.sql(sql, **tables)
