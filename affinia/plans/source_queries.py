"""Queries that write data derived from the tables to the shared folder and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators import filters as FL
from affinia.operators import vectors as VE
from affinia.plans import views as V
from affinia.plans.registry import query, rounded, stamp
from affinia.plans.text_queries import DOC_SQL, PG_LK, digest
from affinia.plans.vector_queries import DOT_SQL, EX_SQL, PAIRS_SQL, TOP_SQL, examples, products, scene_pairs, scenes, with_sql
from affinia.plans.views import sql
from affinia.session import scratch_path
from affinia.sources import io, rejects
from affinia.streaming.tables import append_to


@query("SRC-01_read_pages_xml", (
    "SELECT page_id AS id, url AS title, 'p' || page_id AS redirect_title, md5(html) AS text_md5, 'u' || page_id AS username FROM pages"))
def _(spark, sf):
    """The pages as a wiki XML dump, written by Spark and read back by row tag."""
    path = scratch_path(spark, "dump")
    revision = F.array(F.struct(
        F.col("page_id").alias("id"),
        F.struct(F.concat(F.lit("u"), F.col("page_id")).alias("username"), F.col("page_id").alias("id")).alias("contributor"),
        F.struct(F.base64(F.encode("html", "UTF-8")).alias("_VALUE"), F.length("html").cast("bigint").alias("_bytes")).alias("text"),
    ))
    V.table(spark, sf, "pages").select(
        F.col("url").alias("title"), F.lit(0).alias("ns"), F.col("page_id").alias("id"),
        F.struct(F.concat(F.lit("p"), F.col("page_id")).alias("_title")).alias("redirect"), revision.alias("revision"),
    ).write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").option("compression", "bzip2").save(path)
    back = io.read_pages_xml(spark, path)
    body = F.decode(F.unbase64(F.col("revision")[0]["text"]), "UTF-8")
    return back.select(
        "id", "title", "redirect_title", F.md5(body).alias("text_md5"),
        F.col("revision")[0]["contributor"]["username"].alias("username"),
    )


DOC_ROWS = PG_LK + DOC_SQL + " SELECT primary_t AS doc_primary, md5(array_to_string(tokens, ' ')) AS tokens_md5 FROM doc"


def _doc_rows(df: DataFrame) -> DataFrame:
    return df.select(F.col("primary").alias("doc_primary"), digest("tokens").alias("tokens_md5"))


@query("SRC-02_read_typed", DOC_ROWS)
def _(spark, sf):
    """Text documents written with some rows that hold nothing; those are dropped on reading."""
    path = scratch_path(spark, "docs")
    docs = V.wiki_docs(spark, sf)
    nothing = docs.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields])
    io.write_typed(docs.unionByName(nothing), path)
    return _doc_rows(io.read_typed(spark, path, "text_document"))


@query("SRC-02_rejects", PG_LK + DOC_SQL + (
    ", n AS (SELECT count(*) AS n FROM doc) SELECT 'no field set' AS reason, 1 AS files, n AS records FROM n "
    "UNION ALL SELECT 'unreadable file', 1, NULL FROM n UNION ALL SELECT 'read', NULL, n FROM n"))
def _(spark, sf):
    """Documents, as many rows that hold nothing in a file of their own, and a file that is no Parquet."""
    path = scratch_path(spark, "docs")
    docs = V.wiki_docs(spark, sf)
    io.write_typed(docs, f"{path}/good")
    docs.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields]).coalesce(1).write.parquet(f"{path}/nothing")
    V.table(spark, sf, "nation").select("n_name").coalesce(1).write.text(f"{path}/broken")
    checked = rejects.checked_typed(spark, [f"{path}/{part}" for part in ("good", "nothing", "broken")], "text_document")
    read = checked.rows.agg(F.count("*").alias("records")).select(F.lit("read").alias("reason"), F.lit(None).cast("bigint").alias("files"), "records")
    return rejects.summary(checked.rejects).unionByName(read)


@query("SRC-03_write_typed", DOC_ROWS)
def _(spark, sf):
    path = scratch_path(spark, "docs")
    io.write_typed(V.wiki_docs(spark, sf), path, parts=2)
    return _doc_rows(spark.read.parquet(path))


@query("SRC-04_read_playlists", sql("pls", (
    "SELECT track_uri, album_uri, artist_uri, count(*) AS n, CAST(sum(pos) AS BIGINT) AS positions, CAST(sum(num_tracks) AS BIGINT) AS lengths FROM pls GROUP BY 1, 2, 3")))
def _(spark, sf):
    """Playlist files of at most 1,000 playlists each, as the source data comes."""
    path = scratch_path(spark, "playlists")
    tracks = V.playlist_uris(spark, sf).withColumn("slice", F.floor(F.col("pl") / 1000))
    entry = F.struct("pos", F.struct("track_uri", "artist_uri", "album_uri").alias("t"))
    lists = tracks.groupBy("slice", "pl", "num_tracks").agg(F.array_sort(F.collect_list(entry)).alias("_t"))
    lists = lists.select("slice", F.struct("num_tracks", F.col("_t.t").alias("tracks")).alias("p"))
    files = lists.groupBy("slice").agg(F.collect_list("p").alias("playlists"))
    files.repartition("slice").write.partitionBy("slice").json(path)
    rows = io.read_playlists(spark, f"{path}/*/*.json")
    return rows.groupBy("track_uri", "album_uri", "artist_uri").agg(
        F.count("*").alias("n"), F.sum("pos").alias("positions"), F.sum("num_tracks").alias("lengths")
    )


EXAMPLE_ROWS = (
    "SELECT pl, string_agg(track_idx, ' ' ORDER BY pos) FILTER (WHERE pos < 5) AS track_context, string_agg(track_idx, ' ' ORDER BY pos) FILTER (WHERE pos >= 5) AS next_track FROM ex "
)


def _written_examples(spark, sf) -> str:
    path = scratch_path(spark, "examples")
    io.write_examples(examples(spark, sf).withColumnRenamed("file", "slice"), path)
    return path


def _example_rows(df: DataFrame) -> DataFrame:
    return df.select("pl", F.array_join("track_context", " ").alias("track_context"), F.array_join("next_track", " ").alias("next_track"))


@query("SRC-05_write_examples", with_sql("pls", EX_SQL) + EXAMPLE_ROWS + "GROUP BY pl")
def _(spark, sf):
    return _example_rows(spark.read.parquet(_written_examples(spark, sf)))


@query("SRC-06_read_examples", with_sql("pls", EX_SQL) + EXAMPLE_ROWS + "WHERE file BETWEEN 0 AND 8 GROUP BY pl")
def _(spark, sf):
    """Only the folders of the training slices are listed and read."""
    return _example_rows(io.read_examples(spark, _written_examples(spark, sf), "^[0-8]$"))


@query("SRC-07_read_scene_product", with_sql("views", PAIRS_SQL) + "SELECT scene, product, 4 AS corners FROM sp")
def _(spark, sf):
    path = scratch_path(spark, "pairs")
    box = F.array(*[F.lit(x) for x in (0.1, 0.2, 0.7, 0.9)])
    scene_pairs(spark, sf).withColumn("bbox", box).write.json(path)
    return io.read_scene_product(spark, path).select("scene", "product", F.size("bbox").alias("corners"))


@query("SRC-07_rejects", with_sql("views", PAIRS_SQL) + (
    "SELECT reason, count(*) AS records FROM (SELECT CASE WHEN no % 5 = 0 THEN 'malformed' WHEN no % 7 = 0 THEN 'no product' "
    "WHEN no % 11 = 0 THEN 'malformed' ELSE 'read' END AS reason FROM (SELECT CAST('0x' || scene[1:6] AS BIGINT) AS no FROM sp)) GROUP BY 1"))
def _(spark, sf):
    """Pairs as lines, some cut off, some without a product and some with a box that is none."""
    path = scratch_path(spark, "pairs")
    box = F.array(*[F.lit(x) for x in (0.1, 0.2, 0.7, 0.9)])
    no = F.conv(F.substring("scene", 1, 6), 16, 10).cast("bigint")
    pairs = scene_pairs(spark, sf).withColumn("product", F.when((no % 7 != 0) | (no % 5 == 0), F.col("product")))
    line = F.to_json(F.struct("scene", "product", box.alias("bbox")))
    strange = F.to_json(F.struct("scene", "product", F.lit("wide").alias("bbox")))
    written = F.when(no % 5 == 0, F.substring(line, 1, 9)).when((no % 7 != 0) & (no % 11 == 0), strange).otherwise(line)
    pairs.select(written.alias("value")).write.text(path)
    checked = rejects.checked_scene_product(spark, path)
    read = checked.rows.agg(F.count("*").alias("records")).select(F.lit("read").alias("reason"), "records")
    return rejects.summary(checked.rejects).select("reason", "records").unionByName(read)


def _key_values(spark, sf) -> DataFrame:
    return V.items(spark, sf).select(F.md5(F.col("item").cast("string")).alias("key"), F.col("category").alias("value"))


KV_SQL = sql("items", "SELECT md5(CAST(item AS VARCHAR)) AS key, category AS value FROM items")


@query("SRC-08_read_key_value", KV_SQL)
def _(spark, sf):
    path = scratch_path(spark, "catalogue")
    _key_values(spark, sf).write.parquet(path)
    return io.read_key_value(spark, path, "string")


@query("SRC-08_read_key_value_lines", KV_SQL)
def _(spark, sf):
    path = scratch_path(spark, "catalogue")
    _key_values(spark, sf).write.json(path)
    return io.read_key_value(spark, path, "string", "lines")


@query("SRC-08_read_key_value_object", KV_SQL)
def _(spark, sf):
    """Files that are one JSON object each, of about 500 keys."""
    path = scratch_path(spark, "catalogue")
    rows = _key_values(spark, sf)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(max(1, rows.count() // 500))))
    entries = F.map_from_entries(F.collect_list(F.struct("key", "value")))
    rows.groupBy("part").agg(F.to_json(entries).alias("value")).repartition("part").write.partitionBy("part").text(path)
    return io.read_key_value(spark, f"{path}/*/*.txt", "string", "object")


@query("SRC-09_read_stopwords", sql("docs", (
    "SELECT DISTINCT unnest(tokens) AS word FROM docs")))
def _(spark, sf):
    """One word per line, many of them repeated. Lines end with a newline only, as words may
    hold a carriage return."""
    path = scratch_path(spark, "words")
    V.docs(spark, sf).select(F.explode("tokens").alias("value")).write.option("lineSep", "\n").text(path)
    return io.read_stopwords(spark, path)


def _image_files(spark, sf) -> str:
    """One file per brand; the odd brands' files are empty."""
    path = scratch_path(spark, "files")
    rows = V.items(spark, sf).select("brand", F.col("category").alias("value")).where(
        F.regexp_extract("brand", r"(\d+)", 1).cast("int") % 2 == 0
    )
    rows.repartition("brand").write.partitionBy("brand").text(path)
    return path


@query("SRC-10_list_valid_files", "SELECT DISTINCT p_brand AS brand FROM part WHERE CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) % 2 = 0")
def _(spark, sf):
    files = io.list_valid_files(spark, _image_files(spark, sf))
    return files.select(_brand_of("path").alias("brand")).distinct()


def _brand_of(path: str) -> F.Column:
    """The brand in a folder name, whose # is percent-encoded once or twice."""
    return F.concat(F.lit("Brand#"), F.regexp_extract(path, r"brand=Brand(?:%2523|%23|#)(\d+)/", 1).cast("int"))


@query("FLT-06_valid_pairs", sql("items", (
    "SELECT item, category, brand FROM items WHERE CAST(regexp_extract(brand, '(\\d+)', 1) AS INT) % 2 = 0")))
def _(spark, sf):
    """Pairs of an item's brand and category whose brand has a file that is not empty."""
    files = io.list_valid_files(spark, _image_files(spark, sf))
    brands = files.select(_brand_of("path").alias("key"))
    pairs = V.items(spark, sf).select("item", F.col("brand").alias("scene"), F.col("category").alias("product"))
    have = brands.unionByName(pairs.select(F.col("product").alias("key")))
    return FL.valid_pairs(pairs, have).select("item", F.col("product").alias("category"), F.col("scene").alias("brand"))


@query("SRC-12_write_recommendations", with_sql("vecs", DOT_SQL) + (
    "SELECT query, rk AS rank, round(s, 6) AS score, md5(CAST(item AS VARCHAR)) AS item, 'http://i.pinimg.com/400x/' || k[1:2] || '/' || k[3:4] || '/' || k[5:6] || '/' || k || '.jpg' AS url FROM "
    "(SELECT *, md5(CAST(item AS VARCHAR)) AS k, row_number() OVER (PARTITION BY query ORDER BY round(s, 9) DESC, item) AS rk FROM x) WHERE rk <= 5"))
def _(spark, sf):
    path = scratch_path(spark, "report")
    found = VE.knn(scenes(spark, sf), products(spark, sf), 5).withColumn("item", F.md5(F.col("item").cast("string")))
    io.write_recommendations(found, path)
    return spark.read.parquet(path).select("query", F.col("rank").cast("bigint").alias("rank"), rounded("score").alias("score"), "item", "url")


@query("SRC-16_write_popularity_table", sql("views", "SELECT item, count(*) AS times_chosen FROM views GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25"))
def _(spark, sf):
    path = scratch_path(spark, "popular")
    io.write_popularity_table(V.views(spark, sf), path, 25)
    return spark.read.parquet(path)


EVENT_SCHEMA = "event_id bigint, ts timestamp, user bigint, item bigint, event_type string, value double"


def event_files(spark, sf) -> str:
    """The events as a folder of files in time order."""
    path = scratch_path(spark, "events")
    rows = V.views(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartitionByRange(8, "ts").sortWithinPartitions("ts").write.parquet(path)
    return path


def event_stream(spark, sf, files_per_batch: int | None = None) -> DataFrame:
    return io.read_event_stream(spark, event_files(spark, sf), EVENT_SCHEMA, files_per_batch)


@query("SRC-14_read_event_stream", sql("views", (
    "SELECT event_id, u AS \"user\", item, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type FROM views")))
def _(spark, sf):
    out = scratch_path(spark, "copied")
    append_to(event_stream(spark, sf, 3), out, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user", "item", stamp("ts").alias("ts"), "event_type")
