"""The test tables as the operators' inputs, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.functions import text
from affinia.functions.keys import json_field
from affinia.operators.documents import text_document
from affinia.operators.indexing import dense_index
from affinia.operators.sizes import spread

HREF = 'href="([^"]*)"'
ANCHOR = '<a href="([^"]*)">([^<]*)</a>'


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark, sf) -> DataFrame:
    texts = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return texts.select("doc_id", text.simple_tokenize(F.col("text")).alias("tokens"))


def pages(spark, sf) -> DataFrame:
    """Web pages as wiki pages: anchors become [[target|shown]] links, some titles get a
    reserved prefix, some pages a redirect or no revision."""
    body = F.regexp_replace("html", ANCHOR, "[[$1|$2]]")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    named = F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("User:"), title)).otherwise(title)
    revision = F.struct(
        F.col("page_id").alias("id"), F.lit(None).cast("bigint").alias("parentid"),
        F.lit(None).cast("string").alias("timestamp"),
        F.lit(None).cast("struct<username:string,id:bigint,ip:string>").alias("contributor"),
        F.lit(False).alias("minor"), F.lit(None).cast("string").alias("model"),
        F.lit(None).cast("string").alias("format"), F.lit(None).cast("string").alias("sha1"), body.alias("text"),
    )
    return table(spark, sf, "pages").select(
        named.alias("title"), F.lit(0).cast("bigint").alias("ns"), F.col("page_id").alias("id"),
        F.when(F.col("page_id") % 11 == 0, F.lit("elsewhere")).alias("redirect_title"),
        F.when(F.col("page_id") % 13 != 0, F.array(revision)).otherwise(F.array().cast(
            "array<struct<id:bigint,parentid:bigint,timestamp:string,contributor:struct<username:string,id:bigint,"
            "ip:string>,minor:boolean,model:string,format:string,sha1:string,text:string>>"
        )).alias("revision"),
    )


def links(spark, sf) -> DataFrame:
    """(url, primary, secondary): a page and the targets of its links."""
    return table(spark, sf, "pages").select(
        "url", F.col("url").alias("primary"),
        F.array_distinct(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("secondary"),
    )


def wiki_docs(spark, sf) -> DataFrame:
    return text_document(pages(spark, sf))


def views(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("user"), json_field(F.col("props"), "$.k").cast("bigint").alias("item"),
        "ts", "event_type", "value",
    )


def users(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"), F.col("n_regionkey").alias("region")
    )
    return table(spark, sf, "customer").join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("user"), "country", "region", (F.col("c_acctbal") >= 0).alias("adult"),
        F.col("c_mktsegment").alias("segment"),
    )


def ratings(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user"))
    return table(spark, sf, "lineitem").join(orders, "l_orderkey").select(
        "user", F.col("l_partkey").alias("item"), F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
        F.col("l_shipdate").alias("ts"),
    )


def items(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"), (F.col("p_size") % 10 != 0).alias("active"), F.col("p_size").alias("size"),
    )


def playlist_uris(spark, sf) -> DataFrame:
    """(file, pl, pos, num_tracks, track_uri, album_uri, artist_uri): one playlist per customer
    in order of date and line, as if read from one file per ten playlists' last digit."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("pl"), "o_orderdate")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    rows = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, "l_partkey")
    ordered = rows.orderBy(*[F.asc(c) for c in (
        "pl", "o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        "l_extendedprice")])
    # Only what the playlists are made of is kept of the sorted rows, which are numbered as they lie.
    numbered = dense_index(ordered.select("pl", "l_partkey", "l_suppkey", "p_brand", "p_type"), name="_at")
    counts = numbered.groupBy("pl").agg(F.min("_at").alias("_first"), F.count("*").alias("num_tracks"))
    placed = numbered.join(counts, "pl").withColumn("pos", F.col("_at") - F.col("_first"))
    return placed.select(
        (F.col("pl") % 10).alias("file"), "pl", "pos", "num_tracks",
        F.concat(F.lit("track:"), F.col("l_partkey")).alias("track_uri"),
        F.concat(F.lit("album:"), F.col("p_brand"), F.lit(" "), F.col("p_type")).alias("album_uri"),
        F.concat(F.lit("artist:"), F.col("l_suppkey")).alias("artist_uri"),
    )


def playlists(spark, sf) -> DataFrame:
    """Playlist rows with plain numbers: track = part, album = brand and type, artist = supplier."""
    return playlist_uris(spark, sf).select(
        "file", "pl", "pos", "num_tracks",
        F.substring_index("track_uri", ":", -1).cast("bigint").alias("track_idx"),
        F.substring_index("artist_uri", ":", -1).cast("bigint").alias("artist_idx"),
        (F.regexp_extract("album_uri", r"#(\d+)", 1).cast("bigint") * 10 + F.length("album_uri")).alias("album_idx"),
    )


def vecs(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


def scored(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        "doc_id", F.least(F.lit(1.0), F.col("n_chars") / 5000.0).alias("score"), F.col("quality").alias("label"),
        "lang", "source",
    )


def log(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("corr_id"), F.col("turn").alias("stage"), "role", "text"
    )


# DuckDB spellings of the views above.
SQL = {
    "docs": (
        "docs AS (SELECT doc_id, list_transform(list_filter(string_split_regex(text, "
        "'" + text.SEPARATORS.replace("'", "''") + "'), lambda x: length(x) > 0), lambda x: lower(x)) AS tokens FROM documents)"
    ),
    "terms": (
        "occ AS (SELECT doc_id, unnest(tokens) AS token FROM docs), "
        "terms AS (SELECT token, count(*) AS frequency, count(DISTINCT doc_id) AS doc_frequency FROM occ GROUP BY token)"
    ),
    "dict": (
        "dict AS (SELECT token, frequency, doc_frequency, row_number() OVER (ORDER BY frequency DESC, token) - 1 AS idx "
        "FROM terms WHERE frequency >= 20)"
    ),
    "pg": (
        "pg AS (SELECT page_id AS id, CASE WHEN page_id % 7 = 0 THEN 'User:' ELSE '' END || "
        "regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, page_id % 11 = 0 AS redirect, "
        "page_id % 13 = 0 AS empty, regexp_replace(html, '" + ANCHOR + r"', '[[\1|\2]]', 'g') AS body FROM pages)"
    ),
    "links": (
        "links AS (SELECT url, url AS primary_t, list_distinct(regexp_extract_all(html, '" + HREF + "', 1)) AS secondary FROM pages)"
    ),
    "tstats": (
        "tocc AS (SELECT url AS d, primary_t AS token FROM links UNION ALL SELECT url, unnest(secondary) FROM links), "
        "tstats AS (SELECT token, count(*) AS frequency, count(DISTINCT d) AS doc_frequency FROM tocc GROUP BY token)"
    ),
    "tdict": (
        "tdict AS (SELECT token, frequency, doc_frequency, row_number() OVER (ORDER BY frequency DESC, token) - 1 AS idx FROM tstats)"
    ),
    "tpairs": (
        "mem AS (SELECT DISTINCT t.d, k.idx FROM tocc t JOIN tdict k USING (token)), "
        "tpairs AS (SELECT a.idx AS i, b.idx AS j, count(*) AS n FROM mem a JOIN mem b ON a.d = b.d AND a.idx < b.idx GROUP BY 1, 2)"
    ),
    "views": (
        "views AS (SELECT event_id, user_id AS u, CAST(json_extract(props, '$.k') AS BIGINT) AS item, ts, event_type, value FROM events)"
    ),
    "users": (
        "users AS (SELECT c_custkey AS u, n_name AS country, n_regionkey AS region, c_acctbal >= 0 AS adult, c_mktsegment AS segment "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey)"
    ),
    "ratings": (
        "ratings AS (SELECT o_custkey AS u, l_partkey AS item, CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating, l_shipdate AS ts "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
    ),
    "latest": (
        "latest AS (SELECT u, item, rating, ts FROM (SELECT *, row_number() OVER (PARTITION BY u, item ORDER BY ts DESC, rating DESC) AS rn "
        "FROM ratings) WHERE rn = 1)"
    ),
    "dev": "dev AS (SELECT *, rating - avg(rating) OVER (PARTITION BY u) AS d FROM latest)",
    "sums": (
        "sums AS (SELECT a.u AS l, b.u AS r, count(*) AS n, sum(a.d * b.d) AS sxy, sum(a.d * a.d) AS sxx, sum(b.d * b.d) AS syy "
        "FROM dev a JOIN dev b ON a.item = b.item AND a.u < b.u GROUP BY 1, 2)"
    ),
    "sim": (
        "sim AS (SELECT l, r, n, CASE WHEN sqrt(sxx) * sqrt(syy) > 0 THEN sxy / (sqrt(sxx) * sqrt(syy)) END AS s FROM sums)"
    ),
    "near": (
        "near AS (SELECT e, nb, s, rk FROM (SELECT e, nb, s, row_number() OVER (PARTITION BY e ORDER BY s DESC, nb) AS rk FROM "
        "(SELECT l AS e, r AS nb, s FROM sim UNION ALL SELECT r, l, s FROM sim) WHERE s IS NOT NULL) WHERE rk <= 5)"
    ),
    "items": (
        "items AS (SELECT p_partkey AS item, p_type AS category, p_brand AS brand, p_retailprice AS price, p_size % 10 <> 0 AS active, "
        "p_size AS size FROM part)"
    ),
    "pls": (
        "pls AS (SELECT o_custkey % 10 AS file, o_custkey AS pl, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, l_orderkey, "
        "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) - 1 AS pos, "
        "count(*) OVER (PARTITION BY o_custkey) AS num_tracks, l_partkey AS track_idx, l_suppkey AS artist_idx, "
        "CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS BIGINT) * 10 + length('album:' || p_brand || ' ' || p_type) AS album_idx, "
        "'track:' || l_partkey AS track_uri, 'album:' || p_brand || ' ' || p_type AS album_uri, 'artist:' || l_suppkey AS artist_uri "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey)"
    ),
    "vecs": "vecs AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)",
    "scored": (
        "scored AS (SELECT doc_id, least(1.0::DOUBLE, n_chars / 5000.0::DOUBLE) AS score, quality AS label, lang, source "
        "FROM labels JOIN documents USING (doc_id))"
    ),
}
# What each view is built on.
NEEDS = {
    "terms": ["docs"], "dict": ["terms"], "tstats": ["links"], "tdict": ["tstats"], "tpairs": ["tdict"],
    "latest": ["ratings"], "dev": ["latest"], "sums": ["dev"], "sim": ["sums"], "near": ["sim"],
}


def sql(names: str, body: str) -> str:
    """``body`` under the named views and all they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ", ".join(SQL[name] for name in order) + " " + body
