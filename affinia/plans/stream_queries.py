"""Streaming queries over the events as a folder of files, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators import layered_bloom as LB
from affinia.operators import evaluate as E
from affinia.operators import similarity as S
from affinia.plans import views as V
from affinia.plans.interaction_queries import latest
from affinia.plans.registry import query, rounded, stamp
from affinia.plans.source_queries import event_stream
from affinia.plans.vector_queries import RATE
from affinia.plans.views import sql
from affinia.session import scratch_path
from affinia.sources import io
from affinia.streaming import operators as ST
from affinia.streaming.tables import append_to

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def finished(spark, stream: DataFrame) -> DataFrame:
    """Rows a stream has finished by the end of the input."""
    out = scratch_path(spark, "stream")
    append_to(stream, out, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query("STR-01_stream_popularity", sql("views", (
    "SELECT " + STAMP.format("s") + " AS \"start\", item, n AS times_chosen FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS s, item, count(*) AS n FROM views GROUP BY 1, 2) "
    "WHERE s + INTERVAL 1 DAY <= (SELECT max(ts) FROM views) - INTERVAL 1 HOUR")))
def _(spark, sf):
    """Daily windows that the watermark has passed."""
    rows = finished(spark, ST.stream_popularity(event_stream(spark, sf), "1 day"))
    return rows.select(stamp("start").alias("start"), "item", "times_chosen")


@query("STR-01_stream_trending", sql("views", (
    ", h AS (SELECT time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR AS s, item FROM views UNION ALL SELECT time_bucket(INTERVAL 12 HOUR, ts), item FROM views) "
    "SELECT " + STAMP.format("s") + " AS \"start\", item, count(*) AS times_chosen FROM h WHERE s + INTERVAL 24 HOUR <= (SELECT max(ts) FROM views) - INTERVAL 1 HOUR GROUP BY s, item")).replace(") ,", "),", 1))
def _(spark, sf):
    """Sliding windows of a day, every twelve hours."""
    rows = finished(spark, ST.stream_popularity(event_stream(spark, sf), "24 hours", "12 hours"))
    return rows.select(stamp("start").alias("start"), "item", "times_chosen")


@query("STR-02_stream_feature_upsert", sql("views", (
    "SELECT u AS \"user\", event_id, item, event_type, " + STAMP.format("ts") + " AS ts FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY ts DESC, event_id DESC) AS rn FROM views) WHERE rn = 1")))
def _(spark, sf):
    out = scratch_path(spark, "online")
    stream = event_stream(spark, sf, 3).select("user", "ts", "event_id", "item", "event_type")
    ST.stream_feature_upsert(stream, out, scratch_path(spark, "offsets"), "user").awaitTermination()
    return ST.feature_table(spark, out, stream.schema, "user").read().select("user", "event_id", "item", "event_type", stamp("ts").alias("ts"))


@query("STR-03_stream_hourly_metrics", sql("views", (
    "SELECT " + STAMP.format("h") + " AS hour, event_type, count(*) AS events, round(sum(value), 6) AS value FROM (SELECT *, date_trunc('hour', ts) AS h FROM views) "
    "WHERE h + INTERVAL 1 HOUR <= (SELECT max(ts) FROM views) - INTERVAL 10 MINUTE GROUP BY h, event_type")))
def _(spark, sf):
    rows = finished(spark, ST.stream_hourly_metrics(event_stream(spark, sf)))
    return rows.select(stamp("hour").alias("hour"), "event_type", "events", rounded("value").alias("value"))


@query("STR-04_stream_sessions", sql("views", (
    ", g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS nw FROM views WINDOW w AS (PARTITION BY u ORDER BY ts)), "
    "s AS (SELECT *, sum(nw) OVER (PARTITION BY u ORDER BY ts) AS n FROM g) "
    ", b AS (SELECT u, n, min(ts) AS t0, count(*) AS clicks FROM s GROUP BY u, n HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM views) - INTERVAL 1 HOUR) "
    "SELECT event_id, u AS \"user\", " + STAMP.format("t0") + " AS \"start\", clicks, row_number() OVER (PARTITION BY u, n ORDER BY ts, event_id) AS step FROM s JOIN b USING (u, n)")).replace(") ,", "),", 1))
def _(spark, sf):
    """Finished sessions of the stream, with their clicks in order from the event table."""
    sessions = finished(spark, ST.stream_sessions(event_stream(spark, sf), "6 hours"))
    events = V.views(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = ST.session_clicks(events, sessions).join(sessions.select("user", "start", "clicks"), ["user", "start"])
    return rows.select("event_id", "user", stamp("start").alias("start"), "clicks", "step")


@query("STR-05_speed_layer_similarity", sql("latest", (
    ", om AS (SELECT u, avg(rating) AS m FROM latest WHERE ts < TIMESTAMP '2000-06-01' GROUP BY 1), nm AS (SELECT u, avg(rating) AS m FROM latest WHERE ts >= TIMESTAMP '2000-06-01' GROUP BY 1), "
    "hd AS (SELECT x.u, x.item, x.rating - coalesce(om.m, nm.m) AS d FROM latest x LEFT JOIN om USING (u) LEFT JOIN nm USING (u)) "
    'SELECT a.u AS "left", b.u AS "right", count(*) AS n, round(sum(a.d * b.d), 9) AS sxy FROM hd a JOIN hd b ON a.item = b.item AND a.u < b.u GROUP BY 1, 2')).replace(") ,", "),", 1))
def _(spark, sf):
    """The sums of the last build plus those of the stream equal the sums of everything."""
    rows = latest(spark, sf)
    day = F.lit("2000-06-01").cast(rows.schema["ts"].dataType)
    old, new = rows.where(F.col("ts") < day), rows.where(F.col("ts") >= day)
    source = scratch_path(spark, "ratings")
    new.withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(4, "ts", "user", "item").write.parquet(source)
    stream = io.read_event_stream(spark, source, "user bigint, item bigint, rating double, ts timestamp")
    out = scratch_path(spark, "speed")
    means = old.groupBy("user").agg(F.avg("rating").alias("mean"))
    ST.speed_layer_similarity(stream, old, means, out, scratch_path(spark, "offsets")).awaitTermination()
    delta = ST.SpeedLayer(spark, out).sums.read()
    total = S.add_sums(S.similarity_sums(old), delta)
    return total.select("left", "right", F.col("n").cast("bigint").alias("n"), rounded("sxy", 9).alias("sxy"))


@query("STR-06_stream_bloom_add", sql("views", (
    "SELECT u * 1000 + item AS key, bool_or(event_type = 'purchase') AS maybe FROM views GROUP BY 1")))
def _(spark, sf):
    """Every key that went by in the stream is found, and no other."""
    keys = event_stream(spark, sf, 3).where(F.col("event_type") == "purchase").select(
        (F.col("user") * 1000 + F.col("item")).alias("key")
    )
    out = scratch_path(spark, "bloom")
    ST.stream_bloom_add(keys, out, scratch_path(spark, "offsets"), "key", RATE).awaitTermination()
    asked = V.views(spark, sf).select((F.col("user") * 1000 + F.col("item")).alias("key"))
    return LB.contains(ST.merged_bloom(spark, out, RATE), asked, "key")


# A view without an outcome is final once the watermark of both sides is past its two days.
OUTCOME_SQL = (
    ", w AS (SELECT least(max(ts) FILTER (WHERE event_type = 'view'), max(ts) FILTER (WHERE event_type = 'purchase')) - INTERVAL 1 HOUR AS w FROM views), "
    "m AS (SELECT p.event_id, p.ts, o.ts AS outcome FROM views p LEFT JOIN views o ON o.event_type = 'purchase' AND o.u = p.u AND o.item = p.item "
    "AND o.ts BETWEEN p.ts AND p.ts + INTERVAL 2 DAY WHERE p.event_type = 'view') "
)


@query("STR-07_stream_outcome_join", sql("views", "SELECT 0").replace(" SELECT 0", OUTCOME_SQL) + (
    "SELECT event_id, " + STAMP.format("outcome") + " AS outcome FROM m, w WHERE outcome IS NOT NULL OR ts + INTERVAL 2 DAY < w"))
def _(spark, sf):
    """Views with the purchases that followed within two days, and those that none followed."""
    events = event_stream(spark, sf)
    preds = events.where(F.col("event_type") == "view").select("event_id", "user", "item", "ts")
    outcomes = events.where(F.col("event_type") == "purchase").select("user", "item", "ts")
    rows = finished(spark, ST.stream_outcome_join(preds, outcomes, "2 days"))
    return rows.select("event_id", stamp("outcome_ts").alias("outcome"))


@query("STR-07_outcome_rates", sql("views", "SELECT 0").replace(" SELECT 0", OUTCOME_SQL) + (
    ", f AS (SELECT event_id, any_value(ts) AS ts, count(outcome) AS n FROM m, w WHERE outcome IS NOT NULL OR ts + INTERVAL 2 DAY < w GROUP BY 1) "
    "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS views, count(*) FILTER (WHERE n > 0) AS followed, CAST(sum(n) AS BIGINT) AS outcomes FROM f GROUP BY 1"))
def _(spark, sf):
    """Per day, how many settled views an outcome followed."""
    events = event_stream(spark, sf)
    preds = events.where(F.col("event_type") == "view").select("event_id", "user", "item", "ts")
    outcomes = events.where(F.col("event_type") == "purchase").select("user", "item", "ts")
    return ST.outcome_rates(finished(spark, ST.stream_outcome_join(preds, outcomes, "2 days")), "event_id")


@query("STR-08_stream_score_drift", sql("views", (
    ", o AS (SELECT CAST(greatest(0, least(9, floor(value / 10))) AS INT) AS b, count(*) AS o, count(*) FILTER (WHERE event_type = 'view') AS e FROM views GROUP BY 1), "
    "g AS (SELECT unnest(range(0, 10)) AS b), f AS (SELECT coalesce(o, 0) + 1 AS o, coalesce(e, 0) + 1 AS e FROM g LEFT JOIN o USING (b)), "
    "t AS (SELECT o / (SELECT sum(o) FROM f) AS p, e / (SELECT sum(e) FROM f) AS q FROM f) SELECT (SELECT count(*) FROM views) AS rows, round(sum(p * ln(p / q)), 6) AS kl FROM t")).replace(") ,", "),", 1))
def _(spark, sf):
    prior = E.binned(V.views(spark, sf).where(F.col("event_type") == "view"), "value", 0.0, 100.0, 10)
    out = scratch_path(spark, "drift")
    scored = event_stream(spark, sf).withColumnRenamed("value", "score")
    ST.stream_score_drift(scored, prior, out, scratch_path(spark, "offsets"), 0.0, 100.0, 10).awaitTermination()
    return ST.drift_table(spark, out).read().select("rows", rounded("kl").alias("kl"))


@query("STR-09_freshness_state", sql("views", (
    "SELECT u AS \"user\", item, count(*) FILTER (WHERE event_type = 'view') AS shown FROM views WHERE ts >= TIMESTAMP '2024-01-08' GROUP BY 1, 2 "
    "HAVING count(*) FILTER (WHERE event_type = 'view') >= 2 AND count(*) FILTER (WHERE event_type = 'click') = 0")))
def _(spark, sf):
    out = scratch_path(spark, "fresh")
    ST.freshness_state(event_stream(spark, sf, 3), out, scratch_path(spark, "offsets")).awaitTermination()
    return ST.stale_since(ST.freshness_table(spark, out).read(), 2, "2024-01-08")
