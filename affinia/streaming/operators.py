"""Streaming operators. Windowed ones are plain DataFrame transformations; the others keep
a table up to date and return the running query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from affinia.operators import layered_bloom as LB
from affinia.operators.evaluate import binned, kl_divergence
from affinia.operators.features import asof_join
from affinia.operators.indexing import place_in_group
from affinia.operators.pairs import SUMS
from affinia.operators.similarity import similarity_delta
from affinia.streaming.tables import BUCKETS, StateTable, Version, each_batch, latest_by, latest_rows, sum_by


def stream_popularity(events: DataFrame, window: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """(start, end, item, times_chosen) per tumbling or sliding window; rows later than the
    delay are dropped and a window is final once the watermark passes it."""
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    counts = events.withWatermark("ts", delay).groupBy(span.alias("w"), "item").agg(
        F.count("*").alias("times_chosen")
    )
    return counts.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "item", "times_chosen")


def stream_hourly_metrics(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """(hour, event_type, events, value): the hourly status table, row by row as hours close."""
    sums = events.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(
        F.count("*").alias("events"), F.sum("value").alias("value")
    )
    return sums.select(F.col("w.start").alias("hour"), "event_type", "events", "value")


def stream_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """(user, start, end, clicks): finished sessions and how many clicks they have.

    The state holds three values per open session, however many clicks it has; the
    clicks themselves are put in order by ``session_clicks``.
    """
    found = events.withWatermark("ts", delay).groupBy("user", F.session_window("ts", gap).alias("w")).agg(
        F.count("*").alias("clicks")
    )
    return found.select("user", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "clicks")


def session_clicks(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events of finished sessions with the session's start and their ``step`` in it."""
    starts = sessions.select("user", F.col("start").alias("ts"), "start", "end")
    inside = asof_join(events, starts, "user").where(F.col("ts") < F.col("end"))
    placed = place_in_group(inside, ["user", "start"], F.asc("ts"), F.asc("event_id"), name="step")
    return placed.withColumn("step", F.col("step") + 1).drop("end")


def stream_outcome_join(preds: DataFrame, outcomes: DataFrame, bound: str, delay: str = "1 hour") -> DataFrame:
    """Predictions with the time of the first-matching outcomes within the bound, null once none
    can come any more. ``preds``: user, item, ts, ...; ``outcomes``: user, item, ts."""
    left = preds.withWatermark("ts", delay)
    right = outcomes.select(
        F.col("user").alias("_u"), F.col("item").alias("_i"), F.col("ts").alias("outcome_ts")
    ).withWatermark("outcome_ts", delay)
    near = (
        (F.col("user") == F.col("_u")) & (F.col("item") == F.col("_i"))
        & (F.col("outcome_ts") >= F.col("ts")) & (F.col("outcome_ts") <= F.col("ts") + F.expr(f"interval {bound}"))
    )
    return left.join(right, near, "left_outer").drop("_u", "_i")


def outcome_rates(joined: DataFrame, key: str) -> DataFrame:
    """(day, views, followed, outcomes) of settled predictions, each counted once however many outcomes it has."""
    each = joined.groupBy(key).agg(F.min("ts").alias("ts"), F.count("outcome_ts").alias("n"))
    return each.groupBy(F.to_date("ts").cast("string").alias("day")).agg(
        F.count("*").alias("views"), F.count_if(F.col("n") > 0).alias("followed"), F.sum("n").alias("outcomes"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them, over the batches the query still knows of."""
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)


def feature_table(spark: SparkSession, path: str, schema: str | StructType, key: str, ts: str = "ts") -> StateTable:
    """The latest feature row per key; a row with a true ``deleted`` column takes its key out."""
    return StateTable(spark, path, schema, [key], latest_by([key], ts))


def stream_feature_upsert(events: DataFrame, path: str, checkpoint: str, key: str, ts: str = "ts",
                          **trigger) -> StreamingQuery:
    """Keeps the latest feature row per key; read with ``feature_table``."""
    schema = events.schema

    def step(batch: DataFrame, number: int) -> None:
        feature_table(batch.sparkSession, path, schema, key, ts).apply(batch, number)

    return each_batch(events, checkpoint, step, **trigger)


RATING_LOG = "user bigint, item bigint, rating double, ts timestamp, mean double"
MEAN_LOG = "user bigint, mean double"
SUM_LOG = "left bigint, right bigint, n double, sxy double, sxx double, syy double"


class SpeedLayer:
    """Pair sums that change between two full builds, kept in three tables under ``path``.

    ``ratings`` (by item) holds the latest rating per user and item with the mean that the
    user's ratings are measured from, ``means`` (by user) that mean, and ``sums`` what the
    ratings since the build have added.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.ratings = StateTable(spark, f"{path}/ratings", RATING_LOG, ["item"], latest_by(["user", "item"], "ts"), buckets)
        self.means = StateTable(spark, f"{path}/means", MEAN_LOG, ["user"], lambda rows: rows.groupBy("user").agg(
            F.min("mean").alias("mean")), buckets)
        self.sums = StateTable(spark, f"{path}/sums", SUM_LOG, ["left", "right"], sum_by(["left", "right"], *SUMS), buckets)

    def start(self, base: DataFrame, means: DataFrame) -> None:
        """Takes over the last build: ``base`` (user, item, rating) and ``means`` (user, mean)."""
        first = F.lit("1000-01-01").cast("timestamp")  # before any rating that streams in
        held = base.select("user", "item", "rating").withColumn("ts", first).join(means, "user")
        self.means.apply(means.select("user", "mean"), 0)
        self.ratings.apply(held, 0)

    def add(self, batch: DataFrame, number: int) -> None:
        """A batch reads the buckets of its items and users, and of no others."""
        number += 1  # the build is number 0
        new = latest_rows(batch.select("user", "item", "rating", "ts"), ["user", "item"], "ts").persist()
        known = self.means.read(only=self.means.buckets_of(new))
        fresh = new.join(known, "user", "left_anti").groupBy("user").agg(F.avg("rating").alias("mean"))
        # The state before this batch, also when it is run again after some of its tables were committed.
        self.means.apply(fresh, number)
        held = self.means.read(only=self.means.buckets_of(new))
        stamped = new.join(held, "user").select("user", "item", "rating", "ts", "mean")
        if (self.sums.version() or Version(0, -1, 0)).batch < number:
            old = self.ratings.read(only=self.ratings.buckets_of(new))
            measured = old.select("user", "mean").unionByName(stamped.select("user", "mean")).groupBy("user").agg(F.min("mean").alias("mean"))
            late = new.join(old.select("user", "item", F.col("ts").alias("_t")), ["user", "item"], "left")
            newer = late.where(F.col("_t").isNull() | (F.col("ts") >= F.col("_t"))).select("user", "item", "rating")
            self.sums.apply(similarity_delta(old.select("user", "item", "rating"), newer, measured), number, merged=True)
        self.ratings.apply(stamped, number)
        new.unpersist()


def speed_layer_similarity(ratings: DataFrame, base: DataFrame, means: DataFrame, path: str, checkpoint: str,
                           **trigger) -> StreamingQuery:
    """Adds the pair sums that each small batch of ratings changes, between full builds.

    ``base`` (user, item, rating) and ``means`` (user, mean) are those of the last build;
    they are taken over once. A user new since the build keeps the mean of the first batch.
    """
    SpeedLayer(ratings.sparkSession, path).start(base, means)

    def step(batch: DataFrame, number: int) -> None:
        SpeedLayer(batch.sparkSession, path).add(batch, number)

    return each_batch(ratings, checkpoint, step, **trigger)


def bloom_tables(spark: SparkSession, path: str, key_type: str = "bigint") -> tuple[StateTable, StateTable]:
    """The bitmaps of a layered filter and the keys themselves."""
    bitmaps = StateTable(spark, f"{path}/bitmaps", LB.BITMAPS, ["layer", "bucket"], LB.or_layers, 4)
    return bitmaps, StateTable(spark, f"{path}/keys", f"key {key_type}", ["key"], lambda rows: rows.distinct())


def stream_bloom_add(keys: DataFrame, path: str, checkpoint: str, key: str, rate: float = 0.01, first: int = LB.FIRST,
                     **trigger) -> StreamingQuery:
    """Grows a layered filter by the keys of every batch, and keeps the keys for exact answers.

    The layers, a few numbers each, are part of the version that their bitmaps are in.
    """
    kind = keys.schema[key].dataType.simpleString()

    def step(batch: DataFrame, number: int) -> None:
        bitmaps, stored = bloom_tables(batch.sparkSession, path, kind)
        batch = batch.select(F.col(key).alias("key")).where("key is not null").distinct().persist()
        held = merged_bloom(batch.sparkSession, path, rate, first, kind)
        fresh = batch if not held.layers else LB.contains(held, batch, "key").where(~F.col("maybe")).select("key")
        count = fresh.count()
        if count:
            layer = LB.layer_for(held.layers, count, rate, first)
            layers = [vars(x) for x in held.layers if x.number != layer.number] + [vars(layer) | {"keys": layer.keys + count}]
            bitmaps.apply(LB.layer_bitmaps(fresh, "key", layer), number, {"layers": layers})
        stored.apply(batch, number)
        batch.unpersist()

    return each_batch(keys, checkpoint, step, **trigger)


def merged_bloom(spark: SparkSession, path: str, rate: float = 0.01, first: int = LB.FIRST, key_type: str = "bigint") -> LB.LayeredFilter:
    """The filter as of the latest version."""
    bitmaps, _ = bloom_tables(spark, path, key_type)
    version = bitmaps.version()
    layers = tuple(LB.Layer(**x) for x in version.meta["layers"]) if version else ()
    return LB.LayeredFilter(rate, first, layers, LB.or_layers(bitmaps.raw(version)))


DRIFT_LOG = "batch bigint, rows bigint, kl double"


def drift_table(spark: SparkSession, path: str) -> StateTable:
    return StateTable(spark, path, DRIFT_LOG, ["batch"], lambda rows: rows.distinct(), 1)


def stream_score_drift(scored: DataFrame, prior: DataFrame, path: str, checkpoint: str, low: float, high: float,
                       bins: int, score: str = "score", **trigger) -> StreamingQuery:
    """Writes (rows, kl) of every batch's scores against the stored prior counts."""

    def step(batch: DataFrame, number: int) -> None:
        counts = binned(batch, score, low, high, bins).persist()
        kl = kl_divergence(counts, prior, bins)
        rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        drift_table(batch.sparkSession, path).apply(kl.select(F.lit(number).cast("bigint").alias("batch"), rows.scalar().alias("rows"), "kl"), number)
        counts.unpersist()

    return each_batch(scored, checkpoint, step, **trigger)


def freshness_state(events: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Writes per-batch (day, user, item, shown, clicked) counts; they add up when read."""

    def step(batch: DataFrame, number: int) -> None:
        freshness_table(batch.sparkSession, path).apply(batch.groupBy(F.to_date("ts").alias("day"), "user", "item").agg(
            F.count_if(F.col("event_type") == "view").alias("shown"),
            F.count_if(F.col("event_type") == "click").alias("clicked"),
        ), number)

    return each_batch(events, checkpoint, step, **trigger)


FRESHNESS_LOG = "day date, user bigint, item bigint, shown bigint, clicked bigint"


def freshness_table(spark: SparkSession, path: str) -> StateTable:
    """(day, user, item, shown, clicked): as of any kept version."""
    return StateTable(spark, path, FRESHNESS_LOG, ["user"], sum_by(["day", "user", "item"], "shown", "clicked"))


def stale_since(parts: DataFrame, shown: int = 3, since: str | None = None) -> DataFrame:
    """(user, item, shown): shown often enough and never clicked, counting from a day on."""
    kept = parts if since is None else parts.where(F.col("day") >= F.lit(since).cast("date"))
    sums = kept.groupBy("user", "item").agg(F.sum("shown").alias("shown"), F.sum("clicked").alias("clicked"))
    return sums.where((F.col("shown") >= shown) & (F.col("clicked") == 0)).select("user", "item", "shown")
