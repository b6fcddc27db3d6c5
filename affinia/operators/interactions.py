"""Views, events and ratings: counts, funnels, roll-ups and rating preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinia.operators.indexing import (
    dense_index, running_sum, sorted_parts, top_per_group, with_last_seen,
)


def view_counts(views: DataFrame) -> DataFrame:
    """Distinct views per user and item."""
    return views.groupBy("user", "item").agg(F.count_distinct("event_id").alias("count_views"))


def item_viewers(views: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct viewers per item; exact unless asked otherwise.

    The exact count first removes duplicate (item, user) rows, so a hot item's viewers
    are spread over all tasks and only their number meets in one.
    """
    if approximate:
        return views.groupBy("item").agg(F.approx_count_distinct("user").alias("count_viewers"))
    return views.select("item", "user").distinct().groupBy("item").agg(F.count("user").alias("count_viewers"))


def order_views(counts: DataFrame, descending: bool = True) -> DataFrame:
    """By count, then user."""
    count = F.desc("count_views") if descending else F.asc("count_views")
    return counts.orderBy(count, F.asc("user"))


def item_popularity(events: DataFrame) -> DataFrame:
    return events.groupBy("item").agg(F.count("*").alias("times_chosen"))


def rank_items(events: DataFrame) -> DataFrame:
    """(item, times_chosen, rank): rank 1 is the most chosen, ties by item."""
    ranked = dense_index(item_popularity(events), F.desc("times_chosen"), F.asc("item"), name="rank")
    return ranked.withColumn("rank", F.col("rank") + 1)


def most_popular(events: DataFrame, n: int, since: Column | None = None) -> DataFrame:
    """The n most chosen items, optionally of a trailing period."""
    kept = events if since is None else events.where(F.col("ts") >= since)
    return item_popularity(kept).orderBy(F.desc("times_chosen"), F.asc("item")).limit(n)


def trivial(items: DataFrame, item_id: int) -> DataFrame:
    """One fixed item, if it is available."""
    return items.where(F.col("active") & (F.col("item") == item_id)).select("item")


def funnel(events: DataFrame, steps: list[str], by: str | None = None) -> DataFrame:
    """(step, step_no, users, dropped): users who reached each step in order.

    A step counts from its first event that is not before the previous step's. ``by``
    follows each (user, by) pair, such as the recommended item, on its own.
    """
    key = ["user"] + ([by] if by else [])
    reached, parts = None, []
    for number, step in enumerate(steps):
        here = events.where(F.col("event_type") == step).select(*key, "ts")
        if reached is not None:
            here = here.join(reached, key).where(F.col("ts") >= F.col("_since"))
        reached = here.groupBy(*key).agg(F.min("ts").alias("_since"))
        parts.append(reached.agg(F.count("*").alias("users")).select(
            F.lit(step).alias("step"), F.lit(number).alias("step_no"), "users"
        ))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    before = F.lag("users").over(W.orderBy("step_no"))  # one row per step
    return table.withColumn("dropped", F.coalesce(before - F.col("users"), F.lit(0)))


def hourly_rollup(events: DataFrame) -> DataFrame:
    """(hour, event_type, events, value): hourly status table."""
    return events.groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(
        F.count("*").alias("events"), F.sum("value").alias("value")
    )


def current_inventory(stock: DataFrame, events: DataFrame) -> DataFrame:
    """(item, stock): start-of-day stock less what was bought since."""
    sold = events.where(F.col("event_type") == "purchase").groupBy("item").agg(F.count("*").alias("_sold"))
    return stock.join(sold, "item", "left").select(
        "item", (F.col("stock") - F.coalesce("_sold", F.lit(0))).alias("stock")
    )


def zipf_profile(events: DataFrame) -> DataFrame:
    """(item, times_chosen, rank, share, expected): observed share against (1/rank)/sum(1/rank)."""
    ranked = rank_items(events)
    totals = ranked.agg(
        F.sum("times_chosen").alias("_all"), F.sum(F.lit(1.0) / F.col("rank")).alias("_harmonic")
    )
    total, harmonic = totals.select("_all").scalar(), totals.select("_harmonic").scalar()
    return ranked.withColumn("share", F.col("times_chosen") / total).withColumn(
        "expected", (F.lit(1.0) / F.col("rank")) / harmonic
    )


def sparsity_profile(ratings: DataFrame) -> DataFrame:
    """(item, raters, rank, sharing, expected_sharing, density) of the user-item matrix.

    ``sharing`` is the number of other users a rater of the item shares it with;
    ``expected_sharing`` is (M-1) * P(rank) under the Zipf law; ``density`` is that of
    the whole matrix.
    """
    cells = ratings.select("user", "item").distinct()
    ranked = dense_index(
        cells.groupBy("item").agg(F.count("*").alias("raters")), F.desc("raters"), F.asc("item"), name="rank"
    ).withColumn("rank", F.col("rank") + 1)
    totals = ranked.agg(
        F.sum("raters").alias("entries"), F.count("*").alias("items"),
        F.sum(F.lit(1.0) / F.col("rank")).alias("harmonic"),
    )
    users = ratings.select("user").distinct().agg(F.count("*")).scalar()
    entries, items = totals.select("entries").scalar(), totals.select("items").scalar()
    harmonic = totals.select("harmonic").scalar()
    return ranked.select(
        "item", "raters", "rank", (F.col("raters") - 1).alias("sharing"),
        ((items - 1) * (F.lit(1.0) / F.col("rank")) / harmonic).alias("expected_sharing"),
        (entries / (items * users)).alias("density"),
    )


def exposure_weight(events: DataFrame, load: str = "load") -> DataFrame:
    """Clicks with weight 1 / number of items shown in the same page load."""
    shown = events.where(F.col("event_type") == "view").groupBy(load).agg(
        F.count_distinct("item").alias("exposed")
    )
    return events.where(F.col("event_type") == "click").join(shown, load).withColumn(
        "weight", F.lit(1.0) / F.col("exposed")
    )


def implicit_rating(events: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(user, item, strongest, total): per-event-type strengths; other types are ignored."""
    strength = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])[F.col("event_type")]
    weighed = events.withColumn("_w", strength).where(F.col("_w").isNotNull())
    return weighed.groupBy("user", "item").agg(F.max("_w").alias("strongest"), F.sum("_w").alias("total"))


def incremental_gain(df: DataFrame, group: str, spend: str, outcome: str, baseline: Column | None = None) -> DataFrame:
    """(group, spend, outcomes, expected, gain): outcomes beyond those the usual number of
    outcomes per spend predicts. ``baseline`` picks the rows that define the usual rate."""
    per = df.groupBy(group).agg(F.sum(spend).alias("spend"), F.sum(outcome).alias("outcomes"))
    usual = df if baseline is None else df.where(baseline)
    rate = usual.agg(F.sum(outcome) / F.sum(spend)).scalar()
    return per.withColumn("expected", F.col("spend") * rate).withColumn(
        "gain", F.col("outcomes") - F.col("expected")
    )


def weekly_kpis(events: DataFrame) -> DataFrame:
    """(week, active_users, signups, top_item): weekly actives, first-time signups and the
    item most often touched by the users who signed up that week (ties by item)."""
    dated = events.withColumn("week", F.date_trunc("week", "ts"))
    active = dated.select("week", "user").distinct().groupBy("week").agg(F.count("*").alias("active_users"))
    new = events.where(F.col("event_type") == "signup").groupBy("user").agg(F.min("ts").alias("_first")).select(
        "user", F.date_trunc("week", "_first").alias("week")
    )
    signups = new.groupBy("week").agg(F.count("*").alias("signups"))
    touched = dated.join(new, ["user", "week"]).groupBy("week", "item").agg(F.count("*").alias("_n"))
    driver = top_per_group(touched, ["week"], [F.desc("_n"), F.asc("item")], 1).select(
        "week", F.col("item").alias("top_item")
    )
    return active.join(signups, "week", "left").join(driver, "week", "left").withColumn(
        "signups", F.coalesce("signups", F.lit(0))
    )


def latest_rating(ratings: DataFrame) -> DataFrame:
    """The most recent rating per user and item; equal times keep the larger rating.

    ``max`` of (time, rating) is summed up on the map side, unlike a ranked window.
    """
    last = ratings.groupBy("user", "item").agg(F.max(F.struct("ts", "rating")).alias("_last"))
    return last.select("user", "item", F.col("_last.rating").alias("rating"), F.col("_last.ts").alias("ts"))


def user_mean_deviation(ratings: DataFrame, user: str = "user", rating: str = "rating") -> DataFrame:
    """Adds ``mean`` (over all of a user's ratings) and ``deviation``.

    The mean is an aggregate joined back, so a user with very many ratings is not
    gathered in one window partition.
    """
    means = ratings.groupBy(user).agg(F.avg(rating).alias("mean"))
    return ratings.join(means, user).withColumn("deviation", F.col(rating) - F.col("mean"))


def session_sequence(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Events with ``session`` (1.. per user) and ``step`` (1.. per session).

    A session ends after a gap of inactivity. Gaps and numbers come from the global
    order, so a user with very many events is spread over partitions.
    """
    placed = sorted_parts(events, F.asc("user"), F.asc("ts"), F.asc("event_id"))
    seen = with_last_seen(placed, F.struct("user", "ts"), "_before", inclusive=False)
    gap = F.col("ts").cast("timestamp").cast("double") - F.col("_before.ts").cast("timestamp").cast("double")
    same = (F.col("_before.user") == F.col("user")) & (gap <= gap_minutes * 60)
    flagged = seen.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_one", F.lit(1))
    numbered = running_sum(running_sum(flagged, "_new", "_session"), "_one", "_row")
    first = numbered.groupBy("user").agg(F.min("_session").alias("_s0"))
    start = numbered.groupBy("_session").agg(F.min("_row").alias("_r0"))
    return numbered.join(first, "user").join(start, "_session").select(
        *events.columns, (F.col("_session") - F.col("_s0") + 1).alias("session"),
        (F.col("_row") - F.col("_r0") + 1).alias("step"),
    )


def lag_context(events: DataFrame, n: int) -> DataFrame:
    """Adds ``context`` = the user's last n items, newest first, and ``weights`` = 1/age.

    Each row is sent to the n rows after it by number, so a group never holds more than n.
    """
    rows = dense_index(events, F.asc("user"), F.asc("ts"), F.asc("event_id"), name="_at")
    sent = rows.select("user", "item", F.col("_at").alias("_from"), F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_age"))
    sent = sent.select("user", (F.col("_from") + F.col("_age")).alias("_at"), "_age", "item")
    got = sent.groupBy("user", "_at").agg(F.array_sort(F.collect_list(F.struct("_age", "item"))).alias("_got"))
    joined = rows.join(got, ["user", "_at"], "left").withColumn(
        "context", F.coalesce(F.col("_got.item"), F.array().cast(f"array<{events.schema['item'].dataType.simpleString()}>"))
    )
    return joined.withColumn(
        "weights", F.transform("context", lambda _, age: F.lit(1.0) / (age + 1))
    ).drop("_at", "_got")
