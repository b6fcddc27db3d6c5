"""Row filters: serving rules, feature restrictions, freshness and validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def min_playlist_length(playlists: DataFrame, least: int = 10) -> DataFrame:
    """Playlists whose declared track count reaches the minimum."""
    return playlists.where(F.col("num_tracks") >= least)


def valid_pairs(pairs: DataFrame, files: DataFrame, scene: str = "scene", product: str = "product") -> DataFrame:
    """Pairs whose two keys both have a valid file."""
    have = files.select("key").distinct()
    kept = pairs.join(have.withColumnRenamed("key", scene), scene, "left_semi")
    return kept.join(have.withColumnRenamed("key", product), product, "left_semi")


def filter_views(views: DataFrame, users: DataFrame, since: str, country: str) -> DataFrame:
    """Views from a date on, by users of one country."""
    chosen = users.where(F.col("country") == country).select("user")
    start = F.lit(since).cast(views.schema["ts"].dataType)  # a literal of the column's type reaches the scan
    return views.where(F.col("ts") >= start).join(chosen, "user", "left_semi")


def filter_ratings(ratings: DataFrame, users: DataFrame, items: DataFrame, since: str, until: Column | str,
                   country: str) -> DataFrame:
    """Rated rows in a date range, of users of a country and of active items."""
    kind = ratings.schema["ts"].dataType
    last = F.lit(until).cast("date") if isinstance(until, str) else until
    kept = ratings.where(
        (F.col("ts") >= F.lit(since).cast(kind)) & (F.col("ts") < F.date_add(last, 1).cast(kind))
        & F.col("rating").isNotNull()
    )
    chosen = users.where(F.col("country") == country).select("user")
    live = items.where(F.col("active")).select("item")
    return kept.join(chosen, "user", "left_semi").join(live, "item", "left_semi")


def exclude_interacted(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates the user has not chosen before."""
    return candidates.join(history.select("user", "item"), ["user", "item"], "left_anti")


def stale_pairs(events: DataFrame, shown: int = 3) -> DataFrame:
    """(user, item) shown at least ``shown`` times and never clicked."""
    counts = events.groupBy("user", "item").agg(
        F.count_if(F.col("event_type") == "view").alias("shown"),
        F.count_if(F.col("event_type") == "click").alias("clicked"),
    )
    return counts.where((F.col("shown") >= shown) & (F.col("clicked") == 0))


def freshness_filter(candidates: DataFrame, events: DataFrame, shown: int = 3) -> DataFrame:
    return exclude_interacted(candidates, stale_pairs(events, shown))


def availability_filter(candidates: DataFrame, stock: DataFrame) -> DataFrame:
    """Drops the items whose stock is used up."""
    gone = stock.where(F.col("stock") <= 0).select("item")
    return candidates.join(gone, "item", "left_anti")


def apply_rules(ranked: DataFrame, rules: DataFrame) -> DataFrame:
    """(user, item, rank, dropped_by): rules (rule, first, second) keep two items apart.

    A row is dropped when a better-ranked item of the same list excludes it. The log
    names the lowest-numbered rule that dropped it, null for kept rows.
    """
    shown = ranked.select("user", F.col("item").alias("first"), F.col("rank").alias("_before"))
    both = rules.select("rule", "first", "second").unionByName(
        rules.select("rule", F.col("second").alias("first"), F.col("first").alias("second"))
    )
    hit = shown.join(both, "first").select("user", F.col("second").alias("item"), "rule", "_before")
    caught = ranked.join(hit, ["user", "item"]).where(F.col("_before") < F.col("rank"))
    reasons = caught.groupBy("user", "item").agg(F.min("rule").alias("dropped_by"))
    return ranked.join(reasons, ["user", "item"], "left")


def feature_filter(candidates: DataFrame, user_features: DataFrame, item_features: DataFrame) -> DataFrame:
    """Geographic and adult-content restrictions.

    ``user_features``: user, region, adult. ``item_features``: item, region (null =
    everywhere), adult_only.
    """
    joined = candidates.join(user_features, "user").join(
        item_features.select("item", F.col("region").alias("_where"), "adult_only"), "item"
    )
    allowed = (F.col("_where").isNull() | (F.col("_where") == F.col("region"))) & (
        ~F.col("adult_only") | F.col("adult")
    )
    return joined.where(allowed).select(*candidates.columns)


def filter_log(candidates: DataFrame, filters: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Candidates with the names of all the filters that would remove them.

    ``filters`` maps a name to the removed keys and the columns they match on.
    """
    out, flags = candidates, []
    for number, (name, (removed, on)) in enumerate(filters.items()):
        flag = f"_f{number}"
        out = out.join(removed.select(*on).distinct().withColumn(flag, F.lit(name)), on, "left")
        flags.append(flag)
    reasons = F.array_compact(F.array(*flags))
    return out.withColumn("reasons", reasons).drop(*flags)
