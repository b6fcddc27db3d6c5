"""Pearson similarity of users or items, affinity, incremental updates, neighbour lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators.indexing import top_per_group
from affinia.operators.interactions import user_mean_deviation
from affinia.operators.neighbours import nearest, similarity_mass
from affinia.operators.pairs import SUMS, add_pair_sums, pair_sums
from affinia.session import cut_lineage


def similarity_sums(ratings: DataFrame, swap: bool = False, **limits: int) -> DataFrame:
    """Per pair left < right: co-rated count and the three sums of mean deviations."""
    entity, feature = ("item", "user") if swap else ("user", "item")
    rows = user_mean_deviation(ratings, entity)
    return pair_sums(rows, entity, feature, "deviation", **limits)


def pearson(sums: DataFrame) -> DataFrame:
    """Adds ``similarity``; null where a side never departs from its mean."""
    norm = F.sqrt("sxx") * F.sqrt("syy")
    return sums.withColumn("similarity", F.when(norm > 0, F.col("sxy") / norm))


def user_similarity(ratings: DataFrame, swap: bool = False, **limits: int) -> DataFrame:
    """(left, right, n, similarity) for pairs that share a rated item (or, swapped, a rater).

    Means run over all of an entity's ratings. Each pair is held once; ``both_ways``
    mirrors it where a neighbour list needs that.
    """
    return pearson(similarity_sums(ratings, swap, **limits)).select("left", "right", "n", "similarity")


def nearest_entities(ratings: DataFrame, k: int, swap: bool = False, **blocks: int) -> DataFrame:
    """(entity, neighbour, similarity): the k users (or, swapped, items) of largest similarity.

    Equal to cutting ``user_similarity`` at k per entity, without a row per pair.
    """
    entity, feature = ("item", "user") if swap else ("user", "item")
    return nearest(user_mean_deviation(ratings, entity), k, entity, feature, "deviation", **blocks)


def total_similarity(ratings: DataFrame, swap: bool = False, **blocks: int) -> DataFrame:
    """(entity, n, mass): known similarities of each entity and the sum of their sizes, without a row per pair."""
    entity, feature = ("item", "user") if swap else ("user", "item")
    return similarity_mass(user_mean_deviation(ratings, entity), entity, feature, "deviation", **blocks)


def both_ways(similarity: DataFrame) -> DataFrame:
    """(entity, neighbour, similarity) in both directions."""
    forth = similarity.select(F.col("left").alias("entity"), F.col("right").alias("neighbour"), "similarity")
    back = similarity.select(F.col("right").alias("entity"), F.col("left").alias("neighbour"), "similarity")
    return forth.unionByName(back)


def corated_jaccard(ratings: DataFrame, **limits: int) -> DataFrame:
    """(left, right, shared, jaccard): co-rated items over items rated by either."""
    cells = cut_lineage(ratings.select("user", "item").distinct())
    shared = pair_sums(cells, "user", "item", **limits).select("left", "right", F.col("n").alias("shared"))
    sizes = cells.groupBy("user").agg(F.count("*").alias("_n"))
    joined = shared.join(sizes.select(F.col("user").alias("left"), F.col("_n").alias("_l")), "left").join(
        sizes.select(F.col("user").alias("right"), F.col("_n").alias("_r")), "right"
    )
    return joined.select(
        "left", "right", F.col("shared").cast("bigint").alias("shared"),
        (F.col("shared") / (F.col("_l") + F.col("_r") - F.col("shared"))).alias("jaccard"),
    )


def neighbours(similarity: DataFrame, k: int) -> DataFrame:
    """The k most similar entities of each, by similarity then id; nulls never count.

    ``similarity`` holds each pair once (left, right) or is a list of neighbours already
    (entity, neighbour), as ``nearest_entities`` gives it.
    """
    listed = similarity if "neighbour" in similarity.columns else both_ways(similarity)
    known = listed.where(F.col("similarity").isNotNull())
    return top_per_group(known, ["entity"], [F.desc("similarity"), F.asc("neighbour")], k)


def affinity(ratings: DataFrame, similarity: DataFrame, k: int = 5, targets: DataFrame | None = None) -> DataFrame:
    """(user, item, affinity): mean of A plus the similarity-weighted mean of (r - mean of A)
    over those of A's k nearest users who rated the item.

    Without ``targets`` every item rated by a neighbour is predicted. A weight sum
    below 1e-12 in size gives null.
    """
    near = neighbours(similarity, k).select(F.col("entity").alias("user"), "neighbour", "similarity")
    means = ratings.groupBy("user").agg(F.avg("rating").alias("mean"))
    rated = ratings.select(F.col("user").alias("neighbour"), "item", "rating")
    votes = near.join(means, "user").join(rated, "neighbour")
    summed = votes.groupBy("user", "item", "mean").agg(
        F.sum(F.col("similarity") * (F.col("rating") - F.col("mean"))).alias("_num"),
        F.sum("similarity").alias("_den"),
    )
    out = summed.select(
        "user", "item",
        F.when(F.abs("_den") >= 1e-12, F.col("mean") + F.col("_num") / F.col("_den")).alias("affinity"),
    )
    if targets is None:
        return out
    return targets.select("user", "item").join(out, ["user", "item"], "left")


def update_similarity(sums: DataFrame, old: DataFrame, new: DataFrame, means: DataFrame, **limits: int) -> DataFrame:
    """New pair sums after new ratings: only pairs they touch change, means are held."""
    return add_sums(sums, similarity_delta(old, new, means, **limits))


def add_sums(*parts: DataFrame) -> DataFrame:
    """One row per pair; several tables are added up where the left entity is, from their members where they are known."""
    if len(parts) > 1:
        return add_pair_sums(*[(part, 1) for part in parts])
    return parts[0].groupBy("left", "right").agg(*[F.sum(c).alias(c) for c in SUMS])


def similarity_delta(old: DataFrame, new: DataFrame, means: DataFrame, **limits: int) -> DataFrame:
    """(left, right, sums) to add for new ratings (one per user and item).

    ``means`` (user, mean) are those of the last full build; users without one take the
    mean of their new ratings. Only the items that got new ratings are read. Where a new
    rating replaces an old one, what the old one had added is taken off.
    """
    touched = old.join(new.select("item").distinct(), "item", "left_semi").select("user", "item", "rating")
    again = new.select("user", "item")
    replaced = touched.join(again, ["user", "item"], "left_semi")
    kept = touched.join(again, ["user", "item"], "left_anti")
    own = new.groupBy("user").agg(F.avg("rating").alias("_own"))

    def changed(before: DataFrame, after: DataFrame) -> DataFrame:
        rows = before.withColumn("_new", F.lit(False)).unionByName(
            after.select("user", "item", "rating").withColumn("_new", F.lit(True))
        )
        rows = rows.join(means.select("user", "mean"), "user", "left").join(own, "user", "left")
        rows = rows.withColumn("deviation", F.col("rating") - F.coalesce("mean", "_own"))
        return pair_sums(rows, "user", "item", "deviation", fresh=F.col("_new"), **limits)

    delta = changed(kept, new)
    if not replaced.isEmpty():
        delta = add_pair_sums((delta, 1), (changed(kept, replaced), -1))
    return delta


def cf_recommend(ratings: DataFrame, similarity: DataFrame, mode: str = "user", k: int = 5, n: int = 10,
                 like: float = 4.0) -> DataFrame:
    """(user, item, score, rank): unseen items liked by similar users, or similar to liked items.

    The score of an item is the sum of the similarities that lead to it.
    """
    near = neighbours(similarity, k).where(F.col("similarity") > 0)
    liked = ratings.where(F.col("rating") >= like).select("user", "item")
    if mode == "user":
        found = near.join(liked.withColumnRenamed("user", "neighbour"), "neighbour").select(
            F.col("entity").alias("user"), "item", "similarity"
        )
    else:
        found = liked.join(near.withColumnRenamed("entity", "item"), "item").select(
            "user", F.col("neighbour").alias("item"), "similarity"
        )
    unseen = unseen_items(found, ratings)
    scored = unseen.groupBy("user", "item").agg(F.sum("similarity").alias("score"))
    # Rounded to compare, so that sums taken in another order still tie.
    return top_per_group(scored, ["user"], [F.desc(F.round("score", 9)), F.asc("item")], n)


def unseen_items(candidates: DataFrame, history: DataFrame) -> DataFrame:
    return candidates.join(history.select("user", "item"), ["user", "item"], "left_anti")


def neighbour_features(similarity: DataFrame, features: DataFrame, column: str, k: int = 5) -> DataFrame:
    """(user, column, predicted): the most frequent feature value among the k nearest users."""
    near = neighbours(similarity, k)
    values = features.select(F.col("user").alias("neighbour"), F.col(column).alias("_v"))
    counts = near.join(values, "neighbour").groupBy(F.col("entity").alias("user"), "_v").agg(F.count("*").alias("_n"))
    top = top_per_group(counts, ["user"], [F.desc("_n"), F.asc("_v")], 1)
    return top.select("user", F.col("_v").alias("predicted"))


def neighbour_random(ratings: DataFrame, similarity: DataFrame, k: int = 5, n: int = 3, like: float = 4.0,
                     seed: int = 0) -> DataFrame:
    """n hash-drawn unseen items out of what a user's neighbourhood liked."""
    near = neighbours(similarity, k)
    liked = ratings.where(F.col("rating") >= like).select(F.col("user").alias("neighbour"), "item")
    found = near.join(liked, "neighbour").select(F.col("entity").alias("user"), "item").distinct()
    drawn = unseen_items(found, ratings).withColumn("_draw", F.xxhash64("user", "item", F.lit(seed)))
    return top_per_group(drawn, ["user"], [F.asc("_draw"), F.asc("item")], n).select("user", "item", "rank")
