"""Recommendation lists: exploration, blending, diversity, fallbacks and experiments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.functions.keys import draw, unit_draw
from affinia.operators.indexing import dense_index, place_in_group, top_per_group
from affinia.operators.sizes import broadcast_if_small


def eps_greedy(popularity: DataFrame, users: DataFrame, n: int, eps: float | Column, seed: int = 0) -> DataFrame:
    """(user, slot, item, explored): n distinct items per user.

    Each slot explores with probability eps and takes a drawn item, else the next most
    popular one; an item met twice keeps its first slot. 2n slots and n spare popular
    ones are laid out per user, so n distinct items always remain if the catalogue has
    them. ``eps`` may be a column of ``users``, which lets it shrink over time.
    """
    if not isinstance(eps, Column):
        if not 0 < eps < 1:
            raise ValueError("eps must lie between 0 and 1")
        eps = F.lit(eps)
    ranked = dense_index(
        popularity.select("item", "times_chosen"), F.desc("times_chosen"), F.asc("item"), name="_at"
    ).select("item", "_at")
    size = ranked.count()
    slots = F.sequence(F.lit(0), F.lit(3 * n - 1))
    flagged = F.transform(slots, lambda s: F.struct(
        s.alias("slot"), ((s < 2 * n) & (unit_draw(F.col("user"), s, seed=seed) < eps)).alias("explored")
    ))
    rows = users.withColumn("_f", flagged).select("user", "_f", F.inline("_f"))
    taken = F.size(F.filter("_f", lambda f: ~f["explored"] & (f["slot"] < F.col("slot"))))
    at = F.when(F.col("explored"), draw(size, F.col("user"), F.col("slot"), seed=seed + 1)).otherwise(taken)
    placed = rows.select("user", "slot", "explored", at.cast("bigint").alias("_at"))
    found = placed.join(broadcast_if_small(ranked), "_at")
    first = found.groupBy("user", "item").agg(
        F.min("slot").alias("_s"), F.min_by("explored", "slot").alias("explored")
    )
    return top_per_group(first, ["user"], [F.asc("_s")], n, rank="slot").drop("_s")


def bandit_arms(events: DataFrame, arm: str, reward: str) -> DataFrame:
    """(arm, pulls, mean_reward, best): observed mean reward; the best arm, ties by name."""
    arms = events.groupBy(F.col(arm).alias("arm")).agg(
        F.count("*").alias("pulls"), F.avg(reward).alias("mean_reward")
    )
    # The least (-reward, name) is the best arm.
    best = arms.agg(F.min(F.struct(-F.col("mean_reward"), F.col("arm")))["arm"]).scalar()
    return arms.withColumn("best", F.col("arm") == best)


def blend(scores: dict[str, tuple[DataFrame, float]], n: int | None = None) -> DataFrame:
    """(user, item, score): weighted sum of score tables (user, item, score).

    The first table decides the candidates; the others only add to them.
    """
    (base, weight), *others = scores.values()
    out = base.select("user", "item", (F.col("score") * weight).alias("score"))
    for table, w in others:
        part = table.select("user", "item", (F.col("score") * w).alias("_s"))
        out = out.join(part, ["user", "item"], "left").select(
            "user", "item", (F.col("score") + F.coalesce("_s", F.lit(0.0))).alias("score")
        )
    return out if n is None else top_per_group(out, ["user"], [F.desc("score"), F.asc("item")], n)


def query_blend(query_item: DataFrame, user_item: DataFrame, user_weight: float = 0.5, n: int | None = None) -> DataFrame:
    """Candidates by query; query-item and user-item scores together."""
    return blend({"query": (query_item, 1.0), "user": (user_item, user_weight)}, n)


def context_blend(query_item: DataFrame, user_item: DataFrame, context_item: DataFrame,
                  context_weight: float = 0.25, n: int | None = None) -> DataFrame:
    """As ``query_blend`` with the context added at a lower weight."""
    return blend({"query": (query_item, 1.0), "user": (user_item, 0.5), "context": (context_item, context_weight)}, n)


def collate_ranks(rankings: dict[str, tuple[DataFrame, float]], n: int | None = None) -> DataFrame:
    """(user, item, score, rank): several rankings merged by the sum of weight / rank."""
    parts = [t.select("user", "item", (F.lit(w) / F.col("rank")).alias("_s")) for t, w in rankings.values()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    merged = union.groupBy("user", "item").agg(F.sum("_s").alias("score"))
    if n is not None:
        return top_per_group(merged, ["user"], [F.desc("score"), F.asc("item")], n)
    placed = place_in_group(merged, ["user"], F.desc("score"), F.asc("item"), name="rank")
    return placed.withColumn("rank", F.col("rank") + 1)


def diversify(ranked: DataFrame, category: str, most: int, n: int) -> DataFrame:
    """The first n of each list with at most ``most`` items per category."""
    thinned = top_per_group(ranked, ["user", category], [F.asc("rank")], most, rank="_c").drop("_c")
    return top_per_group(thinned.withColumnRenamed("rank", "_r"), ["user"], [F.asc("_r")], n).drop("_r")


def with_fallback(recs: DataFrame, users: DataFrame, popular: DataFrame) -> DataFrame:
    """(user, item, rank, source): users without a list get the popular one.

    ``popular`` (item, rank) is a short list, carried as one array value.
    """
    listed = popular.agg(F.array_sort(F.collect_list(F.struct("rank", "item")))).scalar()
    missing = users.select("user").join(recs.select("user"), "user", "left_anti")
    filled = missing.select("user", F.inline(listed)).select("user", "item", "rank", F.lit("popular").alias("source"))
    own = recs.select("user", "item", "rank", F.lit("personal").alias("source"))
    return own.unionByName(filled)


def ensemble(predictions: DataFrame, priors: DataFrame) -> DataFrame:
    """(key, score): models pooled with weight 1 / (1 + |mean score - prior mean| / prior sd).

    ``predictions``: model, key, score. ``priors``: model, prior_mean, prior_sd.
    """
    means = predictions.groupBy("model").agg(F.avg("score").alias("_m"))
    weights = means.join(priors, "model").select(
        "model", (F.lit(1.0) / (1 + F.abs(F.col("_m") - F.col("prior_mean")) / F.col("prior_sd"))).alias("_w")
    )
    return predictions.join(weights, "model").groupBy("key").agg(
        (F.sum(F.col("score") * F.col("_w")) / F.sum("_w")).alias("score")
    )


def cascade(predictions: DataFrame, models: list[str], threshold: float) -> DataFrame:
    """(key, score, model, depth): the first model that is confident enough answers;
    if none is, the mean of all that were called does."""
    wide = predictions.where(F.col("model").isin(models)).groupBy("key").pivot("model", models).agg(
        F.max("score").alias("score"), F.max("confidence").alias("confidence")
    )
    score, model, depth = F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(len(models))
    known = F.array_compact(F.array(*[F.col(f"{m}_score") for m in models]))
    pooled = F.aggregate(known, F.lit(0.0), lambda t, x: t + x) / F.size(known)
    for number, name in reversed(list(enumerate(models, 1))):
        sure = F.col(f"{name}_confidence") >= threshold
        score = F.when(sure, F.col(f"{name}_score")).otherwise(score)
        model = F.when(sure, F.lit(name)).otherwise(model)
        depth = F.when(sure, F.lit(number)).otherwise(depth)
    return wide.select(
        "key", F.coalesce(score, pooled).alias("score"), F.coalesce(model, F.lit("pooled")).alias("model"),
        depth.alias("depth"),
    )


def assign_experiment(requests: DataFrame, key: str, salt: str, arms: dict[str, int]) -> DataFrame:
    """Adds ``arm`` by a salted hash of the key; ``arms`` maps names to percent, adding to 100."""
    if sum(arms.values()) != 100:
        raise ValueError("arm shares must add up to 100")
    point = F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(100))
    arm, upto = F.lit(None).cast("string"), 100
    for name, share in reversed(arms.items()):
        arm = F.when(point < upto, F.lit(name)).otherwise(arm)
        upto -= share
    return requests.withColumn("arm", arm)


def shadow_compare(live: DataFrame, shadow: DataFrame, key: list[str]) -> DataFrame:
    """(key, live, shadow, delta, in_live, in_shadow): full outer comparison of two outputs."""
    a = live.select(*key, F.col("score").alias("live"), F.lit(True).alias("_a"))
    b = shadow.select(*key, F.col("score").alias("shadow"), F.lit(True).alias("_b"))
    return a.join(b, key, "full").select(
        *key, "live", "shadow", (F.col("shadow") - F.col("live")).alias("delta"),
        F.coalesce("_a", F.lit(False)).alias("in_live"), F.coalesce("_b", F.lit(False)).alias("in_shadow"),
    )


def new_item_exposure(recs: DataFrame, items: DataFrame, users: DataFrame, n: int = 100) -> DataFrame:
    """(user, item, rank): each new item takes slot 2 for its own n users.

    Users are taken in order of arrival (``ts``), n for the first new item, the next n
    for the second and so on; the other lists stay as they are, as does one that already
    shows the new item first.
    """
    order = dense_index(users.groupBy("user").agg(F.min("ts").alias("_t")), F.asc("_t"), F.asc("user"), name="_u")
    news = dense_index(items.select("item").distinct(), F.asc("item"), name="_i").withColumnRenamed("item", "_new")
    chosen = order.withColumn("_i", F.floor(F.col("_u") / n)).join(broadcast_if_small(news), "_i").select("user", "_new")
    held = recs.join(chosen, "user").where(F.col("item") == F.col("_new")).select("user", F.col("rank").alias("_held"))
    lists = recs.join(chosen, "user", "left").join(held, "user", "left")
    moves = F.col("_new").isNotNull() & (F.col("rank") > 1) & (F.col("rank") < F.coalesce("_held", F.lit(1 << 30)))
    kept = lists.where(F.col("_new").isNull() | (F.col("item") != F.col("_new"))).select(
        "user", "item", (F.col("rank") + F.when(moves & (F.coalesce("_held", F.lit(0)) != 1), 1).otherwise(0)).alias("rank")
    )
    added = chosen.join(recs.select("user").distinct(), "user", "left_semi").join(held, "user", "left").select(
        "user", F.col("_new").alias("item"), F.when(F.col("_held") == 1, 1).otherwise(2).alias("rank")
    )
    return kept.unionByName(added)
