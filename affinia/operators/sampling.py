"""Negatives, triplets, splits, shuffles and batches; every draw is a seeded hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.functions.keys import draw
from affinia.operators.indexing import dense_index
from affinia.operators.sizes import broadcast_if_small


def _drawn_rows(rows: DataFrame, pool: DataFrame, slot: Column, keys: list[Column], seed: int) -> DataFrame:
    """Join each row (one per slot) to the pool row at a drawn position.

    Positions are uniform, so this join has no hot key.
    """
    size = pool.count()
    picked = rows.withColumn("_slot", slot).withColumn("_at", draw(size, *keys, F.col("_slot"), seed=seed))
    return picked.join(broadcast_if_small(pool), "_at").drop("_at")


def uniform_negatives(examples: DataFrame, items: DataFrame, n: int = 64, seed: int = 0, key: str = "pl",
                      item: str = "track_idx", positives: str | None = None) -> DataFrame:
    """(key, slot, item columns): n uniform items per example, over the full range.

    With ``positives`` (an array column) drawn items that are positives are left out.
    """
    pool = dense_index(items, F.asc(item), name="_at")
    rows = examples.select(key, *([positives] if positives else []))
    drawn = _drawn_rows(rows, pool, F.explode(F.sequence(F.lit(0), F.lit(n - 1))), [F.col(key)], seed)
    if positives:
        drawn = drawn.where(~F.array_contains(positives, F.col(item))).drop(positives)
    return drawn.withColumnRenamed("_slot", "slot")


def triplets(pairs: DataFrame, n: int = 5, seed: int = 0, scene: str = "scene", product: str = "product") -> DataFrame:
    """(scene, positive, negative, slot, is_test): n products of drawn pairs per pair.

    Every tenth pair in (scene, product) order is a test pair with all its negatives.
    """
    placed = dense_index(pairs.select(scene, product), F.asc(scene), F.asc(product), name="_pos")
    pool = placed.select(F.col("_pos").alias("_at"), F.col(product).alias("negative"))
    rows = placed.select(scene, F.col(product).alias("positive"), "_pos")
    drawn = _drawn_rows(rows, pool, F.explode(F.sequence(F.lit(0), F.lit(n - 1))), [F.col("_pos")], seed)
    return drawn.select(
        F.col(scene).alias("scene"), "positive", "negative", F.col("_slot").alias("slot"),
        (F.col("_pos") % 10 == 0).alias("is_test"),
    )


def split_by_shard(df: DataFrame, digits: list[int], shard: str = "shard") -> DataFrame:
    """Rows whose shard number ends in one of the digits."""
    return df.where(F.pmod(F.col(shard), F.lit(10)).isin(digits))


def bootstrap(df: DataFrame, *order: Column, seed: int = 0) -> DataFrame:
    """As many rows as the input, drawn with replacement, with their drawn ``place``."""
    placed = dense_index(df, *order, name="_at")
    size = placed.count()
    slots = placed.select(F.col("_at").alias("place"))
    drawn = slots.withColumn("_at", draw(size, F.col("place"), seed=seed))
    return drawn.join(placed, "_at").drop("_at")


def shuffle_rows(df: DataFrame, *key: str, seed: int = 0) -> DataFrame:
    """Adds ``place``: the row's number in a seeded random order of the whole table."""
    hashed = df.withColumn("_h", F.xxhash64(*key, F.lit(seed)))
    return dense_index(hashed, F.asc("_h"), *[F.asc(k) for k in key], name="place").drop("_h")


def batches(df: DataFrame, size: int, *key: str, seed: int = 0, drop_last: bool = False) -> DataFrame:
    """Shuffled rows with their ``batch`` and place in it."""
    placed = shuffle_rows(df, *key, seed=seed)
    out = placed.withColumn("batch", F.floor(F.col("place") / size)).withColumn("slot", F.col("place") % size)
    if drop_last:
        out = out.where(F.col("batch") < F.lit(placed.count() // size))
    return out.drop("place")


def random_items(catalogue: DataFrame, n: int, seed: int = 0, key: str = "item") -> DataFrame:
    """n items by seeded hash order."""
    return catalogue.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def sequential_split(df: DataFrame, ts: str, train_end: str, gap: str, test_length: str) -> DataFrame:
    """Rows marked train (before ``train_end``) or test (a period after a delay); others dropped.

    ``gap`` and ``test_length`` are interval texts such as '2 days'.
    """
    end = F.lit(train_end).cast(df.schema[ts].dataType)
    start = end + F.expr(f"interval {gap}")
    stop = start + F.expr(f"interval {test_length}")
    at = F.col(ts)
    part = F.when(at < end, "train").when((at >= start) & (at < stop), "test")
    return df.withColumn("part", part).where(F.col("part").isNotNull())


def limit_queries(queries: DataFrame, n: int, key: str = "query") -> DataFrame:
    """The first n queries by key."""
    return queries.orderBy(key).limit(n)


def max_lines(df: DataFrame, n: int) -> DataFrame:
    """At most n input rows."""
    return df.limit(n)


def unique_keys(pairs: DataFrame, *columns: str) -> DataFrame:
    """Distinct union of several key columns, as ``key``."""
    out = pairs.select(F.explode(F.array(*columns)).alias("key"))
    return out.distinct()


def unique_entities(pairs: DataFrame, column: str) -> DataFrame:
    return pairs.select(column).distinct()


def sorted_keys(keys: DataFrame, column: str = "key") -> DataFrame:
    return keys.select(column).distinct().orderBy(column)
