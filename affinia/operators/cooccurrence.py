"""Windowed token co-occurrence, title pairs, Dice scores and packed matrix rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinia.functions import scores
from affinia.operators.dictionary import lookup_token_index
from affinia.operators.indexing import place_in_group, top_per_group
from affinia.operators.pairs import set_pairs
from affinia.operators.sizes import broadcast_if_small
from affinia.session import cut_lineage

FRAGMENT = 1024
#: Entries up to which a matrix row is numbered by one task.
ROW_LIMIT = 1 << 20


def indexed_fragments(docs: DataFrame, dictionary: DataFrame, window: int, key: str, tokens: str,
                      fragment: int = FRAGMENT) -> DataFrame:
    """(ids): token indices of document pieces, each with ``window`` tokens of overlap.

    A document of any length becomes many bounded rows before anything is grouped.
    """
    last = F.floor((F.size(tokens) - 1) / fragment).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), last),
        lambda at: F.struct(at.alias("piece"), F.slice(tokens, at * fragment + 1, F.lit(fragment + window)).alias("part")),
    )
    rows = docs.where(F.size(tokens) > 0).select(key, F.inline(pieces))
    placed = rows.select(key, "piece", F.posexplode("part").alias("_at", "token"))
    found = lookup_token_index(placed, dictionary)
    ordered = F.array_sort(F.collect_list(F.struct("_at", "embedding")))
    return found.groupBy(key, "piece").agg(F.transform(ordered, lambda s: s["embedding"]).alias("ids"))


def context_pairs(docs: DataFrame, dictionary: DataFrame, window: int = 10, key: str = "doc_id",
                  tokens: str = "tokens", fragment: int = FRAGMENT) -> DataFrame:
    """(a, b, d): the band join; token index b stands d places after a, d up to the window.

    Equal tokens never meet, and at distance exactly ``window`` two meet only when the
    later one has the larger index. Every token emits at most ``window`` rows.
    """
    ids = indexed_fragments(docs, dictionary, window, key, tokens, fragment)
    centres = F.sequence(F.lit(1), F.least(F.size("ids"), F.lit(fragment)))
    near = F.transform(
        centres,
        lambda at: F.transform(
            F.slice("ids", at + 1, F.lit(window)),
            lambda other, gap: F.struct(
                F.element_at("ids", at).alias("a"), other.alias("b"), (gap + 1).alias("d")
            ),
        ),
    )
    return ids.select(F.inline(F.flatten(near))).where(
        (F.col("a") != F.col("b")) & ((F.col("d") < window) | (F.col("b") > F.col("a")))
    )


def token_cooccurrence(docs: DataFrame, dictionary: DataFrame, window: int = 10, key: str = "doc_id",
                       tokens: str = "tokens", fragment: int = FRAGMENT) -> DataFrame:
    """(i, j, x) with i > j: sum of 1/distance over the pairs of the band join.

    The weights are summed as whole multiples of 1/lcm(1..window), so the sums do not
    depend on the order of addition; they are partly summed before the shuffle.
    """
    scale = math.lcm(*range(1, window + 1))
    pairs = context_pairs(docs, dictionary, window, key, tokens, fragment)
    summed = pairs.groupBy(F.greatest("a", "b").alias("i"), F.least("a", "b").alias("j")).agg(
        F.sum(F.lit(scale).cast("bigint") / F.col("d")).cast("bigint").alias("_units")
    )
    return summed.select("i", "j", (F.col("_units") / F.lit(float(scale))).alias("x"))


def title_cooccurrence(url2url: DataFrame, key: str = "url", **limits: int) -> DataFrame:
    """(i, j, count), i < j: documents that hold both titles, as primary or link."""
    sets = url2url.select(key, F.concat(F.array("primary_index"), F.col("secondary_index")).alias("members"))
    return set_pairs(sets, key, "members", **limits).select(
        F.col("left").alias("i"), F.col("right").alias("j"), F.col("n").alias("count")
    )


def dice_similarity(pairs: DataFrame, dictionary: DataFrame, factor: float = 2.0) -> DataFrame:
    """Pairs with both titles, their document frequencies and the Dice score."""
    def side(index: str, suffix: str) -> DataFrame:
        return broadcast_if_small(dictionary.select(
            F.col("index").alias(index), F.col("token").alias(f"title_{suffix}"),
            F.col("doc_frequency").alias(f"df_{suffix}"),
        ))

    joined = pairs.join(side("i", "i"), "i").join(side("j", "j"), "j")
    return joined.withColumn("dice", scores.dice(F.col("count"), F.col("df_i"), F.col("df_j"), factor))


def url_pair_examples(pairs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(i, j, target): square root of the Dice score as the label."""
    return dice_similarity(pairs, dictionary).select(
        "i", "j", scores.sqrt_target(F.col("dice")).alias("target")
    )


def top_neighbours_dice(scored: DataFrame, n: int) -> DataFrame:
    """First n partners of each row title by (dice, count, title), all descending."""
    return top_per_group(scored, ["i"], [F.desc("dice"), F.desc("count"), F.desc("title_j")], n)


def top_neighbours_cooccur(triples: DataFrame, dictionary: DataFrame, n: int, rows: int | None = None) -> DataFrame:
    """First n partners of each row by weight, with token names; optionally the first rows only."""
    kept = triples if rows is None else triples.where(F.col("i") < rows)
    top = top_per_group(kept, ["i"], [F.desc("x"), F.asc("j")], n)
    names = broadcast_if_small(dictionary.select((F.col("index") + 1).alias("_e"), "token"))
    left = names.select(F.col("_e").alias("i"), F.col("token").alias("token_i"))
    right = names.select(F.col("_e").alias("j"), F.col("token").alias("token_j"))
    return top.join(left, "i", "left").join(right, "j", "left")


def pack_rows(triples: DataFrame, max_row_size: int = 1000, i: str = "i", j: str = "j", x: str = "x") -> DataFrame:
    """(index, chunk, other_index, count): matrix rows cut into chunks of max_row_size.

    A row is numbered as it passes the task of its index. Places within a row of more than
    ``ROW_LIMIT`` entries come from the global numbering, so that no task has all of it.
    Only chunks are gathered.
    """
    triples = cut_lineage(triples.select(i, j, x))
    heavy = cut_lineage(triples.groupBy(i).agg(F.count("*").alias("_n")).where(F.col("_n") > ROW_LIMIT).select(i))
    at = F.row_number().over(W.partitionBy(i).orderBy(F.asc(j))) - 1
    if heavy.isEmpty():
        placed = triples.withColumn("place", at)
    else:
        heavy = broadcast_if_small(heavy)
        placed = triples.join(heavy, i, "left_anti").withColumn("place", at.cast("bigint")).unionByName(
            place_in_group(triples.join(heavy, i, "left_semi"), [i], F.asc(j)))
    chunked = placed.withColumn("chunk", F.floor(F.col("place") / max_row_size))
    entries = F.array_sort(F.collect_list(F.struct(F.col(j).alias("j"), F.col(x).alias("x"))))
    return chunked.groupBy(F.col(i).alias("index"), "chunk").agg(entries.alias("_e")).select(
        "index", "chunk", F.col("_e.j").alias("other_index"), F.col("_e.x").alias("count")
    )


def unpack_rows(rows: DataFrame) -> DataFrame:
    """(i, j, x) triples of packed rows."""
    entry = F.explode(F.arrays_zip("other_index", "count")).alias("_e")
    return rows.select(F.col("index").alias("i"), entry).select(
        "i", F.col("_e.other_index").alias("j"), F.col("_e.count").alias("x")
    )
