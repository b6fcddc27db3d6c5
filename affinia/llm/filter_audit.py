"""What each of five filters removes, in every order in which they can be applied.

A document's failures are a mask of five bits. Documents are counted per (part, mask)
first, so that at most 32 cells a part are left whatever the number of documents. Each
cell is then folded with SQL's higher-order functions across the array of all 120 orders,
a constant that is broadcast with the plan: a running state says whether the cell's
documents still stand, and every step adds a struct that is weighted with the cell's
counts. The 600 structs of the cells of a part are added element by element.

Odd rows: a null text counts as empty, a null ``source`` as the empty string. A null
doc_id is smaller than none and larger than none, so such a row never fails E and is no
one's first copy; it has no labels. Rows that repeat a doc_id with the same text are no
copies of each other, as neither id is smaller. A doc_id labelled more than once counts as
good or toxic if any of its rows says so; null labels say nothing. Other columns are not
read. Without documents there is no row.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.sizes import broadcast_if_small

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(LETTERS)]
#: Row counts of a cell: all documents, those of good quality, toxic ones.
WEIGHTS = ["n", "good", "toxic"]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
#: Null ids match no label; they are dealt over this many join keys instead of one.
NULL_KEYS = 1 << 20


def text_failures(text: Column) -> Column:
    """The bits of A to D: too short, repetitive, shouting, with symbols of markup or code."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    failed = [
        n < 200, 100 * distinct.cast("bigint") < 50 * n.cast("bigint"),
        100 * capitals.cast("bigint") > 2 * F.length(text).cast("bigint"), text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))


def flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic) as 0 or 1, one row per labelled document."""

    def any_one(name: str) -> Column:
        return F.max(F.when(F.col(name) == 1, 1).otherwise(0))

    return labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        any_one("quality").alias("good"), any_one("toxic").alias("toxic"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters.

    No text is shuffled, only its SHA-256. Copies are summed on the map side per (text,
    part) together with their smallest id, so a text that makes up a third of the table
    sends one row per task and part.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text_failures(text).alias("mask"),
    )
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("rows"))
    spot = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest", "part"), F.lit(NULL_KEYS)) + 1).otherwise(0)
    marks = broadcast_if_small(flags(labels).withColumn("spot", F.lit(0).cast("bigint")))
    rows = rows.withColumn("spot", spot.cast("bigint")).join(marks, ["doc_id", "spot"], "left").select(
        "doc_id", "part", "digest", "mask", F.col("rows").alias("n"),
        *[(F.col("rows") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])
    identified = F.col("doc_id").isNotNull()
    same = rows.groupBy("digest", "part", "mask").agg(
        *[F.sum(w).alias(w) for w in WEIGHTS],
        *[F.sum(F.when(~identified, F.col(w)).otherwise(0)).alias(f"no_id_{w}") for w in WEIGHTS],
        F.min(F.when(identified, F.struct("doc_id", *WEIGHTS))).alias("first"),
    )
    # The same rows under new column identities, as a plan may not join a table to itself.
    lowest = same.groupBy(F.col("digest").alias("of")).agg(F.min("first.doc_id").alias("lowest"))
    held = same.join(lowest, F.col("digest") == F.col("of")).withColumn(
        "leads", F.coalesce(F.col("first.doc_id") == F.col("lowest"), F.lit(False)))

    def spared(w: str) -> Column:
        return F.col(f"no_id_{w}") + F.when(F.col("leads"), F.col("first")[w]).otherwise(0)

    both = F.array(
        F.struct("mask", *[spared(w).alias(w) for w in WEIGHTS]),
        F.struct((F.col("mask") + 16).alias("mask"), *[(F.col(w) - spared(w)).alias(w) for w in WEIGHTS]),
    )
    return held.select("part", F.explode(both).alias("c")).select("part", "c.*").groupBy("part", "mask").agg(
        *[F.sum(w).alias(w) for w in WEIGHTS]).where("n > 0")


def order_steps() -> Column:
    """All orders in one array: a name and the five bits of its filters, in turn."""
    return F.array(*[
        F.struct(F.lit(o).alias("filter_order"), F.array(*[F.lit(1 << LETTERS.index(c)) for c in o]).alias("bits"))
        for o in ORDERS
    ])


def _step(cell: Column, passed: Column, bit: Column) -> Column:
    """What one filter does to a cell of which ``passed`` says whether it still stands."""
    fails = cell["mask"].bitwiseAND(bit) != 0

    def where(condition: Column, weight: str) -> Column:
        return F.when(condition, cell[weight]).otherwise(F.lit(0).cast("bigint"))

    return F.struct(
        where(passed & ~fails, "n").alias("kept"), where(passed & fails, "n").alias("removed"),
        where(~passed & fails, "n").alias("redundant"), where(cell["mask"] == bit, "n").alias("unique_fails"),
        where(passed & fails, "good").alias("good_lost"), where(passed & fails, "toxic").alias("toxic_lost"),
    )


def folded(cell: Column, orders: Column) -> Column:
    """The cell's 600 weighted structs: each order is one fold over its five filters."""

    def along(order: Column) -> Column:
        start = F.struct(F.lit(True).alias("passed"), F.array().cast(
            "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>").alias("done"))
        return F.aggregate(
            order["bits"], start,
            lambda at, bit: F.struct(
                (at["passed"] & (cell["mask"].bitwiseAND(bit) == 0)).alias("passed"),
                F.concat(at["done"], F.array(_step(cell, at["passed"], bit))).alias("done")),
            lambda at: at["done"])

    return F.flatten(F.transform(orders, along))


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, the six counts, shapley): 600 rows per part.

    ``removed`` counts what falls at this step, ``redundant`` what fails its filter but has
    fallen before, ``unique_fails`` what no other filter would catch, ``shapley`` what its
    filter removes in all 120 orders together (its Shapley value times 120).
    """
    counted = cells(docs, labels)
    orders = order_steps()  # a constant that every task gets with its plan
    # At most 32 cells a part, so the list is bounded.
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *WEIGHTS)).alias("cells"))
    zeros = F.array_repeat(F.struct(*[F.lit(0).cast("bigint").alias(c) for c in COUNTS]), 5 * len(ORDERS))
    summed = parts.select("part", F.aggregate("cells", zeros, lambda total, cell: _plus(total, folded(cell, orders))).alias("steps"))
    flat = F.flatten(F.transform(orders, lambda o: F.transform(
        o["bits"], lambda bit, i: F.struct(o["filter_order"].alias("filter_order"), (i + 1).alias("step"), bit.alias("bit")))))
    named = summed.select("part", F.arrays_zip(flat.alias("at"), F.col("steps").alias("counts")).alias("rows"))

    def shapley(bit: int) -> Column:
        return F.aggregate(
            F.filter("rows", lambda r: r["at"]["bit"] == bit), F.lit(0).cast("bigint"), lambda s, r: s + r["counts"]["removed"])

    totals = F.map_from_arrays(
        F.array(*[F.lit(1 << i) for i in range(len(LETTERS))]), F.array(*[shapley(1 << i) for i in range(len(LETTERS))]))
    rows = named.withColumn("shares", totals).select("part", "shares", F.explode("rows").alias("r"))
    return rows.select(
        "part", "r.at.filter_order", "r.at.step", *[F.col(f"r.counts.{c}").alias(c) for c in COUNTS],
        F.col("shares")[F.col("r.at.bit")].alias("shapley"))
