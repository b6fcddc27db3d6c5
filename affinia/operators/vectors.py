"""Exact and approximate nearest neighbours over vector tables.

Scores are block products inside Arrow batches. Where the queries are small by measure
they are broadcast and the items are scanned once without a shuffle; otherwise both
sides are cut into blocks, and every pair of a tile of query blocks and a tile of item
blocks is one bounded task. Only the best k of a tile leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.indexing import top_per_group

BROADCAST_BYTES = 64 << 20
BLOCK = 8192
# Scores are compared rounded, so that equal vectors tie whatever their place in a product.
PLACES = 9
#: What a score may lie below another one and still be equal to it when rounded.
SLACK, DRIFT = 1e-8, 1e-12
#: Items multiplied at once, and bytes of vectors of a tile of blocks, two of which a task holds.
CHUNK, TILE_BYTES = 2048, 16 << 20


def matrix_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(column), -1)


def _names(column) -> np.ndarray:
    values = column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()
    return values.astype("U") if values.dtype == object else values


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def best(scores: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, larger first, lower name on ties."""
    scores = np.round(scores, PLACES)
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.nonzero(scores >= floor)[0]
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((names[near], -scores[near]))][:k]


class Leaders:
    """The best k (query, name, score) of each query over the item blocks seen so far."""

    def __init__(self, queries: np.ndarray, matrix: np.ndarray, k: int, skip_self: bool):
        self.queries, self.matrix, self.k, self.skip_self = queries, matrix, k, skip_self
        self.floor = np.full(len(queries), -np.inf)
        self.names, self.scores = None, np.full((len(queries), k), -np.inf)

    def add(self, names: np.ndarray, matrix: np.ndarray) -> None:
        for at in range(0, len(names), CHUNK):
            self._add(names[at:at + CHUNK], matrix[at:at + CHUNK])

    def _add(self, names: np.ndarray, matrix: np.ndarray) -> None:
        if self.names is None:
            self.names = np.zeros(self.scores.shape, names.dtype)
        elif self.names.dtype != names.dtype:
            self.names = self.names.astype(np.promote_types(self.names.dtype, names.dtype))
        step = max(1, (4 << 20) // len(names))
        for lo in range(0, len(self.queries), step):
            block = self.matrix[lo:lo + step] @ matrix.T
            if self.skip_self:
                block[self.queries[lo:lo + step, None] == names[None, :]] = -np.inf
            floor = self.floor[lo:lo + step]
            if block.shape[1] > self.k and not np.isfinite(floor).all():
                at = block.shape[1] - self.k
                floor = np.maximum(floor, np.round(np.partition(block, at, axis=1)[:, at], PLACES))
            # Few scores are left to be rounded once each query has k of them.
            row, column = np.nonzero((block >= (floor - SLACK - DRIFT * np.abs(floor))[:, None]) & (block > -np.inf))
            found = block[row, column]
            keep = np.round(found, PLACES) >= floor[row]
            if keep.any():
                self._merge(row[keep] + lo, names[column[keep]], found[keep])

    def _merge(self, query: np.ndarray, names: np.ndarray, scores: np.ndarray) -> None:
        """The best k of the named queries, of those held and the new ones; lower names on ties."""
        some = np.unique(query)
        row, column = np.nonzero(self.scores[some] > -np.inf)
        held = some[row]
        query, names, scores = (np.concatenate(x) for x in (
            (held, query), (self.names[held, column], names), (self.scores[held, column], scores)))
        near = np.round(scores, PLACES)
        order = np.lexsort((names, -near, query))
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order, place = order[place < self.k], place[place < self.k]
        self.names[query[order], place], self.scores[query[order], place] = names[order], scores[order]
        last = order[place == self.k - 1]
        self.floor[query[last]] = near[last]

    def table(self, schema: pa.Schema) -> pa.Table:
        if self.names is None:
            return schema.empty_table()
        row, column = np.nonzero(self.scores > -np.inf)
        return pa.table([
            pa.array(self.queries[row], type=schema.field(0).type), pa.array(self.names[row, column], type=schema.field(1).type),
            pa.array(self.scores[row, column]),
        ], schema=schema)


def _arrow_type(kind: str) -> pa.DataType:
    return pa.string() if kind == "string" else pa.int64()


def _prepare(df: DataFrame, key: str, vec: str, name: str, as_is: bool = False) -> DataFrame:
    kind = "string" if df.schema[key].dataType.simpleString() == "string" else "bigint"
    as_is = as_is and df.schema[vec].dataType.simpleString() == "array<float>"  # half the bytes on the way
    return df.where(F.col(vec).isNotNull()).select(
        F.col(key).cast(kind).alias(name), F.col(vec).cast("array<float>" if as_is else "array<double>").alias("vec")
    )


def knn(
    queries: DataFrame, items: DataFrame, k: int, query_key: str = "query", item_key: str = "item",
    vec: str = "vec", metric: str = "dot", exclude_self: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES, block: int = BLOCK,
) -> DataFrame:
    """(query, item, score, rank): the k items of largest inner product or cosine.

    Scores equal to nine decimals are ties and go to the lower item. ``exclude_self``
    leaves out the item equal to the query. Beyond ``broadcast_bytes`` both sides are cut into
    blocks, which are sent in tiles of at most ``TILE_BYTES`` or one block.
    """
    q = _prepare(queries, query_key, vec, "query", as_is=True)
    i = _prepare(items, item_key, vec, "item", as_is=True)
    size = q.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    n, d = size["n"], size["d"] or 0
    out = f"query {q.schema['query'].dataType.simpleString()}, item {i.schema['item'].dataType.simpleString()}, score double"
    schema = pa.schema([
        ("query", _arrow_type(q.schema["query"].dataType.simpleString())),
        ("item", _arrow_type(i.schema["item"].dataType.simpleString())),
        ("score", pa.float64()),
    ])
    fit = _unit if metric == "cosine" else (lambda m: m)
    if n * (d + k * 3) * 8 <= broadcast_bytes:
        held = q.toArrow()
        shared = q.sparkSession.sparkContext.broadcast((_names(held.column(0)), fit(matrix_of(held.column(1)))))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, matrix = shared.value
            lead = Leaders(names, matrix, k, exclude_self)
            for batch in batches:
                if batch.num_rows:
                    lead.add(_names(batch.column(0)), fit(matrix_of(batch.column(1))))
            yield from lead.table(schema).to_batches()

        found = i.mapInArrow(scan, out)
    else:
        # Blocks travel in tiles, so that a vector is sent once per tile of the other side and not once per block.
        m, cores = i.count(), q.sparkSession.sparkContext.defaultParallelism
        most, least = max(block, TILE_BYTES // (8 * max(d, 1))), math.isqrt(2 * cores) + 1
        qn, im = (min(max(1, -(-rows // block)), max(least, -(-rows // most))) for rows in (n, m))
        qb = q.withColumn("_q", F.pmod(F.xxhash64("query"), F.lit(qn)).cast("int")).withColumn(
            "_i", F.explode(F.sequence(F.lit(0), F.lit(im - 1)))
        )
        ib = i.withColumn("_i", F.pmod(F.xxhash64("item"), F.lit(im)).cast("int")).withColumn(
            "_q", F.explode(F.sequence(F.lit(0), F.lit(qn - 1)))
        )
        found = _cogroup(qb, ib, k, exclude_self, fit, schema, out)
    return top_per_group(found, ["query"], [by_score(), F.asc("item")], k)


def by_score(score: str = "score") -> Column:
    return F.desc(F.round(score, PLACES))


def _cogroup(qb: DataFrame, ib: DataFrame, k: int, skip_self: bool, fit, schema: pa.Schema, out: str) -> DataFrame:
    """Best k per query of each (_q, _i) block pair."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        lead = Leaders(_names(left.column("query")), fit(matrix_of(left.column("vec"))), k, skip_self)
        lead.add(_names(right.column("item")), fit(matrix_of(right.column("vec"))))
        return lead.table(schema)

    return qb.groupBy("_q", "_i").cogroup(ib.groupBy("_q", "_i")).applyInArrow(run, out)


def _planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((tables, bits, dim))


def _signed(df: DataFrame, key: str, bits: int, tables: int, seed: int) -> DataFrame:
    """One row per (key, hash table): the sign pattern against the seeded planes."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, vec array<double>, bucket array<bigint>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = matrix_of(batch.column(1))
            planes = _planes(matrix.shape[1], bits, tables, seed)
            codes = [((matrix @ p.T) > 0) @ weights + (t << bits) for t, p in enumerate(planes)]
            flat = np.stack(codes, axis=1).astype("int64")
            spans = pa.array(np.arange(0, flat.size + 1, tables, dtype="int32"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(spans, pa.array(flat.ravel()))],
                names=[key, "vec", "bucket"],
            )

    return df.mapInArrow(sign, schema).withColumn("_q", F.explode("bucket")).drop("bucket")


def ann(
    queries: DataFrame, items: DataFrame, k: int, query_key: str = "query", item_key: str = "item",
    vec: str = "vec", metric: str = "cosine", bits: int | None = None, tables: int = 8, seed: int = 7,
    exclude_self: bool = False, block: int = BLOCK,
) -> DataFrame:
    """Approximate neighbours: sign buckets, then exact scores inside a shared bucket.

    A bucket of any size is cut into blocks of about ``block`` items and its queries go
    to each of them, so a bucket that holds a third of the items is many bounded tasks.
    Without ``bits`` there are as many as keep a bucket of a table at about 64 items.
    """
    held = _prepare(items, item_key, vec, "item")
    if bits is None:
        bits = max(1, (held.count() // 64).bit_length())
    q = _signed(_prepare(queries, query_key, vec, "query"), "query", bits, tables, seed)
    i = _signed(held, "item", bits, tables, seed)
    cuts = i.groupBy("_q").agg(F.ceil(F.count("*") / block).cast("int").alias("_cuts"))
    # One row per bucket: at most tables * 2^bits of them.
    cuts = F.broadcast(cuts)
    ib = i.join(cuts, "_q").withColumn(
        "_i", F.pmod(F.xxhash64("item", F.lit(seed)), F.col("_cuts")).cast("int")
    )
    qb = q.join(cuts, "_q").withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
    fit = _unit if metric == "cosine" else (lambda m: m)
    schema = pa.schema([
        ("query", _arrow_type(q.schema["query"].dataType.simpleString())),
        ("item", _arrow_type(i.schema["item"].dataType.simpleString())),
        ("score", pa.float64()),
    ])
    out = f"query {q.schema['query'].dataType.simpleString()}, item {i.schema['item'].dataType.simpleString()}, score double"
    found = _cogroup(
        qb.drop("_cuts"), ib.drop("_cuts"), k, exclude_self, fit, schema, out
    ).groupBy("query", "item").agg(F.max("score").alias("score"))
    return top_per_group(found, ["query"], [by_score(), F.asc("item")], k)


def ann_recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that the approximate search found."""
    hits = approximate.select("query", "item").withColumn("hit", F.lit(1))
    joined = exact.select("query", "item").join(hits, ["query", "item"], "left")
    return joined.agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def centroids(likes: DataFrame, emb: DataFrame, user: str = "user", item: str = "item",
              vec: str = "vec", weight: str | None = None) -> DataFrame:
    """(user, vec): mean of the vectors of a user's items, optionally times their rating.

    The weighted form is sum(r * v) / count, so cosine search is unaffected by the scale.
    The sums are added per component, which combines on the map side for any user.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    parts = likes.select(user, item, w.alias("_w")).join(emb.select(item, vec), item).select(
        user, "_w", F.posexplode(vec).alias("_at", "_x")
    )
    means = parts.groupBy(user, "_at").agg(F.avg(F.col("_w") * F.col("_x").cast("double")).alias("_m"))
    return means.groupBy(user).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", "_m"))), lambda s: s["_m"]).alias(vec)
    )


def centroid_search(likes: DataFrame, emb: DataFrame, k: int = 1, user: str = "user", item: str = "item",
                    vec: str = "vec", weight: str | None = None, metric: str = "cosine") -> DataFrame:
    """Items nearest to the (weighted) mean of what a user liked."""
    return knn(centroids(likes, emb, user, item, vec, weight), emb, k, user, item, vec, metric)


def per_item_search(likes: DataFrame, emb: DataFrame, k: int = 1, user: str = "user", item: str = "item",
                    rating: str = "rating", vec: str = "vec") -> DataFrame:
    """For each liked item its nearest other item; the k least distance/rating per user.

    The nearest item does not depend on the user, so it is found once per distinct liked
    item and joined back. An item reached twice keeps its smaller value. A rating of 0 puts
    the other item infinitely far away, or at NaN if its distance is 0 too: after all others.
    """
    sources = emb.join(likes.select(item).distinct(), item, "left_semi")
    near = knn(sources, emb, 1, item, item, vec, "cosine", exclude_self=True).select(
        F.col("query").alias(item), F.col("item").alias("candidate"), (1 - F.col("score")).alias("distance")
    )
    rated = F.col(rating).cast("double")
    far = F.when(F.round("distance", PLACES) > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    scored = likes.join(near, item).withColumn(
        "value", F.when(rated == 0, far).otherwise(F.try_divide(F.col("distance"), rated)))
    each = scored.groupBy(user, "candidate").agg(F.min("value").alias("value"))
    return top_per_group(each, [user], [F.asc("value"), F.asc("candidate")], k)
