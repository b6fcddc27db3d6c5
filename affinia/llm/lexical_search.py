"""Ranked lexical search by one Aho-Corasick scan of the documents, without an index of them.

The terms of all items form an automaton that is broadcast, each term between two guards
(spaces), so that it is only found as a whole term. In a text every byte that belongs to no
term becomes a space; then the automaton's outputs are exactly the occurrences of item
terms. What a scan finds per document (ids and counts of item terms) is written once; the
document frequencies are sums over it, and a second pass maps the automaton's outputs to
items, adds up scores and keeps the best of each item per task.

The automaton is bounded: items are dealt out to groups by their measured bytes, and each
group of items has its own automaton and scan.

Odd rows: a null text has no terms. Every row is a document of its own; a null doc_id ranks
after all others of its score. Items of one item_id (null included) are one item with the
terms of all its rows. Items and documents without terms are in no result. Other columns
are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.hashing import Kept
from affinia.llm.tables import blocks, utf8, written
from affinia.operators.indexing import top_per_group
from affinia.operators.sizes import measured_bytes, spread

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a term consists of: ASCII digits and letters, and every character beyond ASCII.
TERM = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
SPACE = 0x20
#: Every byte of a text as the automaton sees it.
SEEN = np.full(256, SPACE, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    SEEN[_first:_last + 1] = np.arange(_first, _last + 1)
SEEN[0x41:0x5B] = np.arange(0x61, 0x7B)

#: Bytes of item terms that one automaton holds.
GROUP_BYTES = 16 << 20
#: Bytes of text that one pass of the automaton reads, and cells of a block of scores.
PIECE, CELLS = 1 << 20, 1 << 21
#: First-level groups of the best rows of an item, so that no task gets those of all tasks.
SPLITS = 64
_EVENT = np.dtype([("end", np.int64), ("term", np.int64)])

_kept = Kept()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once."""
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    return items.select("item_id", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(1))).alias("term")).distinct()


def build(terms: list[str]):
    """The automaton of the guarded terms; its outputs are their places in the list."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for at, term in enumerate(terms):
        found.add_word(" " + term.encode().decode("latin-1") + " ", at)
    found.make_automaton()
    return found


def pieces(seen: np.ndarray, size: int = PIECE) -> Iterator[str]:
    """A guarded text in parts that end at a guard, with which the next one begins."""
    first = 0
    while first < len(seen) - 1:
        last = min(first + size, len(seen))
        while seen[last - 1] != SPACE:
            gap = np.flatnonzero(seen[last:last + size] == SPACE)
            last = last + int(gap[0]) + 1 if len(gap) else min(last + size, len(seen))
        yield seen[first:last].tobytes().decode("latin-1"), first
        first = last - 1


def count_terms(automaton, n_terms: int, data: np.ndarray, offsets: np.ndarray):
    """(terms per text, text of each count, term, count) of a block of texts, in order."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    seen = np.full(len(data) + n + 1, SPACE, np.uint8)
    seen[np.arange(len(data)) + np.repeat(np.arange(n), lengths) + 1] = SEEN[data]
    first = np.flatnonzero((seen[1:] != SPACE) & (seen[:-1] == SPACE)) + 1
    starts = offsets[:-1] + np.arange(n) + 1  # of each text in ``seen``
    totals = np.bincount(np.searchsorted(starts, first, side="right") - 1, minlength=n)
    keys, counts = [], []
    if n_terms:
        for piece, at in pieces(seen):
            events = np.fromiter(automaton.iter(piece), dtype=_EVENT)
            text = np.searchsorted(starts, events["end"] + at - 1, side="right") - 1  # the end is a guard
            key, count = np.unique(text * n_terms + events["term"], return_counts=True)
            keys.append(key)
            counts.append(count)
    if not keys:
        return totals, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.zeros(len(key), np.int64)
    np.add.at(count, at, np.concatenate(counts))
    return totals, key // n_terms, key % n_terms, count


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _scan(shared) -> Callable:
    name = uuid.uuid4().hex  # a process builds an automaton once, not once per task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        if name not in _kept:
            _kept.clear()
            _kept[name] = build(terms)
        automaton = _kept[name]
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for first, last in blocks(offsets, PIECE):
                own = offsets[first:last + 1]
                n, text, term, count = count_terms(automaton, len(terms), data[own[0]:own[-1]], own - own[0])
                sizes = np.bincount(text, minlength=last - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(n.astype(np.int64)), _lists(sizes, term),
                     _lists(sizes, count)], names=["doc_id", "n", "terms", "counts"])

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of each batch hold a term; -1 stands for documents with any term, -2 for all their terms."""
    for batch in batches:
        n = batch.column("n").to_numpy(zero_copy_only=False)
        term, held = np.unique(batch.column("terms").flatten().to_numpy(zero_copy_only=False), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1, -2], term]).astype(np.int32)),
             pa.array(np.concatenate([[np.count_nonzero(n), n.sum()], held]).astype(np.int64))], names=["term", "held"])


def weights(held: np.ndarray, docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * docs + 2) / (2.0 * held + 1))).astype(np.int64)


class Best:
    """The best ``k`` rows of every item among those seen so far."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)
        self.rows = tuple(np.zeros(0, np.int64) for _ in range(4))  # item, score, without id, id

    def add(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            place = len(scores) - self.k
            self.floor = np.maximum(self.floor, np.partition(scores, place, axis=0)[place])
        doc, item = np.nonzero(scores >= self.floor)
        if not len(doc):
            return
        new = item, scores[doc, item], no_id[doc], ids[doc]
        rows = [np.concatenate(pair) for pair in zip(self.rows, new)]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = [r[order] for r in rows]
        place = np.arange(len(order)) - np.searchsorted(rows[0], rows[0])
        rows = [r[place < self.k] for r in rows]
        place = place[place < self.k]
        full = place == self.k - 1
        self.floor[rows[0][full]] = np.maximum(self.floor[rows[0][full]], rows[1][full])
        self.rows = tuple(rows)


def _rank(shared, schema: pa.Schema, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, starts, items, weight, docs, total = shared.value
        best, n_items = Best(len(item_ids), k), max(len(item_ids), 1)
        each = max(CELLS // n_items, 1)
        degree = np.diff(starts)
        for whole in batches:
            for at in range(0, whole.num_rows, each):
                batch = whole.slice(at, each)
                n = batch.column("n").to_numpy(zero_copy_only=False)
                m = 10 + (90 * n * docs) // max(total, 1)
                sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
                term = batch.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(len(n)), sizes)
                gain = weight[term] * ((1000000000 * tf) // (1000 * tf + 8 * m[doc]))
                scores = np.zeros(len(n) * n_items, np.int64)
                for lo, hi in _runs(degree[term]):
                    of = degree[term[lo:hi]]
                    place = np.arange(of.sum()) - np.repeat(np.cumsum(of) - of, of) + np.repeat(starts[term[lo:hi]], of)
                    np.add.at(scores, np.repeat(doc[lo:hi], of) * n_items + items[place], np.repeat(gain[lo:hi], of))
                ids = batch.column("doc_id")
                best.add(scores.reshape(len(n), n_items), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                         ids.fill_null(0).to_numpy(zero_copy_only=False))
        item, score, no_id, ids = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([item_ids[i] for i in item.tolist()], schema.field("item_id").type),
             pa.array(ids, schema.field("doc_id").type, mask=no_id == 1), pa.array(score)], schema=schema)

    return run


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges whose sizes sum to about ``CELLS``."""
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + CELLS, side="right")), first + 1)
        yield first, last
        first = last


def _search_group(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    # A group of items: about GROUP_BYTES, or one item alone.
    held = pairs.toArrow()
    if not held.num_rows:
        return spark.createDataFrame([], f"item_id {pairs.schema['item_id'].dataType.simpleString()}, doc_id bigint, score bigint")
    names, term = np.unique(np.array(held.column("term").to_pylist(), dtype=object), return_inverse=True)
    item_ids = list(dict.fromkeys(held.column("item_id").to_pylist()))
    number = {v: i for i, v in enumerate(item_ids)}
    item = np.array([number[v] for v in held.column("item_id").to_pylist()], dtype=np.int64)
    order = np.argsort(term, kind="stable")
    starts = np.searchsorted(term[order], np.arange(len(names) + 1))
    # Written once, as both the frequencies and the scores are read from it.
    counted = written(
        docs.mapInArrow(_scan(spark.sparkContext.broadcast(names.tolist())),
                        "doc_id bigint, n bigint, terms array<int>, counts array<int>"), "terms-found")
    sums = counted.mapInArrow(_frequencies, "term int, held bigint").groupBy("term").agg(F.sum("held").alias("held"))
    got = dict(sums.collect())  # one row per term of the group
    frequency = np.array([got.get(i, 0) for i in range(len(names))], dtype=np.int64)
    n, total = got.get(-1, 0), got.get(-2, 0)
    shared = spark.sparkContext.broadcast((item_ids, starts, item[order], weights(frequency, n), n, total))
    kind = held.schema.field("item_id").type
    schema = pa.schema([("item_id", kind), ("doc_id", pa.int64()), ("score", pa.int64())])
    spark_kind = pairs.schema["item_id"].dataType.simpleString()
    return counted.mapInArrow(_rank(shared, schema, k), f"item_id {spark_kind}, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, scores above 0."""
    pairs = written(item_terms(items), "item-terms")
    groups = -(-measured_bytes(pairs) // group_bytes)
    docs = spread(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    kind = pairs.schema["item_id"].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"item_id {kind}, doc_id bigint, score bigint")
    for g in range(groups):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g)
        found = found.unionByName(_search_group(docs, own, k))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    split = F.pmod(F.spark_partition_id(), F.lit(SPLITS))
    first = top_per_group(found.withColumn("split", split), ["item_id", "split"], order, k).drop("rank")
    return top_per_group(first, ["item_id"], order, k).select("item_id", "rank", "doc_id", "score")
