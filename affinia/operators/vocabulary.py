"""Dictionary lookup inside Arrow batches: tokens keep their order and nothing is regrouped.

A vocabulary is sent to the executors as a table sorted by a 64-bit hash of the tokens,
with the tokens themselves for an exact comparison. A batch is encoded into its distinct
tokens first, so that each is looked up once. On top of it stand the documents' index
lists, their tf-idf weights and the windowed co-occurrence, each of which needs no shuffle
of tokens; co-occurrence sends sums of pairs, added up over many batches and packed by
their larger index, of which a task adds up one share at a time.

The vocabulary is broadcast only up to a measured size. Beyond it the same results come
from the joins of ``dictionary``, ``documents`` and ``cooccurrence``.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.functions.text import MINHASH_BUCKETS, STOPWORDS
from affinia.operators import cooccurrence, documents
from affinia.operators.dictionary import lookup_title_index
from affinia.operators.sizes import measured_bytes

#: Most bytes of tokens, hashes and numbers that are broadcast.
BROADCAST_BYTES = 256 << 20
#: Tokens whose pairs are formed at once.
STEP = 1 << 18
#: Sums of pairs that a task holds before it sends them, and shares of the larger indices.
HELD, SHARES = 1 << 22, 4096
_BASE = 0x9E3779B97F4A7C15 | 1


def hashes(tokens: pa.Array) -> np.ndarray:
    """A 64-bit hash of every token: a polynomial in its bytes, mixed."""
    tokens = tokens.cast(pa.large_string())
    if not len(tokens):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset:tokens.offset + len(tokens) + 1]
    held = tokens.buffers()[2]
    data = (np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8))[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    up, down = (np.full(len(data) + 1, base, np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    np.cumprod(up, out=up)
    np.cumprod(down, out=down)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    x = (total[offsets[1:]] - total[offsets[:-1]]) * down[offsets[:-1]]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def bucket(token: str) -> int:
    """The bucket of a token outside the dictionary, as ``functions.text.minhash_bucket`` has it."""
    raw = token.encode()
    if len(token) <= 4:
        return zlib.crc32(raw) & 65535
    return min(zlib.crc32(raw[at:at + 4]) & 65535 for at in range(max(1, min(10, len(token)) - 4)))


@dataclass
class Table:
    """What the executors get: tokens in order of their hash, and their dictionary numbers."""

    name: str
    size: int
    hash: np.ndarray
    tokens: pa.Array
    index: np.ndarray

    @staticmethod
    def of(tokens: pa.Array, index: np.ndarray) -> Table:
        own = hashes(tokens)
        order = np.argsort(own, kind="stable")
        return Table(uuid.uuid4().hex, len(own), own[order], tokens.take(pa.array(order)), index[order])

    def find(self, tokens: pa.Array) -> np.ndarray:
        """Dictionary numbers; -1 for tokens that are not in it."""
        out = np.full(len(tokens), -1, np.int64)
        if not self.size or not len(tokens):
            return out
        own = hashes(tokens)
        at = np.searchsorted(self.hash, own)
        # Almost always one round: only tokens of one hash stand next to each other.
        left = np.arange(len(own))
        while len(left):
            left = left[(at[left] < self.size) & (self.hash[np.minimum(at[left], self.size - 1)] == own[left])]
            same = pc.equal(tokens.take(pa.array(left)), self.tokens.take(pa.array(at[left]))).to_numpy(zero_copy_only=False).astype(bool)
            out[left[same]] = self.index[at[left[same]]]
            left = left[~same]
            at[left] += 1
        return out

    def embed(self, tokens: pa.Array, hashed: bool = True) -> np.ndarray:
        """1 + dictionary number; unknown ones a bucket past the dictionary, or -1 if they are not ``hashed``."""
        found = self.find(tokens)
        out = np.where(found >= 0, found + 1, -1)
        if hashed:
            unknown = np.flatnonzero(found < 0)
            for at, token in zip(unknown, tokens.take(pa.array(unknown)).to_pylist()):
                out[at] = self.size + 1 + bucket(token)
        return out


def vocabulary(dictionary: DataFrame, limit: int = BROADCAST_BYTES):
    """The broadcast table of a dictionary (token, index); None where its measured size is beyond the limit."""
    rows = dictionary.select("token", F.col("index").cast("bigint").alias("index"))
    if 2 * measured_bytes(rows) > limit:
        return None
    held = rows.toArrow().combine_chunks()
    tokens = held.column("token").combine_chunks() if held.num_rows else pa.array([], pa.string())
    table = Table.of(tokens, held.column("index").to_numpy())
    return dictionary.sparkSession.sparkContext.broadcast(table)


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All tokens of a batch, and the row of each; null lists and tokens are left out."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat, row = lists.flatten(), np.repeat(np.arange(len(lists)), sizes)
    if flat.null_count:
        there = flat.is_valid()
        flat, row = flat.filter(there), row[there.to_numpy(zero_copy_only=False)]
    return flat, row


def _embedded(lists: pa.Array, table: Table, hashed: bool) -> tuple[np.ndarray, np.ndarray]:
    """(number of every token, its row), in order."""
    flat, row = _flat(lists)
    coded = flat.dictionary_encode()
    return table.embed(coded.dictionary, hashed)[coded.indices.to_numpy(zero_copy_only=False)], row


def _kind(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)


def index_tokens(docs: DataFrame, words, keep: list[str], tokens: str = "tokens", name: str = "token_index", hashed: bool = True) -> DataFrame:
    """The kept columns and the ordered dictionary numbers of every row's tokens.

    With ``hashed`` they are embedding numbers, unknown tokens in buckets past the
    dictionary; without, plain dictionary numbers, and unknown tokens are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row = _embedded(batch.column(tokens), words.value, hashed)
            if not hashed:
                ids, row = ids[ids > 0] - 1, row[ids > 0]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], lists], names=[*keep, name])

    return docs.select(*keep, tokens).mapInArrow(run, f"{_kind(docs, keep)}, {name} array<bigint>")


def txt2url(docs: DataFrame, tokens: DataFrame, titles: DataFrame, key: str = "url") -> DataFrame:
    """(key, primary_index, token_index) as ``documents.txt2url``; documents without a token are left out."""
    words = vocabulary(tokens)
    if words is None:
        return documents.txt2url(docs, tokens, titles, key)
    placed = lookup_title_index(docs.where(F.size("tokens") > 0).withColumnRenamed("primary", "title"), titles)
    return index_tokens(placed.select(key, F.col("title_index").alias("primary_index"), "tokens"), words, [key, "primary_index"])


def tfidf(docs: DataFrame, dictionary: DataFrame, key: str = "doc_id", stop: list[str] = STOPWORDS) -> DataFrame:
    """(key, index, weight) as ``documents.tfidf``, with a document's counts, weights and norm made in its row.

    A key stands in one row of ``docs``.
    """
    words = vocabulary(dictionary)
    if words is None:
        return documents.tfidf(docs, dictionary, key, stop)
    held = dictionary.select("index", "doc_frequency").toArrow()  # two numbers per token of the vocabulary
    frequency = np.zeros(held.num_rows, np.int64)
    frequency[held.column("index").to_numpy()] = held.column("doc_frequency").to_numpy()
    idf = np.maximum(0.0, np.log(1.0 + frequency.max(initial=0)) - np.log(1.0 + frequency) + 1.0)
    numbers = docs.sparkSession.sparkContext.broadcast(idf)
    kind = _kind(docs, [key])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dropped = pa.array(stop, pa.string())
        for batch in batches:
            flat, row = _flat(batch.column("tokens"))
            coded = flat.dictionary_encode()
            number = words.value.find(coded.dictionary)
            number[pc.is_in(coded.dictionary, value_set=dropped).to_numpy(zero_copy_only=False)] = -1
            ids = number[coded.indices.to_numpy(zero_copy_only=False)]
            row, ids = row[ids >= 0], ids[ids >= 0]
            cell, tf = np.unique(row * max(len(numbers.value), 1) + ids, return_counts=True)
            row, ids = cell // max(len(numbers.value), 1), cell % max(len(numbers.value), 1)
            x = tf * numbers.value[ids]
            norm = np.sqrt(np.bincount(row, x * x, minlength=batch.num_rows))[row]
            weight = np.divide(x, norm, out=np.zeros(len(x)), where=norm > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(ids), pa.array(weight)], names=[key, "index", "weight"])

    return docs.select(key, "tokens").mapInArrow(run, f"{kind}, index bigint, weight double")


def _runs(ids: np.ndarray, row: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Parts of about ``STEP`` tokens with the window after them, and how many tokens are their own."""
    for first in range(0, len(ids), STEP):
        yield ids[first:first + STEP + window], row[first:first + STEP + window], min(STEP, len(ids) - first)


def _pairs(ids: np.ndarray, row: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(a, b, distance) of the band join; numbers below 1 keep their place and meet none."""
    for part, of, own in _runs(ids, row, window):
        for d in range(1, min(window, len(part) - 1) + 1):
            n = min(own, len(part) - d)
            a, b = part[:n], part[d:d + n]
            keep = (of[:n] == of[d:d + n]) & (a != b) & (a > 0) & (b > 0)
            if d == window:
                keep &= b > a
            yield a[keep], b[keep], d


def context_pairs(docs: DataFrame, dictionary: DataFrame, window: int = 10, tokens: str = "tokens", hashed: bool = True) -> DataFrame:
    """(a, b, d) as ``cooccurrence.context_pairs``; without ``hashed`` only pairs of known tokens."""
    words = vocabulary(dictionary)
    if words is None:
        found = cooccurrence.context_pairs(docs.withColumn("_row", F.monotonically_increasing_id()), dictionary, window, "_row", tokens)
        size = dictionary.count()
        return found if hashed else found.where((F.col("a") <= size) & (F.col("b") <= size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, d in _pairs(*_embedded(batch.column(0), words.value, hashed), window):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), d, np.int32))], names=["a", "b", "d"])

    return docs.select(tokens).mapInArrow(run, "a bigint, b bigint, d int")


def _added(keys: list[np.ndarray], units: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Every key once, in order, with the sum of its units."""
    key, unit = np.concatenate(keys), np.concatenate(units)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(unit[order], first) if len(first) else unit


def _packed(key: np.ndarray, unit: np.ndarray) -> bytes:
    """Ascending keys as their gaps, and units: lowest bytes of all first, so that leading zeros stand together."""
    planes, sizes = [], [len(key)]
    for values in (np.diff(key, prepend=0), unit):
        sizes.append((int(values.max()).bit_length() + 7) // 8)
        planes.append(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :sizes[-1]].T.tobytes())
    return np.array(sizes, "<i4").tobytes() + b"".join(planes)


def _unpacked(packed: memoryview) -> tuple[np.ndarray, np.ndarray]:
    n, *widths = np.frombuffer(packed, "<i4", 3)
    at, out = 12, []
    for width in widths:
        values = np.zeros((n, 8), np.uint8)
        values[:, :width] = np.frombuffer(packed, np.uint8, n * width, at).reshape(width, n).T
        out.append(values.view("<i8").ravel())
        at += n * width
    return np.cumsum(out[0]), out[1]


def token_cooccurrence(docs: DataFrame, dictionary: DataFrame, window: int = 10, tokens: str = "tokens", hashed: bool = True) -> DataFrame:
    """(i, j, x) with i > j, as ``cooccurrence.token_cooccurrence``; without ``hashed`` only pairs of known tokens.

    Pairs are formed and added up in the tasks as whole multiples of 1/lcm(1..window); what is
    shuffled are these sums, some bytes each.
    """
    words = vocabulary(dictionary)
    if words is None:
        found = cooccurrence.token_cooccurrence(docs.withColumn("_row", F.monotonically_increasing_id()), dictionary, window, "_row", tokens)
        return found if hashed else found.where(F.col("i") <= dictionary.count())
    scale = math.lcm(*range(1, window + 1))
    span = words.value.size + 2 + MINHASH_BUCKETS

    def send(key: np.ndarray, unit: np.ndarray) -> Iterator[pa.RecordBatch]:
        share = ((key // span * 0x9E3779B1 >> 7) % SHARES).astype(np.int16)
        order = np.argsort(share, kind="stable")
        share, key, unit = share[order], key[order], unit[order]
        first = np.flatnonzero(np.concatenate([[True], share[1:] != share[:-1]])) if len(key) else np.zeros(0, np.int64)
        sums = [_packed(key[lo:hi], unit[lo:hi]) for lo, hi in zip(first, [*first[1:], len(key)])]
        yield pa.RecordBatch.from_arrays([pa.array(share[first].astype(np.int32)), pa.array(sums, pa.binary())], names=["of_i", "sums"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, units, held = [], [], 0
        for batch in batches:
            for a, b, d in _pairs(*_embedded(batch.column(0), words.value, hashed), window):
                keys.append(np.maximum(a, b) * span + np.minimum(a, b))
                units.append(np.full(len(a), scale // d, np.int64))
                held += len(a)
                if held < 2 * HELD:
                    continue
                key, unit = _added(keys, units)
                keys, units, held = [key], [unit], len(key)
                if held >= HELD:
                    yield from send(key, unit)
                    keys, units, held = [], [], 0
        if held:
            yield from send(*_added(keys, units))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, keys, units, held = None, [], [], 0

        def end() -> Iterator[pa.RecordBatch]:
            key, unit = _added(keys, units)
            for lo in range(0, len(key), STEP):
                part = key[lo:lo + STEP]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part // span), pa.array(part % span), pa.array(unit[lo:lo + STEP])], names=["i", "j", "units"])

        for batch in batches:
            for share, packed in zip(batch.column("of_i").to_numpy(), batch.column("sums")):
                if share != of and keys:
                    yield from end()
                    keys, units, held = [], [], 0
                of = share
                key, unit = _unpacked(memoryview(packed.as_buffer()))
                keys.append(key)
                units.append(unit)
                held += len(key)
                if held >= 2 * HELD:
                    key, unit = _added(keys, units)
                    keys, units, held = [key], [unit], 0
        if keys:
            yield from end()

    sums = docs.select(tokens).mapInArrow(add_up, "of_i int, sums binary")
    ordered = sums.repartition("of_i").sortWithinPartitions("of_i")
    summed = ordered.mapInArrow(merge, "i bigint, j bigint, units bigint")
    return summed.select("i", "j", (F.col("units") / F.lit(float(scale))).alias("x"))
