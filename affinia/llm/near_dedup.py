"""MinHash near-dedup by SetSketch registers.

A register holds the floor of the logarithm (base ``BASE``, a little over 1) of the
smallest of the exponentially spread hashes of a set, truncated to a fixed range. It
merges by maximum, and two sets agree in a register with a probability that follows
their similarity. Bands of registers give candidates; a joint likelihood of how many
registers are smaller, equal and larger estimates the similarity and drops the
hopeless ones; what is left is confirmed on the full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm import graph
from affinia.llm.hashing import LOWER, M1, STEP, mix, shingle_sets, word_hashes
from affinia.llm.tables import blocks, free_name, row_key, utf8, written
from affinia.operators.sizes import broadcast_if_small

BASE = 1.02
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
#: Registers run from 0 to LEVELS; they cover minima from 20 down to 2 ** -32.
LEVELS = int(math.log(2**32, BASE)) + int(math.log(20, BASE)) + 2
#: Words of 64 bits of an odd sketch, which bounds the difference of two sets from below.
ODD = 16
#: Estimates this far below the threshold are six standard deviations away.
MARGIN = 0.2

_seeds = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * STEP)
_FACTORS = (_seeds[:REGISTERS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_seeds[REGISTERS:] >> np.uint64(32)).astype(np.uint32)
_BAND_SEEDS = mix(np.arange(7001, 7001 + BANDS, dtype=np.uint64))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers, one row per set of 64-bit hashes; an empty set has zeros."""
    low = np.full((len(sets), REGISTERS), np.uint32(0xFFFFFFFF))
    for i, items in enumerate(sets):
        short = (items >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(short), 512):
            spread = np.multiply.outer(_FACTORS, short[at:at + 512])
            spread += _SHIFTS[:, None]
            np.minimum(low[i], spread.min(axis=1), out=low[i])
    # The minimum of uniform hashes, as the minimum of exponential ones.
    h = -np.log1p(-(low + 0.5) / 2.0**32)
    k = np.floor(1 - np.log(h) / math.log(BASE)) + int(math.log(20, BASE))
    k = np.clip(k, 1, LEVELS).astype(np.uint16)
    k[[len(s) == 0 for s in sets]] = 0
    return k


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of the sets behind ``a`` and ``b``."""
    return np.maximum(a, b)


def band_keys(k: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, of its number and its registers."""
    parts = k.reshape(len(k), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(_BAND_SEEDS, (len(k), BANDS)).copy()
    for r in range(ROWS):
        keys = mix(keys * STEP + parts[:, :, r])
    return keys


def likely_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The Jaccard similarity under which the registers' order is likeliest, row by row.

    Of all registers, ``less`` are smaller in a, ``more`` are larger and the rest are
    equal. With u and v the shares of both set sizes, a register is larger in a with
    probability p(u - v * J) and smaller with p(v - u * J), where
    p(x) = -log_base(1 - x * (base - 1) / base). The sizes are known, so that J is the
    only unknown; it is looked for on a grid.
    """
    less, more = (a < b).sum(axis=1)[:, None], (a > b).sum(axis=1)[:, None]
    same = a.shape[1] - less - more
    u = (na / (na + nb))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-9
    score = more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, tiny))
    return j[np.arange(len(j)), score.argmax(axis=1)]


def odd_sketch(items: np.ndarray) -> np.ndarray:
    """One bit per residue of the hashes, set if an odd number of items has it.

    Items in both of two sets cancel out, so two sketches differ in at most as many bits
    as the sets differ in items: a pair whose sketches differ too much is no link.
    """
    odd = np.bincount((items % np.uint64(64 * ODD)).astype(np.int64), minlength=64 * ODD) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_key(items: np.ndarray) -> int:
    """A key of a whole set; equal sets have equal keys, the empty set has 0."""
    if len(items) == 0:
        return 0
    parts = mix(items ^ M1)
    key = mix(parts.sum(dtype=np.uint64, keepdims=True) + np.array([len(items)], np.uint64) * STEP)
    return int(key.view(np.int64)[0]) or 1


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in blocks(offsets):
                piece = LOWER[data[offsets[i]:offsets[j]]]
                sets = shingle_sets(*word_hashes(piece, offsets[i:j + 1] - offsets[i]), size)
                keys = band_keys(registers(sets)).view(np.int64)
                lengths = np.array([len(s) for s in sets])
                at = np.concatenate([[0], np.cumsum(np.where(lengths > 0, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(lengths, pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(keys[lengths > 0].ravel())),
                ], names=["doc_id", "n_shingles", "set_key", "bands"])
    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in blocks(offsets):
                piece = LOWER[data[offsets[i]:offsets[j]]]
                sets = shingle_sets(*word_hashes(piece, offsets[i:j + 1] - offsets[i]), size)
                sketch = registers(sets)
                yield pa.RecordBatch.from_arrays([
                    pa.array([set_key(s) for s in sets], pa.int64()),
                    pa.array([k.tobytes() for k in sketch], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([odd_sketch(s) for s in sets], pa.list_(pa.int64())),
                ], names=["node", "sketch", "items", "odd"])
    return run


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, items = batch.column(0), batch.column(1).to_pylist()
        lengths = np.array([len(x) // 8 for x in items])
        for at in range(0, len(items), 256):
            repeated = np.repeat(np.arange(at, at + len(lengths[at:at + 256])), lengths[at:at + 256])
            yield pa.RecordBatch.from_arrays([
                nodes.take(pa.array(repeated)), pa.array(np.frombuffer(b"".join(items[at:at + 256]), np.int64))],
                names=["node", "item"])


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [batch.column(k) for k in (0, 1)]
            sketch = [
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (2, 3)
            ]
            sets = [[np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(k)] for k in (4, 5)]
            sizes = [np.array([len(s) for s in side], dtype=np.float64) for side in sets]
            likely = likely_similarity(*sketch, *sizes) >= percent / 100 - MARGIN
            linked = np.zeros(batch.num_rows, dtype=bool)
            for r in np.flatnonzero(likely):
                a, b = sets[0][r], sets[1][r]
                both = len(a) + len(b) - len(np.union1d(a, b))
                linked[r] = 100 * both >= percent * (len(a) + len(b) - both)
            mask = pa.array(linked)
            yield pa.RecordBatch.from_arrays([ids[0].filter(mask), ids[1].filter(mask)], names=["a", "b"])
    return run


def _candidates(open_keys: DataFrame, members: DataFrame, sets: DataFrame, sample: int | None, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of one band key that are not known to be linked yet.

    Nodes outside the key's largest component ask the ``sample`` nodes of the key whose
    hash is smallest (None: all nodes). The hash is of the node alone, so that the many
    keys of one group of copies choose the same few nodes. From the second round on, a
    pair whose odd sketches already differ in more bits than a link's sets may differ in
    items is left out by the join itself.
    """
    rows = members.join(open_keys, "key")
    if sample != 1:
        rows = rows.join(sets.select("node", "odd"), "node")
    asking = rows.where("component <> largest")
    if sample == 1:
        asked = open_keys.select("key", F.col("hub.node").alias("node2"), F.col("hub.component").alias("component2"),
                                 F.col("hub.n_items").alias("n2"), F.col("hub.n_shared").alias("s2"))
    else:
        chosen = rows if sample is None else rows.where(
            F.xxhash64("node") / F.lit(2.0**64) + 0.5 <= F.lit(float(sample)) / F.col("n_nodes"))
        asked = chosen.select("key", F.col("node").alias("node2"), F.col("component").alias("component2"),
                              F.col("n_items").alias("n2"), F.col("n_shared").alias("s2"), F.col("odd").alias("odd2"))
    # An intersection is at most the smaller set, and at most what either set shares with any other.
    possible = (
        (F.col("component") != F.col("component2"))
        & (F.lit(100) * F.least("n_items", "n2") >= F.lit(percent) * F.greatest("n_items", "n2"))
        & (F.lit(100 + percent) * F.least("n_shared", "s2") >= F.lit(percent) * (F.col("n_items") + F.col("n2"))))
    if sample != 1:
        differ = sum((F.bit_count(F.col("odd")[k].bitwiseXOR(F.col("odd2")[k])) for k in range(ODD)), F.lit(0))
        possible &= F.lit(100 + percent) * differ <= F.lit(100 - percent) * (F.col("n_items") + F.col("n2"))
    pairs = asking.drop("largest", "n_nodes", "hub").join(asked, "key").where(possible)
    return pairs.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def _relabelled(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after further links, found between the components there are."""
    if labels is None:
        return graph.components(links, "a", "b")
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), "component")
        links = links.join(own, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    merged = written(graph.components(links, "a", "b"), "merged")
    into = merged.select(F.col("node").alias("component"), F.col("component").alias("root"))
    kept = labels.join(into, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return kept.unionByName(merged.join(labels.select("node"), "node", "left_anti"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Words are lower-cased in A-Z and split at white space; a document is the set of its
    distinct ``shingle``-word shingles (one of the whole sequence if it is shorter).
    Documents are linked where 100 * intersection >= percent * union; component_id is
    the smallest id that links reach, and kept says that it is the row's own.

    Equal sets become one node first, so copies cost one row each. A band key shared by
    many nodes is resolved in four rounds: in each one, the nodes outside the largest
    component of the key are compared with more of its nodes (1, 8, 128, all), and what
    has been linked by then is not compared again. The last round leaves no pair of
    different components untried, and no key is gathered into one task.

    Null and empty texts and texts of white space have no shingles and are linked with
    nothing. Rows without an id are linked with nothing, have a null component_id and
    are kept. Repeated rows each come back, with the same component. Columns other than
    the two named are ignored; an empty table gives no rows.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = written(source.mapInArrow(
        _sketch(shingle), "doc_id bigint, n_shingles bigint, set_key bigint, bands array<bigint>"), "sketches")
    banded = sketched.where("doc_id is not null and n_shingles > 0").select(
        F.col("set_key").alias("node"), F.col("n_shingles").alias("n_items"), F.explode("bands").alias("key"))
    crowded = banded.groupBy("key").agg(F.min("node").alias("_low"), F.max("node").alias("_high"))
    crowded = crowded.where("_low <> _high").select("key")
    members = written(banded.join(crowded, "key").distinct(), "members")
    nodes = members.select("node").distinct()
    named = sketched.where("doc_id is not null").groupBy(F.col("set_key").alias("node")).agg(
        F.min("doc_id").alias("doc_id"))
    chosen = named.join(nodes, "node", "left_semi").select("doc_id")
    texts = source.join(chosen, "doc_id", "left_semi").select("text")
    sets = written(texts.mapInArrow(_full_sets(shingle), "node bigint, sketch binary, items binary, odd array<bigint>").join(
        nodes, "node", "left_semi").dropDuplicates(["node"]), "sets")
    # Shingles of one candidate alone are in no intersection: what is left bounds them all.
    single = sets.select("node", "items").mapInArrow(_items, "node bigint, item bigint").groupBy("item").agg(
        F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    lone = single.groupBy("node").agg(F.count("*").alias("lone"))
    members = members.join(lone, "node", "left").withColumn("n_shared", F.col("n_items") - F.coalesce("lone", F.lit(0)))
    members = written(members.where(F.lit(100) * F.col("n_shared") >= F.lit(percent) * F.col("n_items")).drop("lone"), "members")
    labels = tried = None
    labelled = members.withColumn("component", F.col("node"))
    for sample in (1, 8, 128, None):
        sizes = labelled.groupBy("key", "component").agg(
            F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node").alias("h"), "node", "component", "n_items", "n_shared")).alias("hub"))
        keys = sizes.groupBy("key").agg(
            F.max(F.struct("n", "component")).alias("_top"), F.sum("n").alias("n_nodes"),
            F.count("*").alias("_parts"), F.min("hub").alias("hub"))
        open_keys = keys.where("_parts > 1").select(
            "key", F.when(F.lit(sample == 1), F.col("hub.component")).otherwise(F.col("_top.component")).alias("largest"),
            "n_nodes", "hub")
        pairs = _candidates(open_keys, labelled, sets, sample, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            continue
        one = sets.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"), F.col("items").alias("items_a"))
        two = sets.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"), F.col("items").alias("items_b"))
        found = pairs.join(one, "a").join(two, "b").select("a", "b", "sketch_a", "sketch_b", "items_a", "items_b")
        found = written(found.mapInArrow(_confirm(percent), "a bigint, b bigint"), "confirmed")
        tried = pairs if tried is None else tried.unionByName(pairs)
        if found.isEmpty():
            continue
        labels = written(_relabelled(labels, found), "labels")
        labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if labels is None:
        roots = named.select("node", F.col("doc_id").alias("component_id"))
    else:
        groups = named.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        lowest = groups.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        roots = groups.join(lowest, "component").select("node", "component_id")
    out = sketched.select("doc_id", "n_shingles", F.col("set_key").alias("node")).join(roots, "node", "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    out = out.withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one row of each group of near duplicates left.

    Rows are judged by their own text, whatever their id: rows of one id with unlike texts
    both stay, and rows without an id are compared as any other. Of a group the row of the
    smallest id stays (rows without one come last); of exact repeats of that row, one.
    Texts without a word all stay.

    Only the keys of the rows that go travel, so that texts are not shuffled where the
    measured size of the keys allows a broadcast.
    """
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    found = near_duplicates(keyed, id_col=key, shingle=shingle, percent=percent).where("n_shingles > 0")
    found = written(found.select(F.col("doc_id").alias(key), "component_id"), "groups")
    grouped = found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    crowded = found.join(grouped, "component_id", "left_semi")
    ids = keyed.select(key, "doc_id").join(crowded.select(key).distinct(), key, "left_semi").distinct()
    first = crowded.join(ids, key).groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key))[key].alias("first"))
    stay = first.select(F.col("first").alias(key))
    gone = written(crowded.select(key).distinct().join(stay, key, "left_anti"), "near-copies")
    repeated = written(found.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), "repeats")
    left = keyed.join(broadcast_if_small(gone), key, "left_anti")
    again = broadcast_if_small(repeated)
    once = left.join(again, key, "left_anti")
    return once.unionByName(left.join(again, key, "left_semi").dropDuplicates([key])).select(*docs.columns)
