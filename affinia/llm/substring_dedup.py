"""Removal of repeated byte strings by sorted suffixes at anchors.

Only suffixes at anchors travel: the anchor of a string of ``LENGTH`` bytes is the place of
its smallest hash of ``LEAD`` leading bytes, which depends on the string alone, so equal
strings meet at equal leading bytes. Neighbouring strings of one text share an anchor and
travel as one stretch: the suffix at the anchor, and what stands before it.

Splitters, sampled from the leading bytes, cut the suffixes into ranges by byte order. In a
range the suffixes are sorted by multikey quicksort (three-way, eight bytes at a time), and
so are the reversed bytes before their anchors; from the common lengths of neighbours it
follows, without another look at the bytes, which strings are equal: those that lie in one
run of both orders.

Leading bytes that many suffixes share are split over several buckets, and what such
buckets leave open is compared across their boundaries afterwards. Of a stretch that is
itself so frequent two copies per task go to its bucket: more are repeated for sure, and
are dealt out evenly.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.hashing import STEP, _tables, mix
from affinia.llm.tables import bit_filter, blocks, has_bit, utf8, written

LENGTH, LEAD = 200, 24
#: Anchors of more suffixes than this and than one in 2,000 of all are split; so at most 2,000 are.
CROWD, SHARE = 8192, 2000
_SPAN_BITS = np.uint64(24)
#: Ranges of leading bytes, and sampled leading bytes that their splitters are taken from; one anchor in RATE is offered.
RANGES, SAMPLE, RATE = 1024, 1 << 14, 64
#: Windows of a text that are looked at together; longer texts go on in the next part.
PART = 1 << 22


def _prefix(data: np.ndarray) -> np.ndarray:
    up, _ = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64, out=total[1:])
    return total


def _between(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``start`` to ``end``."""
    _, down = _tables(len(total))
    return mix((total[end] - total[start]) * down[start])


def _leads(data: np.ndarray) -> np.ndarray:
    """A hash of the LEAD bytes at every place."""
    n = len(data)
    eights = np.lib.stride_tricks.as_strided(data, (n - 7, 8), (1, 1)).copy().view("<u8").ravel()
    h = mix(eights * STEP)
    out = h[:n - LEAD + 1].copy()
    for at in range(8, LEAD, 8):
        out = out * np.uint64(0x2545F4914F6CDD1D) + h[at:at + len(out)]
    return mix(out)


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor hash, stretch hash, anchor's place) of the block's stretches.

    A stretch is a longest row of neighbouring windows of one text with one anchor.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
    if len(data) < length:
        return none
    lead = _leads(np.ascontiguousarray(data))
    places = np.arange(len(lead), dtype=np.uint64)
    packed = (lead >> _SPAN_BITS << _SPAN_BITS) | places
    low, done, width = packed, 1, length - LEAD + 1
    while done * 2 <= width:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    if width > done:
        low = np.minimum(low[:done - width], low[width - done:])
    # Windows that lie in one text, by their text.
    text = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - length + 1, 0))
    if not len(text):
        return none
    before = np.concatenate([[0], np.cumsum(np.maximum(np.diff(offsets) - length + 1, 0))])[:-1]
    window = np.arange(len(text)) - before[text] + offsets[:-1][text]
    anchor = (low[window] & ((np.uint64(1) << _SPAN_BITS) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    size = np.diff(np.append(first, len(text)))
    start, at = window[first], anchor[first]
    whole = _between(_prefix(data), start, start + size - 1 + length)
    own = mix(whole * STEP + ((at - start) * 1024 + size).astype(np.uint64))
    return text[first], start - offsets[:-1][text[first]], size, lead[at], own, at


def _parts(data: np.ndarray, offsets: np.ndarray, length: int):
    """(first text, shift of its windows, bytes, offsets) of blocks; parts of long texts overlap."""
    for i, j in blocks(offsets):
        piece, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        if len(piece) <= PART + length:
            yield i, 0, piece, own
        else:  # one long text
            for at in range(0, len(piece) - length + 1, PART):
                some = piece[at:at + PART + length - 1]
                yield i, at, some, np.array([0, len(some)])


def _count(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for _, _, piece, own in _parts(data, offsets, length):
                _, _, _, anchor, stretch, place = stretches(piece, own, length)
                offered = anchor % np.uint64(RATE) == 0
                leads = np.full(len(anchor), None, dtype=object)
                leads[offered] = [piece[p:p + LEAD].tobytes() for p in place[offered].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)), pa.array(leads, pa.binary())],
                    names=["anchor", "stretch", "lead"])
    return run


_FOUND = "part int, lead binary, bucket bigint, anchor bigint, stretch bigint, key bigint, start bigint, size bigint, at int, bytes binary"
_NAMES = ["part", "lead", "bucket", "anchor", "stretch", "key", "start", "size", "at", "bytes"]


def splitters(leads: list[bytes], weights: list[int], ranges: int = RANGES) -> list[bytes]:
    """Leading bytes at which the next range begins, so that ranges of the sample weigh the same."""
    order = sorted(range(len(leads)), key=leads.__getitem__)
    total = np.cumsum([weights[k] for k in order]) if order else np.zeros(0)
    wanted = np.arange(1, ranges) * (total[-1] / ranges) if order else []
    return sorted({leads[order[k]] for k in np.searchsorted(total, wanted).tolist()})


def _emit(length: int, filters, split: dict[int, int], frequent: list[int], cuts: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, various = filters.value
        common, told = np.array(sorted(frequent), dtype=np.int64), dict.fromkeys(frequent, 0)
        names = np.array(sorted(split), dtype=np.int64)
        ways = np.array([split[a] for a in sorted(split)], dtype=np.uint64)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for i, shift, piece, own in _parts(data, offsets, length):
                found = stretches(piece, own, length)
                keep = has_bit(repeated, found[3])
                text, start, size, anchor, stretch, place = (x[keep] for x in found)
                bucket, signed = anchor.copy(), anchor.view(np.int64)
                if len(names):
                    spot = np.minimum(np.searchsorted(names, signed), len(names) - 1)
                    hot = names[spot] == signed
                    bucket[hot] = mix(anchor[hot] * STEP + stretch[hot] % ways[spot[hot]])
                at, raw = own[:-1][text] + start, piece.tobytes()
                needed, sure = has_bit(various, anchor), np.isin(stretch.view(np.int64), common)
                for k in np.flatnonzero(sure).tolist():
                    name = int(stretch[k].view(np.int64))
                    told[name] += 1
                    sure[k] = told[name] > 2
                bucket[sure] = mix(keys[i + text][sure].view(np.uint64) * STEP + (start[sure] + shift).astype(np.uint64))
                needed &= ~sure
                content = [raw[s:s + n - 1 + length] if k else None for s, n, k in zip(at.tolist(), size.tolist(), needed.tolist())]
                leads = [raw[p:p + LEAD] for p in place.tolist()]
                # Suffixes of one range are neighbours; what is dealt out evenly belongs to none.
                part = np.array([bisect_right(cuts, lead) for lead in leads], dtype=np.int32)
                part[sure] = (bucket[sure] % np.uint64(RANGES)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(part), pa.array(leads, pa.binary()), pa.array(bucket.view(np.int64)), pa.array(signed),
                    pa.array(stretch.view(np.int64)), pa.array(keys[i + text]), pa.array(start + shift),
                    pa.array(np.where(sure, -size, size)), pa.array((place - at).astype(np.int32)), pa.array(content, pa.binary())],
                    names=_NAMES)
    return run


def _words(strings: list[bytes]) -> np.ndarray:
    """Strings as rows of big-endian eight-byte words, filled up with zeros."""
    width = max((len(s) + 7) // 8 for s in strings) or 1
    return np.frombuffer(b"".join(s.ljust(8 * width, b"\0") for s in strings), ">u8").reshape(-1, width).astype(np.uint64)


def multikey_sort(words: np.ndarray) -> np.ndarray:
    """Byte order of rows of words: runs of equal words are sorted by the next word, until each row is alone."""
    order, group = np.arange(len(words)), np.zeros(len(words), np.int64)
    left = np.arange(len(words))  # places of rows that are equal to a neighbour so far
    for column in range(words.shape[1]):
        if len(left) < 2:
            break
        key = words[order[left], column]
        by = np.lexsort((key, group[left]))
        order[left], key = order[left][by], key[by]
        own = group[left]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
        first = left[np.flatnonzero(new)]
        group[left] = np.repeat(first, np.diff(np.append(np.flatnonzero(new), len(left))))
        sizes = np.diff(np.append(np.flatnonzero(new), len(left)))
        left = left[np.repeat(sizes > 1, sizes)]
    return order


def common_lengths(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row of the order has in common with the one before it; 0 for the first."""
    differ = words[order[1:]] ^ words[order[:-1]]
    at = np.argmax(differ != 0, axis=1)
    word = differ[np.arange(len(at)), at]
    within = np.zeros(len(at), np.int64)
    for k in range(1, 8):
        within += word < np.uint64(1) << np.uint64(64 - 8 * k)
    whole = 8 * words.shape[1]
    return np.concatenate([[0], np.where(word == 0, whole, 8 * at + within)])


def equal_windows(content: list[bytes], at: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, window, class) of all windows of some stretches; windows of one class are equal.

    A window of which ``a`` bytes stand before the anchor equals another one if the bytes
    before both anchors agree for ``a`` bytes and the suffixes at them for the rest.
    """
    n = len(content)
    orders, common = [], []
    for strings in ([c[p:] for c, p in zip(content, at.tolist())], [c[:p][::-1] for c, p in zip(content, at.tolist())]):
        words = _words(strings)
        order = multikey_sort(words)
        orders.append(order)
        common.append(common_lengths(words, order))
    rows, windows, classes, before = [], [], [], 0
    run = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(int((at - size + 1).min()), int(at.max()) + 1):
        own = np.flatnonzero((at - size < a) & (a <= at))
        if not len(own):
            continue
        for side, depth in ((0, length - a), (1, a)):
            run[side][orders[side]] = np.cumsum(common[side] < depth)
        _, inverse = np.unique(run[0][own] * (n + 1) + run[1][own], return_inverse=True)
        rows.append(own)
        windows.append(at[own] - a)
        classes.append(inverse + before)
        before += int(inverse.max()) + 1
    return np.concatenate(rows), np.concatenate(windows), np.concatenate(classes)


def _compare(rows: pa.Table, length: int, split: dict[int, int]) -> pa.RecordBatch:
    """Repeated ranges among rows sorted by bucket and stretch; whole groups only.

    A negative size marks a stretch that is known to be repeated.
    """
    sure = rows.column("size").to_numpy() < 0
    out = []
    if sure.any():
        key, start, size = (rows.column(k).to_numpy()[sure] for k in ("key", "start", "size"))
        out.append((key, start, start - size - 1 + length, np.zeros(len(key), np.int64)))
        rows = rows.filter(pa.array(~sure)).combine_chunks()
    if rows.num_rows:
        out += _compared(rows, length, split)
    columns = [np.concatenate([o[k] for o in out]) for k in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["key", "start", "end", "window"])


def _compared(rows: pa.Table, length: int, split: dict[int, int]) -> list[tuple[np.ndarray, ...]]:
    bucket, stretch, key, start, size = (rows.column(k).to_numpy() for k in ("bucket", "stretch", "key", "start", "size"))
    new_group = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    new_kind = new_group | np.concatenate([[True], stretch[1:] != stretch[:-1]])
    kinds = np.flatnonzero(new_kind)
    kind_of = np.cumsum(new_kind) - 1
    copies = np.diff(np.append(kinds, len(bucket)))
    group_of = (np.cumsum(new_group) - 1)[kinds]
    hot = np.isin(rows.column("anchor").to_numpy()[kinds], list(split)) if split else np.zeros(len(kinds), bool)
    several = (np.bincount(group_of)[group_of] > 1) | hot
    # Equal stretches: all their windows are repeated.
    full = copies[kind_of] > 1
    out = [(key[full], start[full], start[full] + size[full] - 1 + length, np.zeros(full.sum(), np.int64))]
    pick = kinds[several]
    if len(pick):
        # A bit of the filter may let a stretch through whose bytes did not travel: it is alone at its anchor.
        sent = rows.column("bytes").take(pa.array(pick))
        there = sent.is_valid().to_numpy(zero_copy_only=False)
        pick, single, hot = pick[there], (copies[several] == 1)[there], hot[several][there]
        content = sent.filter(pa.array(there)).to_pylist()
    if len(pick):
        at = rows.column("at").to_numpy()[pick].astype(np.int64)
        of, j, kind = equal_windows(content, at, size[pick], length)
        by = np.lexsort((j, of))
        of, j, kind = of[by], j[by], kind[by]
        known = np.bincount(kind, weights=np.where(single[of], 1, 2))[kind] > 1
        hit = known & single[of]
        if hit.any():
            rows_hit, place = of[hit], j[hit]
            edge = np.flatnonzero(np.concatenate([[True], (rows_hit[1:] != rows_hit[:-1]) | (place[1:] != place[:-1] + 1)]))
            last = np.append(edge[1:], len(place)) - 1
            own = pick[rows_hit[edge]]
            out.append((key[own], start[own] + place[edge], start[own] + place[last] + length, np.zeros(len(edge), np.int64)))
        if hot.any():
            # Split buckets: every distinct window goes on, once, by a hash of its bytes, marked by -2 where it is settled.
            open_ = np.flatnonzero(hot[of])
            open_ = open_[np.unique(kind[open_], return_index=True)[1]]
            lengths = np.array([len(c) for c in content])
            base = np.concatenate([[0], np.cumsum(lengths)])[:-1]
            total = _prefix(np.frombuffer(b"".join(content), np.uint8))
            h = _between(total, base[of[open_]] + j[open_], base[of[open_]] + j[open_] + length)
            own = pick[of[open_]]
            settled = known[open_] | ~single[of[open_]]
            out.append((key[own], start[own] + j[open_], np.where(settled, -2, -1), h.view(np.int64)))
    return out


def _sorted_buckets(length: int, split: dict[int, int], least: int = 4096):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < least:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            bucket = rows.column("bucket").to_numpy()
            cut = len(bucket) - int((bucket[::-1] != bucket[-1]).argmax()) if bucket[0] != bucket[-1] else 0
            if cut:
                yield _compare(rows.slice(0, cut).combine_chunks(), length, split)
            held, n = rows.slice(cut).to_batches(), len(bucket) - cut
        if n:
            yield _compare(pa.Table.from_batches(held).combine_chunks(), length, split)
    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column(1), batch.column(2)):
            data = (text.as_py() or "").encode()
            kept, removed, n, at = [], 0, 0, 0
            merged: list[list[int]] = []
            for s in sorted((x["start"], x["end"]) for x in spans.as_py() or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            for a, b in merged:
                kept.append(data[at:a])
                removed, n, at = removed + b - a, n + 1, b
            kept.append(data[at:])
            left = b"".join(kept)
            rows.append((len(data), removed, n, hashlib.sha256(left).hexdigest(), left))
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string()),
             pa.array(columns[4], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_ranges(source: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """(key, start, end): byte ranges of (key, text) rows covered by strings that occur twice."""
    session = source.sparkSession
    seen = source.select("text").mapInArrow(_count(length), "anchor bigint, stretch bigint, lead binary")
    each = seen.groupBy("anchor", "stretch").agg(F.count("*").alias("n"), F.max("lead").alias("lead"))
    seen = each.groupBy("anchor").agg(
        F.max("lead").alias("lead"), F.max("n").alias("most"), F.max_by("stretch", "n").alias("often"), F.sum("n").alias("n"), F.count("*").alias("kinds"))
    repeated = written(seen.where("n > 1").withColumn("various", F.col("kinds") > 1), "anchors")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    least = max(crowd, total // SHARE)
    # At most SHARE rows, whatever the input: each has more than one in SHARE of all.
    split = {r["anchor"]: -(-r["n"] // least) for r in repeated.where((F.col("n") > least) & F.col("various")).collect()}
    frequent = [r["often"] for r in repeated.where(F.col("most") > least).select("often").collect()]
    # The offered anchors of the smallest hash: a sample of at most SAMPLE leading bytes, whatever the input.
    sample = repeated.where("lead is not null").orderBy("anchor").limit(SAMPLE).select("lead", F.least("n", F.lit(least)).alias("n")).collect()
    cuts = splitters([bytes(r["lead"]) for r in sample], [r["n"] for r in sample])
    filters = session.sparkContext.broadcast((bit_filter(repeated, "anchor"), bit_filter(repeated.where("various"), "anchor")))
    found = source.mapInArrow(_emit(length, filters, split, frequent, cuts), _FOUND)
    # Far more ranges than tasks, so that tasks get alike; the buckets of a split lead are ranges of their own.
    own = F.when(F.col("anchor").isin(list(split)), F.col("bucket")) if split else F.lit(None).cast("bigint")
    found = found.repartition("part", own).sortWithinPartitions("part", "lead", "bucket", "stretch")
    ranges = found.mapInArrow(_sorted_buckets(length, split), "key bigint, start bigint, end bigint, window bigint")
    ranges = written(ranges, "ranges")
    out = ranges.where("end >= 0").select("key", "start", "end")
    if split:
        windows = ranges.where("end < 0")
        across = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
        late = windows.where("end = -1").join(across, "window").select("key", "start", (F.col("start") + length).alias("end"))
        out = out.unionByName(late)
    return out


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, crowd: int = CROWD,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of ``docs``.

    Each byte of a text's UTF-8 form goes that is covered by a string of ``length``
    bytes which also starts anywhere else in the table, in the same text or another;
    strings may overlap and are judged on the input. ``kept`` are the bytes that are
    left (a cut may fall inside a character), ``n_spans`` counts the longest removed runs.

    Null and empty texts have no bytes and keep none; texts shorter than ``length`` stay
    whole. Repeated rows are copies of each other, rows without an id are treated as any
    other. Other columns are ignored; an empty table gives no rows.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = source.withColumn("key", F.xxhash64("doc_id", "text"))
    ranges = repeated_ranges(keyed.where(F.octet_length("text") >= length).select("key", "text"), length, crowd)
    # A list has at most as many ranges as its own text has stretches.
    spans = ranges.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = keyed.join(spans, "key", "left").select("doc_id", "text", "spans")
    kind = source.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        _remove, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
