"""Best-fit packing of tokenised documents by linear grouping.

Only counts per length reach the driver: ``limit`` numbers, however many documents
there are. From these the large lengths are rounded up within groups of equal
cardinality, configurations of the few rounded sizes are chosen, real documents of each
group take the places, and small documents are best-fitted into what is left. The plan
is a short table of runs (length, ranks from-to, first sequence, offset), which every
piece finds by its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinia.llm.hashing import Kept
from affinia.llm.tables import written

LIMIT = 2048
#: Lengths up to this share of a sequence count as small.
SMALL = 0.4
GROUPS = 512
#: Entries of the chunk memo of a Python worker, after which it starts anew.
MEMO = 300_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Chunks(dict):
    """The ids, as little-endian 32-bit bytes, of a word with its leading space.

    The byte-level pattern never joins what stands before and after a single space
    between two other characters, so a text is its chunks' ids one after the other.
    """

    def __init__(self, path: str):
        super().__init__()
        self.fast = _ranks(path)
        if self.fast is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            # What the tokenizer takes as one id wherever it stands in a text, such as <|endoftext|>.
            self.special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"] if not t["normalized"]}

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def encode(self, text: str) -> bytes:
        ids = self.fast.encode_ordinary(text) if self.fast else self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        got = self.encode(chunk)
        if len(chunk) <= 64:
            self[chunk] = got
        return got


def _ranks(path: str):
    """The same vocabulary as merge ranks, where the file beside the JSON has it.

    It gives the same ids several times faster; tests hold it against the JSON.
    """
    import base64
    import os

    beside = path.removesuffix(".json") + ".tiktoken"
    if beside == path or not os.path.exists(beside):
        return None
    import public_tokenizers
    import tiktoken

    with open(beside, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


_kept = Kept()


def _chunks(path: str) -> _Chunks:
    if path not in _kept:
        _kept[path] = _Chunks(path)
    return _kept[path]


def token_bytes(text: str, memo: _Chunks) -> bytes:
    """The ids of a whole text as little-endian 32-bit bytes."""
    if memo.has_special(text):
        parts = re.split("(" + "|".join(map(re.escape, sorted(memo.special, key=len, reverse=True))) + ")", text)
        return b"".join(
            memo.special[p].to_bytes(4, "little") if p in memo.special else _plain_bytes(p, memo) for p in parts if p)
    return _plain_bytes(text, memo)


def _plain_bytes(text: str, memo: _Chunks) -> bytes:
    words = text.split(" ")
    # A space beside other white space belongs to a run that the pattern treats as one.
    joined, out = [words[0]], []
    for word in words[1:]:
        if not word or word[0].isspace() or not joined[-1] or joined[-1][-1].isspace():
            joined[-1] += " " + word
        else:
            joined.append(" " + word)
    for chunk in joined:
        out.append(memo[chunk])
    return b"".join(out)


def _fast_bytes(text: str, memo: _Chunks) -> bytes:
    if not text:
        return b""
    if "  " in text or text[0] == " " or text[-1] == " " or not _plain(text) or memo.has_special(text):
        return token_bytes(text, memo)
    first, _, rest = text.partition(" ")
    if not rest:
        return memo[first]
    return memo[first] + b"".join(map(memo.__getitem__, (" " + rest.replace(" ", "\0 ")).split("\0")))


_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def _plain(text: str) -> bool:
    """No space stands beside other white space, and no null character is in the text."""
    if "\0" in text:
        return False
    return not any(c in text and (f" {c}" in text or f"{c} " in text) for c in _SPACES[:9]) and (
        text.isascii() or not any(c in text for c in _SPACES[9:]))


def _pieces(path: str, limit: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, part = _chunks(path), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        seen = np.zeros(limit + 1, dtype=np.int64)
        for batch in batches:
            ids, rows = batch.column(0), []
            for r, text in enumerate(batch.column(1)):
                data = _fast_bytes(text.as_py() or "", memo) + end
                total, at, piece = len(data) // 4, 0, 0
                size = total % limit or limit
                while at < total:
                    rows.append((r, piece, at, size, zlib.crc32(data[4 * at:4 * (at + size)]), seen[size]))
                    seen[size] += 1
                    at, piece, size = at + size, piece + 1, limit
            table = np.array(rows, dtype=np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(table[:, 0]))] + [pa.array(table[:, k]) for k in range(1, 6)]
                + [pa.array(np.full(len(table), part, dtype=np.int64))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "nth", "part"])
    return run


def _fill(sizes: np.ndarray, counts: np.ndarray, limit: int) -> np.ndarray:
    """How many of each size fill a sequence best; every size at most ``counts`` times.

    The largest size that is left always takes part; a bounded knapsack over the rest
    finds the fullest configuration, with few large sizes before many small ones.
    """
    take = np.zeros(len(sizes), dtype=np.int64)
    first = int(np.flatnonzero(counts > 0)[0])
    take[first] = 1
    room = limit - int(sizes[first])
    reach = np.full(room + 1, -1, dtype=np.int64)
    reach[0] = -2
    for k in range(first, len(sizes)):
        size, left = int(sizes[k]), int(counts[k]) - (k == first)
        for _ in range(min(left, room // size)):
            new = np.flatnonzero((reach[:room + 1 - size] != -1) & (reach[size:] == -1))
            # Only sums that were reached before this copy may be built on.
            if len(new) == 0:
                break
            reach[new + size] = k
    at = int(np.flatnonzero(reach != -1)[-1])
    while at > 0:
        k = int(reach[at])
        take[k] += 1
        at -= int(sizes[k])
    return take


def plan_runs(counts: np.ndarray, limit: int = LIMIT, groups: int = GROUPS, small: float = SMALL) -> np.ndarray:
    """Rows (length, first rank, end rank, first sequence, offset) that place every piece.

    ``counts[n]`` is the number of pieces of length n. Piece ``r`` of its length lies in
    sequence ``first sequence + r - first rank``. The work and the rows depend on
    ``limit`` and ``groups``, not on the number of pieces.
    """
    left = np.array(counts, dtype=np.int64)
    used = np.zeros(limit + 1, dtype=np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free room: runs (first sequence, how many)
    order: list[int] = []  # the rooms there are, ascending
    sequence = 0

    def put(length: int, many: int, first: int, offset: int) -> None:
        runs.append((length, int(used[length]), int(used[length]) + many, first, offset))
        used[length] += many

    def leave(room: int, first: int, many: int) -> None:
        if room and many:
            if room not in gaps:
                bisect.insort(order, room)
            gaps.setdefault(room, []).append((first, many))

    edge = int(limit * small)
    total = int(left[edge + 1:].sum())
    each = max(1, -(-total // groups))
    # Groups of equal cardinality, by falling length; a length may be shared by two groups.
    members: list[list[list[int]]] = []
    room = 0
    for length in range(limit, edge, -1):
        many = int(left[length])
        while many:
            if room == 0:
                members.append([])
                room = each
            now = min(many, room)
            members[-1].append([length, now])
            many, room = many - now, room - now
    sizes = np.array([g[0][0] for g in members], dtype=np.int64)
    amounts = np.array([sum(n for _, n in g) for g in members], dtype=np.int64)
    while len(sizes) and amounts.any():
        take = _fill(sizes, amounts, limit)
        kinds = np.flatnonzero(take)
        times = int((amounts[kinds] // take[kinds]).min())
        amounts[kinds] -= times * take[kinds]
        places = np.repeat(kinds, take[kinds]).tolist()
        # Real documents of the groups take the places; a run ends where a length does.
        while times:
            heads, now = [], times
            for g in places:
                heads.append(g)
            need: dict[int, int] = {}
            for g in heads:
                need[g] = need.get(g, 0) + 1
            lengths: dict[int, list[int]] = {}
            for g, n in need.items():
                length, many = members[g][0]
                if many >= n:
                    now = min(now, many // n)
                    lengths[g] = [length] * n
                else:  # the places of one sequence take more than one length
                    now, at = 1, 0
                    lengths[g] = []
                    while len(lengths[g]) < n:
                        length, many = members[g][at]
                        lengths[g] += [length] * min(many, n - len(lengths[g]))
                        at += 1
            offset = 0
            for g in need:
                for length in lengths[g]:
                    put(length, now, sequence, offset)
                    offset += length
                    entry = next(x for x in members[g] if x[0] == length)
                    entry[1] -= now
                members[g] = [x for x in members[g] if x[1]]
            leave(limit - offset, sequence, now)
            sequence, times = sequence + now, times - now
    for length in range(edge, 0, -1):
        many = int(left[length])
        while many:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                fresh = limit // length
                whole = many // fresh
                if whole:
                    for k in range(fresh):
                        put(length, whole, sequence, k * length)
                    leave(limit - fresh * length, sequence, whole)
                    sequence, many = sequence + whole, many - whole * fresh
                else:
                    for k in range(many):
                        put(length, 1, sequence, k * length)
                    leave(limit - many * length, sequence, 1)
                    sequence, many = sequence + 1, 0
                continue
            free = order[at]
            first, have = gaps[free].pop()
            if not gaps[free]:
                del gaps[free]
                order.pop(at)
            now = min(have, many)
            put(length, now, first, limit - free)
            leave(free - length, first, now)
            leave(free, first + now, have - now)
            many -= now
    return np.array(runs, dtype=np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = 0,
    path: str | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A document is the ids of its whole text and then ``end_id``. One of more than
    ``limit`` ids is cut into pieces of ``limit``, of which the first may be shorter; no
    other is cut. ``ids_crc32`` is of the piece's ids as little-endian 32-bit numbers.
    ``path`` is the tokenizer's JSON file on every machine.

    A null or empty text is one piece of ``end_id`` alone. Repeated rows, and rows
    without an id, are packed one by one. Other columns are ignored; an empty table
    gives no rows.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    pieces = written(source.mapInArrow(
        _pieces(path or tokenizer_path(), limit, end_id),
        f"doc_id {kind}, piece bigint, start bigint, length bigint, ids_crc32 bigint, nth bigint, part bigint"), "pieces")
    # One row per task and length: ranks go on from task to task.
    each = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = each.select("part", "length", F.coalesce(before, F.lit(0)).alias("_before"))
    counts = np.zeros(limit + 1, dtype=np.int64)
    for row in each.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``limit`` rows
        counts[row["length"]] = row["n"]
    plan = plan_runs(counts, limit)
    bounds: dict[int, list[tuple[int, int, int, int]]] = {}
    for length, low, high, first, offset in plan.tolist():
        bounds.setdefault(length, []).append((low, high, first, offset))
    # Runs of a length follow one another, so that a piece finds its run by halving.
    table = [(n, [r[0] for r in rs], [r[2] - r[0] for r in rs], [r[3] for r in rs]) for n, rs in bounds.items()]
    ranked = pieces.join(starts, ["part", "length"]).withColumn("_rank", F.col("_before") + F.col("nth"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = {n: tuple(map(np.array, rest)) for n, *rest in table}
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            by_length = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[by_length])) + 1
            for rows in np.split(by_length, cuts):
                if len(rows):
                    low, shift, at = lookup[int(length[rows[0]])]
                    run = np.searchsorted(low, rank[rows], side="right") - 1
                    sequence[rows], offset[rows] = rank[rows] + shift[run], at[run]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank").mapInArrow(
        place, f"doc_id {kind}, piece bigint, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
