"""Compressed rows hold every cell, are found by row, and turn into columns."""

import random

import pytest

from affinia.operators import sparse_rows as SR


def cells(seed=0):
    rng = random.Random(seed)
    out = {(u, i): float(rng.randrange(1, 6)) for u in rng.sample(range(-50, 500), 60) for i in rng.sample(range(300), rng.randrange(1, 12))}
    out |= {(7, i): 1.0 for i in range(900)}  # spans chunks
    return out | {(1 << 40, 1 << 41): 2.5}


def frame(spark, held):
    rows = [(u, i, r, "x") for (u, i), r in held.items()] + [(None, 1, 1.0, "x"), (1, None, 1.0, "x")]
    return spark.createDataFrame(rows, "user bigint, item bigint, rating double, chunk string").repartition(3)


def unpacked(df):
    got = df.collect()
    out = {(r["row"], r["column"]): r["value"] for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("entries", [1 << 16, 100, 1])
def test_every_cell(spark, entries):
    held = cells() if entries > 1 else dict(list(cells().items())[:40])
    matrix = SR.build(frame(spark, held), "user", "item", "rating", entries)
    assert unpacked(SR.unpack(matrix.chunks)) == held
    for r in matrix.chunks.collect():
        assert len(r["columns"]) <= entries and list(r["rows"]) == sorted(set(r["rows"])) and r["starts"][0] == 0
    sizes = {r["row"]: r["entries"] for r in matrix.offsets.collect()}
    assert sizes == {u: sum(1 for v, _ in held if v == u) for u, _ in held}


def test_rows_come_from_their_chunks(spark):
    held = cells()
    matrix = SR.build(frame(spark, held), "user", "item", "rating", 100)
    some = sorted({u for u, _ in held})[:5] + [7, 1 << 40, 123456]
    wanted = spark.createDataFrame([(u, "y") for u in [*some, 7]], "id bigint, chunk string")
    assert unpacked(SR.read_rows(matrix, wanted, "id")) == {k: v for k, v in held.items() if k[0] in some}
    spans = {r["row"]: (r["first"], r["last"]) for r in matrix.offsets.collect()}
    assert spans[7][1] - spans[7][0] >= 8 and spans[1 << 40][0] == spans[1 << 40][1]
    assert SR.read_rows(matrix, wanted.limit(0), "id").collect() == []


def test_transposed_twice_is_the_same(spark):
    held = cells()
    matrix = SR.build(frame(spark, held), "user", "item", "rating", 128)
    turned = SR.transpose(matrix, 64)
    assert unpacked(SR.unpack(turned.chunks)) == {(i, u): r for (u, i), r in held.items()}
    assert unpacked(SR.unpack(SR.transpose(turned).chunks)) == held


def test_empty(spark):
    matrix = SR.build(frame(spark, {}), "user", "item", "rating")
    assert SR.unpack(matrix.chunks).collect() == [] and matrix.offsets.collect() == []
