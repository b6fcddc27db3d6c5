"""Pair sums, Pearson similarity, affinity and incremental updates against brute force."""

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from affinia.operators import pairs as P
from affinia.operators import similarity as S
from affinia.operators import active as A

T0 = datetime(2024, 1, 1)


def model_sums(data):
    """{(l, r): (n, sxy, sxx, syy)} of (entity, feature, x) rows."""
    by = defaultdict(list)
    for e, f, x in data:
        by[f].append((e, x))
    out = defaultdict(lambda: [0, 0.0, 0.0, 0.0])
    for members in by.values():
        for a, x in members:
            for b, y in members:
                if a < b:
                    s = out[a, b]
                    s[0] += 1
                    s[1] += x * y
                    s[2] += x * x
                    s[3] += y * y
    return out


def skewed(seed=1, entities=60, features=20):
    """One feature that a third of all rows carry, the others small."""
    rng = random.Random(seed)
    cells = {(e, 0) for e in range(entities)}
    while len(cells) < 3 * entities:
        cells.add((rng.randrange(entities), rng.randrange(1, features)))
    return [(e, f, round(rng.uniform(-2, 2), 3)) for e, f in sorted(cells)]


@pytest.mark.parametrize("limit,block", [(512, 1024), (10, 8), (1, 7), (1, 1000)])
@pytest.mark.parametrize("text", [False, True])
def test_pair_sums(spark, limit, block, text):
    """In-row pairs, block products and their mix give the same exact sums."""
    data = skewed()
    if text:
        data = [(f"e{e:03d}", f"f{f}", x) for e, f, x in data]
    kind = "string" if text else "bigint"
    df = spark.createDataFrame(data, f"e {kind}, f {kind}, x double")
    expected = model_sums(data)
    got = {(r["left"], r["right"]): r for r in P.pair_sums(df, "e", "f", "x", group_limit=limit, block=block).collect()}
    assert got.keys() == expected.keys()
    for key, sums in expected.items():
        assert all(math.isclose(got[key][c], v, abs_tol=1e-9) for c, v in zip(P.SUMS, sums))


@pytest.mark.parametrize("limit", [512, 1])
def test_repeated_rows_mean_the_same_at_every_group_size(spark, limit):
    df = spark.createDataFrame([(1, 7, 2.0), (1, 7, 3.0), (2, 7, 4.0)], "e bigint, f bigint, x double")
    rows = P.pair_sums(df, "e", "f", "x", group_limit=limit, block=2).collect()
    assert [tuple(r[c] for c in ("left", "right", *P.SUMS)) for r in rows] == [(1, 2, 1.0, 20.0, 25.0, 16.0)]
    other = df.select(F.col("e").alias("d"), "f")
    shared = P.shared_counts(df, other, "e", "d", "f", group_limit=limit, block=2).collect()
    assert sorted(tuple(r) for r in shared) == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (2, 2, 1)]


@pytest.mark.parametrize("limit", [512, 5])
def test_fresh_pairs_only(spark, limit):
    data = skewed(2)
    fresh = {(e, f) for e, f, _ in data if (e + f) % 4 == 0}
    expected = model_sums(data)
    for key, sums in model_sums([d for d in data if d[:2] not in fresh]).items():
        expected[key] = [a - b for a, b in zip(expected[key], sums)]
    df = spark.createDataFrame([(*d, d[:2] in fresh) for d in data], "e bigint, f bigint, x double, new boolean")
    got = {(r["left"], r["right"]): r for r in P.pair_sums(
        df, "e", "f", "x", fresh=F.col("new"), group_limit=limit, block=9).collect()}
    assert got.keys() == {k for k, v in expected.items() if v[0] > 0}
    assert all(math.isclose(got[k]["sxy"], expected[k][1], abs_tol=1e-9) for k in got)


@pytest.mark.parametrize("limit", [512, 3])
def test_shared_counts(spark, limit):
    rng = random.Random(4)
    left = {(q, t) for q in range(12) for t in rng.sample(range(30), 5)} | {(q, 99) for q in range(12)}
    right = {(f"d{d}", t) for d in range(40) for t in rng.sample(range(30), 4)} | {(f"d{d}", 99) for d in range(40)}
    expected = defaultdict(int)
    for q, t in left:
        for d, u in right:
            expected[q, d] += t == u
    a = spark.createDataFrame(sorted(left), "q bigint, t bigint")
    b = spark.createDataFrame(sorted(right), "d string, t bigint")
    got = {(r["q"], r["d"]): r["shared"] for r in P.shared_counts(a, b, "q", "d", "t", group_limit=limit, block=5).collect()}
    assert got == {k: v for k, v in expected.items() if v}


def ratings(seed=1, users=25, items=18):
    rng = random.Random(seed)
    cells = rng.sample([(u, i) for u in range(users) for i in range(items)], 200)
    return [(u, i, float(rng.randint(1, 5))) for u, i in cells]


def frame(spark, data):
    return spark.createDataFrame(data, "user bigint, item bigint, rating double")


def model_pearson(data):
    mean = {u: sum(r for v, _, r in data if v == u) / sum(v == u for v, _, _ in data) for u, _, _ in data}
    out = {}
    for key, (n, sxy, sxx, syy) in model_sums([(u, i, r - mean[u]) for u, i, r in data]).items():
        out[key] = sxy / (math.sqrt(sxx) * math.sqrt(syy)) if sxx > 0 and syy > 0 else None
    return out, mean


@pytest.mark.parametrize("limit", [512, 4])
def test_pearson(spark, limit):
    data = ratings() + [(99, i, 3.0) for i in range(6)]
    expected, _ = model_pearson(data)
    got = {(r["left"], r["right"]): r["similarity"] for r in S.user_similarity(frame(spark, data), group_limit=limit, block=6).collect()}
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        if 99 in key:
            assert got[key] is None
        else:
            assert (got[key] is None) == (value is None)
            assert value is None or math.isclose(got[key], value, abs_tol=1e-9)
            assert value is None or -1 - 1e-9 <= got[key] <= 1 + 1e-9


def test_similarity_does_not_depend_on_partitions(spark):
    df = frame(spark, ratings())
    seen = set()
    for parts in (1, 4, 17):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = S.user_similarity(df.repartition(parts), group_limit=6, block=5)
        seen.add(tuple(rows(got, "left", "right", F.round("similarity", 9))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1


def test_affinity(spark):
    data = ratings(3)
    similarity, mean = model_pearson(data)
    rated = {(u, i): r for u, i, r in data}
    got = {(r["user"], r["item"]): r["affinity"] for r in S.affinity(frame(spark, data), S.user_similarity(frame(spark, data)), 4).collect()}
    for a in mean:
        near = sorted(((-s, o) for (l, r), s in similarity.items() if s is not None and a in (l, r)
                       for o in [r if l == a else l]), key=lambda x: (round(x[0], 12), x[1]))[:4]
        for i in range(18):
            votes = [(-s, rated[o, i]) for s, o in near if (o, i) in rated]
            if not votes:
                assert (a, i) not in got
                continue
            weight = sum(s for s, _ in votes)
            expected = None if abs(weight) < 1e-12 else mean[a] + sum(s * (r - mean[a]) for s, r in votes) / weight
            assert (got[a, i] is None) == (expected is None)
            assert expected is None or math.isclose(got[a, i], expected, rel_tol=1e-6, abs_tol=1e-6)


def test_affinity_of_an_item_nobody_near_rated_is_null(spark):
    data = ratings(3)
    targets = spark.createDataFrame([(data[0][0], 777)], "user bigint, item bigint")
    out = S.affinity(frame(spark, data), S.user_similarity(frame(spark, data)), 3, targets)
    assert rows(out) == [(data[0][0], 777, None)]


@pytest.mark.parametrize("limit", [512, 4])
def test_update_similarity(spark, limit):
    """New ratings, some of them in place of old ones and some of users not seen before."""
    data = ratings(7)
    old, new = data[:150], data[150:] + [(u, i, 6 - r) for u, i, r in data[:10]] + [(500, 3, 2.0), (500, 4, 5.0)]
    after = {(u, i): r for u, i, r in old}
    after.update({(u, i): r for u, i, r in new})
    _, means = model_pearson(old)
    fresh = defaultdict(list)
    for u, _, r in new:
        fresh[u].append(r)
    held = {u: means.get(u, sum(rs) / len(rs)) for u, rs in fresh.items()} | means
    expected = model_sums([(u, i, r - held[u]) for (u, i), r in after.items()])
    o, n = frame(spark, old), frame(spark, new)
    m = spark.createDataFrame(list(means.items()), "user bigint, mean double")
    sums = S.similarity_sums(o, group_limit=limit, block=6)
    got = {(r["left"], r["right"]): r for r in S.update_similarity(sums, o, n, m, group_limit=limit, block=6).collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k][c], v, abs_tol=1e-9) for k in got for c, v in zip(P.SUMS, expected[k]))


def test_recommendations_are_unseen(spark):
    data = ratings(9)
    seen = {(u, i) for u, i, _ in data}
    df = frame(spark, data)
    for mode, swap in (("user", False), ("item", True)):
        got = S.cf_recommend(df, S.user_similarity(df, swap=swap), mode, 5, 4).collect()
        assert got and not any((r["user"], r["item"]) in seen for r in got)
        assert all(1 <= r["rank"] <= 4 for r in got)
    drawn = S.neighbour_random(df, S.user_similarity(df), seed=1)
    assert not any((r["user"], r["item"]) in seen for r in drawn.collect())
    assert rows(drawn) == rows(S.neighbour_random(df.repartition(5), S.user_similarity(df), seed=1))


def test_co_coverage_by_count_equals_by_pairs(spark):
    data = ratings(11)
    df = frame(spark, data)
    preds = df.withColumn("prediction", F.lit(3.0))
    a = dict(A.active_scores(df, preds).select("item", "co_coverage").collect())
    assert a == dict(A.co_coverage(df).collect())


def test_known_small_case(spark):
    """Five tasters of four cheeses, with gaps."""
    data = [("A", "w", 5.0), ("A", "x", 4.0), ("A", "y", 4.0), ("A", "z", 1.0), ("B", "w", 2.0), ("B", "x", 3.0), ("B", "y", 3.0),
            ("B", "z", 4.5), ("C", "w", 3.0), ("C", "x", 2.0), ("C", "y", 3.0), ("C", "z", 4.0), ("D", "w", 4.0), ("D", "x", 4.0),
            ("D", "y", 5.0), ("E", "w", 3.0)]
    df = spark.createDataFrame(data, "user string, item string, rating double")
    got = {(r["left"], r["right"]): r["similarity"] for r in S.user_similarity(df).collect()}
    expected, _ = model_pearson(data)
    assert got["A", "E"] is None
    assert all(v is None or math.isclose(got[k], v, abs_tol=1e-9) for k, v in expected.items())


@pytest.mark.parametrize("valued", [True, False])
@pytest.mark.parametrize("limits", [{}, {"entity_limit": 3}, {"group_limit": 6, "entity_limit": 2}])
def test_pair_sums_add_up_where_the_left_entity_is(spark, valued, limits, monkeypatch):
    monkeypatch.setattr(P, "AT_ONCE", 7)
    rng = np.random.default_rng(3)
    data = sorted({(int(e), int(f)) for e, f in zip(rng.integers(0, 25, 160), rng.integers(0, 18, 160))})
    data = [(e, f, float(rng.integers(-3, 4))) for e, f in data]
    df = spark.createDataFrame(data + [(None, 1, 2.0), (3, None, 2.0)], "e bigint, f bigint, x double")
    expected = {}
    for a, f, x in data:
        for b, g, y in data:
            if f == g and a < b:
                x, y = (x, y) if valued else (1.0, 1.0)
                expected.setdefault((a, b), []).append((1.0, x * y, x * x, y * y))
    sums = P.pair_sums(df, "e", "f", "x" if valued else None, **limits)
    got = {(r["left"], r["right"]): tuple(r[c] for c in P.SUMS) for r in sums.collect()}
    assert got == {k: tuple(map(sum, zip(*v))) for k, v in expected.items()}
    assert sums.count() == len(expected)


def test_pair_sums_shuffle_members_and_not_pairs(spark):
    """A member's row holds all that come after it in its group; no row per pair is exchanged."""
    df = spark.range(60).selectExpr("id AS e", "id % 2 AS f", "1.0D AS x")
    plan = P.pair_sums(df, "e", "f", "x")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[left" not in plan and "SortAggregate(key=[left" not in plan


@pytest.mark.parametrize("limits", [{}, {"group_limit": 6, "block": 4, "entity_limit": 2}])
def test_an_update_shuffles_no_table_of_pairs(spark, limits, monkeypatch):
    monkeypatch.setattr(P, "AT_ONCE", 7)
    data = ratings(13)
    old, new = frame(spark, data[:120]), frame(spark, data[120:] + [(u, i, 6 - r) for u, i, r in data[:9]])
    means = old.groupBy("user").agg(F.avg("rating").alias("mean"))
    sums = S.similarity_sums(old, **limits)
    updated = S.update_similarity(sums, old, new, means, **limits)
    plan = updated._jdf.queryExecution().executedPlan().toString()
    assert limits or "HashAggregate(keys=[left" not in plan and "SortAggregate(key=[left" not in plan
    plain = S.add_sums(sums.select("left", "right", *P.SUMS).unionByName(S.similarity_delta(old, new, means, **limits)))
    # Tables that come without their members, such as a stored one, are added up as well.
    stored = S.add_sums(spark.createDataFrame(sums.collect(), sums.schema), S.similarity_delta(old, new, means, **limits))
    expected = {(r["left"], r["right"]): [r[c] for c in P.SUMS] for r in plain.collect()}
    for found in (updated, stored):
        got = {(r["left"], r["right"]): [r[c] for c in P.SUMS] for r in found.collect()}
        assert got.keys() == expected.keys() and found.count() == len(expected)
        assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in expected.items())
