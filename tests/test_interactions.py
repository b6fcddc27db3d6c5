"""Global order helpers, funnels, sessions, as-of joins, filters and feature tables."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from affinia.operators import features as FE
from affinia.operators import filters as FL
from affinia.operators import indexing as IX
from affinia.operators import interactions as I
from affinia.operators import evaluate as E

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_dense_index(spark, parts):
    values = [(random.Random(i).randint(0, 9), i) for i in range(500)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(values, "a bigint, b bigint").repartition(7)
        got = IX.dense_index(df, F.desc("a"), F.asc("b")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    order = sorted(values, key=lambda v: (-v[0], v[1]))
    assert {(r["a"], r["b"]): r["index"] for r in got} == {v: i for i, v in enumerate(order)}


def test_last_seen_crosses_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        values = [(i, i if i % 100 == 0 else None) for i in range(1000)]
        df = spark.createDataFrame(values, "k bigint, v bigint").repartition(16)
        placed = IX.sorted_parts(df, F.asc("k"))
        assert placed.select("_part").distinct().count() > 4
        got = IX.with_last_seen(placed, F.col("v"), "seen").collect()
        before = IX.with_last_seen(placed, F.col("v"), "seen", inclusive=False).collect()
        run = IX.running_sum(placed.withColumn("one", F.lit(1)), "one", "n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert all(r["seen"] == r["k"] // 100 * 100 for r in got)
    assert all(r["seen"] == (None if r["k"] == 0 else (r["k"] - 1) // 100 * 100) for r in before)
    assert all(r["n"] == r["k"] + 1 for r in run)


def make_events(spark, data):
    return spark.createDataFrame(
        [(i, u, it, at(m), t) for i, (u, it, m, t) in enumerate(data)],
        "event_id bigint, user bigint, item bigint, ts timestamp, event_type string",
    )


def test_sessions_of_one_hot_user(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rng = random.Random(3)
        minute, data = 0, []
        for _ in range(600):
            minute += rng.choice([1, 5, 29, 31, 100])
            data.append((1, rng.randint(0, 9), minute, "view"))
        data += [(2, 0, 5, "view"), (2, 0, 6, "view")]
        got = {r["event_id"]: (r["session"], r["step"]) for r in I.session_sequence(make_events(spark, data), 30).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    session, step, last = 0, 0, None
    for i, (user, _, m, _) in enumerate(data[:600]):
        session, step = (session, step + 1) if last is not None and m - last <= 30 else (session + 1, 1)
        assert got[i] == (session, step)
        last = m
    assert got[600] == (1, 1) and got[601] == (1, 2)


def test_lag_context(spark):
    df = make_events(spark, [(1, 10, 0, "v"), (1, 11, 1, "v"), (1, 12, 2, "v"), (2, 20, 0, "v")])
    got = {r["event_id"]: (r["context"], r["weights"]) for r in I.lag_context(df, 2).collect()}
    assert got == {0: ([], []), 1: ([10], [1.0]), 2: ([11, 10], [1.0, 0.5]), 3: ([], [])}


def test_asof_uses_no_later_row(spark):
    left = spark.createDataFrame([(1, at(10), "a"), (1, at(0), "b"), (2, at(10), "c"), (3, at(5), "d")], "user bigint, ts timestamp, tag string")
    feats = spark.createDataFrame([(1, at(10), 1.0), (1, at(10) + timedelta(seconds=1), 2.0), (2, at(1), 3.0), (2, at(9), 4.0)],
                                  "user bigint, ts timestamp, score double")
    got = dict(FE.asof_join(left, feats, "user").select("tag", "score").collect())
    assert got == {"a": 1.0, "b": None, "c": 4.0, "d": None}


def test_asof_against_brute_force(spark):
    rng = random.Random(5)
    left = [(rng.randint(0, 3), at(rng.randint(0, 500)), i) for i in range(300)]
    feats = [(rng.randint(0, 2), at(m), float(m)) for m in rng.sample(range(500), 120)]
    got = dict(FE.asof_join(
        spark.createDataFrame(left, "user bigint, ts timestamp, tag bigint"),
        spark.createDataFrame(feats, "user bigint, ts timestamp, score double"), "user",
    ).select("tag", "score").collect())
    for user, ts, tag in left:
        known = [f for f in feats if f[0] == user and f[1] <= ts]
        assert got[tag] == (max(known, key=lambda f: f[1])[2] if known else None)


def test_funnel_needs_order(spark):
    df = make_events(spark, [
        (1, 0, 0, "click"), (1, 0, 1, "view"), (2, 0, 0, "view"), (2, 0, 1, "click"), (2, 0, 2, "purchase"),
        (3, 0, 0, "view"), (3, 0, 1, "purchase"), (3, 0, 2, "click"),
    ])
    got = [(r["step"], r["users"], r["dropped"]) for r in I.funnel(df, ["view", "click", "purchase"]).orderBy("step_no").collect()]
    assert got == [("view", 3, 0), ("click", 2, 1), ("purchase", 1, 1)]


def test_latest_rating_ties(spark):
    df = spark.createDataFrame([(1, 1, 2.0, at(0)), (1, 1, 4.0, at(5)), (1, 1, 5.0, at(5)), (1, 2, 1.0, at(9))],
                               "user bigint, item bigint, rating double, ts timestamp")
    assert rows(I.latest_rating(df), "user", "item", "rating") == [(1, 1, 5.0), (1, 2, 1.0)]


def test_freshness(spark):
    shown = [(1, 7, m, "view") for m in range(3)] + [(2, 7, m, "view") for m in range(3)] + [(2, 7, 9, "click"), (3, 7, 0, "view")]
    events = make_events(spark, shown)
    cands = spark.createDataFrame([(1, 7), (2, 7), (3, 7)], "user bigint, item bigint")
    assert rows(FL.freshness_filter(cands, events, 3), "user") == [(2,), (3,)]


def test_rules_log_the_first_rule(spark):
    ranked = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3)], "user bigint, item bigint, rank int")
    rules = spark.createDataFrame([(2, 10, 12), (1, 12, 11), (3, 11, 10)], "rule bigint, first bigint, second bigint")
    assert rows(FL.apply_rules(ranked, rules), "item", F.coalesce("dropped_by", F.lit(0))) == [(10, 0), (11, 3), (12, 1)]


def test_filter_log(spark):
    cands = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "user bigint, item bigint")
    a = spark.createDataFrame([(1, 1), (1, 2)], "user bigint, item bigint")
    b = spark.createDataFrame([(2,)], "item bigint")
    got = dict(FL.filter_log(cands, {"seen": (a, ["user", "item"]), "gone": (b, ["item"])}).select("item", "reasons").collect())
    assert got == {1: ["seen"], 2: ["seen", "gone"], 3: []}


def test_auc_with_ties(spark):
    data = [(0.1, 0), (0.5, 1), (0.5, 0), (0.9, 1), (0.2, 0)]
    auc = E.roc_auc(spark.createDataFrame(data, "score double, label int")).first()["auc"]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0 for p, l in data if l for n, m in data if not m)
    assert abs(auc - wins / 6) < 1e-12


def test_kl_of_equal_counts_is_zero(spark):
    df = spark.createDataFrame([(0, 3), (4, 9)], "bin bigint, n bigint")
    assert abs(E.kl_divergence(df, df, 10).first()["kl"]) < 1e-12


def test_filters_reach_the_scan(spark):
    from affinia.plans import views as V

    views = V.views(spark, "/root/testdata/sf0.001")
    plan = FL.filter_views(views, V.users(spark, "/root/testdata/sf0.001"), "2024-01-10", "NATION_3")
    text = plan.select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in text
    assert "value" not in text.split("ReadSchema")[1].split("\n")[0]
