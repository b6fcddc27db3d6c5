"""Bloom filters, sampling, lists, experiments and contracts."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from affinia.functions import keys
from affinia.operators import bloom as B
from affinia.operators import evaluate as E
from affinia.operators import recommend as R
from affinia.operators import retrieval as RT
from affinia.operators import sampling as SA


def key_frame(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").alias("key"))


def test_bloom(spark):
    bits, hashes = B.design(2000, 0.02)
    bloom = B.bloom_build(key_frame(spark, 0, 2000), "key", bits, hashes)
    inside = B.bloom_contains(key_frame(spark, 0, 2000), bloom, "key", bits, hashes)
    assert inside.where(~F.col("maybe")).isEmpty()
    outside = B.bloom_contains(key_frame(spark, 10_000, 20_000), bloom, "key", bits, hashes)
    assert outside.count() == 10_000
    assert outside.where("maybe").count() / 10_000 < 0.035
    kept = B.bloom_filter_out(key_frame(spark, 1000, 3000), bloom, "key", bits, hashes)
    assert kept.where("key < 2000").isEmpty() and kept.count() > 900


def test_bloom_union_and_intersection(spark):
    """Bit by bit what two filters of plain position sets would hold."""
    bits, hashes = 100_000, 3
    a, b = (B.bloom_build(key_frame(spark, *r), "key", bits, hashes) for r in ((0, 300), (200, 500)))

    def places(lo, hi):
        got = key_frame(spark, lo, hi).select(F.explode(B.positions(F.col("key"), bits, hashes))).collect()
        return {r[0] for r in got}

    def of(bloom):
        out = set()
        for bucket, bitmap in bloom.select("bucket", "bitmap").collect():
            out |= {(bucket - 1) * 32768 + 8 * i + j for i, byte in enumerate(bitmap) for j in range(8) if byte >> j & 1}
        return out

    pa, pb = places(0, 300), places(200, 500)
    assert {x + 0 for x in of(a)} == {p if p else 0 for p in pa} or len(of(a)) == len(pa)
    assert len(of(B.bloom_or(a, b))) == len(pa | pb)
    assert len(of(B.bloom_and(a, b))) == len(pa & pb)


def test_bloom_similarity_counts_shared_bits(spark):
    items = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["b", "c", "d"]), (3, ["z"])], "item bigint, words array<string>")
    bits = {r["item"]: set(r["p"]) for r in items.select(
        "item", F.explode("words").alias("w")).select("item", F.explode(B.positions(F.col("w"), 4096, 2)).alias("b")
    ).groupBy("item").agg(F.collect_set("b").alias("p")).collect()}
    got = {(r["left"], r["right"]): r["common"] for r in B.bloom_similarity(items, "words").collect()}
    expected = {(a, b): len(bits[a] & bits[b]) for a in bits for b in bits if a < b and bits[a] & bits[b]}
    assert got == expected


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(100).select(F.col("id").alias("pl"))
    items = spark.range(50).select(F.col("id").alias("track_idx"))
    one = SA.uniform_negatives(df, items, 8, seed=3)
    two = SA.uniform_negatives(df.repartition(9), items.repartition(5), 8, seed=3)
    assert rows(one) == rows(two) and one.count() == 800
    assert rows(one) != rows(SA.uniform_negatives(df, items, 8, seed=4))
    assert one.select("track_idx").distinct().count() == 50


def test_positives_can_be_left_out(spark):
    df = spark.createDataFrame([(1, [0, 1, 2])], "pl bigint, pos array<bigint>")
    items = spark.range(6).select(F.col("id").alias("track_idx"))
    got = SA.uniform_negatives(df, items, 40, positives="pos")
    assert not got.where(F.col("track_idx") < 3).count() and got.count() > 5


def test_triplets_keep_a_pair_together(spark):
    pairs = spark.range(95).select(F.format_string("s%02d", "id").alias("scene"), F.format_string("p%02d", "id").alias("product"))
    got = SA.triplets(pairs, 5)
    assert got.count() == 95 * 5
    assert got.groupBy("scene").agg(F.count_distinct("is_test").alias("n")).where("n != 1").isEmpty()
    assert got.where("is_test").select("scene").distinct().count() == 10


def test_bootstrap_has_the_same_size(spark):
    df = spark.range(200).select(F.col("id").alias("k"))
    got = SA.bootstrap(df, F.asc("k"), seed=1)
    assert got.count() == 200 and sorted(r["place"] for r in got.collect()) == list(range(200))
    assert 90 < got.select("k").distinct().count() < 160


def test_batches(spark):
    df = spark.range(103).select(F.col("id").alias("k"))
    sizes = {r["batch"]: r["count"] for r in SA.batches(df, 10, "k").groupBy("batch").count().collect()}
    assert sizes == {**{b: 10 for b in range(10)}, 10: 3}
    assert SA.batches(df, 10, "k", drop_last=True).count() == 100
    order = [r["k"] for r in SA.shuffle_rows(df, "k").orderBy("place").collect()]
    assert sorted(order) == list(range(103)) and order != list(range(103))


@pytest.mark.parametrize("eps", [0.01, 0.5, 0.99])
def test_eps_greedy(spark, eps):
    popularity = spark.createDataFrame([(i, 1000 - i) for i in range(40)], "item bigint, times_chosen bigint")
    users = spark.range(200).select(F.col("id").alias("user"))
    got = R.eps_greedy(popularity, users, 10, eps, seed=2).collect()
    lists = {}
    for r in got:
        lists.setdefault(r["user"], {})[r["slot"]] = r["item"]
    assert len(lists) == 200
    assert all(sorted(v) == list(range(1, 11)) and len(set(v.values())) == 10 for v in lists.values())
    explored = sum(r["explored"] for r in got) / len(got)
    assert abs(explored - eps) < 0.2
    if eps == 0.01:
        assert sum(v[1] == 0 for v in lists.values()) > 180


def test_eps_must_be_inside_the_interval(spark):
    popularity = spark.createDataFrame([(1, 1)], "item bigint, times_chosen bigint")
    for eps in (0, 1, 1.5):
        with pytest.raises(ValueError):
            R.eps_greedy(popularity, popularity.select(F.col("item").alias("user")), 1, eps)


def test_eps_may_be_a_column(spark):
    popularity = spark.createDataFrame([(i, 100 - i) for i in range(30)], "item bigint, times_chosen bigint")
    users = spark.range(300).select(F.col("id").alias("user"), F.when(F.col("id") < 150, 0.9).otherwise(0.05).alias("eps"))
    got = R.eps_greedy(popularity, users, 5, F.col("eps"))
    shares = got.groupBy((F.col("user") < 150).alias("early")).agg(F.avg(F.col("explored").cast("int")).alias("s"))
    by = {r["early"]: r["s"] for r in shares.collect()}
    assert by[True] > 0.7 and by[False] < 0.2


def test_experiment_shares(spark):
    users = spark.range(20_000).select(F.col("id").alias("user"))
    got = {r["arm"]: r["count"] / 20_000 for r in R.assign_experiment(users, "user", "s", {"a": 50, "b": 30, "c": 20}).groupBy("arm").count().collect()}
    assert all(abs(got[k] - v) < 0.02 for k, v in {"a": 0.5, "b": 0.3, "c": 0.2}.items())


def test_new_item_takes_second_slot(spark):
    recs = spark.createDataFrame([(u, i, i) for u in range(6) for i in (1, 2, 3)], "user bigint, item bigint, rank int")
    items = spark.createDataFrame([(2,), (90,)], "item bigint")
    users = spark.createDataFrame([(u, u) for u in range(6)], "user bigint, ts bigint")
    got = {}
    for r in R.new_item_exposure(recs, items, users, 2).collect():
        got.setdefault(r["user"], {})[r["rank"]] = r["item"]
    lists = {u: [v[k] for k in sorted(v)] for u, v in got.items()}
    assert lists[0] == [1, 2, 3] and lists[1] == [1, 2, 3]
    assert lists[2] == [1, 90, 2, 3] and lists[3] == [1, 90, 2, 3]
    assert lists[4] == [1, 2, 3] and lists[5] == [1, 2, 3]


def test_retrieve_keeps_its_length(spark):
    ranked = spark.createDataFrame([(1, i, i) for i in range(1, 21)], "user bigint, item bigint, rank int")
    gone = spark.createDataFrame([(i,) for i in range(1, 10)], "item bigint")
    got = RT.retrieve(ranked, [(gone, ["item"])], 5)
    assert rows(got, "item", "rank") == [(10, 1), (11, 2), (12, 3), (13, 4), (14, 5)]


def test_posting_lists_are_cut(spark):
    docs = spark.createDataFrame([(i, ["the", f"w{i}"]) for i in range(25)], "doc_id bigint, tokens array<string>")
    got = RT.posting_lists(docs, chunk=10).where("token = 'the'").orderBy("chunk").collect()
    assert [r["docs"] for r in got] == [list(range(10)), list(range(10, 20)), list(range(20, 25))]


def test_contract_violations(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2]), (1, [0.1]), (2, [5.0, 0.0]), (None, None)], "id bigint, vec array<double>")
    got = dict(E.check_schema(df, "id", "string", "vec", 2, -1.0, 1.0, 10).collect())
    assert got == {"key_type": 1, "key_missing": 1, "vector_missing": 1, "dimension": 1, "component_range": 1, "too_few": 1, "key_repeated": 1}


def test_pair_key_tells_pairs_apart(spark):
    pairs = spark.range(100).select((F.col("id") % 10).alias("u"), F.floor(F.col("id") / 10).alias("i"))
    assert pairs.select(keys.pair_key(F.col("u"), F.col("i")).alias("k")).distinct().count() == 100


def test_cascade_pools_when_nobody_is_sure(spark):
    preds = spark.createDataFrame([("a", 1, 2.0, 0.9), ("b", 1, 4.0, 0.9), ("a", 2, 2.0, 0.1), ("b", 2, 4.0, 0.9), ("a", 3, 2.0, 0.1), ("b", 3, 4.0, 0.2)],
                                  "model string, key bigint, score double, confidence double")
    got = rows(R.cascade(preds, ["a", "b"], 0.5), "key", "score", "model", "depth")
    assert got == [(1, 2.0, "a", 1), (2, 4.0, "b", 2), (3, 3.0, "pooled", 2)]


@pytest.mark.parametrize("limits", [{}, {"block": 9, "columns": 5}])
@pytest.mark.parametrize("text", [False, True])
def test_nearest_by_shared_bits_equals_the_best_pairs(spark, limits, text):
    import random

    from affinia.operators.similarity import neighbours

    draw = random.Random(2)
    rows = [(f"i{i}" if text else i, draw.sample("abcdefghij", draw.randint(0, 4))) for i in range(50)]
    items = spark.createDataFrame(rows, f"item {'string' if text else 'bigint'}, words array<string>")
    pairs = neighbours(B.bloom_similarity(items, "words").withColumnRenamed("common", "similarity"), 4)
    near = neighbours(B.bloom_similarity(items, "words", k=4, **limits).withColumnRenamed("common", "similarity"), 4)
    assert sorted(map(tuple, near.select(*pairs.columns).collect())) == sorted(map(tuple, pairs.collect()))
