"""Versioned tables: constant read cost, pinned readers, retries, deletions, and what a batch reads."""

import os
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from affinia.operators import layered_bloom as LB
from affinia.operators import similarity as S
from affinia.streaming import operators as ST
from affinia.streaming.tables import StateTable, latest_by, read_parts, sum_by

T0 = datetime(2024, 1, 1)


def counts(spark, path, **options):
    return StateTable(spark, str(path), "k bigint, n bigint", ["k"], sum_by(["k"], "n"), **options)


def delta(spark, pairs):
    return spark.createDataFrame(pairs, "k bigint, n bigint")


def parquet_files(path):
    return sum(n.endswith(".parquet") for _, _, names in os.walk(path) for n in names)


def test_read_cost_stays_constant_over_fifty_batches_and_a_restart(spark, tmp_path):
    table, expected, opened = counts(spark, tmp_path / "t", buckets=3, parts=4, kept=2), {}, []
    for batch in range(50):
        if batch == 25:  # a new process knows nothing but the path
            table = counts(spark, tmp_path / "t", buckets=7)
        table.apply(delta(spark, [(batch % 5, 1), (batch % 7, 10)]), batch)
        for k, n in ((batch % 5, 1), (batch % 7, 10)):
            expected[k] = expected.get(k, 0) + n
        opened.append(len(table.paths(table.version())))
    assert {r["k"]: r["n"] for r in table.read().collect()} == expected
    assert max(opened) <= 3 * 4 and sum(opened[30:]) / 20 < 1.3 * sum(opened[10:30]) / 20
    assert table.version().number == 50 and len(table.versions()) <= 4
    assert parquet_files(tmp_path / "t") <= 4 * 3 * 5


def test_a_batch_that_runs_again_leaves_one_version(spark, tmp_path, monkeypatch):
    table = counts(spark, tmp_path / "t", buckets=2)
    table.apply(delta(spark, [(1, 1)]), 0)
    with monkeypatch.context() as m:  # dies between its parts and its manifest
        m.setattr(type(table.folder), "put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.apply(delta(spark, [(1, 5), (2, 5)]), 1)
    assert rows(table.read()) == [(1, 1)]
    for _ in range(3):  # after the commit it changes nothing
        table.apply(delta(spark, [(1, 5), (2, 5)]), 1)
    assert rows(table.read()) == [(1, 6), (2, 5)] and table.versions() == [1, 2]
    named = {p for parts in table.version().parts.values() for p in parts}
    assert set(table.folder.names("data")) == named  # what the lost attempt left is gone


def test_a_reader_stays_on_its_version(spark, tmp_path):
    table = counts(spark, tmp_path / "t", buckets=1, parts=2, kept=3)
    table.apply(delta(spark, [(1, 1)]), 0)
    early = table.read()
    for batch in (1, 2):
        table.apply(delta(spark, [(1, 1), (batch + 1, 1)]), batch)
    assert rows(early) == [(1, 1)]
    assert rows(table.read(number=2)) == [(1, 2), (2, 1)]
    assert rows(table.read()) == [(1, 3), (2, 1), (3, 1)]


def test_deleted_rows_go_and_may_come_back(spark, tmp_path):
    schema = "user bigint, ts timestamp, x string, deleted boolean"
    table = StateTable(spark, str(tmp_path / "t"), schema, ["user"], latest_by(["user"], "ts"), 1, 2)

    def put(batch, *entries):
        table.apply(spark.createDataFrame([(u, T0 + timedelta(hours=h), x, gone) for u, h, x, gone in entries], schema), batch)

    put(0, (1, 0, "a", None), (2, 0, "b", False))
    put(1, (1, 1, None, True))
    assert rows(table.read(), "user", "x") == [(2, "b")]
    put(2, (3, 2, "c", None))  # compacts
    assert read_parts(spark, str(tmp_path / "t"), schema).where("deleted").isEmpty()
    put(3, (1, 3, "again", None))
    assert rows(table.read(), "user", "x") == [(1, "again"), (2, "b"), (3, "c")]


def test_only_named_buckets_are_read(spark, tmp_path):
    table = counts(spark, tmp_path / "t", buckets=8)
    table.apply(delta(spark, [(k, k) for k in range(64)]), 0)
    wanted = delta(spark, [(5, 0), (6, 0)])
    only = table.buckets_of(wanted)
    assert 1 <= len(only) <= 2
    got = table.read(only=only)
    assert len(got.inputFiles()) == len(only)
    assert {5, 6} <= {r["k"] for r in got.collect()}
    assert table.read(only=[]).isEmpty()


def test_empty_batches_and_tables(spark, tmp_path):
    table = counts(spark, tmp_path / "t")
    assert table.read().isEmpty() and table.version() is None and table.buckets_of(delta(spark, [])) == []
    table.apply(delta(spark, []), 0, {"note": 1})
    assert table.read().isEmpty() and table.version().meta == {"note": 1}
    table.apply(delta(spark, [(None, 2)]), 1)
    assert rows(table.read()) == [(None, 2)] and table.version().meta == {"note": 1}


def test_a_batch_of_ratings_reads_only_its_items_buckets(spark, tmp_path, monkeypatch):
    base = spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(30) for i in range(40) if (u + i) % 3 == 0],
                                 "user bigint, item bigint, rating double")
    means = base.groupBy("user").agg(F.avg("rating").alias("mean"))
    layer = ST.SpeedLayer(spark, str(tmp_path / "s"), buckets=16)
    layer.start(base, means)
    layer.start(base, means)
    opened = []
    real = StateTable.raw
    monkeypatch.setattr(StateTable, "raw", lambda self, version, only=None: (
        opened.append((self.path.rsplit("/", 1)[-1], len(self.paths(version, only)) if version else 0)), real(self, version, only))[1])
    batch = spark.createDataFrame([(3, 7, 1.0, T0), (99, 7, 5.0, T0)], "user bigint, item bigint, rating double, ts timestamp")
    layer.add(batch, 0)
    layer.add(batch, 0)
    assert max(n for name, n in opened if name == "ratings") == 1
    assert max(n for name, n in opened if name == "means") <= 4
    monkeypatch.undo()
    after = base.where("not (user = 3 and item = 7)").unionByName(batch.drop("ts"))
    held = means.unionByName(spark.createDataFrame([(99, 5.0)], "user bigint, mean double"))
    expected = S.pearson(S.add_sums(S.pair_sums(after.join(held, "user").withColumn("deviation", F.col("rating") - F.col("mean")), "user", "item", "deviation")))
    got = S.add_sums(S.similarity_sums(base).unionByName(layer.sums.read())).where("n > 0")
    assert sorted((r["left"], r["right"], r["n"], round(r["sxy"], 6) + 0.0) for r in got.collect()) == sorted(
        (r["left"], r["right"], r["n"], round(r["sxy"], 6) + 0.0) for r in expected.collect())


def test_bloom_state_grows_by_layers(spark, tmp_path):
    path = str(tmp_path / "b")
    source = tmp_path / "in"
    for n, (lo, hi) in enumerate(((0, 50), (0, 120), (100, 400))):
        spark.range(lo, hi).select(F.col("id").alias("key")).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("key bigint").parquet(str(source))
        ST.stream_bloom_add(stream, path, str(tmp_path / "cp"), "key", 1e-4, first=64).awaitTermination()
    held = ST.merged_bloom(spark, path, 1e-4, 64)
    assert [x.number for x in held.layers] == [0, 1, 2] and sum(x.keys for x in held.layers) <= 400
    _, stored = ST.bloom_tables(spark, path)
    asked = spark.range(0, 2000).select(F.col("id").alias("key"))
    assert {r["key"] for r in LB.settled(held, asked, "key", stored.read()).where("present").collect()} == set(range(400))


def test_rows_that_are_merged_are_not_merged_or_held_again(spark, tmp_path, monkeypatch):
    table = counts(spark, tmp_path / "t", buckets=2, parts=2)
    merges = []
    real = table.merge
    monkeypatch.setattr(table, "merge", lambda df: (merges.append(1), real(df))[1])
    table.apply(delta(spark, [(1, 1), (2, 5), (None, 3)]), 0, merged=True)
    assert rows(table.read().where("k is not null")) == [(1, 1), (2, 5)] and table.read().count() == 3 and not merges
    table.apply(delta(spark, [(1, 1), (1, 2)]), 1)
    assert rows(table.read().where("k is not null")) == [(1, 4), (2, 5)] and len(merges) > 0
    table.apply(delta(spark, [(1, 1), (2, 1)]), 2, merged=True)  # compacts
    table.apply(delta(spark, [(1, 1)]), 3)
    assert rows(table.read().where("k is not null")) == [(1, 6), (2, 6)]
