"""Micro-batches in a set order: late rows, restarts and equality with the batch form."""

import os
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from affinia.operators import similarity as S
from affinia.sources import io
from affinia.streaming import operators as ST
from affinia.streaming.tables import append_to, latest_rows, read_parts

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp, user bigint, item bigint, event_type string, value double"


def write_in_order(spark, folder, batches, schema=SCHEMA):
    """One file per batch with rising modification times, so they are read in order."""
    os.makedirs(folder)
    for n, batch in enumerate(batches):
        part = f"{folder}-parts/{n}"
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        with open(f"{part}/{name}", "rb") as source, open(f"{folder}/{n}.parquet", "wb") as target:
            target.write(source.read())
        os.utime(f"{folder}/{n}.parquet", (1_700_000_000 + 60 * n,) * 2)
    return folder


def event(i, minutes, user=1, item=1, kind="view", value=1.0):
    return (i, T0 + timedelta(minutes=minutes), user, item, kind, value)


def test_late_row_is_dropped(spark, tmp_path):
    # The watermark that drops rows is that of the batch before last.
    batches = [[event(0, 5), event(1, 65)], [event(2, 200)], [event(5, 210)], [event(3, 10)], [event(4, 500)]]
    folder = write_in_order(spark, str(tmp_path / "in"), batches)
    stream = io.read_event_stream(spark, folder, SCHEMA, 1)
    out = str(tmp_path / "out")
    append_to(ST.stream_popularity(stream, "1 hour", delay="10 minutes"), out, str(tmp_path / "cp")).awaitTermination()
    got = rows(spark.read.parquet(out), "start", "times_chosen")
    assert got == [(T0, 1), (T0 + timedelta(hours=1), 1), (T0 + timedelta(hours=3), 2)]


def test_feature_log_survives_a_restart(spark, tmp_path):
    folder = write_in_order(spark, str(tmp_path / "in"), [[event(0, 1, 1, 10), event(1, 2, 2, 20)], [event(2, 5, 1, 11), event(3, 0, 2, 19)]])
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = io.read_event_stream(spark, folder, SCHEMA, 1).select("user", "ts", "item")
        ST.stream_feature_upsert(stream, out, cp, "user").awaitTermination()
        return rows(latest_rows(read_parts(spark, out, "user bigint, ts timestamp, item bigint"), ["user"], "ts"), "user", "item")

    assert run() == [(1, 11), (2, 20)]
    assert run() == [(1, 11), (2, 20)]
    spark.createDataFrame([event(4, 9, 2, 21)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    assert run() == [(1, 11), (2, 21)]


def test_speed_layer_over_several_batches(spark, tmp_path):
    """Users new since the build keep the mean of their first batch; replaced ratings count once."""
    base = [(1, 1, 5.0), (1, 2, 3.0), (2, 1, 4.0), (2, 3, 2.0), (3, 2, 1.0)]
    news = [[(3, 1, 4.0), (9, 1, 2.0), (9, 2, 4.0)], [(1, 1, 1.0), (9, 3, 5.0)], [(9, 1, 3.0), (2, 2, 2.0)]]
    schema = "user bigint, item bigint, rating double, ts timestamp"
    stamped = [[(*r, T0 + timedelta(hours=n)) for r in batch] for n, batch in enumerate(news)]
    folder = write_in_order(spark, str(tmp_path / "in"), stamped, schema)
    old = spark.createDataFrame(base, "user bigint, item bigint, rating double")
    means = old.groupBy("user").agg(F.avg("rating").alias("mean"))
    stream = io.read_event_stream(spark, folder, schema, 1)
    ST.speed_layer_similarity(stream, old, means, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = S.add_sums(S.similarity_sums(old).unionByName(read_parts(spark, str(tmp_path / "out/sums"), ST.SUM_LOG)))
    after = {(u, i): r for u, i, r in base}
    for batch in news:
        after.update({(u, i): r for u, i, r in batch})
    held = {1: 4.0, 2: 3.0, 3: 1.0, 9: 3.0}
    expected = {}
    for (u, i), r in after.items():
        for (v, j), q in after.items():
            if i == j and u < v:
                n, s = expected.get((u, v), (0, 0.0))
                expected[u, v] = (n + 1, s + (r - held[u]) * (q - held[v]))
    found = {(r["left"], r["right"]): (r["n"], r["sxy"]) for r in got.where("n > 0").collect()}
    assert found.keys() == expected.keys()
    assert all(found[k][0] == v[0] and abs(found[k][1] - v[1]) < 1e-9 for k, v in expected.items())


def test_freshness_counts_add_up(spark, tmp_path):
    batches = [[event(0, 0), event(1, 1)], [event(2, 2), event(3, 3, 2)], [event(4, 4, 1, 5), event(5, 5, 1, 5, "click")]]
    folder = write_in_order(spark, str(tmp_path / "in"), batches)
    out = str(tmp_path / "out")
    ST.freshness_state(io.read_event_stream(spark, folder, SCHEMA, 1), out, str(tmp_path / "cp")).awaitTermination()
    parts = read_parts(spark, out, ST.FRESHNESS_LOG)
    assert rows(ST.stale_since(parts, 3)) == [(1, 1, 3)]
    assert ST.stale_since(parts, 3, since="2024-01-02").isEmpty()


def test_missing_log_reads_as_empty(spark, tmp_path):
    assert read_parts(spark, str(tmp_path / "none"), "a bigint").count() == 0


def test_outcome_beyond_the_bound_does_not_count(spark, tmp_path):
    views = write_in_order(spark, str(tmp_path / "v"), [[event(0, 0), event(1, 0, 2)], [event(9, 10_000, 7)]])
    buys = write_in_order(spark, str(tmp_path / "b"), [[event(2, 30, 1, 1, "purchase"), event(3, 500, 2, 1, "purchase")], [event(8, 10_000, 8)]])
    preds = io.read_event_stream(spark, views, SCHEMA, 1).select("event_id", "user", "item", "ts")
    outcomes = io.read_event_stream(spark, buys, SCHEMA, 1).select("user", "item", "ts")
    out = str(tmp_path / "out")
    append_to(ST.stream_outcome_join(preds, outcomes, "2 hours", "1 hour"), out, str(tmp_path / "cp")).awaitTermination()
    got = {r["event_id"]: r["outcome_ts"] for r in spark.read.parquet(out).collect()}
    assert got[0] == T0 + timedelta(minutes=30) and got[1] is None


def test_late_outcomes_are_counted_and_unmatched_predictions_come_once(spark, tmp_path):
    views = write_in_order(spark, str(tmp_path / "v"), [[event(0, 0), event(1, 0, 2)], [event(9, 10_000, 7)], [event(10, 20_000, 7)], [event(11, 20_001, 7)]])
    buys = write_in_order(spark, str(tmp_path / "b"), [
        [event(2, 30, 1, 1, "purchase")], [event(8, 10_000, 8, 1, "purchase")], [event(6, 20_000, 8)],
        [event(3, 40, 2, 1, "purchase"), event(7, 20_002, 8)]])
    preds = io.read_event_stream(spark, views, SCHEMA, 1).select("event_id", "user", "item", "ts")
    outcomes = io.read_event_stream(spark, buys, SCHEMA, 1).select("user", "item", "ts")
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    joined = ST.stream_outcome_join(preds, outcomes, "2 hours", "1 hour")
    query = append_to(joined, out, cp)
    query.awaitTermination()
    assert ST.late_rows(query) == 1
    append_to(joined, out, cp).awaitTermination()  # a restart repeats nothing
    got = sorted((r["event_id"], r["outcome_ts"]) for r in spark.read.parquet(out).collect())
    assert got[:2] == [(0, T0 + timedelta(minutes=30)), (1, None)]
    assert len({e for e, _ in got}) == len(got)
    rates = ST.outcome_rates(spark.read.parquet(out), "event_id").orderBy("day").first()
    assert (rates["views"], rates["followed"], rates["outcomes"]) == (2, 1, 1)
