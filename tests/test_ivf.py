"""The inverted file: exact scores, recall, and a cost per query that does not grow with the table."""

from dataclasses import replace

import numpy as np
import pytest

from affinia.operators import ivf as IVF
from affinia.operators import vectors as VE


def clustered(seed, n, dim=16, each=200):
    """Vectors around centres whose number grows with the table."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // each, dim))
    return centres[rng.integers(0, len(centres), n)] + 0.25 * rng.standard_normal((n, dim))


def frames(spark, vecs, n_queries=40):
    rng = np.random.default_rng(1)
    asked = vecs[rng.permutation(len(vecs))[:n_queries]] + 0.1 * rng.standard_normal((n_queries, vecs.shape[1]))
    make = lambda m, name: spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(m)], f"{name} bigint, vec array<double>, list int")
    return make(asked, "query"), make(vecs, "item"), asked


@pytest.fixture(scope="module")
def built(spark):
    out = []
    for n in (2000, 12000):
        queries, items, asked = frames(spark, clustered(n, n))
        out.append((queries, items, IVF.build(items, per_list=50)))
    return out


def test_cost_is_flat_and_recall_high(built):
    scanned = []
    for queries, items, index in built:
        exact = VE.knn(queries, items, 10, metric="cosine")
        assert VE.ann_recall(IVF.search(index, queries, 10), exact).first()["recall"] >= 0.9
        scanned.append(IVF.cost(index, queries).agg({"scanned": "avg"}).first()[0])
    assert built[1][2].n_lists == 6 * built[0][2].n_lists
    assert scanned[1] < 1.6 * scanned[0] and scanned[1] < 0.15 * 12000


def test_scores_are_exact_and_repeatable(built):
    queries, items, index = built[0]
    unit = lambda df, key: {r[key]: np.array(r["vec"]) / np.linalg.norm(r["vec"]) for r in df.collect()}
    q, x = unit(queries, "query"), unit(items, "item")
    got = IVF.search(index, queries, 10).collect()
    assert all(r["score"] == pytest.approx(float(q[r["query"]] @ x[r["item"]])) for r in got)
    ranks = {}
    for r in sorted(got, key=lambda r: (r["query"], r["rank"])):
        ranks.setdefault(r["query"], []).append((-round(r["score"], 9), r["item"]))
    assert all(v == sorted(v) and len(v) == 10 for v in ranks.values())
    again = IVF.search(IVF.build(items.repartition(7), per_list=50), queries.repartition(3), 10).collect()
    assert sorted((r["query"], r["item"]) for r in got) == sorted((r["query"], r["item"]) for r in again)


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_all_lists_give_the_exact_neighbours(spark, metric):
    queries, items, _ = frames(spark, clustered(3, 600, each=60), 15)
    index = replace(IVF.build(items, metric=metric, per_list=20), margins=(1e9, 1e9))
    exact = VE.knn(queries, items, 5, metric=metric)
    columns = ["query", "item", "rank"]
    assert sorted(IVF.search(index, queries, 5, metric=metric).select(columns).collect()) == sorted(exact.select(columns).collect())


def test_a_list_of_equal_items_is_cut_into_rows(spark, monkeypatch):
    monkeypatch.setattr(IVF._pack, "__defaults__", (50,))
    vecs = np.concatenate([np.tile([[1.0, 0.0, 0.0]], (400, 1)), np.random.default_rng(0).standard_normal((200, 3))])
    queries, items, _ = frames(spark, vecs, 5)
    index = IVF.build(items, per_list=20)
    sizes = [len(r["items"]) for r in index.lists.collect()]
    assert sum(sizes) == 600 and max(sizes) < 120
    hits = IVF.search(index, queries.limit(1).selectExpr("query", "array(1D, 0D, 0D) AS vec"), 5).collect()
    assert [r["score"] for r in hits] == pytest.approx([1.0] * 5)


def test_small_and_empty_tables(spark):
    queries, items, _ = frames(spark, np.array([[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]), 2)
    none = spark.createDataFrame([(77, None, 1)], "item bigint, vec array<double>, list int")
    assert IVF.search(IVF.build(none), queries, 3).collect() == []
    one = IVF.build(items.where("item = 0").unionByName(none))
    assert {(r["query"], r["item"]) for r in IVF.search(one, queries, 3).collect()} == {(0, 0), (1, 0)}
    assert IVF.search(IVF.build(items), queries, 3).count() == 6
    assert IVF.search(IVF.build(items), queries.limit(0), 3).count() == 0


def test_lists_are_measured_with_their_codes_and_broadcast(spark):
    """Queries stay in their tasks, where the best candidates are cut before the shuffle."""
    from affinia.operators import ivf
    from affinia.operators.sizes import measured_bytes

    assert measured_bytes(spark.createDataFrame([(1, bytearray(1000)), (2, None)], "list int, codes binary")) >= 1000
    vecs = np.random.default_rng(5).standard_normal((600, 4))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "item bigint, vec array<double>")
    index = ivf.build(items, per_list=32)
    plan = ivf.candidates(index, items.selectExpr("item AS query", "vec"), 40)._jdf.queryExecution().executedPlan().toString()
    assert any("BroadcastHashJoin [list" in line for line in plan.splitlines())


@pytest.mark.parametrize("margin", [None, 1e9])
def test_search_is_the_same_whether_the_index_is_held_or_joined(spark, monkeypatch, margin):
    queries, items, _ = frames(spark, clustered(4, 1500, each=50), 30)
    index = IVF.build(items, per_list=20)
    index = index if margin is None else replace(index, margins=(margin, margin))
    columns = ["query", "item", "rank"]
    with monkeypatch.context() as patch:
        # Of a held index no candidate leaves the task of its query.
        patch.setattr(IVF, "candidates", None)
        held, cost = IVF.search(index, queries, 5, again=40).select(columns).collect(), IVF.cost(index, queries).collect()
    monkeypatch.setattr(IVF, "INDEX_BYTES", 0)
    monkeypatch.setattr(IVF, "CENTRES_BYTES", 0)
    assert sorted(held) == sorted(IVF.search(index, queries, 5, again=40).select(columns).collect())
    assert sorted(cost) == sorted(IVF.cost(index, queries).collect())
