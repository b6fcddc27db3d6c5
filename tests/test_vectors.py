"""Nearest neighbours, centroids, playlists and losses against numpy."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from affinia.operators import evaluate as E
from affinia.operators import models as M
from affinia.operators import playlists as P
from affinia.operators import vectors as VE

RNG = np.random.default_rng(0)
Q = np.round(RNG.standard_normal((40, 8)), 3)
X = np.round(RNG.standard_normal((300, 8)), 3)
X[50:60] = X[40]


def frames(spark, names="bigint"):
    key = (lambda i: i) if names == "bigint" else (lambda i: f"n{i:05d}")
    q = spark.createDataFrame([(key(i), [float(v) for v in r]) for i, r in enumerate(Q)], f"query {names}, vec array<double>")
    x = spark.createDataFrame([(key(i), [float(v) for v in r]) for i, r in enumerate(X)], f"item {names}, vec array<double>")
    return q, x


def expected_top(metric, k):
    a, b = Q, X
    if metric == "cosine":
        a, b = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (Q, X))
    scores = np.round(a @ b.T, 9)
    return {q: [int(i) for i in np.lexsort((np.arange(len(X)), -scores[q]))[:k]] for q in range(len(Q))}


@pytest.mark.parametrize("metric", ["dot", "cosine"])
@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0, "block": 16}, {"broadcast_bytes": 0, "block": 10000}])
@pytest.mark.parametrize("names", ["bigint", "string"])
def test_knn(spark, metric, how, names):
    """Broadcast and block forms agree with numpy; equal vectors rank by key."""
    q, x = frames(spark, names)
    got = {}
    for r in VE.knn(q, x.repartition(5), 12, metric=metric, **how).collect():
        strip = (lambda v: v) if names == "bigint" else (lambda v: int(v[1:]))
        got.setdefault(strip(r["query"]), {})[r["rank"]] = strip(r["item"])
    assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == expected_top(metric, 12)


def test_knn_without_self(spark):
    _, x = frames(spark)
    got = VE.knn(x, x, 1, "item", "item", exclude_self=True).collect()
    assert len(got) == len(X) and all(r["query"] != r["item"] for r in got)
    near = {r["query"]: r["item"] for r in VE.knn(x, x, 1, "item", "item", metric="cosine").collect()}
    assert near[40] == 40 and near[55] == 40 and near[7] == 7


def test_fewer_items_than_k(spark):
    q, x = frames(spark)
    assert VE.knn(q, x.where("item < 3"), 10).groupBy("query").count().where("count != 3").isEmpty()


@pytest.mark.parametrize("block", [8192, 7])
def test_ann_is_exact_inside_buckets(spark, block):
    q, x = frames(spark)
    found = VE.ann(q, x, 10, bits=2, tables=6, block=block)
    exact = VE.knn(q, x, 10, metric="cosine")
    assert VE.ann_recall(found, exact).first()["recall"] > 0.8
    every = {(r["query"], r["item"]): r["score"] for r in VE.knn(q, x, 300, metric="cosine").collect()}
    assert all(abs(r["score"] - every[r["query"], r["item"]]) < 1e-12 for r in found.collect())
    again = VE.ann(q.repartition(3), x.repartition(4), 10, bits=2, tables=6, block=8192)
    shown = ["query", "item", "rank", F.round("score", 9)]
    assert rows(found, *shown) == rows(again, *shown)


def test_weighted_centroid(spark):
    _, x = frames(spark)
    likes = spark.createDataFrame([(1, 3, 2.0), (1, 9, 5.0), (2, 4, 1.0)], "user bigint, item bigint, rating double")
    got = {r["user"]: r["vec"] for r in VE.centroids(likes, x, weight="rating").collect()}
    assert np.allclose(got[1], (2 * X[3] + 5 * X[9]) / 2) and np.allclose(got[2], X[4])
    top = VE.centroid_search(likes, x, 1).where("query = 2").first()
    assert top["item"] == 4


def test_per_item_search(spark):
    _, x = frames(spark)
    likes = spark.createDataFrame([(1, 40, 1.0), (1, 9, 5.0), (1, 200, 2.0)], "user bigint, item bigint, rating double")
    unit = X / np.linalg.norm(X, axis=1, keepdims=True)
    best = {}
    for item, rating in ((40, 1.0), (9, 5.0), (200, 2.0)):
        s = unit @ unit[item]
        s[item] = -np.inf
        s = np.round(s, 9)
        near = int(np.argmax(s))
        best[near] = min(best.get(near, 9), (1 - s[near]) / rating)
    expected = sorted(best.items(), key=lambda v: (v[1], v[0]))[:2]
    got = [(r["candidate"], r["value"]) for r in VE.per_item_search(likes, x, 2).orderBy("rank").collect()]
    assert [g[0] for g in got] == [e[0] for e in expected]


def test_per_item_search_with_ratings_of_zero(spark):
    x = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, [0.0, 1.0]), (4, [-1.0, 0.2])], "item bigint, vec array<double>")
    likes = spark.createDataFrame([(1, 0, 0.0), (1, 4, 2.0), (2, 0, 0.0), (2, 2, 0.0)], "user bigint, item bigint, rating double")
    got = VE.per_item_search(likes, x, 5).orderBy("user", "rank").collect()
    assert [(r["user"], r["candidate"]) for r in got] == [(1, 2), (1, 1), (2, 1), (2, 3)]
    assert 0 < got[0]["value"] < 1 and got[1]["value"] == got[2]["value"] == float("inf") and np.isnan(got[3]["value"])


# ---- playlists --------------------------------------------------------------------------

ALBUMS, ARTISTS = np.round(RNG.standard_normal((9, 4)), 2), np.round(RNG.standard_normal((7, 4)), 2)
TRACKS = [(t, t % 13, t % 7) for t in range(60)]
LISTS = {p: [int(t) for t in np.random.default_rng(p).integers(0, 60, 6 + p)] for p in range(9)}


def playlist_frames(spark):
    data = [(0, p, i, *TRACKS[t]) for p, ts in LISTS.items() for i, t in enumerate(ts)]
    tracks = spark.createDataFrame(data, "file bigint, pl bigint, pos bigint, track_idx bigint, album_idx bigint, artist_idx bigint")
    vec = "id bigint, vec array<double>"
    albums = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(ALBUMS)], vec)
    artists = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(ARTISTS)], vec)
    every = spark.createDataFrame(TRACKS, "track_idx bigint, album_idx bigint, artist_idx bigint")
    return tracks, albums, artists, every


def model_score(p, t):
    vec = lambda t: np.concatenate([ALBUMS[TRACKS[t][1] % 9], ARTISTS[TRACKS[t][2]]])
    context = LISTS[p][:5]
    s = max(vec(c) @ vec(t) for c in context)
    return s + 0.1 * (TRACKS[t][1] in [TRACKS[c][1] for c in context]) + 0.1 * (TRACKS[t][2] in [TRACKS[c][2] for c in context])


@pytest.mark.parametrize("blocks", [{}, {"block_examples": 2, "block_tracks": 11}])
def test_corpus_scores_and_recall(spark, blocks):
    tracks, albums, artists, every = playlist_frames(spark)
    examples = P.split_context_next(tracks)
    contexts = P.context_vectors(examples, albums, artists, "pl", 9)
    corpus = P.album_artist_vectors(every, albums, artists, 9)
    top = P.score_corpus(contexts, corpus, 20, **blocks).collect()
    for p, ts in LISTS.items():
        expected = sorted(range(60), key=lambda t: (-round(model_score(p, t), 9), t))[:20]
        got = sorted((r for r in top if r["pl"] == p), key=lambda r: r["rank"])
        assert [r["track_idx"] for r in got] == expected
        assert all(abs(r["score"] - model_score(p, r["track_idx"])) < 1e-9 for r in got)
    recall = {r["pl"]: r for r in P.recall_at_k(P.score_corpus(contexts, corpus, 20, **blocks), examples).collect()}
    for p, ts in LISTS.items():
        best = sorted(range(60), key=lambda t: (-round(model_score(p, t), 9), t))[:20]
        nexts = ts[5:]
        assert abs(recall[p]["track_recall"] - sum(t in nexts for t in best) / len(nexts)) < 1e-12
        assert abs(recall[p]["artist_recall"] - sum(TRACKS[t][2] in [TRACKS[n][2] for n in nexts] for t in best) / len(nexts)) < 1e-12


def test_short_playlists_are_dropped(spark):
    data = [(0, 1, i, i, 0, 0) for i in range(5)] + [(0, 2, i, i, 0, 0) for i in range(6)]
    df = spark.createDataFrame(data, "file bigint, pl bigint, pos bigint, track_idx bigint, album_idx bigint, artist_idx bigint")
    got = P.split_context_next(df).collect()
    assert [(r["pl"], r["track_context"], r["next_track"]) for r in got] == [(2, [0, 1, 2, 3, 4], [5])]


def test_playlist_loss(spark):
    c, p, n = (np.round(RNG.standard_normal((k, 6)), 2) for k in (5, 3, 4))
    pa, na = [0.5, 2.0, 1.0], [0.1, 0.9, -1.0, 0.3]
    df = spark.createDataFrame([(1, c.tolist(), p.tolist(), n.tolist(), pa, na)],
                               "pl bigint, context_vecs array<array<double>>, pos_vecs array<array<double>>, neg_vecs array<array<double>>, "
                               "pos_affinity array<double>, neg_affinity array<double>")
    relu = lambda x: np.maximum(0, x)
    flip = lambda m: m[::-1] @ m.T
    expected = {
        "mean_triplet": relu(1 + np.mean(na) - np.mean(pa)), "extremal_triplet": relu(1 + max(na) - min(pa)),
        "context_self": relu(0.5 - flip(c)).mean(), "next_self": relu(0.5 - flip(p)).mean(), "negative_self": relu(flip(n)).mean(),
        "norm_excess": relu(np.linalg.norm(np.concatenate([c, p, n]), axis=1) - 1.5).sum(),
    }
    got = P.playlist_loss(df, bound=1.5).first()
    assert all(abs(got[k] - v) < 1e-9 for k, v in expected.items())
    assert abs(got["loss"] - sum(expected.values())) < 1e-9


def test_glove_loss_falls(spark):
    rng = np.random.default_rng(1)
    triples = [(i, j, float(rng.integers(1, 200))) for i in range(12) for j in range(i)]
    df = spark.createDataFrame(triples, "i bigint, j bigint, x double")
    params, losses = M.glove_fit(df, dim=4, iterations=4)
    assert all(b < a for a, b in zip(losses, losses[1:]))
    assert params.count() == 12
    vec = {r["id"]: (np.array(r["vec"]), r["bias"]) for r in params.collect()}
    model = np.mean([min(1, x / 100) ** 0.75 * (np.log10(1 + x) - (vec[i][0] @ vec[j][0] + vec[i][1] + vec[j][1])) ** 2 for i, j, x in triples])
    assert abs(model - losses[-1]) < 1e-9 and abs(E.glove_loss(df, params).first()["loss"] - model) < 1e-9


def test_glove_steps_do_not_depend_on_blocks(spark):
    rng = np.random.default_rng(2)
    triples = [(i, j, float(rng.integers(1, 200))) for i in range(40) for j in range(i) if (i * j) % 3] + [(99, j, 5.0) for j in range(40)]
    df = spark.createDataFrame(triples, "i bigint, j bigint, x double")
    fits = [M.glove_fit(df, dim=3, iterations=3, **blocks) for blocks in ({}, {"block": 7, "cell": 5}, {"block": 1})]
    ids = [{r["id"]: [*r["vec"], r["bias"]] for r in params.collect()} for params, _ in fits]
    assert ids[0].keys() == {i for t in triples for i in t[:2]}
    for other, (_, losses) in zip(ids[1:], fits[1:]):
        assert losses == pytest.approx(fits[0][1])
        assert all(other[k] == pytest.approx(v) for k, v in ids[0].items())


def test_glove_steps_send_no_block_to_every_cell(spark, monkeypatch):
    """A sparse matrix: parameters are not joined to edges, whether they are broadcast whole or in shares."""
    rng = np.random.default_rng(3)
    triples = [(int(i) + (1 << 40), int(j), float(x)) for i, j, x in {(i, j): (i, j, x) for i, j, x in zip(
        rng.integers(0, 300, 500), rng.integers(0, 300, 500), rng.integers(1, 200, 500))}.values()] + [(7, 7, 3.0)]
    df = spark.createDataFrame(triples, "i bigint, j bigint, x double")
    whole, losses = M.glove_fit(df, dim=3, iterations=2, block=50)
    monkeypatch.setattr(M, "_cells", None)
    for limit in (M.PARAMS_BYTES, 8000):
        monkeypatch.setattr(M, "PARAMS_BYTES", limit)
        params, found = M.glove_fit(df, dim=3, iterations=2)
        assert found == pytest.approx(losses)
        got, expected = ({r["id"]: [*r["vec"], r["bias"]] for r in p.collect()} for p in (params, whole))
        assert got.keys() == expected.keys() and all(got[k] == pytest.approx(v) for k, v in expected.items())


def test_small_blocks_do_not_send_a_vector_to_every_block(spark, monkeypatch):
    sent = []
    real = VE._cogroup
    monkeypatch.setattr(VE, "_cogroup", lambda q, i, *a: (sent.append(q.count() + i.count()), real(q, i, *a))[1])
    rng = np.random.default_rng(4)
    q, x = (spark.createDataFrame([(k, [float(v) for v in np.round(rng.standard_normal(4), 1)]) for k in range(400)], f"{n} bigint, vec array<float>")
            for n in ("query", "item"))
    got = VE.knn(q, x, 5, broadcast_bytes=0, block=4).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in VE.knn(q, x, 5).collect()} and len(got) == 2000
    assert len(sent) == 1 and sent[0] < 800 * 20


def test_candidates_of_documents_are_counted_without_a_row_per_pair(spark, monkeypatch):
    """As the joins find them, with repeated rows, words of every document, and none of a query's."""
    from affinia.operators import retrieval as RT

    rng = np.random.default_rng(6)
    words = [[f"w{int(x)}" for x in rng.zipf(1.3, 12) % 40] for _ in range(90)]
    queries = spark.createDataFrame([(k, w + w[:2]) for k, w in enumerate(words[:20])] + [(99, ["none"]), (98, [])], "query bigint, tokens array<string>")
    index = spark.createDataFrame([(t, k) for k, w in enumerate(words[20:]) for t in w], "token string, doc_id bigint")
    expected = {(q, d, len(set(words[q]) & set(words[20 + d]))) for q in range(20) for d in range(70)}
    joined = RT.inverted_candidates(queries, index, group_limit=5)
    assert {tuple(r) for r in joined.collect()} == {x for x in expected if x[2]}
    monkeypatch.setattr(RT, "shared_counts", None)
    monkeypatch.setattr(RT, "CELLS", 50)
    found = RT.inverted_candidates(queries, index)
    assert {tuple(r) for r in found.collect()} == {x for x in expected if x[2]}
    assert RT.inverted_candidates(queries.limit(0), index).collect() == []
    vecs = {k: rng.standard_normal(3) for k in range(70)}
    frame = lambda name: spark.createDataFrame([(k, [float(x) for x in v]) for k, v in vecs.items()], f"{name} bigint, vec array<double>")
    top = {(r["query"], r["rank"]): r["doc_id"] for r in RT.rerank_by_vector(found, frame("query"), frame("doc_id"), 4).collect()}
    for q in range(20):
        cosine = lambda d: vecs[q] @ vecs[d] / np.linalg.norm(vecs[q]) / np.linalg.norm(vecs[d])  # noqa: B023, E731
        best = sorted((d for x, d, n in expected if x == q and n), key=lambda d: (-cosine(d), d))[:4]
        assert [top[q, r + 1] for r in range(len(best))] == best


def test_item_vectors_are_fitted_until_nothing_is_gained(spark, monkeypatch):
    """Items of a taste stand together in most histories, and with all others in a few."""
    rng = np.random.default_rng(4)
    seqs = [([int(x) for x in (rng.permutation(12) + 12 * (n % 2) if n % 8 else rng.permutation(24))],) for n in range(120)]
    df = spark.createDataFrame(seqs, "items array<bigint>")
    fits, real = [], M.glove_fit
    monkeypatch.setattr(M, "glove_fit", lambda *a, **b: (fits.append(real(*a, **b)), fits[-1])[1])
    vecs = {int(r["item"]): np.array(r["vec"]) for r in M.item_embeddings(df, "items", dim=4).collect()}
    (_, losses), = fits
    falls = -np.diff(losses) / np.array(losses[:-1])
    assert len(vecs) == 24 and len(losses) > 5 and (falls[:-1] >= M.TOLERANCE).all() and losses[-1] < 0.1 * losses[1]
    own = np.mean([vecs[a] @ vecs[b] for a in range(12) for b in range(12) if a != b])
    met = np.mean([vecs[a] @ vecs[b + 12] for a in range(12) for b in range(12)])
    assert own > met + 0.5
    shares = {}
    for limit in (M.PARAMS_BYTES, 500):
        monkeypatch.setattr(M, "PARAMS_BYTES", limit)
        shares[limit] = {r["item"]: r["vec"] for r in M.item_embeddings(df, "items", dim=4).collect()}
    whole, cut = shares.values()
    assert whole.keys() == cut.keys() and all(cut[k] == pytest.approx(v, abs=1e-6) for k, v in whole.items())
