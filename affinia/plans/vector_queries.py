"""Queries on vectors, playlists, sampling, bloom filters and token lookup."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.functions import keys, scores, text
from affinia.operators import active as A
from affinia.operators import bloom as B
from affinia.operators import cooccurrence as C
from affinia.operators import dictionary as D
from affinia.operators import evaluate as E
from affinia.operators import ivf as IVF
from affinia.operators import layered_bloom as LB
from affinia.operators import features as FE
from affinia.operators import models as M
from affinia.operators import playlists as P
from affinia.operators import retrieval as RT
from affinia.operators import sampling as SA
from affinia.operators import vectors as VE
from affinia.operators.filters import min_playlist_length
from affinia.operators.indexing import dense_index, place_in_group, top_per_group
from affinia.operators.track_search import list_rows, recall_of_lists, track_lists
from affinia.plans import views as V
from affinia.plans.interaction_queries import score_table
from affinia.plans.registry import query, rounded
from affinia.plans.text_queries import COO, digest, title_pairs, triples
from affinia.plans.views import sql
from affinia.session import cut_lineage


def with_sql(names: str, more: str) -> str:
    """The named views and further ones, ready for a SELECT."""
    return sql(names, "SELECT 0").replace(" SELECT 0", ", " + more) + " "


def big(column: str = "rank"):
    return F.col(column).cast("bigint").alias(column)


# ---- vectors ----------------------------------------------------------------------------

def scenes(spark, sf) -> DataFrame:
    return V.vecs(spark, sf).where(F.col("id") % 2 == 0).select(F.col("id").alias("query"), "vec", "label")


def products(spark, sf) -> DataFrame:
    return V.vecs(spark, sf).where(F.col("id") % 2 == 1).select(F.col("id").alias("item"), "vec", "label")


DOT_SQL = "x AS (SELECT q.id AS query, i.id AS item, list_dot_product(q.vec, i.vec) AS s FROM vecs q JOIN vecs i ON q.id % 2 = 0 AND i.id % 2 = 1)"
TOP_SQL = (
    "SELECT query, item, round(s, 6) AS score, rk AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(s, 9) DESC, item) AS rk FROM x) WHERE rk <= "
)


@query("RET-01_knn_inner_product", with_sql("vecs", DOT_SQL) + TOP_SQL + "10")
def _(spark, sf):
    found = VE.knn(scenes(spark, sf), products(spark, sf), 10)
    return found.select("query", "item", rounded("score").alias("score"), big())


@query("RET-01_knn_in_blocks", with_sql("vecs", DOT_SQL) + TOP_SQL + "10")
def _(spark, sf):
    """As above with no side broadcast: blocks of 64 on both sides."""
    found = VE.knn(scenes(spark, sf), products(spark, sf), 10, broadcast_bytes=0, block=64)
    return found.select("query", "item", rounded("score").alias("score"), big())


@query("JOIN-08_cross_score", with_sql("vecs", DOT_SQL) + TOP_SQL + "50")
def _(spark, sf):
    """Every scene is scored against every product; the best 50 of each leave the tasks."""
    found = VE.knn(scenes(spark, sf), products(spark, sf), 50)
    return found.select("query", "item", rounded("score").alias("score"), big())


@query("WIN-06_topk_per_query", sql("views", (
    'SELECT u AS "user", item, s AS score, rk AS rank FROM (SELECT u, item, CAST(count(*) AS DOUBLE) AS s, row_number() OVER (PARTITION BY u ORDER BY count(*) DESC, item) AS rk '
    "FROM views WHERE event_type = 'view' GROUP BY 1, 2) WHERE rk <= 10")))
def _(spark, sf):
    top = top_per_group(score_table(spark, sf, "view"), ["user"], [F.desc("score"), F.asc("item")], 10)
    return top.select("user", "item", "score", big())


PAIR_SQL = "pr AS (SELECT a.id, a.vec AS av, b.vec AS bv FROM vecs a JOIN vecs b ON b.id = a.id + 1)"


def neighbours_in_order(spark, sf) -> DataFrame:
    v = V.vecs(spark, sf)
    after = v.select((F.col("id") - 1).alias("id"), F.col("vec").alias("bv"))
    return v.select("id", F.col("vec").alias("av")).join(after, "id")


@query("SCL-16_dot_l2", with_sql("vecs", PAIR_SQL) + (
    "SELECT id, round(list_dot_product(av, bv), 6) AS dot, round(sqrt(list_dot_product(av, av)), 6) AS l2 FROM pr"))
def _(spark, sf):
    a, b = F.col("av"), F.col("bv")
    return neighbours_in_order(spark, sf).select(
        "id", rounded(scores.dot(a, b)).alias("dot"), rounded(scores.l2(a)).alias("l2")
    )


@query("SCL-17_cosine_angular", with_sql("vecs", PAIR_SQL + (
    ", c AS (SELECT id, list_dot_product(av, bv) / (sqrt(list_dot_product(av, av)) * sqrt(list_dot_product(bv, bv))) AS p FROM pr)")) + (
    "SELECT id, round(p, 6) AS cosine, round(1 - p, 6) AS distance, round(sqrt(greatest(0, 1 - p * p)), 6) AS angular, round(1 - (1 - p), 6) AS similarity FROM c"))
def _(spark, sf):
    p = scores.cosine(F.col("av"), F.col("bv"))
    d = scores.correlation_distance(p)
    return neighbours_in_order(spark, sf).select(
        "id", rounded(p).alias("cosine"), rounded(d).alias("distance"), rounded(scores.angular(p)).alias("angular"),
        rounded(scores.similarity_from_distance(d)).alias("similarity"),
    )


def likes(spark, sf) -> DataFrame:
    """(user, item, rating): bought items with a rating from what was paid."""
    bought = V.views(spark, sf).where(F.col("event_type") == "purchase")
    return bought.groupBy("user", "item").agg(F.max(F.ceil(F.col("value") / 20)).cast("double").alias("rating"))


def catalogue(spark, sf) -> DataFrame:
    return V.vecs(spark, sf).select(F.col("id").alias("item"), "vec")


LIKES_SQL = "likes AS (SELECT u, item, CAST(max(ceil(value / 20)) AS DOUBLE) AS r FROM views WHERE event_type = 'purchase' GROUP BY 1, 2)"
CENTRE_SQL = (
    LIKES_SQL + ", comp AS (SELECT u, unnest(vec) AS x, unnest(range(1, len(vec) + 1)) AS p, r FROM likes JOIN vecs ON vecs.id = likes.item), "
    "cen AS (SELECT u, list(m ORDER BY p) AS c FROM (SELECT u, p, avg({w}) AS m FROM comp GROUP BY 1, 2) GROUP BY 1), "
    "x AS (SELECT u AS query, id AS item, list_cosine_similarity(c, vec) AS s FROM cen CROSS JOIN vecs)"
)


@query("RET-03_centroid_search", with_sql("views vecs", CENTRE_SQL.format(w="x")) + TOP_SQL + "5")
def _(spark, sf):
    found = VE.centroid_search(likes(spark, sf), catalogue(spark, sf), 5)
    return found.select("query", "item", rounded("score").alias("score"), big())


@query("RET-04_weighted_centroid_search", with_sql("views vecs", CENTRE_SQL.format(w="x * r")) + TOP_SQL + "5")
def _(spark, sf):
    found = VE.centroid_search(likes(spark, sf), catalogue(spark, sf), 5, weight="rating")
    return found.select("query", "item", rounded("score").alias("score"), big())


PER_ITEM_SQL = LIKES_SQL + (
    ", n1 AS (SELECT a.id AS item, b.id AS candidate, 1 - list_cosine_similarity(a.vec, b.vec) AS d, "
    "row_number() OVER (PARTITION BY a.id ORDER BY list_cosine_similarity(a.vec, b.vec) DESC, b.id) AS rk FROM vecs a JOIN vecs b ON a.id <> b.id WHERE a.id IN (SELECT item FROM likes)), "
    "e AS (SELECT u, candidate, min(d / r) AS v FROM likes JOIN n1 USING (item) WHERE rk = 1 GROUP BY 1, 2)"
)
PER_ITEM_TOP = 'SELECT u AS "user", candidate, round(v, 6) AS value, rk AS rank FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY v, candidate) AS rk FROM e) WHERE rk <= '


@query("RET-05_per_item_search", with_sql("views vecs", PER_ITEM_SQL) + PER_ITEM_TOP + "1")
def _(spark, sf):
    found = VE.per_item_search(likes(spark, sf), catalogue(spark, sf), 1)
    return found.select("user", "candidate", rounded("value").alias("value"), big())


@query("RET-06_per_item_topk", with_sql("views vecs", PER_ITEM_SQL) + PER_ITEM_TOP + "5")
def _(spark, sf):
    found = VE.per_item_search(likes(spark, sf), catalogue(spark, sf), 5)
    return found.select("user", "candidate", rounded("value").alias("value"), big())


@query("RET-07_ann_search")
def _(spark, sf):
    """Sign buckets, as many as the number of items asks for."""
    return VE.ann(scenes(spark, sf), products(spark, sf), 10)


@query("RET-07_ann_recall")
def _(spark, sf):
    exact = VE.knn(scenes(spark, sf), products(spark, sf), 10, metric="cosine")
    return VE.ann_recall(VE.ann(scenes(spark, sf), products(spark, sf), 10), exact)


@query("RET-07_inverted_file")
def _(spark, sf):
    return IVF.search(IVF.build(products(spark, sf)), scenes(spark, sf), 10)


@query("RET-07_inverted_file_recall")
def _(spark, sf):
    """Recall against exact search, and what a query costs."""
    index = IVF.build(products(spark, sf))
    exact = VE.knn(scenes(spark, sf), products(spark, sf), 10, metric="cosine")
    recall = VE.ann_recall(IVF.search(index, scenes(spark, sf), 10), exact)
    cost = IVF.cost(index, scenes(spark, sf)).agg(F.avg("probed").alias("lists_probed"), F.avg("scanned").alias("codes_read"))
    return recall.join(cost, F.lit(True)).withColumn("lists", F.lit(index.n_lists)).withColumn("scored", F.lit(320))


COSINE_SQL = "x AS (SELECT q.id AS query, i.id AS item, list_cosine_similarity(q.vec, i.vec) AS s FROM vecs q JOIN vecs i ON q.id % 2 = 0 AND i.id % 2 = 1)"


@query("RET-07_inverted_file_all_lists", with_sql("vecs", COSINE_SQL) + TOP_SQL + "10")
def _(spark, sf):
    """With margins that let every list in, the inverted file gives the exact neighbours and scores."""
    index = replace(IVF.build(products(spark, sf)), margins=(4.0, 4.0))
    found = IVF.search(index, scenes(spark, sf), 10)
    return found.select("query", "item", rounded("score").alias("score"), big())


@query("ACT-02_representatives", with_sql("vecs", (
    "comp AS (SELECT id, label, unnest(vec) AS x, unnest(range(1, len(vec) + 1)) AS p FROM vecs), cen AS (SELECT label, p, avg(x) AS m FROM comp GROUP BY 1, 2), "
    "d AS (SELECT label, id, sqrt(sum((x - m) * (x - m))) AS d FROM comp JOIN cen USING (label, p) GROUP BY 1, 2)")) + (
    "SELECT label, id, round(d, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY d, id) AS rk FROM d) WHERE rk = 1"))
def _(spark, sf):
    return A.representatives(V.vecs(spark, sf), "label").select("label", "id", rounded("distance").alias("distance"))


@query("EVAL-10_check_schema", sql("vecs", (
    "SELECT 'key_type' AS \"check\", 0 AS violations UNION ALL SELECT 'key_missing', count(*) FILTER (WHERE id IS NULL) FROM vecs UNION ALL "
    "SELECT 'vector_missing', count(*) FILTER (WHERE vec IS NULL) FROM vecs UNION ALL SELECT 'dimension', count(*) FILTER (WHERE len(vec) <> 64) FROM vecs UNION ALL "
    "SELECT 'component_range', count(*) FILTER (WHERE list_min(vec) < -0.3 OR list_max(vec) > 0.3) FROM vecs UNION ALL SELECT 'too_few', CASE WHEN count(vec) >= 100 THEN 0 ELSE 1 END FROM vecs UNION ALL "
    "SELECT 'key_repeated', count(*) FROM (SELECT id FROM vecs GROUP BY 1 HAVING count(*) > 1)")))
def _(spark, sf):
    return E.check_schema(V.vecs(spark, sf), "id", "bigint", "vec", 64, -0.3, 0.3, 100)


@query("FEA-04_registry_check", sql("vecs", (
    ", b AS (SELECT greatest(0, least(19, floor((vec[1] + 1) / 2 * 20)))::INT AS o, greatest(0, least(19, floor((vec[2] + 1) / 2 * 20)))::INT AS e FROM vecs), "
    "k AS (SELECT unnest(range(0, 20)) AS b), f AS (SELECT (SELECT count(*) FROM b WHERE o = k.b) + 1 AS o, (SELECT count(*) FROM b WHERE e = k.b) + 1 AS e FROM k), "
    "t AS (SELECT sum(o / so * ln((o / so) / (e / se))) AS kl FROM f, (SELECT sum(o) AS so, sum(e) AS se FROM f)) "
    "SELECT 'key_type' AS \"check\", 0 AS violations UNION ALL SELECT 'key_missing', count(*) FILTER (WHERE id IS NULL) FROM vecs UNION ALL "
    "SELECT 'vector_missing', count(*) FILTER (WHERE vec IS NULL) FROM vecs UNION ALL SELECT 'dimension', count(*) FILTER (WHERE len(vec) <> 64) FROM vecs UNION ALL "
    "SELECT 'component_range', count(*) FILTER (WHERE list_min(vec) < -1 OR list_max(vec) > 1) FROM vecs UNION ALL SELECT 'too_few', CASE WHEN count(vec) >= 100 THEN 0 ELSE 1 END FROM vecs UNION ALL "
    "SELECT 'key_repeated', count(*) FROM (SELECT id FROM vecs GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'distribution', (kl > 0.5)::BIGINT FROM t")).replace("vecs AS", "vecs AS", 1).replace(") ,", "),", 1))
def _(spark, sf):
    rows = V.vecs(spark, sf).withColumn("score", F.col("vec")[0].cast("double"))
    expected = E.binned(rows.withColumn("score", F.col("vec")[1].cast("double")), "score", -1.0, 1.0, 20)
    return FE.registry_check(rows, "id", "bigint", "vec", 64, -1.0, 1.0, 100, "score", expected, 20, 0.5)


TRIPLET_SQL = "t AS (SELECT a.id, a.vec AS v, b.vec AS p, c.vec AS n FROM vecs a JOIN vecs b ON b.id = a.id + 1 JOIN vecs c ON c.id = a.id + 3 WHERE a.id % 2 = 0)"


@query("EVAL-02_triplet_loss", with_sql("vecs", TRIPLET_SQL) + (
    "SELECT id // 32 AS batch, count(*) AS rows, round(sum(greatest(0, 1 + list_dot_product(v, n) - list_dot_product(v, p))), 6) AS triplet, "
    "round(sum(greatest(0, sqrt(list_dot_product(v, v)) - 1) + greatest(0, sqrt(list_dot_product(p, p)) - 1) + greatest(0, sqrt(list_dot_product(n, n)) - 1)), 6) AS norm_excess FROM t GROUP BY 1"))
def _(spark, sf):
    v = V.vecs(spark, sf)
    scene = v.where(F.col("id") % 2 == 0).select("id", F.col("vec").alias("scene_vec"))
    pos = v.select((F.col("id") - 1).alias("id"), F.col("vec").alias("pos_vec"))
    neg = v.select((F.col("id") - 3).alias("id"), F.col("vec").alias("neg_vec"))
    rows = scene.join(pos, "id").join(neg, "id").withColumn("batch", F.floor(F.col("id") / 32))
    scored = rows.withColumn("pos_score", scores.dot(F.col("scene_vec"), F.col("pos_vec"))).withColumn(
        "neg_score", scores.dot(F.col("scene_vec"), F.col("neg_vec"))
    )
    return E.triplet_loss(scored, batch="batch").select(
        "batch", "rows", rounded("triplet").alias("triplet"), rounded("norm_excess").alias("norm_excess")
    )


def token_vectors(spark, sf, d: DataFrame) -> DataFrame:
    """Fixed vectors for the dictionary tokens: the embedding table by index, repeated."""
    v = V.vecs(spark, sf)
    numbered = d.withColumn("_id", F.col("index") % v.count())
    return numbered.join(v.select(F.col("id").alias("_id"), "vec"), "_id").select(
        (F.col("index") + 1).alias("embedding"), "vec"
    )


@query("EVAL-04_glove_loss", COO + (
    ", vv AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings), nv AS (SELECT count(*) AS c FROM vv), "
    "e AS (SELECT x, list_dot_product(a.vec, b.vec) AS p FROM coo JOIN vv a ON a.id = (i - 1) % (SELECT c FROM nv) JOIN vv b ON b.id = (j - 1) % (SELECT c FROM nv)) "
    "SELECT count(*) AS pairs, round(avg(pow(least(1, x / 100), 0.75) * (log10(1 + x) - p) * (log10(1 + x) - p)), 6) AS loss FROM e"))
def _(spark, sf):
    found, d = triples(spark, sf)
    params = token_vectors(spark, sf, d).select(F.col("embedding").alias("id"), "vec", F.lit(0.0).alias("bias"))
    return E.glove_loss(found, params).select("pairs", rounded("loss").alias("loss"))


@query("EVAL-05_text_url_loss", with_sql("tpairs vecs", PAIR_SQL + (
    ", up AS (SELECT sqrt(2.0 * n / (a.doc_frequency + b.doc_frequency)) AS target, list_dot_product(va.vec, vb.vec) AS s FROM tpairs "
    "JOIN tdict a ON a.idx = i JOIN tdict b ON b.idx = j JOIN vecs va ON va.id = i % 500 JOIN vecs vb ON vb.id = j % 500), "
    "tl AS (SELECT avg(pow(greatest(0, 1 - list_dot_product(av, bv)), 2)) AS t FROM pr), ul AS (SELECT avg((s - target) * (s - target)) AS u FROM up)")) + (
    "SELECT round(t, 6) AS text_loss, round(u, 6) AS url_loss, round(t + u, 6) AS loss FROM tl, ul"))
def _(spark, sf):
    text_pairs = neighbours_in_order(spark, sf).select(scores.dot(F.col("av"), F.col("bv")).alias("score"))
    pairs, d = title_pairs(spark, sf)
    v = V.vecs(spark, sf)
    targets = C.url_pair_examples(pairs, d)
    left = v.select(F.col("id").alias("_i"), F.col("vec").alias("vi"))
    right = v.select(F.col("id").alias("_j"), F.col("vec").alias("vj"))
    url_pairs = targets.join(left, F.col("i") % 500 == F.col("_i")).join(right, F.col("j") % 500 == F.col("_j")).select(
        "target", scores.dot(F.col("vi"), F.col("vj")).alias("score")
    )
    return E.text_url_loss(text_pairs, url_pairs).select(
        rounded("text_loss").alias("text_loss"), rounded("url_loss").alias("url_loss"), rounded("loss").alias("loss")
    )


@query("REC-08_glove_fit")
def _(spark, sf):
    found, _d = triples(spark, sf)
    params, _losses = M.glove_fit(found, dim=8, iterations=3)
    return params.select("id", rounded("bias").alias("bias"), rounded(scores.l2(F.col("vec"))).alias("norm"))


@query("REC-06_item_embeddings")
def _(spark, sf):
    """Histories in pieces of at most 1,000 tracks, which is also the longest sentence of the fit."""
    pieces = V.playlists(spark, sf).withColumn("piece", F.floor(F.col("pos") / 1000))
    rows = pieces.groupBy("pl", "piece").agg(F.array_sort(F.collect_list(F.struct("pos", "track_idx"))).alias("_t"))
    return M.item_embeddings(rows.select(F.col("_t.track_idx").alias("items")), "items", dim=8)


@query("REC-06_fitted_embeddings")
def _(spark, sf):
    """Vectors of items from what users looked at, in order of time, in pieces of at most 1,000 events."""
    events = V.views(spark, sf).where(F.col("item").isNotNull())
    placed = place_in_group(events, ["user"], F.asc("ts"), F.asc("event_id")).withColumn("piece", F.floor(F.col("place") / 1000))
    rows = placed.groupBy("user", "piece").agg(F.array_sort(F.collect_list(F.struct("place", "item"))).alias("_t"))
    return M.item_embeddings(rows.select(F.col("_t.item").alias("items")), "items", dim=4)


# ---- text queries ------------------------------------------------------------------------

BENCH_SEP = text.SEPARATORS.replace("'", "''")
QTOK_SQL = (
    "qt AS (SELECT item_id AS query, list_transform(list_filter(string_split_regex(text, '" + BENCH_SEP
    + "'), lambda x: length(x) > 0), lambda x: lower(x)) AS tokens FROM benchmark)"
)


def questions(spark, sf) -> DataFrame:
    return V.table(spark, sf, "benchmark").select(F.col("item_id").alias("query"), "text")


@query("RET-02_sentence_knn", with_sql("dict vecs", QTOK_SQL + (
    ", qp AS (SELECT query, unnest(tokens) AS token, unnest(range(0, len(tokens))) AS pos FROM qt), nv AS (SELECT count(*) AS c FROM vecs), "
    "qc AS (SELECT query, unnest(vec) AS x, unnest(range(1, len(vec) + 1)) AS p FROM qp JOIN dict USING (token) JOIN vecs ON vecs.id = idx % (SELECT c FROM nv)), "
    "qv AS (SELECT query, list(m ORDER BY p) AS v FROM (SELECT query, p, avg(x) AS m FROM qc GROUP BY 1, 2) GROUP BY 1), "
    "x AS (SELECT query, id AS item, list_dot_product(v, vec) AS s FROM qv CROSS JOIN vecs)")) + TOP_SQL + "5")
def _(spark, sf):
    d = D.token_dictionary(V.docs(spark, sf))
    found = RT.text_query_knn(questions(spark, sf), d, token_vectors(spark, sf, d), catalogue(spark, sf), 5)
    return found.select("query", "item", rounded("score").alias("score"), big())


@query("RET-08_inverted_index", sql("docs", (
    "SELECT token, (rn - 1) // 500 AS chunk, count(*) AS n, md5(string_agg(doc_id, ' ' ORDER BY doc_id)) AS docs_md5 FROM "
    "(SELECT token, doc_id, row_number() OVER (PARTITION BY token ORDER BY doc_id) AS rn FROM (SELECT DISTINCT doc_id, unnest(tokens) AS token FROM docs)) GROUP BY 1, 2")))
def _(spark, sf):
    lists = RT.posting_lists(V.docs(spark, sf), chunk=500)
    return lists.select("token", "chunk", F.size("docs").cast("bigint").alias("n"), digest("docs").alias("docs_md5"))


@query("JOIN-14_inverted_index_lookup", with_sql("docs", QTOK_SQL) + (
    "SELECT query, doc_id, count(*) AS shared FROM (SELECT query, unnest(list_distinct(tokens)) AS token FROM qt) JOIN "
    "(SELECT doc_id, unnest(list_distinct(tokens)) AS token FROM docs) USING (token) GROUP BY 1, 2"))
def _(spark, sf):
    asked = questions(spark, sf).select("query", text.simple_tokenize(F.col("text")).alias("tokens"))
    return RT.inverted_candidates(asked, RT.inverted_index(V.docs(spark, sf)))


@query("JOIN-14_rerank_by_vector", with_sql("docs vecs", QTOK_SQL + (
    ", cn AS (SELECT query, doc_id, count(*) AS shared FROM (SELECT query, unnest(list_distinct(tokens)) AS token FROM qt) JOIN "
    "(SELECT doc_id, unnest(list_distinct(tokens)) AS token FROM docs) USING (token) GROUP BY 1, 2), nv AS (SELECT count(*) AS c FROM vecs), "
    "x AS (SELECT query, doc_id AS item, list_cosine_similarity(a.vec, b.vec) AS s FROM cn JOIN vecs a ON a.id = query JOIN vecs b ON b.id = doc_id)")) + TOP_SQL + "10")
def _(spark, sf):
    asked = questions(spark, sf).select("query", text.simple_tokenize(F.col("text")).alias("tokens"))
    found = RT.inverted_candidates(asked, RT.inverted_index(V.docs(spark, sf)))
    v = V.vecs(spark, sf)
    top = RT.rerank_by_vector(found, v.withColumnRenamed("id", "query"), v.withColumnRenamed("id", "doc_id"), 10)
    return top.select("query", F.col("doc_id").alias("item"), rounded("score").alias("score"), big())


# ---- bloom filters --------------------------------------------------------------------------

#: Error rate of the filters below; their size follows from the counted keys.
RATE = 1e-6


def bought(spark, sf) -> DataFrame:
    return V.views(spark, sf).where(F.col("event_type") == "purchase").select(
        keys.pair_key(F.col("user"), F.col("item")).alias("key"), "user", "item"
    )


def plain_keys(spark, sf, event_type: str) -> DataFrame:
    return V.views(spark, sf).where(F.col("event_type") == event_type).select((F.col("user") * 1000 + F.col("item")).alias("key"))


PRESENT_SQL = (
    ", b AS (SELECT DISTINCT u * 1000 + item AS key FROM views WHERE event_type = 'purchase'), "
    "v AS (SELECT DISTINCT u * 1000 + item AS key FROM views WHERE event_type IN ('view', 'purchase')) "
)


@query("RET-10_bloom_contains", sql("views", "SELECT 0").replace(" SELECT 0", PRESENT_SQL) + "SELECT key, key IN (SELECT key FROM b) AS maybe FROM v")
def _(spark, sf):
    """Bought pairs are found and only viewed ones are not."""
    rows = plain_keys(spark, sf, "purchase")
    return LB.contains(LB.build(rows, "key", RATE), rows.unionByName(plain_keys(spark, sf, "view")), "key")


@query("RET-10_bloom_grown", sql("views", "SELECT 0").replace(" SELECT 0", PRESENT_SQL) + "SELECT key, key IN (SELECT key FROM b) AS maybe FROM v")
def _(spark, sf):
    """Half of the keys in the first build, half added later, in a second layer."""
    rows = plain_keys(spark, sf, "purchase")
    first = LB.build(rows.where(F.col("key") % 2 == 0), "key", RATE)
    both = LB.add(first, rows.where(F.col("key") % 2 == 1), "key")
    return LB.contains(both, rows.unionByName(plain_keys(spark, sf, "view")), "key")


@query("RET-10_bloom_settled", sql("views", "SELECT 0").replace(" SELECT 0", PRESENT_SQL) + "SELECT key, key IN (SELECT key FROM b) AS present FROM v")
def _(spark, sf):
    """A filter that errs often gives the exact answer once its doubtful rows are joined."""
    rows = plain_keys(spark, sf, "purchase")
    held = LB.build(rows, "key", 0.3)
    return LB.settled(held, rows.unionByName(plain_keys(spark, sf, "view")), "key", rows)


@query("RET-10_bloom_filter_out", sql("views", (
    "SELECT DISTINCT u AS \"user\", item FROM views v WHERE event_type = 'view' "
    "AND NOT EXISTS (SELECT 1 FROM views b WHERE b.event_type = 'purchase' AND b.u = v.u AND b.item = v.item)")))
def _(spark, sf):
    """Viewed pairs that were not bought."""
    rows = bought(spark, sf)
    viewed = V.views(spark, sf).where(F.col("event_type") == "view").select(
        keys.pair_key(F.col("user"), F.col("item")).alias("key"), "user", "item"
    ).distinct()
    return LB.filter_out(viewed, LB.build(rows, "key"), "key", rows).select("user", "item")


@query("RET-10_bloom_build")
def _(spark, sf):
    held = LB.build(bought(spark, sf), "key")
    return held.bitmaps.select("layer", "bucket", F.bitmap_count("bitmap").alias("bits_set"))


def _set_keys(spark, sf, event_type) -> DataFrame:
    return V.views(spark, sf).where(F.col("event_type") == event_type).select(F.col("item").alias("key")).distinct()


# Of any event, so that keys of neither set are asked for too.
SETS_SQL = (
    ", s AS (SELECT item AS key, bool_or(event_type = 'view') AS a, bool_or(event_type = 'purchase' AND u % 7 = 0) AS b FROM views GROUP BY 1) "
)


def _two_sets(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = V.views(spark, sf)
    rare = events.where((F.col("event_type") == "purchase") & (F.col("user") % 7 == 0))
    return _set_keys(spark, sf, "view"), rare.select(F.col("item").alias("key")).distinct(), events.select(F.col("item").alias("key"))


@query("SET-05_bloom_union", sql("views", "SELECT 0").replace(" SELECT 0", SETS_SQL) + "SELECT key, a OR b AS maybe FROM s")
def _(spark, sf):
    one, two, every = _two_sets(spark, sf)
    return LB.contains(LB.merge(LB.build(one, "key", RATE), LB.build(two, "key", RATE)), every, "key")


@query("SET-05_bloom_intersect", sql("views", "SELECT 0").replace(" SELECT 0", SETS_SQL) + "SELECT key, a AND b AS maybe FROM s")
def _(spark, sf):
    """Filters of one size, which follows from the larger of the two counted sets."""
    one, two, every = _two_sets(spark, sf)
    bits, hashes = B.design(max(1, one.count(), two.count()), RATE)
    parts = [B.bloom_build(k, "key", bits, hashes) for k in (one, two)]
    return B.bloom_contains(every, B.bloom_and(*parts), "key", bits, hashes)


@query("RET-11_bloom_similarity")
def _(spark, sf):
    from affinia.operators.similarity import neighbours

    items = V.items(spark, sf).join(V.table(spark, sf, "part").select(F.col("p_partkey").alias("item"), "p_name"), "item")
    described = items.select("item", F.concat(
        F.split("p_name", " "), F.array("brand", "category", F.concat(F.lit("size"), F.col("size")))
    ).alias("words"))
    near = B.bloom_similarity(described, "words", k=10).withColumnRenamed("common", "similarity")
    return neighbours(near, 10)


# ---- playlists ---------------------------------------------------------------------------

def _dictionary_sql(name: str) -> str:
    return (
        f"d_{name} AS (SELECT {name}_uri, row_number() OVER (ORDER BY min(file * 1000000000 + pl * 1000 + pos), {name}_uri) - 1 AS idx FROM pls GROUP BY 1)"
    )


DICTS_SQL = ", ".join(_dictionary_sql(n) for n in ("track", "album", "artist"))


def uri_dictionaries(rows: DataFrame) -> dict[str, DataFrame]:
    return {n: P.uri_dictionary(rows, f"{n}_uri") for n in ("track", "album", "artist")}


@query("DICT-03_uri_dictionaries", with_sql("pls", DICTS_SQL) + (
    "SELECT 'track' AS kind, track_uri AS uri, idx AS \"index\" FROM d_track UNION ALL SELECT 'album', album_uri, idx FROM d_album UNION ALL SELECT 'artist', artist_uri, idx FROM d_artist"))
def _(spark, sf):
    parts = [
        table.select(F.lit(n).alias("kind"), F.col(f"{n}_uri").alias("uri"), "index")
        for n, table in uri_dictionaries(V.playlist_uris(spark, sf)).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("WIN-02_first_seen_index", with_sql("pls", _dictionary_sql("album")) + 'SELECT album_uri, idx AS "index" FROM d_album')
def _(spark, sf):
    return P.uri_dictionary(V.playlist_uris(spark, sf), "album_uri")


@query("JOIN-04_lookup_track_indices", with_sql("pls", DICTS_SQL) + (
    "SELECT pl, pos, t.idx AS track_idx, al.idx AS album_idx, ar.idx AS artist_idx FROM pls JOIN d_track t USING (track_uri) JOIN d_album al USING (album_uri) JOIN d_artist ar USING (artist_uri)"))
def _(spark, sf):
    rows = V.playlist_uris(spark, sf)
    out = D.lookup_track_indices(rows, *uri_dictionaries(rows).values())
    return out.select("pl", "pos", "track_idx", "album_idx", "artist_idx")


@query("AGG-10_first_record_per_key", sql("pls", (
    "SELECT track_idx, pl, pos, album_idx, artist_idx FROM (SELECT *, row_number() OVER (PARTITION BY track_idx ORDER BY file, pl, pos) AS rn FROM pls) WHERE rn = 1")))
def _(spark, sf):
    return P.first_record(V.playlists(spark, sf), "track_idx", "file", "pl", "pos").select(
        "track_idx", "pl", "pos", "album_idx", "artist_idx"
    )


@query("FLT-05_min_playlist_length", sql("pls", "SELECT DISTINCT pl, num_tracks FROM pls WHERE num_tracks >= 40"))
def _(spark, sf):
    return min_playlist_length(V.playlists(spark, sf), 40).select("pl", "num_tracks").distinct()


@query("SCL-15_album_bucket", sql("pls", "SELECT pl, pos, album_idx % 97 AS bucket FROM pls"))
def _(spark, sf):
    return V.playlists(spark, sf).select("pl", "pos", keys.album_bucket(F.col("album_idx"), 97).alias("bucket"))


def examples(spark, sf, tracks: DataFrame | None = None) -> DataFrame:
    tracks = V.playlists(spark, sf) if tracks is None else tracks
    return P.split_context_next(min_playlist_length(tracks, 10))


EX_SQL = "ex AS (SELECT * FROM pls WHERE num_tracks >= 10)"


@query("WIN-05_split_context_next", with_sql("pls", EX_SQL) + (
    "SELECT pl, string_agg(track_idx, ' ' ORDER BY pos) FILTER (WHERE pos < 5) AS track_context, string_agg(album_idx, ' ' ORDER BY pos) FILTER (WHERE pos < 5) AS album_context, "
    "string_agg(track_idx, ' ' ORDER BY pos) FILTER (WHERE pos >= 5) AS next_track, string_agg(artist_idx, ' ' ORDER BY pos) FILTER (WHERE pos >= 5) AS next_artist FROM ex GROUP BY pl"))
def _(spark, sf):
    return examples(spark, sf).select(
        "pl", *[F.array_join(c, " ").alias(c) for c in ("track_context", "album_context", "next_track", "next_artist")]
    )


@query("EVAL-11_check_inputs", with_sql("pls", EX_SQL) + (
    "SELECT max(track_idx) FILTER (WHERE pos < 5) AS max_track, max(album_idx) FILTER (WHERE pos < 5) AS max_album, max(artist_idx) FILTER (WHERE pos < 5) AS max_artist, "
    "max(track_idx) FILTER (WHERE pos < 5) <= (SELECT count(*) FROM part) AS track_ok, max(album_idx) FILTER (WHERE pos < 5) <= 100 AS album_ok, "
    "max(artist_idx) FILTER (WHERE pos < 5) <= (SELECT count(*) FROM supplier) AS artist_ok FROM ex"))
def _(spark, sf):
    return P.check_inputs(
        examples(spark, sf), V.table(spark, sf, "part").count(), 100, V.table(spark, sf, "supplier").count()
    )


def corpus(spark, sf, tracks: DataFrame | None = None) -> DataFrame:
    """Each track once, as first seen, with its album and artist vectors."""
    tracks = V.playlists(spark, sf) if tracks is None else tracks
    first = P.first_record(tracks, "track_idx", "file", "pl", "pos")
    return P.album_artist_vectors(first, V.vecs(spark, sf), V.vecs(spark, sf), 100)


def ranked_corpus(spark, sf, k: int, *keep: str):
    """The k best tracks of every example, as lists, and the examples.

    The lists may come with columns of the examples, then for every row of an example.
    """
    tracks = cut_lineage(V.playlists(spark, sf))
    rows = cut_lineage(examples(spark, sf, tracks))
    vecs = V.vecs(spark, sf)
    tables = P.vector_tables(tracks, vecs, vecs, 100)
    if tables is not None:
        known = P.with_known_vectors(P.first_record(tracks, "track_idx", "file", "pl", "pos"), vecs, vecs, 100)
        known = cut_lineage(known.select("track_idx", "album_idx", "artist_idx"))
        lists = P.looked_up_lists(rows if keep else rows.where(F.col("chunk") == 0), known, tables, k, keep=keep)
        if lists is not None:
            return lists, rows
    contexts = P.context_vectors(rows, vecs, vecs, "pl", 100).where(F.col("chunk") == 0)
    return track_lists(contexts, corpus(spark, sf, tracks), k), rows


AFF_SQL = EX_SQL + (
    ", tr AS (SELECT track_idx, album_idx, artist_idx FROM (SELECT *, row_number() OVER (PARTITION BY track_idx ORDER BY file, pl, pos) AS rn FROM pls) WHERE rn = 1), "
    "ids AS (SELECT DISTINCT album_idx % 100 AS a FROM pls UNION SELECT DISTINCT artist_idx FROM pls), "
    "g AS (SELECT x.id AS p, y.id AS q, list_dot_product(x.vec, y.vec) AS d FROM vecs x JOIN vecs y ON true WHERE x.id IN (SELECT a FROM ids) AND y.id IN (SELECT a FROM ids)), "
    "cx AS (SELECT DISTINCT pl, album_idx, artist_idx FROM ex WHERE pos < 5), "
    "kinds AS (SELECT DISTINCT album_idx, artist_idx FROM tr), "
    "sk AS (SELECT pl, k.album_idx, k.artist_idx, max(ga.d + gr.d) + 0.1 * max((cx.album_idx = k.album_idx)::INT) + 0.1 * max((cx.artist_idx = k.artist_idx)::INT) AS s "
    "FROM cx JOIN kinds k ON true JOIN g ga ON ga.p = cx.album_idx % 100 AND ga.q = k.album_idx % 100 JOIN g gr ON gr.p = cx.artist_idx AND gr.q = k.artist_idx GROUP BY 1, 2, 3), "
    "rs AS (SELECT pl, track_idx, tr.artist_idx, s, row_number() OVER (PARTITION BY pl ORDER BY round(s, 9) DESC, track_idx) AS rk FROM sk JOIN tr ON tr.album_idx = sk.album_idx AND tr.artist_idx = sk.artist_idx)"
)


@query("REC-05_context_affinity", with_sql("pls vecs", AFF_SQL) + (
    "SELECT pl, track_idx, round(s, 6) AS score, rk AS rank FROM rs WHERE rk <= 10"))
def _(spark, sf):
    lists, _ = ranked_corpus(spark, sf, 10)
    return list_rows(lists).select("pl", "track_idx", rounded("score").alias("score"), big())


@query("EVAL-01_recall_at_k", with_sql("pls vecs", AFF_SQL) + (
    ", t500 AS (SELECT * FROM rs WHERE rk <= 500), nx AS (SELECT pl, count(*) AS n, count(DISTINCT track_idx) AS dn FROM ex WHERE pos >= 5 GROUP BY 1), "
    "ht AS (SELECT pl, count(*) AS h FROM t500 WHERE (pl, track_idx) IN (SELECT pl, track_idx FROM ex WHERE pos >= 5) GROUP BY 1), "
    "ha AS (SELECT pl, count(*) AS h FROM t500 WHERE (pl, artist_idx) IN (SELECT pl, artist_idx FROM ex WHERE pos >= 5) GROUP BY 1) "
    "SELECT pl, round(coalesce(ht.h, 0) / n, 6) AS track_recall, round(coalesce(ha.h, 0) / n, 6) AS artist_recall, round(coalesce(ht.h, 0) / dn, 6) AS distinct_track_recall "
    "FROM nx LEFT JOIN ht USING (pl) LEFT JOIN ha USING (pl)"))
def _(spark, sf):
    lists, rows = ranked_corpus(spark, sf, 500, "next_track", "next_artist")
    out = recall_of_lists(lists, rows)
    return out.select("pl", *[rounded(c).alias(c) for c in ("track_recall", "artist_recall", "distinct_track_recall")])


LOSS_SQL = AFF_SQL.split(", kinds AS")[0] + (
    ", tn AS (SELECT count(*) AS n FROM part), "
    "mem AS (SELECT pl, 'pos' AS kind, tr.album_idx, tr.artist_idx FROM ex JOIN tr USING (track_idx) WHERE pos >= 5 "
    "UNION ALL SELECT pl, 'neg', tr.album_idx, tr.artist_idx FROM (SELECT DISTINCT pl, unnest(range(0, 16)) AS slot FROM ex) "
    "JOIN tn ON true JOIN tr ON track_idx = 1 + (pl * 31 + slot * 17) % n "
    "UNION ALL SELECT pl, 'context', album_idx, artist_idx FROM ex WHERE pos < 5), "
    "kind AS (SELECT pl, kind, album_idx AS al, artist_idx AS ar, count(*) AS c FROM mem GROUP BY 1, 2, 3, 4), "
    "dots AS (SELECT a.pl, a.kind, a.c * b.c AS c, ga.d + gr.d AS s FROM kind a JOIN kind b ON a.pl = b.pl AND a.kind = b.kind "
    "JOIN g ga ON ga.p = a.al % 100 AND ga.q = b.al % 100 JOIN g gr ON gr.p = a.ar AND gr.q = b.ar), "
    "selves AS (SELECT pl, kind, sum(c * greatest(0, CASE WHEN kind = 'neg' THEN s ELSE 0.5 - s END)) / sum(c) AS v FROM dots GROUP BY 1, 2), "
    "aff AS (SELECT m.pl, m.kind, m.c, m.al, m.ar, max(ga.d + gr.d) + 0.1 * max((x.al = m.al)::INT) + 0.1 * max((x.ar = m.ar)::INT) AS s "
    "FROM kind m JOIN kind x ON x.pl = m.pl AND x.kind = 'context' AND m.kind <> 'context' "
    "JOIN g ga ON ga.p = x.al % 100 AND ga.q = m.al % 100 JOIN g gr ON gr.p = x.ar AND gr.q = m.ar GROUP BY 1, 2, 3, 4, 5), "
    "sums AS (SELECT pl, sum(c * s) FILTER (WHERE kind = 'pos') / sum(c) FILTER (WHERE kind = 'pos') AS gm, "
    "sum(c * s) FILTER (WHERE kind = 'neg') / sum(c) FILTER (WHERE kind = 'neg') AS bm, min(s) FILTER (WHERE kind = 'pos') AS gl, "
    "max(s) FILTER (WHERE kind = 'neg') AS bh FROM aff GROUP BY 1), "
    "ex2 AS (SELECT pl, sum(c * greatest(0, sqrt(greatest(0, ga.d + gr.d)) - 1.2)) AS e FROM kind JOIN g ga ON ga.p = al % 100 AND ga.q = al % 100 "
    "JOIN g gr ON gr.p = ar AND gr.q = ar GROUP BY 1), "
    "t AS (SELECT pl, greatest(0, 1 + bm - gm) AS mean_triplet, greatest(0, 1 + bh - gl) AS extremal_triplet, "
    "any_value(v) FILTER (WHERE kind = 'context') AS context_self, any_value(v) FILTER (WHERE kind = 'pos') AS next_self, "
    "any_value(v) FILTER (WHERE kind = 'neg') AS negative_self, any_value(e) AS norm_excess FROM sums JOIN selves USING (pl) JOIN ex2 USING (pl) GROUP BY pl, gm, bm, gl, bh)"
)


@query("JOIN-10_membership_boost", with_sql("pls", EX_SQL) + (
    "SELECT m.pl, m.pos, bool_or(c.album_idx = m.album_idx) AS album_in_context, bool_or(c.artist_idx = m.artist_idx) AS artist_in_context, "
    "round(0.1::DOUBLE * max((c.album_idx = m.album_idx)::INT) + 0.1::DOUBLE * max((c.artist_idx = m.artist_idx)::INT), 6) AS boost "
    "FROM ex m JOIN ex c ON c.pl = m.pl AND c.pos < 5 AND m.pos >= 5 GROUP BY 1, 2"))
def _(spark, sf):
    """Every track that comes next: whether the context holds its album and its artist."""
    listed = cut_lineage(V.playlists(spark, sf))
    contexts = examples(spark, sf, listed).where(F.col("chunk") == 0).select("pl", "album_context", "artist_context")
    rows = listed.where(F.col("pos") >= 5).select("pl", "pos", "album_idx", "artist_idx").join(contexts, "pl")
    return P.membership_boost(rows).select("pl", "pos", "album_in_context", "artist_in_context", rounded("boost").alias("boost"))


@query("EVAL-03_playlist_loss", with_sql("pls vecs", LOSS_SQL) + "SELECT pl, " + ", ".join(
    f"round({t}, 6) AS {t}" for t in P.LOSS_TERMS) + ", round(" + " + ".join(P.LOSS_TERMS) + ", 6) AS loss FROM t")
def _(spark, sf):
    """Sixteen negatives per playlist, taken from the tracks by a fixed rule."""
    _listed, rows, vectors, contexts, tables = loss_inputs(spark, sf)
    n = V.table(spark, sf, "part").count()
    slots = rows.where(F.col("chunk") == 0).select("pl", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("at"))
    fixed = slots.select("pl", F.lit("neg").alias("kind"), F.col("at").cast("bigint").alias("at"),
                         (1 + (F.col("pl") * 31 + F.col("at") * 17) % n).alias("track_idx"))
    members = next_tracks(rows).unionByName(fixed).join(vectors, "track_idx")
    out = P.set_losses(contexts, members, bound=1.2, tables=tables)
    return out.select("pl", *[rounded(t).alias(t) for t in (*P.LOSS_TERMS, "loss")])


def loss_inputs(spark, sf):
    """Playlist rows, examples, tracks, contexts and the tables of vectors; without these, tracks and contexts have vectors."""
    vecs = V.vecs(spark, sf)
    listed = cut_lineage(V.playlists(spark, sf))
    rows = cut_lineage(examples(spark, sf, listed))
    tables = P.vector_tables(listed, vecs, vecs, 100)
    if tables is None:
        vectors = cut_lineage(corpus(spark, sf, listed).select("track_idx", "album_idx", "artist_idx", "vec"))
        contexts = P.context_vectors(rows, vecs, vecs, "pl", 100)
    else:
        first = P.first_record(listed, "track_idx", "file", "pl", "pos")
        vectors = cut_lineage(P.with_known_vectors(first, vecs, vecs, 100).select("track_idx", "album_idx", "artist_idx"))
        contexts = rows
    return listed, rows, vectors, contexts.where(F.col("chunk") == 0), tables


def next_tracks(rows: DataFrame) -> DataFrame:
    return rows.select("pl", "chunk", F.posexplode("next_track").alias("at", "track_idx")).select(
        "pl", F.lit("pos").alias("kind"), (F.col("chunk") * 10_000 + F.col("at")).alias("at"), "track_idx")


@query("EVAL-03_playlist_loss_drawn")
def _(spark, sf):
    """With negatives drawn by hash."""
    _listed, rows, vectors, contexts, tables = loss_inputs(spark, sf)
    nexts = next_tracks(rows).join(vectors, "track_idx")
    drawn = SA.uniform_negatives(contexts.select("pl"), vectors, 16).withColumn("kind", F.lit("neg")).withColumn("at", F.col("slot").cast("bigint"))
    return P.set_losses(contexts, nexts.unionByName(drawn.select(*nexts.columns)), tables=tables)


# ---- sampling ------------------------------------------------------------------------------

@query("SMP-01_negatives_per_example", with_sql("pls", EX_SQL) + (
    "SELECT pl, 64 AS negatives, 64 AS slots, 0 AS unknown, 0 AS positives FROM ex GROUP BY pl"))
def _(spark, sf):
    """Whatever is drawn: 64 of the catalogue per example, one per slot, and none of the example's own if those are left out."""
    tracks = V.items(spark, sf).select(F.col("item").alias("track_idx"), "brand")
    rows = cut_lineage(examples(spark, sf).where(F.col("chunk") == 0))
    drawn = cut_lineage(SA.uniform_negatives(rows, tracks, 64))
    known = drawn.join(tracks.select("track_idx", F.lit(1).alias("known")), "track_idx", "left")
    counts = known.groupBy("pl").agg(
        F.count("*").alias("negatives"), F.count_distinct("slot").alias("slots"), F.count_if(F.col("known").isNull()).alias("unknown"))
    own = rows.select("pl", F.explode("next_track").alias("track_idx")).distinct()
    clean = SA.uniform_negatives(rows, tracks, 64, positives="next_track").join(own, ["pl", "track_idx"], "left_semi")
    return counts.join(clean.groupBy("pl").agg(F.count("*").alias("positives")), "pl", "left").withColumn(
        "positives", F.coalesce("positives", F.lit(0)))


@query("SMP-01_uniform_negatives")
def _(spark, sf):
    tracks = V.items(spark, sf).select(F.col("item").alias("track_idx"), "brand")
    return SA.uniform_negatives(examples(spark, sf), tracks, 64)


def scene_pairs(spark, sf) -> DataFrame:
    return V.views(spark, sf).select(
        F.md5(F.concat(F.lit("s"), F.col("user"))).alias("scene"), F.md5(F.concat(F.lit("p"), F.col("item"))).alias("product")
    ).distinct()


PAIRS_SQL = "sp AS (SELECT DISTINCT md5('s' || u) AS scene, md5('p' || item) AS product FROM views)"


@query("SMP-02_triplets")
def _(spark, sf):
    return SA.triplets(scene_pairs(spark, sf))


@query("SMP-02_triplets_of_test_pairs", with_sql("views", PAIRS_SQL) + (
    "SELECT scene, product AS positive, count(*) * 5 AS n FROM (SELECT *, row_number() OVER (ORDER BY scene, product) - 1 AS p FROM sp) WHERE p % 10 = 0 GROUP BY 1, 2"))
def _(spark, sf):
    test = SA.triplets(scene_pairs(spark, sf)).where("is_test")
    return test.groupBy("scene", "positive").agg(F.count("*").alias("n"))


@query("SMP-03_split_by_shard", sql("pls", "SELECT file, count(*) AS n FROM pls WHERE file <> 9 GROUP BY 1"))
def _(spark, sf):
    train = SA.split_by_shard(V.playlists(spark, sf), list(range(9)), "file")
    return train.groupBy("file").agg(F.count("*").alias("n"))


@query("SMP-04_bootstrap")
def _(spark, sf):
    return SA.bootstrap(scene_pairs(spark, sf), F.asc("scene"), F.asc("product"))


@query("SMP-04_bootstrap_counts", with_sql("views", PAIRS_SQL) + "SELECT count(*) AS rows, count(*) AS places, 0 AS unknown, true AS repeats FROM sp")
def _(spark, sf):
    """As many rows as the input, all of them of it, in places 0.., some drawn more than once."""
    pairs = cut_lineage(scene_pairs(spark, sf))
    drawn = cut_lineage(SA.bootstrap(pairs, F.asc("scene"), F.asc("product")))
    unknown = drawn.join(pairs, ["scene", "product"], "left_anti").agg(F.count("*").alias("unknown"))
    return drawn.agg(
        F.count("*").alias("rows"), F.count_distinct("place").alias("places"),
        (F.count_distinct("scene", "product") < F.count("*")).alias("repeats"),
    ).withColumn("unknown", unknown.scalar())


@query("SMP-05_shuffle_rows")
def _(spark, sf):
    return SA.shuffle_rows(scene_pairs(spark, sf), "scene", "product")


@query("SMP-05_batches")
def _(spark, sf):
    return SA.batches(scene_pairs(spark, sf), 64, "scene", "product")


@query("SMP-05_batch_sizes", with_sql("views", PAIRS_SQL + ", t AS (SELECT count(*) AS n FROM sp)") + (
    "SELECT b AS batch, CASE WHEN b < n // 64 THEN 64 ELSE n % 64 END AS rows FROM (SELECT n, unnest(range(0, (n + 63) // 64)) AS b FROM t)"))
def _(spark, sf):
    return SA.batches(scene_pairs(spark, sf), 64, "scene", "product").groupBy("batch").agg(F.count("*").alias("rows"))


@query("SMP-06_random_items")
def _(spark, sf):
    return SA.random_items(V.items(spark, sf).select("item", "category"), 100)


@query("SMP-06_random_items_counts", sql("items", "SELECT least(100, count(*)) AS rows, least(100, count(*)) AS items, 0 AS unknown FROM items"))
def _(spark, sf):
    catalogue = V.items(spark, sf).select("item", "category")
    drawn = cut_lineage(SA.random_items(catalogue, 100))
    unknown = drawn.select("item", "category").join(catalogue, ["item", "category"], "left_anti").agg(F.count("*").alias("unknown"))
    return drawn.agg(F.count("*").alias("rows"), F.count_distinct("item").alias("items")).withColumn("unknown", unknown.scalar())


@query("SET-01_unique_keys", with_sql("views", PAIRS_SQL) + "SELECT scene AS key FROM sp UNION SELECT product FROM sp")
def _(spark, sf):
    return SA.unique_keys(scene_pairs(spark, sf), "scene", "product")


@query("SET-02_unique_entities", with_sql("views", PAIRS_SQL) + "SELECT DISTINCT scene FROM sp")
def _(spark, sf):
    return SA.unique_entities(scene_pairs(spark, sf), "scene")


@query("SET-03_distinct_links", sql("links", "SELECT url, unnest(secondary) AS target FROM links"))
def _(spark, sf):
    found = V.table(spark, sf, "pages").select("url", F.regexp_extract_all("html", F.lit(V.HREF), F.lit(1)).alias("all"))
    return found.select("url", F.explode(F.array_distinct("all")).alias("target"))


@query("SRT-06_sorted_keys", with_sql("views", PAIRS_SQL) + (
    "SELECT key, row_number() OVER (ORDER BY key) - 1 AS place FROM (SELECT DISTINCT product AS key FROM sp)"))
def _(spark, sf):
    """With the place at which each key came out."""
    return dense_index(SA.sorted_keys(scene_pairs(spark, sf).withColumnRenamed("product", "key")), name="place")


@query("SRT-07_limit_queries", with_sql("vecs", DOT_SQL) + TOP_SQL + "10 AND query < 200")
def _(spark, sf):
    first = SA.limit_queries(scenes(spark, sf), 100)
    found = VE.knn(first, products(spark, sf), 10)
    return found.select("query", "item", rounded("score").alias("score"), big())


@query("SRT-08_max_lines", (
    "SELECT count(*) AS rows, count(DISTINCT event_id) AS events, 0 AS unknown FROM (SELECT * FROM events LIMIT 500) "
    "UNION ALL SELECT count(*), count(DISTINCT event_id), 0 FROM events"))
def _(spark, sf):
    """500 different rows of the table, and all of a table that has no more than asked for."""
    events = V.table(spark, sf, "events")

    def counted(n: int) -> DataFrame:
        some = SA.max_lines(events, n)
        known = some.join(events.select("event_id", F.lit(1).alias("known")), "event_id", "left")
        return known.agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("events"), F.count_if(F.col("known").isNull()).alias("unknown"))

    return counted(500).unionByName(counted(10_000_000))
