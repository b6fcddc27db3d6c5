"""Queries on views, events, ratings, filters and collaborative filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.functions import keys, scores
from affinia.operators import active as A
from affinia.operators import evaluate as E
from affinia.operators import features as FE
from affinia.operators import filters as FL
from affinia.operators import interactions as I
from affinia.operators import recommend as R
from affinia.operators import retrieval as RT
from affinia.operators import sampling as SA
from affinia.operators import similarity as S
from affinia.operators import sparse_rows as SR
from affinia.operators import models as M
from affinia.operators.factor_search import best_unseen
from affinia.operators.indexing import dense_index, place_in_group, top_per_group
from affinia.plans import views as V
from affinia.plans.registry import query, rounded, stamp
from affinia.plans.views import sql
from affinia.session import cut_lineage
from affinia.sources import io

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


# ---- views and events ------------------------------------------------------------------

@query("SRC-11_scan_tables_sql", sql("views users", (
    "SELECT u AS \"user\", item, count(DISTINCT event_id) AS count_views FROM views JOIN users USING (u) "
    "WHERE ts >= TIMESTAMP '2024-01-10' AND country = 'NATION_3' GROUP BY 1, 2")))
def _(spark, sf):
    return io.scan_tables_sql(spark, {"views": V.views(spark, sf), "users": V.users(spark, sf)}, """
        SELECT v.user, v.item, count(DISTINCT v.event_id) AS count_views
        FROM {views} v JOIN {users} u ON v.user = u.user
        WHERE v.ts >= TIMESTAMP_NTZ '2024-01-10' AND u.country = 'NATION_3'
        GROUP BY v.user, v.item""")


@query("AGG-07_view_counts", sql("views", 'SELECT u AS "user", item, count(DISTINCT event_id) AS count_views FROM views GROUP BY 1, 2'))
def _(spark, sf):
    return I.view_counts(V.views(spark, sf))


@query("AGG-08_item_viewers", sql("views", "SELECT item, count(DISTINCT u) AS count_viewers FROM views GROUP BY 1"))
def _(spark, sf):
    return I.item_viewers(V.views(spark, sf))


@query("AGG-09_item_popularity", sql("views", "SELECT item, count(*) AS times_chosen FROM views WHERE event_type = 'purchase' GROUP BY 1"))
def _(spark, sf):
    return I.item_popularity(V.views(spark, sf).where(F.col("event_type") == "purchase"))


@query("SRT-01_most_popular", sql("views", (
    "SELECT item, count(*) AS times_chosen FROM views WHERE ts >= TIMESTAMP '2024-01-24' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")))
def _(spark, sf):
    views = V.views(spark, sf)
    week = F.lit("2024-01-24").cast(views.schema["ts"].dataType)
    return I.most_popular(views, 10, week)


@query("SRT-02_trivial_recommender", sql("items", "SELECT item FROM items WHERE active AND item = 7"))
def _(spark, sf):
    return I.trivial(V.items(spark, sf), 7)


@query("SRT-05_order_views", sql("views", (
    'SELECT *, rank() OVER (ORDER BY count_views DESC, "user") - 1 AS place FROM '
    '(SELECT u AS "user", item, count(DISTINCT event_id) AS count_views FROM views GROUP BY 1, 2)')))
def _(spark, sf):
    """With the first place at which a row of its count and user came out."""
    placed = cut_lineage(dense_index(I.order_views(I.view_counts(V.views(spark, sf))), name="at"))
    first = placed.groupBy("user", "count_views").agg(F.min("at").alias("place"))
    return placed.drop("at").join(first, ["user", "count_views"])


@query("WIN-07_rank_items", sql("views", (
    "SELECT item, count(*) AS times_chosen, row_number() OVER (ORDER BY count(*) DESC, item) AS rank FROM views GROUP BY 1")))
def _(spark, sf):
    return I.rank_items(V.views(spark, sf))


FUNNEL_SQL = (
    ", s1 AS (SELECT {k}, min(ts) AS t FROM views WHERE event_type = 'view' GROUP BY {k}), "
    "s2 AS (SELECT {k}, min(v.ts) AS t FROM views v JOIN s1 USING ({k}) WHERE event_type = 'click' AND v.ts >= s1.t GROUP BY {k}), "
    "s3 AS (SELECT {k}, min(v.ts) AS t FROM views v JOIN s2 USING ({k}) WHERE event_type = 'purchase' AND v.ts >= s2.t GROUP BY {k}), "
    "f AS (SELECT 'view' AS step, 0 AS step_no, count(*) AS users FROM s1 UNION ALL SELECT 'click', 1, count(*) FROM s2 "
    "UNION ALL SELECT 'purchase', 2, count(*) FROM s3) "
    "SELECT step, step_no, users, coalesce(lag(users) OVER (ORDER BY step_no) - users, 0) AS dropped FROM f"
)


@query("AGG-15_funnel", sql("views", "SELECT 0").replace(" SELECT 0", FUNNEL_SQL.format(k="u")))
def _(spark, sf):
    return I.funnel(V.views(spark, sf), ["view", "click", "purchase"])


@query("AGG-15_funnel_per_recommendation", sql("views", "SELECT 0").replace(" SELECT 0", FUNNEL_SQL.format(k="u, item")))
def _(spark, sf):
    return I.funnel(V.views(spark, sf), ["view", "click", "purchase"], by="item")


@query("AGG-16_hourly_rollup", sql("views", (
    "SELECT " + STAMP.format("date_trunc('hour', ts)") + " AS hour, event_type, count(*) AS events, round(sum(value), 6) AS value FROM views GROUP BY date_trunc('hour', ts), event_type")))
def _(spark, sf):
    return I.hourly_rollup(V.views(spark, sf)).select(
        stamp("hour").alias("hour"), "event_type", "events", rounded("value").alias("value")
    )


STOCK_SQL = ", stock AS (SELECT item, size AS stock FROM items)"


def stock(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("item", F.col("size").cast("bigint").alias("stock"))


@query("AGG-17_current_inventory", sql("items views", "SELECT 0").replace(" SELECT 0", STOCK_SQL) + (
    " SELECT s.item, s.stock - count(v.item) AS stock FROM stock s LEFT JOIN views v ON v.item = s.item AND event_type = 'purchase' GROUP BY s.item, s.stock"))
def _(spark, sf):
    return I.current_inventory(stock(spark, sf), V.views(spark, sf))


@query("AGG-18_zipf_profile", sql("views", (
    ", c AS (SELECT item, count(*) AS times_chosen, row_number() OVER (ORDER BY count(*) DESC, item) AS rank FROM views GROUP BY 1) "
    "SELECT item, times_chosen, rank, round(times_chosen / (SELECT sum(times_chosen) FROM c), 6) AS share, "
    "round((1.0 / rank) / (SELECT sum(1.0::DOUBLE / rank) FROM c), 6) AS expected FROM c")).replace(") ,", "),", 1))
def _(spark, sf):
    return I.zipf_profile(V.views(spark, sf)).select(
        "item", "times_chosen", "rank", rounded("share").alias("share"), rounded("expected").alias("expected")
    )


@query("AGG-19_sparsity_profile", sql("ratings", (
    ", c AS (SELECT item, count(DISTINCT u) AS raters, row_number() OVER (ORDER BY count(DISTINCT u) DESC, item) AS rank FROM ratings GROUP BY 1) "
    "SELECT item, raters, rank, raters - 1 AS sharing, round(((SELECT count(*) FROM c) - 1) * (1.0::DOUBLE / rank) / (SELECT sum(1.0::DOUBLE / rank) FROM c), 6) AS expected_sharing, "
    "round((SELECT sum(raters) FROM c) / ((SELECT count(*) FROM c) * (SELECT count(DISTINCT u) FROM ratings)), 9) AS density FROM c")).replace(") ,", "),", 1))
def _(spark, sf):
    return I.sparsity_profile(V.ratings(spark, sf)).select(
        "item", "raters", "rank", "sharing", rounded("expected_sharing").alias("expected_sharing"), rounded("density", 9).alias("density")
    )


@query("AGG-20_exposure_weight", sql("views", (
    ", ld AS (SELECT *, u::VARCHAR || ' ' || CAST(ts AS DATE) AS load FROM views), "
    "x AS (SELECT load, count(DISTINCT item) AS exposed FROM ld WHERE event_type = 'view' GROUP BY 1) "
    "SELECT event_id, exposed, round(1.0 / exposed, 6) AS weight FROM ld JOIN x USING (load) WHERE event_type = 'click'")).replace(") ,", "),", 1))
def _(spark, sf):
    loads = V.views(spark, sf).withColumn("load", F.concat_ws(" ", "user", F.to_date("ts")))
    return I.exposure_weight(loads).select("event_id", "exposed", rounded("weight").alias("weight"))


WEIGHTS = {"view": 1.0, "click": 2.0, "purchase": 5.0}


@query("AGG-21_implicit_rating", sql("views", (
    'SELECT u AS "user", item, max(w) AS strongest, sum(w) AS total FROM (SELECT u, item, CASE event_type WHEN \'view\' THEN 1.0::DOUBLE '
    "WHEN 'click' THEN 2.0::DOUBLE WHEN 'purchase' THEN 5.0::DOUBLE END AS w FROM views) WHERE w IS NOT NULL GROUP BY 1, 2")))
def _(spark, sf):
    return I.implicit_rating(V.views(spark, sf), WEIGHTS)


@query("AGG-22_incremental_gain", sql("views", (
    ", d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, value AS spend, CAST(event_type = 'signup' AS INT) AS gained FROM views), "
    "r AS (SELECT sum(gained) / sum(spend) AS rate FROM d WHERE day < '2024-01-08') "
    "SELECT day, round(sum(spend), 6) AS spend, CAST(sum(gained) AS BIGINT) AS outcomes, round(sum(spend) * (SELECT rate FROM r), 6) AS expected, "
    "round(sum(gained) - sum(spend) * (SELECT rate FROM r), 6) AS gain FROM d GROUP BY day")).replace(") ,", "),", 1))
def _(spark, sf):
    days = V.views(spark, sf).select(
        F.to_date("ts").cast("string").alias("day"), F.col("value").alias("spend"),
        (F.col("event_type") == "signup").cast("int").alias("gained"),
    )
    out = I.incremental_gain(days, "day", "spend", "gained", baseline=F.col("day") < "2024-01-08")
    return out.select("day", rounded("spend").alias("spend"), "outcomes", rounded("expected").alias("expected"), rounded("gain").alias("gain"))


@query("AGG-23_weekly_kpis", sql("views", (
    ", w AS (SELECT *, date_trunc('week', ts) AS week FROM views), a AS (SELECT week, count(DISTINCT u) AS active_users FROM w GROUP BY 1), "
    "n AS (SELECT u, date_trunc('week', min(ts)) AS week FROM views WHERE event_type = 'signup' GROUP BY 1), "
    "s AS (SELECT week, count(*) AS signups FROM n GROUP BY 1), "
    "t AS (SELECT week, item, row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, item) AS rk FROM w JOIN n USING (u, week) GROUP BY 1, 2) "
    "SELECT " + STAMP.format("a.week") + " AS week, active_users, coalesce(signups, 0) AS signups, item AS top_item FROM a LEFT JOIN s USING (week) "
    "LEFT JOIN t ON t.week = a.week AND rk = 1")).replace(") ,", "),", 1))
def _(spark, sf):
    return I.weekly_kpis(V.views(spark, sf)).select(stamp("week").alias("week"), "active_users", "signups", "top_item")


@query("WIN-09_session_sequence", sql("views", (
    ", g AS (SELECT *, CASE WHEN epoch(ts) - epoch(lag(ts) OVER w) <= 3600 * 6 THEN 0 ELSE 1 END AS nw FROM views WINDOW w AS (PARTITION BY u ORDER BY ts, event_id)), "
    "s AS (SELECT *, sum(nw) OVER (PARTITION BY u ORDER BY ts, event_id) AS session FROM g) "
    "SELECT event_id, u AS \"user\", CAST(session AS BIGINT) AS session, row_number() OVER (PARTITION BY u, session ORDER BY ts, event_id) AS step FROM s")).replace(") ,", "),", 1))
def _(spark, sf):
    return I.session_sequence(V.views(spark, sf), 360).select("event_id", "user", "session", "step")


@query("WIN-10_lag_features", sql("views", (
    "SELECT event_id, coalesce(lag(item, 1) OVER w, -1) || ' ' || coalesce(lag(item, 2) OVER w, -1) || ' ' || coalesce(lag(item, 3) OVER w, -1) AS context, "
    "round(CASE WHEN lag(item, 3) OVER w IS NOT NULL THEN 11.0 / 6 WHEN lag(item, 2) OVER w IS NOT NULL THEN 1.5 WHEN lag(item, 1) OVER w IS NOT NULL THEN 1.0 ELSE 0 END, 6) AS weight "
    "FROM views WINDOW w AS (PARTITION BY u ORDER BY ts, event_id)")))
def _(spark, sf):
    rows = I.lag_context(V.views(spark, sf), 3)
    shown = F.concat_ws(" ", *[F.coalesce(F.get("context", F.lit(i)), F.lit(-1)) for i in range(3)])
    return rows.select(
        "event_id", shown.alias("context"), rounded(F.aggregate("weights", F.lit(0.0), lambda t, x: t + x)).alias("weight")
    )


@query("SRC-15_snapshot_as_of", (
    "SELECT user_id, event_type, event_id, " + STAMP.format("ts") + " AS ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn "
    "FROM events WHERE ts < TIMESTAMP '2024-01-16') WHERE rn = 1"))
def _(spark, sf):
    log = V.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return io.snapshot_as_of(log, ["user_id", "event_type"], "ts", "2024-01-15").select(
        "user_id", "event_type", "event_id", stamp("ts").alias("ts")
    )


@query("SRC-15_snapshot_delta", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'")
def _(spark, sf):
    return io.snapshot_delta(V.table(spark, sf, "events"), "ts", "2024-01-15").select("event_id")


# ---- joins and filters ------------------------------------------------------------------

@query("JOIN-05_views_join_users", sql("views users", "SELECT event_id, country FROM views JOIN users USING (u)"))
def _(spark, sf):
    return V.views(spark, sf).join(V.users(spark, sf), "user").select("event_id", "country")


@query("JOIN-06_ratings_join_dims", sql("ratings users items", (
    'SELECT u AS "user", item, rating, ' + STAMP.format("ts") + " AS ts, country, category FROM ratings JOIN users USING (u) JOIN items USING (item)")))
def _(spark, sf):
    joined = V.ratings(spark, sf).join(V.users(spark, sf), "user").join(V.items(spark, sf), "item")
    return joined.select("user", "item", "rating", stamp("ts").alias("ts"), "country", "category")


@query("FLT-08_filter_views", sql("views users", (
    "SELECT event_id FROM views WHERE ts >= TIMESTAMP '2024-01-10' AND u IN (SELECT u FROM users WHERE country = 'NATION_3')")))
def _(spark, sf):
    return FL.filter_views(V.views(spark, sf), V.users(spark, sf), "2024-01-10", "NATION_3").select("event_id")


@query("FLT-09_filter_ratings", sql("ratings users items", (
    'SELECT r.u AS "user", r.item, rating, ' + STAMP.format("r.ts") + " AS ts FROM ratings r JOIN users USING (u) JOIN items USING (item) "
    "WHERE CAST(r.ts AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' AND country = 'NATION_3' AND active")))
def _(spark, sf):
    kept = FL.filter_ratings(
        V.ratings(spark, sf), V.users(spark, sf), V.items(spark, sf), "1997-01-01", "1999-12-31", "NATION_3"
    )
    return kept.select("user", "item", "rating", stamp("ts").alias("ts"))


CANDS_SQL = ", cands AS (SELECT DISTINCT u, item FROM views WHERE event_type <> 'error')"


def candidates(spark, sf) -> DataFrame:
    return V.views(spark, sf).where(F.col("event_type") != "error").select("user", "item").distinct()


CANDS = sql("views items users", "SELECT 0").replace(" SELECT 0", CANDS_SQL)


@query("FLT-11_exclude_interacted", CANDS + (
    " SELECT u AS \"user\", item FROM cands c WHERE NOT EXISTS (SELECT 1 FROM views v WHERE v.u = c.u AND v.item = c.item AND event_type = 'purchase')"))
def _(spark, sf):
    bought = V.views(spark, sf).where(F.col("event_type") == "purchase")
    return FL.exclude_interacted(candidates(spark, sf), bought)


@query("SET-06_unseen_items", CANDS + (
    " SELECT u AS \"user\", item FROM cands c WHERE NOT EXISTS (SELECT 1 FROM views v WHERE v.u = c.u AND v.item = c.item AND event_type = 'view')"))
def _(spark, sf):
    seen = V.views(spark, sf).where(F.col("event_type") == "view")
    return S.unseen_items(candidates(spark, sf), seen)


STALE_SQL = (
    ", stale AS (SELECT u, item FROM views GROUP BY 1, 2 HAVING count(*) FILTER (WHERE event_type = 'view') >= 2 AND count(*) FILTER (WHERE event_type = 'click') = 0)"
)


@query("FLT-12_freshness_filter", CANDS + STALE_SQL + (
    ' SELECT u AS "user", item FROM cands WHERE (u, item) NOT IN (SELECT u, item FROM stale)'))
def _(spark, sf):
    return FL.freshness_filter(candidates(spark, sf), V.views(spark, sf), 2)


@query("FLT-13_availability_filter", CANDS + STOCK_SQL + (
    ", left_over AS (SELECT s.item, s.stock - count(v.item) AS stock FROM stock s LEFT JOIN views v ON v.item = s.item AND event_type = 'purchase' GROUP BY s.item, s.stock) "
    'SELECT u AS "user", item FROM cands WHERE item NOT IN (SELECT item FROM left_over WHERE stock <= 0)'))
def _(spark, sf):
    left = I.current_inventory(stock(spark, sf), V.views(spark, sf))
    return FL.availability_filter(candidates(spark, sf), left)


RANKED_SQL = ", ranked AS (SELECT u, item, row_number() OVER (PARTITION BY u ORDER BY count(*) DESC, item) AS rank FROM views GROUP BY 1, 2)"


def ranked(spark, sf, n: int | None = None) -> DataFrame:
    """(user, item, rank): what a user touched most; the whole list, or its first n."""
    counts = V.views(spark, sf).groupBy("user", "item").agg(F.count("*").alias("_n"))
    order = [F.desc("_n"), F.asc("item")]
    if n is not None:
        return top_per_group(counts, ["user"], order, n).drop("_n")
    return place_in_group(counts, ["user"], *order, name="rank").withColumn("rank", F.col("rank") + 1).drop("_n")


RANKED = sql("views items users", "SELECT 0").replace(" SELECT 0", RANKED_SQL)
# Pair rules out of the data: an item and the next one of the same size keep apart.
RULES_SQL = (
    ", rules AS (SELECT item AS rule, item AS first, lead(item) OVER (PARTITION BY size ORDER BY item) AS second FROM items QUALIFY second IS NOT NULL)"
)


@query("FLT-14_apply_rules", RANKED + RULES_SQL + (
    ", ways AS (SELECT rule, first, second FROM rules UNION ALL SELECT rule, second, first FROM rules), "
    "hit AS (SELECT r.u, r.item, min(rule) AS rule FROM ranked r JOIN ranked b ON b.u = r.u AND b.rank < r.rank JOIN ways ON ways.first = b.item AND ways.second = r.item GROUP BY 1, 2) "
    'SELECT u AS "user", item, rank, rule AS dropped_by FROM ranked LEFT JOIN hit USING (u, item)'))
def _(spark, sf):
    numbered = dense_index(V.items(spark, sf).select("item", "size"), F.asc("size"), F.asc("item"), name="_at")
    after = numbered.select((F.col("_at") - 1).alias("_at"), "size", F.col("item").alias("second"))
    rules = numbered.join(after, ["_at", "size"]).select(F.col("item").alias("rule"), F.col("item").alias("first"), "second")
    return FL.apply_rules(ranked(spark, sf), rules).select("user", "item", F.col("rank").cast("bigint").alias("rank"), "dropped_by")


@query("FLT-15_geo_age_filter", CANDS + (
    ' SELECT c.u AS "user", c.item FROM cands c JOIN users USING (u) JOIN items USING (item) '
    "WHERE (size % 5 = 0 OR size % 5 = region) AND (size % 3 <> 0 OR adult)"))
def _(spark, sf):
    items = V.items(spark, sf).select(
        "item", F.when(F.col("size") % 5 != 0, F.col("size") % 5).alias("region"), (F.col("size") % 3 == 0).alias("adult_only")
    )
    return FL.feature_filter(candidates(spark, sf), V.users(spark, sf).select("user", "region", "adult"), items)


@query("EVAL-13_filter_log", CANDS + STALE_SQL + STOCK_SQL + (
    ' SELECT u AS "user", item, concat_ws(\',\', CASE WHEN (u, item) IN (SELECT u, item FROM stale) THEN \'stale\' END, '
    "CASE WHEN item IN (SELECT item FROM stock WHERE stock < 10) THEN 'scarce' END) AS reasons FROM cands"))
def _(spark, sf):
    scarce = stock(spark, sf).where(F.col("stock") < 10)
    logged = FL.filter_log(candidates(spark, sf), {
        "stale": (FL.stale_pairs(V.views(spark, sf), 2), ["user", "item"]), "scarce": (scarce, ["item"]),
    })
    return logged.select("user", "item", F.array_join("reasons", ",").alias("reasons"))


@query("JOIN-12_join_outcomes", CANDS + (
    ' SELECT u AS "user", item, CAST(EXISTS (SELECT 1 FROM views v WHERE v.u = c.u AND v.item = c.item AND event_type = \'purchase\') AS INT) AS label FROM cands c'))
def _(spark, sf):
    bought = V.views(spark, sf).where(F.col("event_type") == "purchase")
    return E.join_outcomes(candidates(spark, sf), bought, ["user", "item"])


@query("JOIN-13_join_trace", (
    "SELECT conv_id AS corr_id, turn AS stage, role, md5(text) AS text_md5, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS step FROM conversations"))
def _(spark, sf):
    return E.trace(V.log(spark, sf), "corr_id", "stage", "role", "text").select(
        "corr_id", "stage", "role", F.md5("text").alias("text_md5"), "step"
    )


# ---- features ---------------------------------------------------------------------------

def user_feature_log(spark, sf) -> DataFrame:
    """A feature row per signup or error event: its value at that time."""
    return V.views(spark, sf).where(F.col("event_type") == "signup").select("user", "ts", F.col("value").alias("score"))


def item_feature_log(spark, sf) -> DataFrame:
    return V.views(spark, sf).where(F.col("event_type") == "error").select("item", "ts", F.col("value").alias("score"))


ASOF_SQL = (
    "SELECT event_id, (SELECT max_by(f.value, f.ts) FROM views f WHERE f.event_type = 'signup' AND f.u = v.u AND f.ts <= v.ts) AS user_score"
)


@query("JOIN-11_asof_features", sql("views", ASOF_SQL + " FROM views v WHERE event_type = 'purchase'"))
def _(spark, sf):
    bought = V.views(spark, sf).where(F.col("event_type") == "purchase").select("event_id", "user", "ts")
    return FE.asof_join(bought, user_feature_log(spark, sf), "user", prefix="user_").select("event_id", "user_score")


@query("FEA-03_training_set_asof", sql("views", ASOF_SQL + (
    ", (SELECT max_by(f.value, f.ts) FROM views f WHERE f.event_type = 'error' AND f.item = v.item AND f.ts <= v.ts) AS item_score "
    "FROM views v WHERE event_type = 'purchase'")))
def _(spark, sf):
    bought = V.views(spark, sf).where(F.col("event_type") == "purchase").select("event_id", "user", "item", "ts")
    return FE.training_set_asof(bought, user_feature_log(spark, sf), item_feature_log(spark, sf)).select(
        "event_id", "user_score", "item_score"
    )


@query("JOIN-15_augment_features", CANDS + (
    ', uf AS (SELECT u, max_by(value, ts) AS us FROM views WHERE event_type = \'signup\' GROUP BY 1), '
    "itf AS (SELECT item, max_by(value, ts) AS its FROM views WHERE event_type = 'error' GROUP BY 1) "
    'SELECT u AS "user", item, us AS user_score, its AS item_score FROM cands LEFT JOIN uf USING (u) LEFT JOIN itf USING (item)'))
def _(spark, sf):
    return FE.augment(
        candidates(spark, sf), user_feature_log(spark, sf).withColumnRenamed("score", "user_score"),
        item_feature_log(spark, sf).withColumnRenamed("score", "item_score"),
    ).select("user", "item", "user_score", "item_score")


@query("FEA-01_build_features", sql("views", (
    "SELECT u AS \"user\", count(*) AS events, count(*) FILTER (WHERE event_type = 'purchase') AS purchases, count(DISTINCT item) AS distinct_partners, "
    "round(sum(value), 6) AS total_value, " + STAMP.format("max(ts)") + " AS last_ts, '2024-01-20' AS as_of FROM views WHERE ts < TIMESTAMP '2024-01-21' GROUP BY u")))
def _(spark, sf):
    return FE.build_features(V.views(spark, sf), "user", "2024-01-20").select(
        "user", "events", "purchases", "distinct_partners", rounded("total_value").alias("total_value"),
        stamp("last_ts").alias("last_ts"), F.col("as_of").cast("string").alias("as_of"),
    )


@query("FEA-02_latest_features", sql("views", (
    "SELECT u AS \"user\", " + STAMP.format("max(ts)") + " AS ts, max_by(value, ts) AS score FROM views WHERE event_type = 'signup' GROUP BY u")))
def _(spark, sf):
    return FE.latest_features(user_feature_log(spark, sf), "user").select("user", stamp("ts").alias("ts"), "score")


@query("FEA-05_inclusion_features", sql("views items", (
    "SELECT category, array_to_string(list_sort(list(DISTINCT brand)), ',') AS members FROM items GROUP BY 1")))
def _(spark, sf):
    return FE.inclusion_features(V.items(spark, sf), "brand", "category").select("category", F.array_join("members", ",").alias("members"))


# ---- ratings and collaborative filtering ---------------------------------------------------

def latest(spark, sf) -> DataFrame:
    return I.latest_rating(V.ratings(spark, sf))


def latest_once(spark, sf) -> DataFrame:
    """For queries that read the ratings several times; each step's shuffle files go before the next."""
    return cut_lineage(I.latest_rating(cut_lineage(V.ratings(spark, sf))))


@query("WIN-03_latest_rating", sql("latest", 'SELECT u AS "user", item, rating, ' + STAMP.format("ts") + " AS ts FROM latest"))
def _(spark, sf):
    return latest(spark, sf).select("user", "item", "rating", stamp("ts").alias("ts"))


@query("WIN-04_user_mean_deviation", sql("dev", (
    'SELECT u AS "user", item, round(rating - d, 6) AS mean, round(d, 6) AS deviation FROM dev')))
def _(spark, sf):
    return I.user_mean_deviation(latest(spark, sf)).select(
        "user", "item", rounded("mean").alias("mean"), rounded("deviation").alias("deviation")
    )


@query("SIM-05_user_item_matrix", sql("latest", (
    'SELECT u AS "user", count(*) AS items, round(sum(rating), 6) AS total, md5(string_agg(item || \':\' || rating, \',\' ORDER BY item)) AS cells FROM latest GROUP BY 1')))
def _(spark, sf):
    """The whole matrix, every user and every item, from its compressed rows."""
    return _row_digests(SR.unpack(_matrix(spark, sf).chunks), "user", "items")


@query("SIM-05_item_user_matrix", sql("latest", (
    "SELECT item, count(*) AS users, round(sum(rating), 6) AS total, md5(string_agg(u || ':' || rating, ',' ORDER BY u)) AS cells FROM latest GROUP BY 1")))
def _(spark, sf):
    """The matrix transposed."""
    return _row_digests(SR.unpack(SR.transpose(_matrix(spark, sf), 4096).chunks), "item", "users")


@query("SIM-05_rows_of_users", sql("latest users", (
    'SELECT u AS "user", item, rating FROM latest JOIN users USING (u) WHERE segment = \'BUILDING\'')))
def _(spark, sf):
    """The rows of one segment's users, read from the chunks that hold them."""
    wanted = V.users(spark, sf).where(F.col("segment") == "BUILDING").select("user")
    found = SR.read_rows(_matrix(spark, sf), wanted, "user")
    return found.select(F.col("row").alias("user"), F.col("column").alias("item"), F.col("value").alias("rating"))


def _matrix(spark, sf) -> SR.SparseRows:
    return SR.build(latest(spark, sf), "user", "item", "rating", 4096)


def _row_digests(cells: DataFrame, row: str, counted: str) -> DataFrame:
    entry = F.concat_ws(":", "column", "value")
    return cells.groupBy(F.col("row").alias(row)).agg(
        F.count("*").alias(counted), rounded(F.sum("value")).alias("total"),
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("column", entry.alias("e")))), lambda s: s["e"]), ",")).alias("cells"))


@query("JOIN-07_corated_self_join", sql("sums", 'SELECT l AS "left", r AS "right", n FROM sums'))
def _(spark, sf):
    sums = S.similarity_sums(latest_once(spark, sf))
    return sums.select("left", "right", F.col("n").cast("bigint").alias("n"))


@query("AGG-12_pearson_sums", sql("sums", (
    'SELECT l AS "left", r AS "right", round(sxy, 9) AS sxy, round(sxx, 9) AS sxx, round(syy, 9) AS syy FROM sums')))
def _(spark, sf):
    return S.similarity_sums(latest_once(spark, sf)).select(
        "left", "right", *[rounded(c, 9).alias(c) for c in ("sxy", "sxx", "syy")]
    )


@query("SIM-01_user_similarity", sql("sim", 'SELECT l AS "left", r AS "right", n, round(s, 6) AS similarity FROM sim'))
def _(spark, sf):
    return S.user_similarity(latest_once(spark, sf)).select(
        "left", "right", F.col("n").cast("bigint").alias("n"), rounded("similarity").alias("similarity")
    )


ITEM_SIM_SQL = (
    ", idev AS (SELECT *, rating - avg(rating) OVER (PARTITION BY item) AS d FROM latest), "
    "isums AS (SELECT a.item AS l, b.item AS r, count(*) AS n, sum(a.d * b.d) AS sxy, sum(a.d * a.d) AS sxx, sum(b.d * b.d) AS syy "
    "FROM idev a JOIN idev b ON a.u = b.u AND a.item < b.item GROUP BY 1, 2), "
    "isim AS (SELECT l, r, n, CASE WHEN sqrt(sxx) * sqrt(syy) > 0 THEN sxy / (sqrt(sxx) * sqrt(syy)) END AS s FROM isums)"
)
ITEM_SIM = sql("latest", "SELECT 0").replace(" SELECT 0", ITEM_SIM_SQL)


@query("SIM-02_item_similarity", ITEM_SIM + ' SELECT l AS "left", r AS "right", n, round(s, 6) AS similarity FROM isim')
def _(spark, sf):
    return S.user_similarity(latest_once(spark, sf), swap=True).select(
        "left", "right", F.col("n").cast("bigint").alias("n"), rounded("similarity").alias("similarity")
    )


@query("SET-04_corated_jaccard", sql("ratings", (
    ", cell AS (SELECT DISTINCT u, item FROM ratings), sz AS (SELECT u, count(*) AS n FROM cell GROUP BY 1), "
    "sh AS (SELECT a.u AS l, b.u AS r, count(*) AS shared FROM cell a JOIN cell b ON a.item = b.item AND a.u < b.u GROUP BY 1, 2) "
    'SELECT l AS "left", r AS "right", shared, round(shared / (x.n + y.n - shared), 6) AS jaccard FROM sh JOIN sz x ON x.u = l JOIN sz y ON y.u = r')).replace(") ,", "),", 1))
def _(spark, sf):
    return S.corated_jaccard(V.ratings(spark, sf)).select("left", "right", "shared", rounded("jaccard").alias("jaccard"))


NEAR = sql("near", "SELECT 0").replace("AS s FROM sums", "AS s0 FROM sums").replace(
    "near AS (", "sim2 AS (SELECT l, r, round(s0, 9) AS s FROM sim), near AS (").replace(
    "SELECT l AS e, r AS nb, s FROM sim UNION ALL SELECT r, l, s FROM sim", "SELECT l AS e, r AS nb, s FROM sim2 UNION ALL SELECT r, l, s FROM sim2"
).replace(" SELECT 0", "")
AFFINITY_SQL = (
    ", means AS (SELECT u, avg(rating) AS m FROM latest GROUP BY 1), "
    "aff AS (SELECT e AS u, l.item, CASE WHEN abs(sum(s)) >= 1e-12 THEN any_value(m) + sum(s * (l.rating - m)) / sum(s) END AS a "
    "FROM near JOIN means ON means.u = e JOIN latest l ON l.u = nb GROUP BY 1, 2)"
)


@query("SIM-01_user_neighbours", NEAR + ' SELECT e AS "user", nb AS neighbour, s AS similarity, rk AS rank FROM near')
def _(spark, sf):
    """The five nearest users of each, without a row per pair of users."""
    return _listed(S.nearest_entities(latest_once(spark, sf), 5), "user")


def _listed(near: DataFrame, name: str) -> DataFrame:
    ranked = top_per_group(near, ["entity"], [F.desc("similarity"), F.asc("neighbour")], 5)
    return ranked.select(F.col("entity").alias(name), "neighbour", "similarity", F.col("rank").cast("bigint").alias("rank"))


ITEM_NEAR = ITEM_SIM + (
    ", isim2 AS (SELECT l, r, round(s, 9) AS s FROM isim WHERE s IS NOT NULL), "
    "inear AS (SELECT * FROM (SELECT e, nb, s, row_number() OVER (PARTITION BY e ORDER BY s DESC, nb) AS rk FROM "
    "(SELECT l AS e, r AS nb, s FROM isim2 UNION ALL SELECT r, l, s FROM isim2)) WHERE rk <= 5)"
)


@query("SIM-02_item_neighbours", ITEM_NEAR + " SELECT e AS item, nb AS neighbour, s AS similarity, rk AS rank FROM inear")
def _(spark, sf):
    return _listed(S.nearest_entities(latest_once(spark, sf), 5, swap=True), "item")


@query("SIM-03_affinity", NEAR + AFFINITY_SQL + ' SELECT u AS "user", item, round(a, 5) AS affinity FROM aff')
def _(spark, sf):
    rows = latest_once(spark, sf)
    return S.affinity(rows, S.nearest_entities(rows, 5)).select("user", "item", rounded("affinity", 5).alias("affinity"))


UPDATE_SQL = (
    ", olds AS (SELECT * FROM latest WHERE ts < TIMESTAMP '2000-06-01'), news AS (SELECT * FROM latest WHERE ts >= TIMESTAMP '2000-06-01'), "
    "om AS (SELECT u, avg(rating) AS m FROM olds GROUP BY 1), nm AS (SELECT u, avg(rating) AS m FROM news GROUP BY 1), "
    "hd AS (SELECT x.u, x.item, x.rating - coalesce(om.m, nm.m) AS d FROM latest x LEFT JOIN om USING (u) LEFT JOIN nm USING (u)) "
    'SELECT a.u AS "left", b.u AS "right", count(*) AS n, round(sum(a.d * b.d), 9) AS sxy FROM hd a JOIN hd b ON a.item = b.item AND a.u < b.u GROUP BY 1, 2'
)


@query("SIM-04_update_similarity", sql("latest", "SELECT 0").replace(" SELECT 0", UPDATE_SQL))
def _(spark, sf):
    """Old sums plus the change by newer ratings equals the sums of all under the held means."""
    rows = latest_once(spark, sf)
    day = F.lit("2000-06-01").cast(rows.schema["ts"].dataType)
    old, new = rows.where(F.col("ts") < day), rows.where(F.col("ts") >= day)
    means = old.groupBy("user").agg(F.avg("rating").alias("mean"))
    updated = S.update_similarity(S.similarity_sums(old), old, new, means)
    return updated.select("left", "right", F.col("n").cast("bigint").alias("n"), rounded("sxy", 9).alias("sxy"))


@query("SIM-06_neighbour_features", NEAR + sql("users", "SELECT 0").replace("WITH ", ", ").replace(" SELECT 0", "") + (
    ' SELECT e AS "user", segment AS predicted FROM (SELECT e, segment, row_number() OVER (PARTITION BY e ORDER BY count(*) DESC, segment) AS rk '
    "FROM near JOIN users ON users.u = nb GROUP BY 1, 2) WHERE rk = 1"))
def _(spark, sf):
    return S.neighbour_features(S.nearest_entities(latest_once(spark, sf), 5), V.users(spark, sf), "segment")


@query("SIM-06_user_segments")
def _(spark, sf):
    rows = latest(spark, sf)
    return M.user_segments(M.matrix_factorisation(rows, rank=4, iterations=3).users, 5)


@query("REC-04_cf_recommend_user", NEAR + (
    ", found AS (SELECT e AS u, l.item, sum(s) AS score FROM near JOIN latest l ON l.u = nb WHERE s > 0 AND l.rating >= 4 "
    "AND NOT EXISTS (SELECT 1 FROM latest x WHERE x.u = e AND x.item = l.item) GROUP BY 1, 2) "
    'SELECT u AS "user", item, round(score, 6) AS score, rk AS rank FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY round(score, 9) DESC, item) AS rk FROM found) WHERE rk <= 10'))
def _(spark, sf):
    rows = latest_once(spark, sf)
    return _cf(rows, S.nearest_entities(rows, 5), "user")


def _cf(rows, near, mode) -> DataFrame:
    top = S.cf_recommend(rows, near, mode, 5, 10)
    return top.select("user", "item", rounded("score").alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query("REC-04_cf_recommend_item", ITEM_SIM + (
    ", isim2 AS (SELECT l, r, round(s, 9) AS s FROM isim WHERE s IS NOT NULL), "
    "inear AS (SELECT * FROM (SELECT e, nb, s, row_number() OVER (PARTITION BY e ORDER BY s DESC, nb) AS rk FROM "
    "(SELECT l AS e, r AS nb, s FROM isim2 UNION ALL SELECT r, l, s FROM isim2)) WHERE rk <= 5 AND s > 0), "
    "found AS (SELECT l.u, nb AS item, sum(s) AS score FROM latest l JOIN inear ON e = l.item WHERE l.rating >= 4 "
    "AND NOT EXISTS (SELECT 1 FROM latest x WHERE x.u = l.u AND x.item = nb) GROUP BY 1, 2) "
    'SELECT u AS "user", item, round(score, 6) AS score, rk AS rank FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY round(score, 9) DESC, item) AS rk FROM found) WHERE rk <= 10'))
def _(spark, sf):
    rows = latest_once(spark, sf)
    return _cf(rows, S.nearest_entities(rows, 5, swap=True), "item")


@query("SMP-08_neighbour_random_counts", NEAR + (
    ", found AS (SELECT DISTINCT e AS u, l.item FROM near JOIN latest l ON l.u = nb WHERE l.rating >= 4 "
    "AND NOT EXISTS (SELECT 1 FROM latest x WHERE x.u = e AND x.item = l.item)) "
    'SELECT u AS "user", least(3, count(*)) AS drawn, 0 AS strange FROM found GROUP BY 1'))
def _(spark, sf):
    """Whatever is drawn: three of what the neighbourhood liked and the user has not rated, or all there are."""
    rows = latest_once(spark, sf)
    near = cut_lineage(S.nearest_entities(rows, 5))
    liked = rows.where(F.col("rating") >= 4).select(F.col("user").alias("neighbour"), "item")
    allowed = near.join(liked, "neighbour").select(F.col("entity").alias("user"), "item").distinct()
    allowed = S.unseen_items(allowed, rows).withColumn("known", F.lit(1))
    drawn = S.neighbour_random(rows, near).join(allowed, ["user", "item"], "left")
    return drawn.groupBy("user").agg(F.count_distinct("item").alias("drawn"), F.count_if(F.col("known").isNull()).alias("strange"))


@query("SMP-08_neighbour_random")
def _(spark, sf):
    rows = latest_once(spark, sf)
    return S.neighbour_random(rows, S.nearest_entities(rows, 5))


@query("SMP-07_sequential_split", sql("ratings", (
    ", parts AS (SELECT CASE WHEN ts < TIMESTAMP '1998-01-01' THEN 'train' WHEN ts >= TIMESTAMP '1998-01-15' AND ts < TIMESTAMP '1998-07-15' THEN 'test' END AS part, rating FROM ratings) "
    "SELECT part, count(*) AS n, round(avg(rating), 6) AS mean FROM parts WHERE part IS NOT NULL GROUP BY 1")).replace(") ,", "),", 1))
def _(spark, sf):
    parts = SA.sequential_split(V.ratings(spark, sf), "ts", "1998-01-01", "14 days", "181 days")
    return parts.groupBy("part").agg(F.count("*").alias("n"), rounded(F.avg("rating")).alias("mean"))


@query("EVAL-12_drift", sql("ratings", (
    ", m AS (SELECT avg(rating) FILTER (WHERE ts < TIMESTAMP '1998-01-01') AS a, avg(rating) FILTER (WHERE ts >= TIMESTAMP '1998-01-15' AND ts < TIMESTAMP '1998-07-15') AS b FROM ratings) "
    "SELECT round(a, 6) AS train, round(b, 6) AS test, round(b - a, 6) AS drift FROM m")).replace(") ,", "),", 1))
def _(spark, sf):
    out = E.drift(V.ratings(spark, sf), "ts", "1998-01-01", "14 days", "181 days", F.avg("rating"))
    return out.select(rounded("train").alias("train"), rounded("test").alias("test"), rounded("drift").alias("drift"))


# ---- active learning -----------------------------------------------------------------------

PRED_SQL = ", mean_pred AS (SELECT u, avg(rating) AS p FROM latest GROUP BY 1), preds AS (SELECT l.u, l.item, l.rating, p FROM latest l JOIN mean_pred USING (u))"
PREDS = sql("latest", "SELECT 0").replace(" SELECT 0", PRED_SQL)


def preds(spark, sf) -> DataFrame:
    """Ratings predicted by the user's mean."""
    return I.user_mean_deviation(latest(spark, sf)).withColumnRenamed("mean", "prediction")


@query("EVAL-06_rmse", PREDS + " SELECT round(sqrt(avg((p - rating) * (p - rating))), 6) AS rmse, count(*) AS rows FROM preds")
def _(spark, sf):
    return E.rmse(preds(spark, sf)).select(rounded("rmse").alias("rmse"), "rows")


@query("ACT-01_active_scores", PREDS + (
    ", ent AS (SELECT item, sum(-(n / t) * ln(n / t)) AS entropy FROM (SELECT item, count(*) AS n, sum(count(*)) OVER (PARTITION BY item) AS t FROM latest GROUP BY item, rating) GROUP BY 1), "
    "uc AS (SELECT u, count(*) - 1 AS o FROM latest GROUP BY 1), cov AS (SELECT item, CAST(sum(o) AS BIGINT) AS c FROM latest JOIN uc USING (u) GROUP BY 1) "
    "SELECT item, count(*) AS popularity, round(var_pop(rating), 6) AS variance, round(any_value(entropy), 6) AS entropy, round(avg(abs(p - rating)), 6) AS error, any_value(c) AS co_coverage "
    "FROM preds JOIN ent USING (item) JOIN cov USING (item) GROUP BY item"))
def _(spark, sf):
    out = A.active_scores(latest(spark, sf), preds(spark, sf))
    return out.select(
        "item", "popularity", rounded("variance").alias("variance"), rounded("entropy").alias("entropy"),
        rounded("error").alias("error"), "co_coverage",
    )


@query("ACT-03_influence", ITEM_SIM + (
    " SELECT item, round(sum(abs(s)), 4) AS influence FROM (SELECT l AS item, s FROM isim WHERE s IS NOT NULL UNION ALL SELECT r, s FROM isim WHERE s IS NOT NULL) GROUP BY 1"))
def _(spark, sf):
    out = A.influence(S.total_similarity(latest_once(spark, sf), swap=True))
    return out.select("item", rounded("influence", 4).alias("influence"))


@query("ACT-03_segment_choice", sql("latest users", (
    "SELECT segment, item, raters, round(mean_rating, 6) AS mean_rating, rk AS rank FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY raters DESC, mean_rating DESC, item) AS rk FROM "
    "(SELECT segment, item, count(*) AS raters, avg(rating) AS mean_rating FROM latest JOIN users USING (u) GROUP BY 1, 2)) WHERE rk <= 10")))
def _(spark, sf):
    out = A.segment_choice(latest(spark, sf), V.users(spark, sf), 10)
    return out.select("segment", "item", "raters", rounded("mean_rating").alias("mean_rating"), F.col("rank").cast("bigint").alias("rank"))


@query("ACT-03_personal_active")
def _(spark, sf):
    """Over every item that a user has not rated."""
    rows = latest_once(spark, sf)
    factors = M.matrix_factorisation(rows, rank=4, iterations=3, implicit=True)
    weight = A.influence(S.total_similarity(rows, swap=True))
    return A.personal_active_of_factors(factors.users, factors.items, weight, rows.select("user", "item"), 5)


@query("ACT-03_personal_top", sql("latest", (
    ", uv AS (SELECT u, [count(*)::DOUBLE, sum(rating) / 10, min(item) % 7] AS v FROM latest GROUP BY 1), "
    "iv AS (SELECT item, [avg(rating), count(*) / 5, max(u) % 5 - 2] AS v FROM latest GROUP BY 1), "
    "x AS (SELECT uv.u, iv.item, list_dot_product(uv.v, iv.v::DOUBLE[]) AS s FROM uv, iv "
    "WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.u = uv.u AND l.item = iv.item)) "
    'SELECT u AS "user", item, round(s, 6) AS score, rk AS rank FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY round(s, 9) DESC, item) AS rk FROM x) WHERE rk <= 5')).replace(") ,", "),", 1))
def _(spark, sf):
    """The same search by vectors of plain sums, which SQL can form too."""
    rows = latest_once(spark, sf)

    def vector(by: str, *parts) -> DataFrame:
        return rows.groupBy(by).agg(F.array(*[p.cast("double") for p in parts]).alias("vec"))

    users = vector("user", F.count("*"), F.sum("rating") / 10, F.min("item") % 7)
    items = vector("item", F.avg("rating"), F.count("*") / 5, F.max("user") % 5 - 2)
    top = best_unseen(users, items, rows, 5)
    return top.select("user", "item", rounded("score").alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query("ACT-04_onboarding_questions", sql("latest", (
    ", b AS (SELECT item, count(*) AS popularity, var_pop(rating) AS variance FROM latest GROUP BY 1) "
    "SELECT item, popularity, round(variance, 6) AS variance, round(variance * popularity / (SELECT max(popularity) FROM b), 6) AS score "
    "FROM b ORDER BY round(variance * popularity / (SELECT max(popularity) FROM b), 9) DESC, item LIMIT 20")).replace(") ,", "),", 1))
def _(spark, sf):
    out = A.onboarding_questions(latest(spark, sf), 20)
    return out.select("item", "popularity", rounded("variance").alias("variance"), rounded("score").alias("score"))


# ---- model fits ----------------------------------------------------------------------------

@query("REC-07_matrix_factorisation")
def _(spark, sf):
    rows = latest_once(spark, sf)
    return M.complete_ratings(M.matrix_factorisation(rows, rank=4, iterations=4), rows)


# ---- lists ---------------------------------------------------------------------------------

@query("REC-01_eps_greedy")
def _(spark, sf):
    popularity = I.item_popularity(V.views(spark, sf))
    users = V.views(spark, sf).select("user").distinct()
    return R.eps_greedy(popularity, users, 10, 0.2)


@query("REC-03_bandit_arms", sql("views", (
    ", a AS (SELECT event_type AS arm, count(*) AS pulls, avg(value) AS m FROM views GROUP BY 1) "
    "SELECT arm, pulls, round(m, 6) AS mean_reward, m = (SELECT max(m) FROM a) AS best FROM a")).replace(") ,", "),", 1))
def _(spark, sf):
    return R.bandit_arms(V.views(spark, sf), "event_type", "value").select(
        "arm", "pulls", rounded("mean_reward").alias("mean_reward"), "best"
    )


def score_table(spark, sf, event_type) -> DataFrame:
    return V.views(spark, sf).where(F.col("event_type") == event_type).groupBy("user", "item").agg(
        F.count("*").cast("double").alias("score")
    )


def _scores_sql(name: str, event_type: str) -> str:
    return f"{name} AS (SELECT u, item, CAST(count(*) AS DOUBLE) AS s FROM views WHERE event_type = '{event_type}' GROUP BY 1, 2)"


BLEND = sql("views items", "SELECT 0").replace(
    " SELECT 0", ", " + ", ".join([_scores_sql("q", "view"), _scores_sql("w", "click"), _scores_sql("c", "purchase")])
)


@query("REC-09_query_blend", BLEND + (
    ' SELECT u AS "user", item, q.s + 0.5 * coalesce(w.s, 0) AS score FROM q LEFT JOIN w USING (u, item)'))
def _(spark, sf):
    return R.query_blend(score_table(spark, sf, "view"), score_table(spark, sf, "click"))


@query("REC-09_context_blend", BLEND + (
    ' SELECT u AS "user", item, q.s + 0.5 * coalesce(w.s, 0) + 0.25 * coalesce(c.s, 0) AS score FROM q LEFT JOIN w USING (u, item) LEFT JOIN c USING (u, item)'))
def _(spark, sf):
    return R.context_blend(*[score_table(spark, sf, t) for t in ("view", "click", "purchase")])


def _rank_table(scores_df) -> DataFrame:
    placed = place_in_group(scores_df, ["user"], F.desc("score"), F.asc("item"), name="rank")
    return placed.withColumn("rank", F.col("rank") + 1)


@query("REC-10_collate_ranks", BLEND + (
    ", rq AS (SELECT u, item, row_number() OVER (PARTITION BY u ORDER BY s DESC, item) AS rk FROM q), rw AS (SELECT u, item, row_number() OVER (PARTITION BY u ORDER BY s DESC, item) AS rk FROM w), "
    "m AS (SELECT u, item, round(sum(x), 9) AS score FROM (SELECT u, item, 1.0::DOUBLE / rk AS x FROM rq UNION ALL SELECT u, item, 0.5::DOUBLE / rk FROM rw) GROUP BY 1, 2) "
    'SELECT * FROM (SELECT u AS "user", item, round(score, 6) AS score, row_number() OVER (PARTITION BY u ORDER BY score DESC, item) AS rank FROM m) WHERE rank <= 10'))
def _(spark, sf):
    lists = {"view": (_rank_table(score_table(spark, sf, "view")), 1.0), "click": (_rank_table(score_table(spark, sf, "click")), 0.5)}
    merged = R.collate_ranks(lists).select("user", "item", rounded("score", 9).alias("score"))
    top = top_per_group(merged, ["user"], [F.desc("score"), F.asc("item")], 10)
    return top.select("user", "item", rounded("score").alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query("REC-11_diversify", RANKED + (
    ", t AS (SELECT u, item, rank, row_number() OVER (PARTITION BY u, category ORDER BY rank) AS c FROM ranked JOIN items USING (item)) "
    'SELECT u AS "user", item, rk AS rank FROM (SELECT u, item, row_number() OVER (PARTITION BY u ORDER BY rank) AS rk FROM t WHERE c <= 2) WHERE rk <= 8'))
def _(spark, sf):
    listed = ranked(spark, sf).join(V.items(spark, sf).select("item", "category"), "item")
    return R.diversify(listed, "category", 2, 8).select("user", "item", F.col("rank").cast("bigint").alias("rank"))


@query("REC-12_fallback_popular", RANKED + (
    ", pop AS (SELECT item, row_number() OVER (ORDER BY count(*) DESC, item) AS rk FROM views GROUP BY 1 ORDER BY 2 LIMIT 5) "
    "SELECT u AS \"user\", item, rank, 'personal' AS source FROM ranked WHERE rank <= 5 UNION ALL "
    "SELECT users.u, pop.item, rk, 'popular' FROM users CROSS JOIN pop WHERE users.u NOT IN (SELECT u FROM views)"))
def _(spark, sf):
    popular = I.rank_items(V.views(spark, sf)).where(F.col("rank") <= 5).select("item", F.col("rank").cast("int").alias("rank"))
    out = R.with_fallback(ranked(spark, sf, 5), V.users(spark, sf), popular)
    return out.select("user", "item", F.col("rank").cast("bigint").alias("rank"), "source")


MODEL_SQL = (
    ", pr AS (SELECT user_id AS key, event_type AS model, value / 100 AS score FROM events), "
    "mm AS (SELECT model, avg(score) AS m FROM pr GROUP BY 1), "
    "wt AS (SELECT model, 1.0::DOUBLE / (1 + abs(m - 0.5) / 0.25) AS w FROM mm) "
)


@query("REC-13_ensemble", "WITH" + MODEL_SQL[1:] + (
    "SELECT key, round(sum(score * w) / sum(w), 6) AS score FROM pr JOIN wt USING (model) GROUP BY 1"))
def _(spark, sf):
    predictions = V.table(spark, sf, "events").select(
        F.col("user_id").alias("key"), F.col("event_type").alias("model"), (F.col("value") / 100).alias("score")
    )
    priors = predictions.select("model").distinct().select("model", F.lit(0.5).alias("prior_mean"), F.lit(0.25).alias("prior_sd"))
    return R.ensemble(predictions, priors).select("key", rounded("score").alias("score"))


@query("REC-13_cascade", sql("views", (
    ", w AS (SELECT u * 100 + item AS key, max(value) FILTER (WHERE event_type = 'view') AS vs, max(value / 400) FILTER (WHERE event_type = 'view') AS vc, "
    "max(value) FILTER (WHERE event_type = 'click') AS cs, max(value / 400) FILTER (WHERE event_type = 'click') AS cc FROM views WHERE event_type IN ('view', 'click') GROUP BY 1) "
    "SELECT key, round(CASE WHEN vc >= 0.3 THEN vs WHEN cc >= 0.3 THEN cs ELSE (coalesce(vs, 0) + coalesce(cs, 0)) / ((vs IS NOT NULL)::INT + (cs IS NOT NULL)::INT) END, 6) AS score, "
    "CASE WHEN vc >= 0.3 THEN 'view' WHEN cc >= 0.3 THEN 'click' ELSE 'pooled' END AS model, CASE WHEN vc >= 0.3 THEN 1 ELSE 2 END AS depth FROM w")).replace(") ,", "),", 1))
def _(spark, sf):
    predictions = V.views(spark, sf).select(
        (F.col("user") * 100 + F.col("item")).alias("key"), F.col("event_type").alias("model"), F.col("value").alias("score"),
        (F.col("value") / 400).alias("confidence"),
    )
    return R.cascade(predictions, ["view", "click"], 0.3).select("key", rounded("score").alias("score"), "model", "depth")


@query("REC-14_assign_experiment")
def _(spark, sf):
    return R.assign_experiment(V.views(spark, sf).select("user").distinct(), "user", "first", {"control": 50, "a": 30, "b": 20})


@query("REC-14_shadow_compare", BLEND + (
    ' SELECT coalesce(q.u, w.u) AS "user", coalesce(q.item, w.item) AS item, q.s AS live, w.s AS shadow, w.s - q.s AS delta, q.u IS NOT NULL AS in_live, w.u IS NOT NULL AS in_shadow '
    "FROM q FULL JOIN w ON q.u = w.u AND q.item = w.item"))
def _(spark, sf):
    return R.shadow_compare(score_table(spark, sf, "view"), score_table(spark, sf, "click"), ["user", "item"])


@query("REC-15_new_item_exposure", RANKED + (
    ", arr AS (SELECT u, row_number() OVER (ORDER BY min(ts), u) - 1 AS p FROM views GROUP BY 1), "
    "nw AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS p FROM items WHERE item NOT IN (SELECT item FROM views)), "
    "ch AS (SELECT arr.u, nw.item FROM arr JOIN nw ON nw.p = arr.p // 20), "
    "kept AS (SELECT r.u, r.item, r.rank + CASE WHEN ch.item IS NOT NULL AND r.rank > 1 THEN 1 ELSE 0 END AS r FROM ranked r LEFT JOIN ch USING (u) WHERE ch.item IS NULL OR ch.item <> r.item), "
    'every AS (SELECT u, item, r FROM kept UNION ALL SELECT u, item, 2 FROM ch) SELECT u AS "user", item, row_number() OVER (PARTITION BY u ORDER BY r, item) AS rank FROM every'))
def _(spark, sf):
    """New items are those that no event has touched yet."""
    new = V.items(spark, sf).join(V.views(spark, sf).select("item"), "item", "left_anti")
    out = R.new_item_exposure(ranked(spark, sf), new, V.views(spark, sf), 20)
    return out.select("user", "item", F.col("rank").cast("bigint").alias("rank"))


@query("RET-09_retrieve_with_callback", RANKED + STALE_SQL + (
    ' SELECT u AS "user", item, rk AS rank FROM (SELECT u, item, row_number() OVER (PARTITION BY u ORDER BY rank) AS rk FROM ranked '
    "WHERE (u, item) NOT IN (SELECT u, item FROM stale) AND item NOT IN (SELECT item FROM items WHERE NOT active)) WHERE rk <= 10"))
def _(spark, sf):
    out = RT.retrieve(ranked(spark, sf), [
        (FL.stale_pairs(V.views(spark, sf), 2), ["user", "item"]), (V.items(spark, sf).where(~F.col("active")), ["item"]),
    ], 10)
    return out.select("user", "item", F.col("rank").cast("bigint").alias("rank"))


@query("RET-09_k_by_avoid_count", sql("views", (
    'SELECT a.u AS "user", 10 + count(DISTINCT b.item) AS k FROM (SELECT DISTINCT u FROM views) a LEFT JOIN views b ON b.u = a.u AND b.event_type = \'error\' GROUP BY 1')))
def _(spark, sf):
    events = V.views(spark, sf)
    return RT.k_by_avoid_count(events.select("user").distinct(), events.where(F.col("event_type") == "error"), 10)


# ---- metrics --------------------------------------------------------------------------------

@query("EVAL-07_roc_auc", sql("scored", (
    "SELECT count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives, "
    "round((SELECT sum(CASE WHEN p.score > n.score THEN 1.0::DOUBLE WHEN p.score = n.score THEN 0.5 ELSE 0 END) FROM scored p JOIN scored n ON p.label = 1 AND n.label = 0) / "
    "(count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)), 6) AS auc FROM scored")))
def _(spark, sf):
    return E.roc_auc(V.scored(spark, sf)).select("positives", "negatives", rounded("auc").alias("auc"))


@query("EVAL-08_kl_divergence", sql("scored", (
    ", o AS (SELECT least(19, floor(score * 20)) AS b, count(*) FILTER (WHERE label = 1) AS o, count(*) FILTER (WHERE label = 0) AS e FROM scored GROUP BY 1), "
    "g AS (SELECT unnest(range(0, 20)) AS b), f AS (SELECT coalesce(o, 0) + 1 AS o, coalesce(e, 0) + 1 AS e FROM g LEFT JOIN o USING (b)), "
    "t AS (SELECT o / (SELECT sum(o) FROM f) AS p, e / (SELECT sum(e) FROM f) AS q FROM f) SELECT round(sum(p * ln(p / q)), 6) AS kl FROM t")).replace(") ,", "),", 1))
def _(spark, sf):
    rows = V.scored(spark, sf)
    observed = E.binned(rows.where(F.col("label") == 1), "score", 0.0, 1.0, 20)
    expected = E.binned(rows.where(F.col("label") == 0), "score", 0.0, 1.0, 20)
    return E.kl_divergence(observed, expected, 20).select(rounded("kl").alias("kl"))


@query("EVAL-09_serving_metrics", sql("scored", (
    ", c AS (SELECT source, count(*) AS n FROM scored GROUP BY 1) "
    "SELECT 'category' AS metric, lang AS bucket, CAST(count(*) AS DOUBLE) AS value FROM scored GROUP BY lang UNION ALL "
    "SELECT 'candidates', CAST(n AS VARCHAR), CAST(count(*) AS DOUBLE) FROM c GROUP BY n UNION ALL "
    "SELECT 'score', 'min', round(min(score), 6) FROM scored UNION ALL SELECT 'score', 'mean', round(avg(score), 6) FROM scored UNION ALL "
    "SELECT 'score', 'max', round(max(score), 6) FROM scored UNION ALL SELECT 'score', 'p05', round(quantile_disc(score, 0.05), 6) FROM scored UNION ALL "
    "SELECT 'score', 'p50', round(quantile_disc(score, 0.5), 6) FROM scored UNION ALL SELECT 'score', 'p95', round(quantile_disc(score, 0.95), 6) FROM scored")).replace(") ,", "),", 1))
def _(spark, sf):
    out = E.serving_metrics(V.scored(spark, sf), "lang", "score", "source")
    return out.select("metric", "bucket", rounded("value").alias("value"))


@query("AGG-14_mean_metric", sql("scored", "SELECT lang, round(avg(score), 6) AS score, round(avg(label), 6) AS label FROM scored GROUP BY lang"))
def _(spark, sf):
    rows = V.scored(spark, sf)
    return E.mean_metric(rows.groupBy("lang"), "score", "label").select(
        "lang", rounded("score").alias("score"), rounded("label").alias("label")
    )


@query("SCL-19_pair_key")
def _(spark, sf):
    pairs = candidates(spark, sf)
    return pairs.select("user", "item", keys.pair_key(F.col("user"), F.col("item")).alias("pair_key"))


@query("SCL-23_hinge_terms", (
    "SELECT event_id, round(greatest(0, 1 + 2 - value), 6) AS margin, round(greatest(0, value - 10), 6) AS norm, round(greatest(0, 0.5 - value), 6) AS affinity FROM events"))
def _(spark, sf):
    v = F.col("value")
    return V.table(spark, sf, "events").select(
        "event_id", rounded(scores.hinge(1 + F.lit(2.0) - v)).alias("margin"), rounded(scores.hinge(v - 10.0)).alias("norm"),
        rounded(scores.hinge(0.5 - v)).alias("affinity"),
    )
