"""Registered queries of the corpus operators, and their SQL twins where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.llm import (
    decontaminate, filter_audit, fingerprints, html_text, lexical_search, line_dedup, near_dedup, packing, quality, secrets,
    substring_dedup, toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = """
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then []
    when len(w) = 1 then [w[1]]
    else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) s from words),
items as (select doc_id, unnest(s) t from sets),
pairs as (
  select a.doc_id x, b.doc_id y, count(*) n from items a join items b on a.t = b.t and a.doc_id <> b.doc_id
  group by all),
links as (
  select x, y from pairs join sets p on p.doc_id = x join sets q on q.doc_id = y
  where 100 * n >= 80 * (len(p.s) + len(q.s) - n)),
reach as (
  select doc_id x, doc_id y from documents
  union select reach.x, links.y from reach join links on links.x = reach.y),
low as (select x, min(y) component_id from reach group by x)
select doc_id, len(s) n_shingles, component_id, doc_id = component_id kept from sets join low on x = doc_id
"""


@query("op1_minhash_near_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


OP2_SQL = """
with split as (select doc_id, text, string_split(text, chr(10)) ls from documents where length(text) > 0),
numbered as (select doc_id, text, ls, unnest(range(len(ls))) i from split),
masked as (
  select doc_id, text, i, strlen(ls[i + 1]) size, len(ls) = 1 alone, struct_pack(a := case when i > 0 then ls[i] end,
      b := case when i + 1 < len(ls) then ls[i + 2] end, c := i > 0, d := i + 1 < len(ls)) surround,
    regexp_replace(trim(regexp_replace(ls[i + 1], '[ \\t\\r\\x0B\\f]+', ' ', 'g')), '[^ ]*[0-9][^ ]*', '<*>', 'g') m
  from numbered),
lines as (
  select *, string_split(m, ' ') ts, struct_pack(n := len(string_split(m, ' ')), h := string_split(m, ' ')[1:3]) leaf
  from masked where m <> ''),
crowded as (select * from lines where leaf in (select leaf from lines group by leaf having count(*) >= 5)),
kinds as (select leaf, m, any_value(ts) ts, count(*) n from crowded group by leaf, m),
tokens as (select leaf, n, unnest(ts) t, generate_subscripts(ts, 1) p from kinds),
total as (select leaf, p, sum(n) total from tokens group by leaf, p),
fixed as (
  select t.leaf, t.p, t.t from (select leaf, p, t, sum(n) n from tokens group by leaf, p, t) t
  join total using (leaf, p) where t.p <= 3 or 2 * t.n >= total),
spread as (
  select leaf, m, generate_subscripts(ts, 1) p, unnest(ts) t from kinds),
shown as (
  select s.leaf, s.m, list(coalesce(f.t, '<*>') order by s.p) shown
  from spread s left join fixed f on f.leaf = s.leaf and f.p = s.p and f.t = s.t group by s.leaf, s.m),
named as (
  select leaf, m, case when len(list_filter(shown, lambda t: t <> '<*>')) >= 0.7 * len(shown)
    then array_to_string(shown, ' ') else m end template from shown),
placed as (select c.*, template from crowded c join named using (leaf, m)),
common as (select leaf, template from placed group by leaf, template having count(distinct text) >= 5),
near as (
  select text from (select distinct text, i, leaf, template, size from placed) join common using (leaf, template)
  group by text having sum(size) > 0.5 * strlen(text)),
counted as (
  select leaf, template from placed where text not in (select text from near) group by leaf, template
  having count(distinct text) >= 5),
around as (
  select leaf, template from placed group by leaf, template
  having count(distinct surround) >= 5 and 2 * count(distinct surround) >= count(*)),
often as (select * from counted union select * from around),
gone as (select doc_id, list(i) g from placed join often using (leaf, template) where not alone group by doc_id)
select d.doc_id, case when length(text) > 0 then len(string_split(text, chr(10))) else 0 end n_lines,
  coalesce(len(g), 0) n_dropped,
  sha256(case when g is null then coalesce(text, '') else
    array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: not list_contains(g, i - 1)), chr(10)) end) kept_sha256
from documents d left join gone using (doc_id)
"""


@query("op2_line_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


# Every shift at which a document and an item have words in common, without any seeds.
OP6_SQL = """
with d as (
  select doc_id, list_filter(string_split(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '),
    lambda x: x <> '') w from documents),
b as (
  select distinct item_id, list_filter(string_split(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '),
    lambda x: x <> '') w from benchmark where item_id is not null),
dp as (select doc_id, unnest(w) x, unnest(range(len(w))) i from d),
bp as (select item_id, len(w) n, unnest(w) x, unnest(range(len(w))) j from b),
shifted as (
  select doc_id, item_id, n, i - j shift, list(j) js, count(*) matched from dp join bp using (x) group by all
  having count(*) >= (case when n >= 13 then 11 else n end)),
scored as (
  select *, list_max(list_transform(range(0, greatest(n - 13, 0) + 1),
    lambda s: len(list_filter(js, lambda j: j >= s and j < s + 13)))) best from shifted),
found as (
  select doc_id, item_id, max(struct_pack(matched := matched, best := best)) m from scored
  where best >= (case when n >= 13 then 11 else n end) group by all)
select doc_id, item_id, m.matched::bigint matched, m.best::bigint best from found
"""


@query("op6_benchmark_decontamination", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_document_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query("op9_secret_scans")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


OP12_SQL = """
with words as (
  select doc_id, coalesce(source, '') part, coalesce(text, '') t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w from documents),
marks as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) good, max(case when toxic = 1 then 1 else 0 end) toxic
  from labels group by doc_id),
firsts as (select t, min(doc_id) low from words group by t),
masked as (
  select part, coalesce(good, 0) good, coalesce(toxic, 0) toxic,
    (case when len(w) < 200 then 1 else 0 end)
    + (case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end)
    + (case when 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 4 else 0 end)
    + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
    + (case when words.doc_id > low then 16 else 0 end) mask
  from words join firsts using (t) left join marks on marks.doc_id = words.doc_id),
cells as (select part, mask, count(*) n, sum(good) good, sum(toxic) toxic from masked group by part, mask),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) l, unnest([1, 2, 4, 8, 16]) b),
orders as (
  select a.l || b.l || c.l || d.l || e.l filter_order, [a.b, b.b, c.b, d.b, e.b] bits
  from letters a join letters b on b.l <> a.l join letters c on c.l not in (a.l, b.l)
  join letters d on d.l not in (a.l, b.l, c.l) join letters e on e.l not in (a.l, b.l, c.l, d.l)),
steps as (select filter_order, bits, unnest(range(1, 6)) step from orders),
sides as (select filter_order, step, bits[step] bit, coalesce(list_sum(bits[1:step - 1]), 0)::int before from steps),
counted as (
  select part, filter_order, step, bit,
    sum(case when mask & (before | bit) = 0 then n else 0 end) kept,
    sum(case when mask & before = 0 and mask & bit <> 0 then n else 0 end) removed,
    sum(case when mask & before <> 0 and mask & bit <> 0 then n else 0 end) redundant,
    sum(case when mask = bit then n else 0 end) unique_fails,
    sum(case when mask & before = 0 and mask & bit <> 0 then good else 0 end) good_lost,
    sum(case when mask & before = 0 and mask & bit <> 0 then toxic else 0 end) toxic_lost
  from cells cross join sides group by all)
select part, filter_order, step::int step, kept::bigint kept, removed::bigint removed, redundant::bigint redundant,
  unique_fails::bigint unique_fails, good_lost::bigint good_lost, toxic_lost::bigint toxic_lost,
  (sum(removed) over (partition by part, bit))::bigint shapley
from counted
"""


@query("op12_filter_interaction_audit", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_TERMS_SQL = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP13_SQL = f"""
with d as (select doc_id, {_TERMS_SQL} w from documents),
sized as (select doc_id, w, len(w)::bigint n from d where len(w) > 0),
whole as (select count(*)::bigint n_docs, sum(n)::bigint total from sized),
items as (select distinct item_id, unnest({_TERMS_SQL}) t from benchmark),
wanted as (select distinct t from items),
found as (
  select doc_id, n, t, count(*)::bigint tf from (select doc_id, n, unnest(w) t from sized)
  join wanted using (t) group by all),
weighed as (
  select t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint w from found, whole group by t, n_docs),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // total))))::bigint score
  from found join weighed using (t) join items using (t), whole group by all),
ranked as (
  select *, (row_number() over (partition by item_id order by score desc, doc_id))::int rank from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


@query("op13_ranked_lexical_search", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = """
with held as (
  select page_id, coalesce(html, '') html, octet_length(encode(coalesce(html, '')))::bigint payload_bytes,
    sha256(coalesce(html, '')) payload_digest from pages),
firsts as (select *, min(page_id) over (partition by html) low from held)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> low then 'revisit' else 'response' end record_type,
  case when payload_bytes >= 100 and page_id <> low then low end refers_to
from firsts
"""


@query("op11_warc", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))
