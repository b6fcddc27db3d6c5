"""Pages to text documents, sparse documents, tf-idf and training fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.functions import keys, scores, text
from affinia.operators.dictionary import lookup_title_index, lookup_token_index
from affinia.operators.sizes import broadcast_if_small


def keep_article(pages: DataFrame, reject: list[str] | None = text.RESERVED) -> DataFrame:
    """Pages with a title and a revision that are no redirect and in no reserved namespace."""
    kept = pages.where(
        (F.coalesce("redirect_title", F.lit("")) == "")
        & (F.coalesce("title", F.lit("")) != "")
        & (F.coalesce(F.size("revision"), F.lit(0)) > 0)
    )
    return kept.where(~F.col("title").rlike(text.prefix_pattern(reject))) if reject else kept


def drop_stopwords(docs: DataFrame, stop: list[str] = text.STOPWORDS, tokens: str = "tokens") -> DataFrame:
    """Token arrays without the words of the fixed stop list."""
    return docs.withColumn(tokens, F.filter(tokens, lambda t: ~t.isin(stop)))


def drop_stopword_rows(rows: DataFrame, stop: DataFrame, token: str = "token") -> DataFrame:
    """Token rows without the words of a stop table of any size."""
    return rows.join(stop.select(F.col("word").alias(token)), token, "left_anti")


def text_document(pages: DataFrame, style: str = "v2", prefix: str = text.URL_PREFIX) -> DataFrame:
    """Page to (primary, secondary, tokens, url).

    v2: urls as keys, simple tokens, distinct links outside the reserved namespaces.
    v1: titles as keys, all links, markup cleaned away and stop words dropped.
    """
    body = F.col("revision")[0]["text"]
    if style == "v1":
        docs = keep_article(pages, None).select(
            F.col("title").alias("primary"),
            text.extract_links(body, None, distinct=False).alias("secondary"),
            text.clean_tokenize(body).alias("tokens"),
            F.concat(F.lit(prefix), F.col("title")).alias("url"),
        )
        return drop_stopwords(docs)
    url = text.title_to_url(F.col("title"), prefix)
    links = text.extract_links(body, text.RESERVED)
    return keep_article(pages).select(
        url.alias("primary"),
        F.transform(links, lambda t: text.title_to_url(t, prefix)).alias("secondary"),
        text.simple_tokenize(body).alias("tokens"),
        url.alias("url"),
    )


def txt2url(docs: DataFrame, tokens: DataFrame, titles: DataFrame, key: str = "url") -> DataFrame:
    """(key, primary_index, token_index): ordered embedding indices, unknown titles dropped."""
    placed = lookup_title_index(docs.withColumnRenamed("primary", "title"), titles).select(
        key, F.col("title_index").alias("primary_index"), F.posexplode("tokens").alias("_at", "token")
    )
    found = lookup_token_index(placed, tokens)
    ordered = F.array_sort(F.collect_list(F.struct("_at", "embedding")))
    return found.groupBy(key, "primary_index").agg(
        F.transform(ordered, lambda s: s["embedding"]).alias("token_index")
    )


def url2url(docs: DataFrame, titles: DataFrame, key: str = "url") -> DataFrame:
    """(key, primary_index, secondary_index): known links in order, none-left documents dropped."""
    primary = lookup_title_index(docs.withColumnRenamed("primary", "title"), titles).select(
        key, F.col("title_index").alias("primary_index"), F.posexplode("secondary").alias("_at", "title")
    )
    found = lookup_title_index(primary, titles)
    ordered = F.array_sort(F.collect_list(F.struct("_at", "title_index")))
    return found.groupBy(key, "primary_index").agg(
        F.transform(ordered, lambda s: s["title_index"]).alias("secondary_index")
    )


def tfidf(docs: DataFrame, dictionary: DataFrame, key: str = "doc_id",
          stop: list[str] = text.STOPWORDS) -> DataFrame:
    """(key, index, weight): L2-normalised tf-idf of the dictionary tokens of a document.

    The N of the idf is the largest document frequency of the dictionary. The norm is
    taken over distinct dictionary tokens, so its group is bounded by the dictionary.
    """
    top = dictionary.agg(F.max("doc_frequency")).scalar()
    tokens = drop_stopwords(docs, stop).select(key, F.explode("tokens").alias("token"))
    counts = tokens.groupBy(key, "token").agg(F.count("*").alias("tf"))
    known = broadcast_if_small(dictionary.select("token", "index", "doc_frequency"))
    raw = counts.join(known, "token").select(
        key, "index", (F.col("tf") * scores.idf(top, F.col("doc_frequency"))).alias("x")
    )
    norm = l2_norm(raw, key)
    return raw.join(norm, key).select(
        key, "index",
        F.when(F.col("norm") > 0, F.col("x") / F.col("norm")).otherwise(0.0).alias("weight"),
    )


def l2_norm(rows: DataFrame, key: str, value: str = "x") -> DataFrame:
    """(key, norm) of long-form vectors."""
    return rows.groupBy(key).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))


def sentence_examples(sparse: DataFrame, length: int = 64, pieces: int = 8, seed: int = 0,
                      key: str = "url") -> DataFrame:
    """(primary_index, piece, tokens): fixed-length fragments of the token indices.

    Short documents are padded, exact ones kept whole, long ones give ``pieces``
    fragments at offsets drawn by hash.
    """
    size = F.size("token_index")
    count = F.when(size > length, F.lit(pieces)).otherwise(F.lit(1))
    rows = sparse.withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
    spare = F.greatest(size - length, F.lit(0)) + 1
    offset = keys.draw(spare, F.col(key), F.col("piece"), seed=seed).cast("int")
    fragment = F.slice("token_index", offset + 1, F.lit(length))
    return rows.select(
        key, "primary_index", "piece", text.pad_or_truncate(fragment, length).alias("tokens")
    )


def sentence_windows(docs: DataFrame, length: int = 64, key: str = "doc_id", items: str = "token_index") -> DataFrame:
    """(key, window, tokens): consecutive windows of fixed length over the whole document, 0-padded."""
    starts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / length))
    rows = docs.where(F.size(items) > 0).select(key, items, F.explode(starts).alias("window"))
    piece = F.slice(items, (F.col("window") * length + 1).cast("int"), F.lit(length))
    return rows.select(key, "window", text.pad_or_truncate(piece, length).alias("tokens"))


