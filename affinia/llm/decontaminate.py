"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed is a fixed mask over neighbouring words, of which some positions are ignored, so
that a changed word in an ignored place does not hide a copy. Seeds of the benchmark and
of the documents are taken at every word, so that any passage of 13 words with two changed
has one; equal seeds give the shift at which a benchmark text may lie in a document, and
the words around the hit are compared under that shift, which tolerates substitutions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.tables import free_name, row_key, written
from affinia.operators.sizes import broadcast_if_small, measured_bytes

#: Word offsets that a seed reads; the others in its span of nine are ignored.
MASKS = ((0, 1, 3, 5, 6, 8), (0, 2, 3, 6, 7, 8), (0, 1, 2, 5, 7, 8))
SPAN = 9
STEP = 1
#: Words of the window that has to agree, and in how many of them.
WINDOW, AGREE = 13, 11
#: A seed table of more bytes than this is joined by shuffling both sides.
BROADCAST = 16 << 20


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null and empty texts have none."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(F.length(plain) > 0, F.split(plain, " ")).otherwise(F.array().cast("array<string>"))


def _seeds(words: str, step: int) -> Column:
    """(at, seed) of every mask at every ``step``-th word; the seed holds the mask's number."""
    masks = ", ".join(
        f"struct(i as at, xxhash64({n}, {', '.join(f'h[i + {o}]' for o in mask)}) as seed)" for n, mask in enumerate(MASKS))
    return F.expr(
        f"flatten(transform(if(size(h) >= {SPAN}, sequence(0, size(h) - {SPAN}, {step}), array()), i -> array({masks})))")


def _short_seeds(words: str, lengths: list[int]) -> Column:
    """(at, seed) of every run of these numbers of words."""
    runs = [
        f"transform(if(size(h) >= {n}, sequence(0, size(h) - {n}), array()), "
        f"i -> struct(i as at, xxhash64({-n}, {', '.join(f'h[i + {o}]' for o in range(n))}) as seed))" for n in lengths]
    return F.expr(f"concat({', '.join(runs)})")


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, matched, best) of every document that holds a benchmark passage.

    Under a shift that a shared seed gives, ``matched`` counts the item's words that
    stand in the document at their place, and ``best`` those in the best window of 13
    words (of all words, if the item has fewer). A pair is reported, with its best
    shift, if that window agrees in at least 11 of 13 words (or in all of the fewer).

    Items of fewer than nine words are found where all their words stand in a row.

    Words are lower-cased runs of letters and digits. Null and empty texts and items match
    nothing. Rows without an id match nothing; repeated rows give one row per pair. Other
    columns are ignored, and either table may be empty. Benchmark seeds are broadcast if
    their counted bytes are few, else both sides are shuffled by the seed; so are the hits,
    after which only documents that have any are read on.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), words_of(F.col(item_text)).alias("item_words"))
    items = items.where("item_id is not null").distinct()
    hashed = items.select("item_id", _hashed(F.col("item_words")).alias("h"))
    # At most eight lengths, each under nine.
    lengths = sorted(r[0] for r in hashed.where(F.size("h").between(1, SPAN - 1)).select(F.size("h").alias("n")).distinct().collect())
    test = hashed.select("item_id", F.inline(_seeds("h", 1)))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    seeds = _seeds("h", STEP)
    if lengths:
        whole = [F.expr(f"xxhash64({-n}, {', '.join(f'h[{o}]' for o in range(n))})") for n in lengths]
        of_length = F.coalesce(*[F.when(F.size("h") == n, seed) for n, seed in zip(lengths, whole)])
        short = hashed.where(F.size("h").between(1, SPAN - 1)).select("item_id", F.lit(0).alias("at"), of_length.alias("seed"))
        test = test.unionByName(short)
        seeds = F.concat(seeds, _short_seeds("h", lengths))
    test = test.select("item_id", F.col("at").alias("item_at"), "seed")
    train = own.select("doc_id", _hashed(words_of(F.col("text"))).alias("h")).select("doc_id", F.inline(seeds))
    if measured_bytes(test) <= BROADCAST:
        test = F.broadcast(test)
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    hits = written(train.join(test, "seed").select("doc_id", "item_id", shift).distinct(), "seed-hits")
    # Only documents with hits are read on; words are compared under each hit's shift.
    with_hits = own.join(broadcast_if_small(hits.select("doc_id").distinct()), "doc_id", "left_semi")
    placed = with_hits.withColumn("words", words_of(F.col("text"))).drop("text").join(hits, "doc_id").join(items, "item_id")
    agrees = F.expr(
        "transform(item_words, (w, i) -> if(i + shift >= 0 and i + shift < size(words) and get(words, i + shift) = w, 1, 0))")
    best = F.expr(
        f"array_max(transform(sequence(0, greatest(size(same) - {WINDOW}, 0)), "
        f"i -> aggregate(slice(same, i + 1, {WINDOW}), 0, (a, x) -> a + x)))")
    scored = placed.select("doc_id", "item_id", agrees.alias("same")).select(
        "doc_id", "item_id", F.expr("aggregate(same, 0, (a, x) -> a + x)").alias("matched"), best.alias("best"),
        F.when(F.size("same") >= WINDOW, F.lit(AGREE)).otherwise(F.size("same")).alias("least"))
    found = scored.where("best >= least").groupBy("doc_id", "item_id").agg(F.max(F.struct("matched", "best")).alias("m"))
    return found.select("doc_id", "item_id", F.col("m.matched").cast("bigint").alias("matched"),
                        F.col("m.best").cast("bigint").alias("best"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark passage.

    Rows are judged by their own text, whatever their id: a clean text with the id of a
    leaking one stays, and a leaking text without an id goes, as do all its repeats.
    """
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    found = written(leaks(keyed, benchmark, id_col=key).select(F.col("doc_id").alias(key)).distinct(), "leaking")
    return keyed.join(broadcast_if_small(found), key, "left_anti").select(*docs.columns)
