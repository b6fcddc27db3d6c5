"""Line dedup by a log-template tree.

A line falls through a tree of fixed depth: first by its number of tokens, then by its
leading tokens, where a token with a digit counts as a variable field. In a leaf, a
further position is a variable field too unless one token holds it in at least half of
the leaf's lines. Lines that keep enough fixed tokens share their leaf's template, the
others are templates of their own. Templates that recur in many documents are dropped.

A document is a text, however often it is copied as a whole. A text that consists of
common lines for the most part is a near copy of others and says nothing about its lines,
which are left to document dedup; but neither does it keep them in other texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.tables import bit_filter, written
from affinia.operators.sizes import broadcast_if_small

DEPTH = 3
FIELD = "<*>"
_DIGIT = re.compile(rb"[0-9]")
#: Share of a text, in bytes, above which common lines make it a near copy of other texts.
OWN = 0.5
_LINE = ["key", "line_no", "alone", "surround", "masked", "text_id", "size", "leaf"]
_LINE_SCHEMA = "key bigint, line_no int, alone boolean, surround bigint, masked string, text_id bigint, size int, leaf bigint"


def _key(id_col: str, text_col: str) -> Column:
    """Tells rows apart by id and text, so that a null or repeated id does no harm."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _hash(*parts: bytes) -> int:
    return int.from_bytes(blake2b(b"\n".join(parts), digest_size=8).digest(), "little", signed=True)


def _tree_lines(depth: int, wanted=None):
    """Per text (key, lines): the leaf of each of its lines, or all of those of wanted leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _LINE]
            for key, text_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                lines = text.as_py().encode().split(b"\n")
                for at, line in enumerate(lines):
                    tokens = line.split()
                    if not tokens:
                        continue
                    if _DIGIT.search(line):
                        tokens = [FIELD.encode() if _DIGIT.search(t) else t for t in tokens]
                    leaf = _hash(str(len(tokens)).encode(), *tokens[:depth])
                    out[-1].append(leaf)
                    if wanted is not None:
                        spot = leaf % (8 * len(wanted.value))
                        if not wanted.value[spot >> 3] >> (spot & 7) & 1:
                            out[-1].pop()
                            continue
                        before, after = at > 0, at + 1 < len(lines)
                        near = _hash(b"%d%d" % (before, after), lines[at - 1] if before else b"", lines[at + 1] if after else b"")
                        for k, v in enumerate((key, at, len(lines) == 1, near, b" ".join(tokens).decode(), text_id, len(line))):
                            out[k].append(v)
            if wanted is None:
                yield pa.RecordBatch.from_arrays([pa.array(out[-1], pa.int64())], names=["leaf"])
            else:
                kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds)], names=_LINE)
    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.length(text_col) > 0).select(
        _key(id_col, text_col).alias("key"), F.xxhash64(F.col(text_col)).alias("text_id"), F.col(text_col).alias("text"))


def crowded_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 5, depth: int = DEPTH,
) -> DataFrame:
    """(key, line_no, alone, surround, masked, text_id, size, leaf) of every line in a leaf of ``least`` lines or more.

    ``masked`` are the line's tokens by one space, with fields for those that have a
    digit; ``surround`` is a hash of the lines before and after it, ``alone`` says that
    there are none, ``size`` is the line's bytes. The leaves are counted first, so that
    only lines that matter travel.
    """
    rows = _texts(docs, id_col, text_col)
    leaves = rows.mapInArrow(_tree_lines(depth), "leaf bigint").groupBy("leaf").agg(F.count("*").alias("n"))
    big = written(leaves.where(F.col("n") >= least).select("leaf"), "leaves")
    wanted = docs.sparkSession.sparkContext.broadcast(bit_filter(big, "leaf"))
    return written(rows.mapInArrow(_tree_lines(depth, wanted), _LINE_SCHEMA).join(big, "leaf", "left_semi"), "lines")


def _shown() -> Column:
    """The tokens of a line with a field in the place of each that is not fixed in the leaf; no list is searched per token."""
    keys = "transform(tokens, (t, i) -> concat_ws(' ', cast(i as string), t))"
    at = "cast(substring_index(k, ' ', 1) as int) as i"
    held = f"transform(array_intersect({keys}, fixed), k -> struct({at}, substring(k, instr(k, ' ') + 1) as t))"
    free = f"transform(array_except({keys}, fixed), k -> struct({at}, '{FIELD}' as t))"
    return F.expr(f"transform(array_sort(concat({held}, {free})), s -> s.t)")


def templates(crowded: DataFrame, depth: int = DEPTH, alike: float = 0.7) -> DataFrame:
    """(leaf, masked, template) of the distinct lines of every leaf."""
    kinds = written(crowded.groupBy("leaf", "masked").agg(F.count("*").alias("n")), "kinds")
    tokens = kinds.select("leaf", "n", F.posexplode(F.split("masked", " ")).alias("pos", "token"))
    total = tokens.groupBy("leaf", "pos").agg(F.sum("n").alias("all"))
    held = tokens.groupBy("leaf", "pos", "token").agg(F.sum("n").alias("n")).join(total, ["leaf", "pos"])
    fixed = held.where((F.col("pos") < depth) | (2 * F.col("n") >= F.col("all"))).select("leaf", "pos", "token")
    # The fixed tokens of a leaf, at most two per position of its lines, which are all of one length.
    fixed = fixed.groupBy("leaf").agg(F.collect_set(F.concat_ws(" ", "pos", "token")).alias("fixed"))
    parts = kinds.select("leaf", "masked").join(fixed, "leaf").withColumn("tokens", F.split("masked", " "))
    parts = parts.withColumn("shown", _shown())
    kept = F.expr(f"size(filter(shown, t -> t <> '{FIELD}'))") >= F.lit(alike) * F.size("tokens")
    return parts.select("leaf", "masked", F.when(kept, F.array_join("shown", " ")).otherwise(F.col("masked")).alias("template"))


def recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 5, depth: int = DEPTH,
    alike: float = 0.7, own: float = OWN,
) -> DataFrame:
    """(key, line_no, template) of the lines to drop.

    A template is common if it stands in ``min_docs`` different texts. It recurs if
    ``min_docs`` of these texts are their own for the most part, that is, if common lines
    make up no more than ``own`` of their bytes; or if its lines stand in ``min_docs``
    different surroundings (the line before and the one after) and half of them or more
    have one of their own. So a block of lines goes whole, copies of a whole text count
    once and keep nothing in other texts, and the lines of near copies, which recur
    together, are left to document dedup. A line that is a whole document is never dropped.
    """
    crowded = crowded_lines(docs, id_col, text_col, min_docs, depth)
    named = templates(crowded, depth, alike)
    placed = written(crowded.join(named, ["leaf", "masked"]).drop("masked"), "placed")
    # One row per text, so that a template of a third of all lines is counted by many tasks.
    once = placed.select("leaf", "template", "text_id", "line_no", "size").distinct()
    texts = written(once.groupBy("leaf", "template", "text_id").agg(F.sum("size").alias("n")), "texts-of-templates")
    common = texts.groupBy("leaf", "template").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    common = written(common.select("leaf", "template"), "common")
    marked = texts.join(broadcast_if_small(common), ["leaf", "template"], "left_semi")
    whole = _texts(docs, id_col, text_col).select("text_id", F.octet_length("text").alias("size")).distinct()
    shares = marked.groupBy("text_id").agg(F.sum("n").alias("n")).join(whole, "text_id")
    near = shares.where(F.col("n") > own * F.col("size")).select("text_id")
    counted = marked.join(near, "text_id", "left_anti").groupBy("leaf", "template").agg(F.count("*").alias("n"))
    by_text = counted.where(F.col("n") >= min_docs).select("leaf", "template")
    each = placed.groupBy("leaf", "template", "surround").agg(F.count("*").alias("n"))
    around = each.groupBy("leaf", "template").agg(F.sum("n").alias("n_lines"), F.count("*").alias("n_surrounds"))
    by_place = around.where((F.col("n_surrounds") >= min_docs) & (2 * F.col("n_surrounds") >= F.col("n_lines")))
    often = written(by_text.unionByName(by_place.select("leaf", "template")).distinct(), "recurring")
    found = placed.where("not alone").join(broadcast_if_small(often), ["leaf", "template"])
    return found.select("key", "line_no", "template")


def drop_recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 5, depth: int = DEPTH,
    alike: float = 0.7,
) -> DataFrame:
    """The rows of ``docs`` without their recurring lines, and n_lines, n_dropped.

    What is left of a text keeps its line ends. No row goes: a text of recurring lines
    only becomes empty, null and empty texts stay as they are, with no lines. Rows of one
    id are judged by their own texts, rows without an id too; exact repeats of a row count
    as one text. An empty table gives no rows.
    """
    gone = recurring_lines(docs, id_col, text_col, min_docs, depth, alike)
    # A list is as long as its own text has lines.
    lists = gone.groupBy("key").agg(F.collect_set("line_no").alias("_gone"))
    rows = docs.withColumn("_key", _key(id_col, text_col)).join(lists.withColumnRenamed("key", "_key"), "_key", "left")
    lines = f"split(`{text_col}`, '\n')"
    # Whether each line goes, in order, without a search of the list per line.
    flags = (f"transform(array_sort(concat(transform(_gone, i -> struct(i, true as g)), transform(array_except("
             f"sequence(0, size({lines}) - 1), _gone), i -> struct(i, false as g)))), s -> s.g)")
    left = F.expr(f"array_join(zip_with({lines}, {flags}, (x, g) -> if(g, null, x)), '\n')")
    n_lines = F.when(F.length(text_col) > 0, F.size(F.split(text_col, "\n"))).otherwise(0).cast("bigint")
    return rows.select(
        *[F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(left).alias(c) if c == text_col else F.col(f"`{c}`")
          for c in docs.columns],
        n_lines.alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_dropped"))
