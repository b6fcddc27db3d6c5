"""Stages judge rows by their own text; short benchmark items are found."""

import corpus_pipeline
import pytest

from affinia.llm import decontaminate, near_dedup

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string, spans string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", "y") for i, t in texts], DOCS)


def left(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def text(name, n=40):
    return " ".join(f"{name}{k}" for k in range(n))


def test_near_duplicates_go_by_text(spark):
    near = text("a")[:-2] + "zz"
    rows = [(1, text("a")), (1, text("b")), (2, near), (None, text("c")), (None, text("c")), (None, text("a")), (3, text("c")),
            (4, text("d")), (4, text("d")), (5, ""), (5, ""), (6, None), (None, None), (7, " \t")]
    got = near_dedup.drop_near_duplicates(frame(spark, rows))
    assert got.columns == DOCS.replace(" bigint", "").replace(" string", "").split(", ")
    want = [(1, text("a")), (1, text("b")), (3, text("c")), (4, text("d")), (5, ""), (5, ""), (6, None), (None, None), (7, " \t")]
    assert left(got) == sorted(want, key=repr)
    assert left(near_dedup.drop_near_duplicates(frame(spark, []))) == []


def test_leaks_go_by_text(spark):
    item = text("q", 20)
    rows = [(1, f"x {item} y"), (1, text("clean")), (None, item), (None, text("other")), (2, None), (3, ""), (4, item), (4, item)]
    tests = spark.createDataFrame([(7, item, "k")], "item_id bigint, text string, row_key string")
    got = decontaminate.drop_leaks(frame(spark, rows), tests)
    assert left(got) == sorted([(1, text("clean")), (None, text("other")), (2, None), (3, "")], key=repr)
    assert len(left(decontaminate.drop_leaks(frame(spark, rows), tests.limit(0)))) == len(rows)


@pytest.mark.parametrize("n", [1, 2, 5, 8, 9, 12])
def test_short_items_are_found_whole(spark, n):
    item = text("q", n)
    broken = " ".join(item.split()[:-1] + ["other"])
    docs = [(1, f"so {item}, and on"), (2, f"{broken} {text('z', 30)}"), (3, item.upper()), (4, text("z", 50)), (5, f"{item} {item}")]
    tests = spark.createDataFrame([(1, item), (2, text("never", 30)), (3, ""), (4, None)], "item_id bigint, text string")
    got = decontaminate.leaks(frame(spark, docs), tests).collect()
    assert sorted((r["doc_id"], r["item_id"], r["matched"], r["best"]) for r in got) == [(d, 1, n, n) for d in (1, 3, 5)]


def test_filtering_stages_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, empty texts and clashing columns through the stages that drop rows."""
    item = text("bench", 15)
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, text("n")), (None, f"{item} {text('m')}"), (8, text("a")), (8, text("b")), (9, text("a")), (10, None), (11, ""), (8, f"{item}")]
    docs = frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == frame(spark, []).columns
    assert left(docs) == sorted([(None, text("n")), (8, text("a")), (8, text("b")), (10, None), (11, "")], key=repr)
    empty = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.collect() == []
