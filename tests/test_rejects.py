"""Planted bad lines and files come out beside the rows, with file, reason and count."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from affinia.sources import rejects as R


def found(checked):
    return sorted((os.path.basename(r["file"]), r["reason"], r["records"]) for r in checked.rejects.collect())


def test_bad_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"product": "p", "scene": "s", "bbox": [0.1]}\n\n{"product": "p"\nnot json\n{"scene": "s"}\n  \n[1]\n"x"\nnull\n')
    (tmp_path / "b.json").write_text('{"product": "q", "scene": "s", "bbox": "wide"}\n{"product": 5, "scene": "t", "other": 1}\n{"product": null, "scene": null}\n')
    checked = R.checked_scene_product(spark, str(tmp_path))
    assert sorted((r["product"], r["scene"]) for r in checked.rows.collect()) == [("5", "t"), ("p", "s")]
    assert checked.counts.get == {"read": 2, "rejected": 8}
    by_reason = {}
    for r in checked.rejects.collect():
        by_reason[os.path.basename(r["file"]), r["reason"]] = r["records"]
    assert by_reason[("a.json", "no product")] >= 1 and by_reason[("b.json", "malformed")] == 1 and by_reason[("b.json", "no product")] == 1
    assert sum(by_reason.values()) == 8
    checked.write_rejects(str(tmp_path / "out"))
    kept = spark.read.parquet(str(tmp_path / "out")).where("reason = 'malformed'")
    assert any(r["sample"].startswith('{"product": "p"') or "json" in r["sample"] or r["sample"].startswith(("[", '"')) for r in kept.collect())


@pytest.fixture
def files(spark, tmp_path):
    """Five files of 1,000 rows, two of them damaged, one without bytes, one without rows and one that is no Parquet."""
    folder = tmp_path / "in"
    spark.range(5000).select("id", F.md5(F.col("id").cast("string")).alias("x")).repartition(5).write.option("parquet.block.size", 4096).parquet(str(folder))
    names = sorted(glob.glob(f"{folder}/*.parquet"))
    cut = open(names[0], "rb").read()
    open(names[0], "wb").write(cut[:len(cut) // 2])
    data = bytearray(open(names[1], "rb").read())
    data[200:len(data) // 3] = b"\x07" * (len(data) // 3 - 200)
    open(names[1], "wb").write(data)
    spark.range(0).select("id", F.lit("a").alias("x")).coalesce(1).write.mode("append").parquet(str(folder))
    spark.createDataFrame([(None, None)] * 7, "id bigint, x string").coalesce(1).write.mode("append").parquet(str(folder))
    (folder / "zero.parquet").write_bytes(b"")
    (folder / "text.parquet").write_text("no parquet at all")
    for name in glob.glob(f"{folder}/.*.crc"):
        os.unlink(name)
    return str(folder), names


def test_damaged_files(spark, files):
    folder, names = files
    checked = R.checked_parquet(spark, folder, "id bigint, x string")
    rows = checked.rows.count()
    got = found(checked)
    reasons = {name: (reason, n) for name, reason, n in got}
    assert reasons[os.path.basename(names[0])] == ("unreadable file", None)
    reason, lost = reasons[os.path.basename(names[1])]
    assert reason == "unreadable rows" and 0 < lost <= 1000 and rows == 4000 - lost
    assert reasons["text.parquet"] == ("unreadable file", None) and "zero.parquet" not in reasons
    assert [n for _, reason, n in got if reason == "no field set"] == [7]
    assert len(got) == 4
    assert checked.counts.get == {"read": rows, "rejected": 7}
    total = {r["reason"]: (r["files"], r["records"]) for r in R.summary(checked.rejects).collect()}
    assert total == {"unreadable file": (2, None), "unreadable rows": (1, lost), "no field set": (1, 7)}


def test_sound_files_have_no_rejects(spark, tmp_path):
    spark.range(100).select("id").write.parquet(str(tmp_path / "ok"))
    checked = R.checked_parquet(spark, str(tmp_path / "ok"), "id bigint")
    assert checked.rows.count() == 100 and checked.rejects.isEmpty() and checked.counts.get == {"read": 100, "rejected": 0}
