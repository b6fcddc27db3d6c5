"""Readers on files written here."""

import json

from conftest import rows
from pyspark.sql import functions as F

from affinia.operators import filters as FL
from affinia.sources import io

XML = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/">
  <siteinfo><sitename>W</sitename></siteinfo>
  <page><title>One</title><ns>0</ns><id>1</id>
    <revision><id>11</id><timestamp>2022-06-01T00:00:00Z</timestamp><contributor><username>u</username><id>5</id></contributor>
    <minor /><text bytes="8" xml:space="preserve">[[Two]] x</text></revision></page>
  <page><title>Moved</title><ns>0</ns><id>2</id><redirect title="One" />
    <revision><id>12</id><contributor><ip>1.2.3.4</ip></contributor><text bytes="1">y</text></revision></page>
</mediawiki>"""


def test_pages_xml(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(XML)
    got = {r["id"]: r for r in io.read_pages_xml(spark, str(tmp_path / "dump.xml")).collect()}
    assert got[1]["title"] == "One" and got[1]["redirect_title"] is None and got[2]["redirect_title"] == "One"
    first = got[1]["revision"][0]
    assert first["text"] == "[[Two]] x" and first["contributor"]["username"] == "u" and first["contributor"]["ip"] is None
    assert got[2]["revision"][0]["contributor"]["ip"] == "1.2.3.4"


def test_typed_records_skip_broken_files(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_typed(spark.createDataFrame([("a", None, 1, 1, 0)], "token string, url string, frequency bigint, doc_frequency bigint, index bigint"), path, 1)
    (tmp_path / "t" / "broken.parquet").write_bytes(b"not a parquet file")
    assert io.read_typed(spark, path, "token_stat").count() == 1


def test_playlist_files(spark, tmp_path):
    for n in (0, 1):
        tracks = [{"track_uri": f"t{n}{i}", "artist_uri": "a", "album_uri": "b", "more": 1} for i in range(3)]
        (tmp_path / f"slice{n}.json").write_text(json.dumps({"info": {}, "playlists": [{"num_tracks": 3, "tracks": tracks}, {"num_tracks": 9, "tracks": []}]}, indent=1))
    got = io.read_playlists(spark, str(tmp_path / "*.json"))
    assert rows(got, "pl", "pos", "track_uri", "num_tracks") == sorted((0, i, f"t{n}{i}", 3) for n in (0, 1) for i in range(3))
    assert got.select("file").distinct().count() == 2
    assert FL.min_playlist_length(got, 4).isEmpty()


def test_json_lines_drop_broken_rows(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"product": "p", "scene": "s", "bbox": [0.1, 0.2, 0.3, 0.4]}\nnot json\n')
    assert rows(io.read_scene_product(spark, str(tmp_path / "p.json")), "product", "scene") == [("p", "s")]


def test_key_value_object(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"k1": [0.5, 1.0], "k2": [2.0]}))
    got = io.read_key_value(spark, str(tmp_path / "c.json"), "array<double>", "object")
    assert {r["key"]: r["value"] for r in got.collect()} == {"k1": [0.5, 1.0], "k2": [2.0]}


def test_stopwords_and_valid_files(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\n,\nthe\n\nof")
    (tmp_path / "empty.txt").write_text("")
    assert rows(io.read_stopwords(spark, str(tmp_path / "stop.txt"))) == [(",",), ("of",), ("the",)]
    files = io.list_valid_files(spark, str(tmp_path))
    assert [r["path"].rsplit("/", 1)[1] for r in files.collect()] == ["stop.txt"]


def test_example_slices_prune_folders(spark, tmp_path):
    path = str(tmp_path / "ex")
    df = spark.range(20).select((F.col("id") % 10).alias("slice"), F.array("id").alias("track_context"))
    io.write_examples(df, path)
    got = io.read_examples(spark, path, "^9$")
    assert got.count() == 2
    assert "PartitionFilters: [" in got._jdf.queryExecution().executedPlan().toString()


def test_snapshots(spark):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00", "a"), (1, "2024-01-02 23:59:59", "b"), (1, "2024-01-03 00:00:00", "c")],
                               "k bigint, t string, v string").withColumn("ts", F.to_timestamp("t")).drop("t")
    assert rows(io.snapshot_as_of(df, ["k"], "ts", "2024-01-02"), "v") == [("b",)]
    assert rows(io.snapshot_delta(df, "ts", "2024-01-02"), "v") == [("b",)]
