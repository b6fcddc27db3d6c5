"""Corpus operators against plain models, and on nulls, empty texts, repeats and empty tables."""

import glob
import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from affinia.llm import (
    decontaminate, fingerprints, html_text, line_dedup, near_dedup, packing, quality, secrets, substring_dedup, toxicity,
)
from affinia.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, component string, spans string"


def frame(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", "y") for i, t in texts], schema)


def odd_texts():
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b c d e f " * 9000), (6, "same words here again " * 30),
            (6, "same words here again " * 30), (7, "same words here again " * 30), (None, "no id " * 60), (None, None)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, n):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def copies(seed, groups=8, each=12):
    rng, out = random.Random(seed), []
    for g in range(groups):
        base = [rng.choice("abcdefghijk") + str(rng.randrange(40)) for _ in range(rng.randrange(3, 90))]
        for _ in range(each):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(own) // 12)):
                own[rng.randrange(len(own))] = "x" + str(rng.randrange(10**6))
            out.append((len(out) * 7 % 1009, " ".join(own).title()))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_match_all_pairs(spark, size):
    docs = copies(size)
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(frame(spark, docs), shingle=size).collect()}
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {
        i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates_of_odd_rows(spark):
    got = near_dedup.near_duplicates(frame(spark, odd_texts())).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=repr) == sorted(
        [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True), (6, 6, True), (7, 6, False),
         (None, None, True), (None, None, True)], key=repr)
    left = near_dedup.drop_near_duplicates(frame(spark, odd_texts()))
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted([1, 2, 3, 4, 5, 6, None, None], key=repr)
    assert near_dedup.near_duplicates(frame(spark, [])).collect() == []


def test_likelihood_follows_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sketch = near_dedup.registers([base[:2000], base[500:2500], base[:1500], base])
    assert near_dedup.likely_similarity(sketch[:1], sketch[1:2], np.array([2000.0]), np.array([2000.0]))[0] == pytest.approx(0.6, abs=0.12)
    assert (near_dedup.merge(sketch[2], near_dedup.registers([base[1500:]])[0]) == sketch[3]).all()


def test_lines(spark):
    rng = random.Random(3)
    free = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(5))
    docs = [(i, f"start {free()}\nPosted by user{i} in 20{i:02d} on this site\n{free()}") for i in range(8)]
    docs += [(100 + i, "copied first line of it\ncopied second line of it\nthird") for i in range(9)]
    got = {r["doc_id"]: r for r in line_dedup.drop_recurring_lines(frame(spark, docs)).collect()}
    assert all("Posted by" not in got[i]["text"] and got[i]["text"].startswith("start") and got[i]["n_dropped"] == 1 for i in range(8))
    assert all(got[100 + i]["n_dropped"] == 0 for i in range(9))
    odd = line_dedup.drop_recurring_lines(frame(spark, odd_texts())).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in odd), key=repr) == sorted(odd_texts(), key=repr)
    assert line_dedup.drop_recurring_lines(frame(spark, [])).collect() == []


def test_fingerprints(spark):
    docs = [(i * 3, "é" * (i % 5) + " ".join(f"w{(i * k) % 97}" for k in range(i * 4))) for i in range(40)] + [(500, None), (501, "")]
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(frame(spark, docs)).collect()}
    ordered = [(i, t or "") for i, t in sorted(docs)]
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == fingerprints.to_text(fingerprints.sketch(text.encode()))
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if not cut:
            assert r["near_edited"] == 1
    rng = np.random.default_rng(0)
    long, other = (bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (60000, 60000))
    a, b, both = (fingerprints.sketch(x) for x in (long[:20000], other, long))
    assert fingerprints.containment(a, both) == pytest.approx(1, abs=0.02) and fingerprints.likeness(a, b) < 0.01
    assert len(fingerprints.merge(a, b)) == len(np.union1d(a, b))
    assert len(fingerprints.fingerprints(frame(spark, odd_texts())).collect()) == len(odd_texts())
    assert fingerprints.fingerprints(frame(spark, [])).collect() == []


@pytest.mark.parametrize("parts", [1, 7])
def test_fingerprints_follow_across_ranges(spark, parts):
    """Rows without an id come first in a fixed order, repeated ids by text, and the last one meets the first."""
    docs = [(None, f"none {i} " * 5) for i in range(6)] + [(i // 2 * 10**15, f"text {i} " * 8) for i in range(30)]
    got = fingerprints.fingerprints(frame(spark, docs).repartition(parts)).collect()
    assert len(got) == len(docs)
    named = sorted((d for d in docs if d[0] is not None))
    want = {(text, after) for (_, text), (_, after) in zip(named, named[1:])}
    sha = lambda text, after: hashlib.sha256((text[:len(text) - len(text) // 4] + after[:len(text) // 4]).encode()).hexdigest()
    found = {r["edited_sha256"] for r in got}
    assert {sha(*w) for w in want} <= found
    first = [t for i, t in docs if i is None]
    assert any(sha(named[-1][1], t) in found for t in first) and any(sha(t, named[0][1]) in found for t in first)


def test_odd_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(200):
        items = rng.integers(0, 2**63, int(rng.integers(1, 3000))).astype(np.uint64)
        a, b = np.unique(items[rng.random(len(items)) < 0.9]), np.unique(items[rng.random(len(items)) < 0.9])
        differ = sum(int(x).bit_count() for x in (near_dedup.odd_sketch(a) ^ near_dedup.odd_sketch(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b))


def test_toxicity(spark):
    rng = random.Random(1)
    plain = ["tree", "house", "river", "walk", "stone", "green", "light", "paper"]
    docs, labels = [], []
    for i in range(900):
        said = [rng.choice(plain) + rng.choice(["", "s", "ing"]) for _ in range(rng.randrange(5, 120))]
        if i % 3 == 0:
            for _ in range(2):
                said.insert(rng.randrange(len(said)), "vile" + rng.choice(["ton", "mus", "rik", "lan"]))
        docs.append((i, " ".join(said)))
        labels.append((i, int(i % 3 == 0)))
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = toxicity.toxicity_scores(frame(spark, docs + [(2000, None), (2001, ""), (None, "tree")]), known).collect()
    held = [(r["predicted"], int(r["doc_id"] % 3 == 0)) for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (2000, 2001))
    one = toxicity.toxicity_scores(frame(spark, odd_texts()), known.where("toxic = 0")).collect()
    assert len(one) == len(odd_texts()) and not any(r["predicted"] for r in one)


def test_toxicity_scores_the_window_at_every_word():
    rng = random.Random(6)
    said = lambda n: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 5) for _ in range(n))
    texts = [said(n) for n in (0, 1, 5, 23, 24, 25, 39, 40, 41, 300, 5000, 0)]
    net = toxicity.Network()
    net.scale = np.array([0.1, 0.0])
    score = lambda some: net.scores(*toxicity.utf8(toxicity.pa.array(some, toxicity.pa.string())))
    for text, got in zip(texts, score(texts)):
        own = text.split()
        windows = [" ".join(own[i:i + toxicity.WINDOW]) for i in range(max(1, len(own) - toxicity.WINDOW + 1))]
        assert got == pytest.approx(max(score(windows)), abs=1e-5)
        words = toxicity.Words(*toxicity.utf8(toxicity.pa.array(windows, toxicity.pa.string())))
        plain = net.forward(net.inputs(words), words.windows()[0])
        assert got == pytest.approx(toxicity._sigmoid(plain.max() * 0.1), abs=1e-5)


PAGE = """<html><body class="x"><header><h1>Site</h1></header><div id="nav-menu"><ul><li><a href=/>Home</a><li><a>B</a></ul></div>
<div class="cookie-notice">We use</div><script>var t="</p>";</script><div class="layout"><div class="sidebar">s<p>foo</p></div>
<div class="post-%d content"><h2>Title &amp; more</h2><p>Some <b>te</b>xt  here,\nlong enough to be it.<p>Second &lt;para&gt; of the text
<form>Mail<input></form><ul><li>one<li>two</ul></div><section id="comments"><p>Nice!</p></section></div><footer>x</footer></body></html>"""


def test_html(spark):
    want = "Title & more Some text here, long enough to be it. Second <para> of the text one two"
    rows = [(i, "http://a.example/x", PAGE % i) for i in range(5)] + [(8, None, None), (9, "u", ""), (None, "http://b.example", "<p>only</p>")]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {**{i: want for i in range(5)}, 8: "", 9: "", None: "only"}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.main_texts(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []
    for page_id, html in duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall():
        inner = re.sub(r"</?[bi]>", "", re.search(r"<article>(.*)</article>", html, re.S)[1])
        from html import unescape
        blocks = html_text.page_blocks(html)
        assert html_text.read_below(blocks, html_text.best_path(blocks)) == " ".join(unescape(re.sub(r"<[^>]*>", " ", inner)).split())


def test_html_keeps_the_whole_article(spark):
    long = "The body of the text goes on for long. " * 20
    body = f"<div class=content><p>{long}</p></div>"
    nav = "<nav><a href=/>Home</a></nav>"
    whole = f"<html><body>{nav}<article><h1>Title</h1><p>A lead.</p>{body}<p>An end.</p></article><p>Stray.</p></body></html>"
    linked = f"<html><body>{nav}<article><h1><a href=/t>Title</a></h1>{body}</article></body></html>"
    short = f"<html><body>{nav}<article>{body}</article></body></html>"
    parts = f"<html><body>{nav}<div class=a><p>{long}</p></div><div class=b><p>The rest of it.</p></div></body></html>"
    table = f"<html><body>{nav}<article><p>Before.</p><table><tr><td>{long}</td></tr></table><p>After.</p></article></body></html>"
    pages = [(1, "whole", whole), (2, "linked", linked), (3, "parts", parts), (4, "table", table)]
    # On this host most pages have a smaller container than the last one needs.
    pages += [(10 + i, "mixed", short) for i in range(5)] + [(20, "mixed", whole)]
    rows = [(i, f"http://{host}.example/", html) for i, host, html in pages]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    long = long.strip()
    want = {1: f"Title A lead. {long} An end.", 2: f"Title {long}", 3: f"{long} The rest of it.", 4: f"Before. {long} After."}
    assert {r["page_id"]: r["text"] for r in got} == {**want, **{10 + i: long for i in range(5)}, 20: want[1]}


def test_leaks(spark):
    item = "the quick brown fox jumps over a lazy dog while seven wizards box in the old grey barn".split()
    other = [*item[:6], "changed", *item[7:]]
    docs = [(1, "before it " + " ".join(item).upper() + " after"), (2, "x, " + "! ".join(other)), (3, " ".join(item[:7])), (4, " ".join(item[::-1])), *odd_texts()[1:]]
    tests = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (None, "x")], "item_id bigint, text string")
    got = decontaminate.leaks(frame(spark, [*docs, (1, docs[0][1])]), tests).collect()
    assert sorted((r["doc_id"], r["item_id"], r["matched"], r["best"]) for r in got) == [(1, 1, 18, 13), (2, 1, 17, 12)]
    assert decontaminate.leaks(frame(spark, []), tests).collect() == []
    assert decontaminate.leaks(frame(spark, docs), tests.limit(0)).collect() == []


def test_leaks_with_any_two_words_changed(spark):
    """All 78 ways to change 2 of 13 words, at odd and even places."""
    item = [f"w{k}" for k in range(13)]
    docs = []
    for a in range(13):
        for b in range(a):
            for lead in (4, 5):
                changed = ["other" if k in (a, b) else w for k, w in enumerate(item)]
                docs.append((len(docs), " ".join(["lead"] * lead + changed + ["tail"] * 3)))
    tests = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    got = decontaminate.leaks(frame(spark, docs), tests).collect()
    assert sorted((r["doc_id"], r["matched"], r["best"]) for r in got) == [(i, 11, 11) for i in range(2 * 78)]


def test_quality(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["and", "the", "word", "other", "text"]) + ("!!" if i % 4 == 0 else "") for _ in range(60))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 400, 2)], "doc_id bigint, quality int")
    got = quality.quality_scores(frame(spark, docs + odd_texts()[:4]), labels).collect()
    assert all(r["kept"] == (r["doc_id"] % 4 != 0) for r in got[:400] if r["doc_id"] > 8)
    assert len(quality.drop_low_quality(frame(spark, docs), labels).collect()) == 300
    assert all(r["kept"] for r in quality.quality_scores(frame(spark, odd_texts()), labels.limit(0)).collect())
    assert quality.quality_scores(frame(spark, []), labels).collect() == []


def repeats(docs):
    seen, out = defaultdict(int), []
    data = [(i, (t or "").encode()) for i, t in docs]
    for _, b in data:
        for p in range(len(b) - 199):
            seen[b[p:p + 200]] += 1
    for i, b in data:
        covered = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                covered[p:p + 200] = True
        spans = int((covered[1:] & ~covered[:-1]).sum() + covered[0])
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out.append((i, len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowd", [8192, 5])
def test_repeated_bytes(spark, crowd):
    rng = random.Random(4)
    text = ["".join(rng.choice("abcdé ") for _ in range(700)) for _ in range(12)]
    docs = [(i, text[i % 12][:150 + 9 * i] + str(i) + text[(i + 3) % 12][i:]) for i in range(40)]
    docs += [(90, "a" * 1500), (91, "ab" * 300), (92, "x" * 199), (93, "y" * 200), (93, "y" * 200), (94, None), (95, ""), (None, text[0])]
    got = substring_dedup.remove_repeats(frame(spark, docs), crowd=crowd).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=repr) == repeats(docs)


def test_no_repeated_bytes_in_an_empty_table(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).collect() == []


def test_secrets(spark):
    rng = random.Random(5)
    tokens = ["".join(rng.choice("0123456789abcdef") for _ in range(20)) for _ in range(200)]
    docs = [(i, f'é PassWord: "{t}" and {"wordlike" * 3} x') for i, t in enumerate(tokens)]
    docs += [(900, f"bare {tokens[0][::-1]} here"), (901, "AKIA" + "Z9" * 8 + " " + "ab12" * 6), (902, "token=abc"), *odd_texts()]
    got = secrets.scan(frame(spark, docs)).collect()
    rows = {r["doc_id"]: r for r in got}
    assert rows[0]["spans"] == "assign:2:33" and rows[0]["n_assign"] == 1
    assert rows[900]["n_assign"] + rows[900]["n_hex"] == 0 and rows[900]["spans"] == "format:5:25"
    assert (rows[901]["n_access"], rows[901]["n_hex"]) == (1, 1)
    assert rows[902]["spans"] == "" and rows[902]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert len(got) == len(docs) and secrets.scan(frame(spark, [])).collect() == []


def test_packing_plan():
    rng = np.random.default_rng(0)
    for lengths in (rng.integers(1, 2049, 3000), rng.integers(600, 1100, 2000), rng.integers(1, 9, 5000), np.zeros(0, int)):
        counts = np.bincount(lengths, minlength=2049)
        used, places = np.zeros(2049, int), defaultdict(list)
        for length, low, high, first, offset in packing.plan_runs(counts).tolist():
            assert low == used[length]
            used[length] = high
            for k in range(high - low):
                places[first + k].append((offset, length))
        assert (used == counts).all()
        for own in places.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 2048


def test_packing(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["", None, "a", "  a  b \n c", "x \n\ny", "é b c", "a　 b", "don't we'll  I'm", "a\0b c", "<|endoftext|> hi", "x\x1c y z",
             "a<|endoftext|>b <|endoftext|><|endoftext|>  c <|endoftext |>", "<|endoftext|>", " <|endoftext|> " * 900,
             "word " * 5000, *[t for (t,) in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]]
    got = packing.pack(frame(spark, list(enumerate(texts)))).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    for i, text in enumerate(texts):
        ids, at = [*own.encode(text or "", add_special_tokens=False).ids, 0], 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            part = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(part)) and r["length"] <= 2048
            assert k == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(ids)
    assert packing.pack(frame(spark, [])).collect() == []


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    result = db.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(result.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in got}
    assert ids and ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    stage = docs
    for _, function in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in stage.select("doc_id").collect()}
        stage = function(spark, stage, SF).cache()
        assert stage.columns == docs.columns and {r["doc_id"] for r in stage.select("doc_id").collect()} <= before
    assert {r["doc_id"] for r in stage.select("doc_id").collect()} == ids
