"""The filter audit and the ranked search against plain loops, and on odd rows."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import ahocorasick  # noqa: F401  (the search needs it)
import numpy as np
import pytest

from affinia.llm import filter_audit, lexical_search
from affinia.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain_audit(docs, labels):
    """Every order walked document by document."""
    good, toxic = ({d for d, *marks in labels if marks[at] == 1 and d is not None} for at in (0, 1))
    rows = [(d, t or "", s or "") for d, t, s in docs]
    fails = []
    for d, t, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = ""
        own += "A" * (len(words) < 200)
        own += "B" * (100 * len(set(words)) < 50 * len(words))
        own += "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        own += "D" * bool(re.search("[#$%&*|]", t))
        own += "E" * (d is not None and any(o is not None and o < d and u == t for o, u, _ in rows))
        fails.append(own)
    out = defaultdict(lambda: [0] * 6)
    for order in map("".join, itertools.permutations("ABCDE")):
        for (d, _, part), failed in zip(rows, fails):
            gone = False
            for step, letter in enumerate(order, 1):
                cell, hit = out[part, order, step], letter in failed
                cell[3] += failed == letter
                if gone:
                    cell[2] += hit
                elif hit:
                    cell[1] += 1
                    cell[4] += d in good
                    cell[5] += d in toxic
                    gone = True
                else:
                    cell[0] += 1
    shares = Counter()
    for (part, order, step), cell in out.items():
        shares[part, order[step - 1]] += cell[1]
    return {(p, o, s, *c, shares[p, o[s - 1]]) for (p, o, s), c in out.items()}


def audit_rows(spark, docs, labels):
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id bigint, text string, source string, part string, n bigint")
    marks = spark.createDataFrame([(*r, "y") for r in labels], "doc_id bigint, quality int, toxic int, digest string")
    return filter_audit.audit(frame, marks)


def test_audit_matches_a_walk_of_every_order(spark):
    rng = random.Random(12)
    texts = ["", None, "One Two", "a # b", "word " * 300, "#" * 9, " ".join(f"w{i}" for i in range(400)), "Up " * 250,
             " ".join(f"W{i}|" for i in range(210)), "é   ß " * 80, "\t\n\x0b x"]
    docs = [(i, rng.choice(texts), rng.choice(["s", "t", None, ""])) for i in rng.sample(range(500), 160)]
    docs += [(7001, "copy", "s"), (7001, "copy", "s"), (7001, "copy", "t"), (7002, "copy", "t"), (None, "copy", "s"), (None, "copy", "s")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, *_ in docs if rng.random() < 0.6] + [(None, 1, 1)]
    got = audit_rows(spark, docs, labels).collect()
    names = ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    assert {tuple(r[c] for c in names) for r in got} == plain_audit(docs, labels)
    assert len(got) == 600 * len({s or "" for *_, s in docs})


def test_audit_of_an_empty_table_and_of_one_long_text(spark):
    assert audit_rows(spark, [], []).count() == 0
    got = audit_rows(spark, [(1, "lorem ipsum " * 200000, "s")], [(1, 1, 0), (1, 0, 1)]).where("filter_order = 'BACDE'").collect()
    first = next(r for r in got if r["step"] == 1)
    assert (first["removed"], first["unique_fails"], first["good_lost"], first["toxic_lost"], first["shapley"]) == (1, 1, 1, 1, 120)


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    of = defaultdict(set)
    for i, t in items:
        of[i].update(plain_terms(t))
    out = set()
    for i, terms in of.items():
        scored = []
        for d, c in counted:
            m = 100 - 90 + (90 * c.total() * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out |= {(i, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)}
    return out


def searched(spark, docs, items, **options):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, term string, n int")
    wanted = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, doc_id string")
    got = lexical_search.search(frame, wanted, **options).collect()
    assert len(got) == len({(r["item_id"], r["rank"]) for r in got})
    return {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(13)
    vocabulary = ["The", "straße", "x", "ab", "abc", "b", "c", "日本", "it's", "a-b", "q1", "Q1", "ÀB", "é", "~"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", ".", "\n", "_", "'", " "]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 40))) for i in rng.sample(range(900), 300)]
    docs += [(1000 + i, docs[0][1]) for i in range(25)] + [(None, docs[3][1]), (None, None), (5, docs[1][1]), (2000, ""), (2001, "?!")]
    items = [(i, text(rng.randrange(1, 6))) for i in range(30)] + [(4, "日本 x"), (None, "ab c"), (50, ""), (51, None), (52, "nowhere")]
    return docs, items


@pytest.mark.parametrize("group_bytes", [1 << 24, 300])
def test_search_matches_plain_loops(spark, corpus, group_bytes):
    docs, items = corpus
    assert searched(spark, docs, items, k=10, group_bytes=group_bytes) == plain_search(docs, items, 10)


def test_search_of_empty_tables_and_of_one_long_text(spark, corpus):
    docs, items = corpus
    assert searched(spark, [], items) == set() == searched(spark, docs, [])
    long = [(1, "ab " * 900000 + "c" * 3000000), (2, "zz"), (3, "zz"), (4, "zz"), (5, "ab")]
    assert searched(spark, long, [(1, "ab c")]) == plain_search(long, [(1, "ab c")], 10)


def test_pieces_end_at_guards():
    seen = np.frombuffer(b" " + b"abc de  fghijklmnop q " * 40, np.uint8)
    whole = list(lexical_search.pieces(seen, 7))
    assert all(p[0] == p[-1] == " " for p, _ in whole) and "".join(p[1:] for p, _ in whole) == seen.tobytes().decode()[1:]
    assert all(seen[at:at + len(p)].tobytes().decode() == p for p, at in whole)


@pytest.mark.parametrize("name", ["op12_filter_interaction_audit", "op13_ranked_lexical_search"])
def test_registered_queries_match_their_twins(spark, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "labels", "benchmark"):
        db.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    got = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(result.fetchall())
