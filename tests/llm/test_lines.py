"""Line templates are counted by documents."""

import random
import time

from affinia.llm import line_dedup

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, template string, text_id string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", "y") for i, t in texts], DOCS)


def body(rng, n=3):
    return "\n".join(" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(9)) for _ in range(n))


FOOTER = "All rights reserved by us\nImprint and contact\nFollow us on 3 networks\nBack to top"


def dropped(spark, docs):
    return [(r["doc_id"], r["n_dropped"], r["text"]) for r in line_dedup.drop_recurring_lines(frame(spark, docs)).collect()]


def test_a_footer_of_four_lines_goes_whole(spark):
    rng = random.Random(1)
    bodies = {i: body(rng) for i in range(30)}
    got = dropped(spark, [(i, f"{b}\n{FOOTER}") for i, b in bodies.items()])
    assert all(n == 4 and text == bodies[i] for i, n, text in got)


def test_copies_of_one_text_switch_nothing_off(spark):
    rng = random.Random(2)
    bodies = {i: body(rng) for i in range(30)}
    copied = f"{bodies[0]}\n{FOOTER}"
    docs = [(i, f"{b}\n{FOOTER}") for i, b in bodies.items()] + [(100 + i, copied) for i in range(60)] + [(None, copied), (0, copied)]
    got = dropped(spark, docs)
    assert len(got) == len(docs) and all(n == 4 for _, n, _ in got)


def test_near_copies_keep_their_lines_but_not_the_footer(spark):
    rng = random.Random(3)
    base = body(rng, 20).split("\n")
    near = []
    for i in range(40):
        own = list(base)
        own[rng.randrange(20)] = body(rng, 1)
        near.append((i, "\n".join(own)))
    others = [(100 + i, f"{body(rng)}\n{FOOTER}") for i in range(8)]
    mixed = [(200 + i, t + "\n" + FOOTER) for i, t in near[:10]]
    got = {i: (n, text) for i, n, text in dropped(spark, near + others + mixed)}
    assert all(got[i] == (0, t) for i, t in near)
    assert all(got[200 + i] == (4, t) for i, t in near[:10])
    assert all(got[i][0] == 4 for i, _ in others)


def test_four_documents_are_too_few(spark):
    rng = random.Random(4)
    docs = [(i, f"{body(rng)}\n{FOOTER}") for i in range(4)] + [(10 + i, f"{body(rng)}\n{FOOTER}") for i in range(0)]
    assert all(n == 0 for _, n, _ in dropped(spark, docs + docs))


def test_very_long_lines_and_many_lines(spark):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(9999)}x" if k % 3 else "same" for k in range(20000))
    docs = [(i, f"{body(rng)}\n{long}\n{body(rng)}") for i in range(6)]
    many = "\n".join(["the same line again"] * 30000)
    started = time.time()
    got = {i: n for i, n, _ in dropped(spark, docs + [(50, f"{many}\n{body(rng)}")] + [(60 + i, f"the same line again\n{body(rng)}") for i in range(6)])}
    assert time.time() - started < 120
    assert all(got[i] == 1 for i in range(6)) and got[50] == 30000 and all(got[60 + i] == 1 for i in range(6))
