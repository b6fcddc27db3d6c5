"""Likeness, containment and merges against exact shingle sets, by length of the text."""

import random

import numpy as np
import pytest

from affinia.llm import fingerprints as FP


def shingles(text):
    return {text[k:k + FP.SHINGLE] for k in range(len(text) - FP.SHINGLE + 1)}


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(n)).encode()


@pytest.mark.parametrize("n, most", [(30, 0.12), (300, 0.09), (3000, 0.04), (20000, 0.02)])
def test_mean_error_by_length(n, most):
    rng, errors = random.Random(n), {"likeness": [], "within": [], "merged": []}
    for share in (0.1, 0.3, 0.5, 0.8, 0.95):
        for _ in range(6 if n > 1000 else 30):
            base = words(rng, n)
            cut = int(len(base) * share)
            a, b, c = base, base[:cut] + words(rng, n)[:len(base) - cut], words(rng, n // 2) + base[cut:]
            sa, sb, sc = map(shingles, (a, b, c))
            fa, fb, fc = map(FP.sketch, (a, b, c))
            errors["likeness"].append(FP.likeness(fa, fb) - len(sa & sb) / len(sa | sb))
            errors["within"].append(FP.containment(fa, fb) - len(sa & sb) / len(sa))
            errors["merged"].append(FP.containment(fa, FP.merge(fb, fc)) - len(sa & (sb | sc)) / len(sa))
    for name, found in errors.items():
        assert np.abs(found).mean() < most, name
        assert abs(np.mean(found)) < most / 2, name  # no lean to either side


def test_a_small_text_within_a_very_large_one():
    rng = random.Random(1)
    large = words(rng, 40000)
    for n in (200, 1000):
        part = large[50000:50000 + 6 * n]
        other = words(rng, n)
        assert FP.containment(FP.sketch(part), FP.sketch(large)) > 0.9
        assert FP.containment(FP.sketch(other), FP.sketch(large)) < 0.1


def test_merges_are_the_fingerprints_of_the_union():
    rng = random.Random(2)
    for n, m in ((5, 8), (40, 900), (4000, 700)):
        a, b = words(rng, n), words(rng, m)
        fa, fb = FP.sketch(a), FP.sketch(b)
        both = FP.merge(fa, fb)
        assert (both == FP.merge(fb, fa)).all() and FP.containment(fa, both) == FP.containment(fb, both) == 1
        exact = len(shingles(a) & (shingles(a) | shingles(b))) / len(shingles(a))
        assert exact == 1


def test_columns(spark):
    rows = [(1, "a text of some length that is followed by another " * 5), (2, "another text, of its own, which is last " * 5), (3, ""), (4, None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, fingerprint string")
    got = {r["doc_id"]: r for r in FP.fingerprints(frame).collect()}
    for r in got.values():
        own, other, after = (FP.from_text(x) for x in (r["fingerprint"], r["edited_fingerprint"], got[r["doc_id"] % 4 + 1]["fingerprint"]))
        assert r["within_edited"] == FP.containment(own, other) and r["within_next"] == FP.containment(own, after)
        assert r["within_both"] == FP.containment(own, FP.merge(other, after))
        assert r["within_both"] >= r["within_next"] - 1e-9
