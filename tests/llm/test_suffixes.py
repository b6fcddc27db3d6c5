"""Sorted suffixes, equal strings from both orders, ranges of sampled splitters, and texts longer than a part."""

import hashlib
import random

import numpy as np
import pytest

from affinia.llm import substring_dedup as S


@pytest.mark.parametrize("seed", range(5))
def test_multikey_sort_and_common_lengths(seed):
    rng = random.Random(seed)
    for _ in range(30):
        strings = [bytes(rng.choices(b"ab\0", k=rng.randrange(0, 30))) for _ in range(rng.randrange(1, 60))]
        words = S._words(strings)
        padded = [s.ljust(8 * words.shape[1], b"\0") for s in strings]
        order = S.multikey_sort(words)
        assert [padded[i] for i in order] == sorted(padded)
        common = S.common_lengths(words, order)
        for k in range(1, len(order)):
            a, b = padded[order[k - 1]], padded[order[k]]
            assert common[k] == next((i for i in range(len(a)) if a[i] != b[i]), len(a))


@pytest.mark.parametrize("seed", range(5))
def test_equal_windows_are_those_of_equal_bytes(seed):
    rng, length = random.Random(seed), 12
    for _ in range(60):
        content, at, size = [], [], []
        for _ in range(rng.randrange(1, 12)):
            p = rng.randrange(0, 6)
            n = rng.randrange(1, p + 2)
            text = bytearray(rng.choices(b"ab", k=n - 1 + length))
            text[p:p + 6] = b"ababba"
            content.append(bytes(text[:n - 1 + length]))
            at.append(p)
            size.append(n)
        got, want = {}, {}
        for row, window, kind in zip(*S.equal_windows(content, np.array(at), np.array(size), length)):
            got.setdefault(kind, set()).add((int(row), int(window)))
        for i, c in enumerate(content):
            for w in range(size[i]):
                want.setdefault((c[w:w + length], at[i] - w), set()).add((i, w))
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_splitters_cut_the_sample_evenly():
    rng = random.Random(1)
    leads = [bytes(rng.choices(b"abcd", k=S.LEAD)) for _ in range(5000)]
    cuts = S.splitters(leads, [1] * 5000, 64)
    assert cuts == sorted(set(cuts)) and len(cuts) == 63
    sizes = np.bincount([S.bisect_right(cuts, lead) for lead in leads], minlength=64)
    assert sizes.max() < 3 * 5000 / 64
    assert S.splitters([], [], 64) == [] and len(S.splitters([b"x"] * 100, [9] * 100, 64)) == 1


def removed(texts, length):
    """Bytes that an equal string of ``length`` bytes elsewhere covers, by a table of all strings."""
    seen = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - length + 1):
            seen.setdefault(t[k:k + length], []).append((i, k))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                gone[i][k:k + length] = True
    return [(int(g.sum()), hashlib.sha256(bytes(b for b, x in zip(t, g) if not x)).hexdigest()) for t, g in zip(texts, gone)]


@pytest.mark.parametrize("crowd", [1 << 13, 4])
def test_texts_over_several_parts(spark, monkeypatch, crowd):
    monkeypatch.setattr(S, "PART", 700)
    monkeypatch.setattr(S, "blocks", lambda offsets, limit=600: __import__("affinia.llm.tables", fromlist=["blocks"]).blocks(offsets, 600))
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(4000)]
    passage, long = " ".join(words[:60]), " ".join(words[100:900])
    texts = [long[:1500] + passage + long[1500:], passage, long[3000:] + passage[:250], "x" * 3000, "ab" * 900 + passage[100:], long[200:700] + "é" + long[600:900]]
    rows = [(i, t, "d") for i, t in enumerate(texts)] + [(90, None, "d"), (91, "", "d")]
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string, bytes string"), crowd=crowd).collect()
    want = removed([t.encode() for t in texts], S.LENGTH)
    assert {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in got if r["doc_id"] < 90} == dict(enumerate(want))
    assert all(r["n_bytes"] == r["n_removed"] == 0 for r in got if r["doc_id"] >= 90)
