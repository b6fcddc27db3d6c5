"""Tokens, links, buckets, dictionaries and co-occurrence against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from affinia.functions import text
from affinia.operators import cooccurrence as C
from affinia.operators import dictionary as D
from affinia.operators import documents as O

SEPARATORS = set(" !@#$%^&*()_+\t\n\",.:;/?><|{}'[]")


def model_tokens(s):
    out, word = [], ""
    for ch in s + " ":
        if ch in SEPARATORS:
            if word:
                out.append(word.lower())
            word = ""
        else:
            word += ch
    return out


@pytest.mark.parametrize("s", [
    "a\\b c-d=e~f`g", "50% A_B\r\nend", "", "   ", "x[y]{z}'q'\"w\"", "Éa ç.ü", "tab\tnew\nline", "a/b?c>d<e|f",
])
def test_simple_tokenize(spark, s):
    got = spark.createDataFrame([(s,)], "s string").select(text.simple_tokenize(F.col("s"))).first()[0]
    assert got == model_tokens(s)


def test_links(spark):
    cases = {
        "[[File:x|caption [[Inner]] end]]": [],
        "[[Foo (bar)|foo]] [[User:me]] [[Category:C]] [[A#b]] [[]]": ["", "A#b", "Category:C", "Foo (bar)"],
        "[[A]] [[A|again]]": ["A"], "no links": [],
    }
    for s, expected in cases.items():
        got = spark.createDataFrame([(s,)], "s string").select(text.extract_links(F.col("s"), text.RESERVED)).first()[0]
        assert sorted(got) == expected
    twice = spark.createDataFrame([("[[A]] [[A|again]] [[User:me]]",)], "s string")
    assert twice.select(text.extract_links(F.col("s"), None, False)).first()[0] == ["A", "A", "User:me"]


def test_quote_markup_is_removed(spark):
    got = spark.createDataFrame([("'''Bold''' it's {{x}} a=b",)], "s string").select(text.clean_tokenize(F.col("s"))).first()[0]
    assert got == ["bold", "it's", "x", "a", "b"]


def test_url(spark):
    got = spark.createDataFrame([("A b/é (c)",)], "s string").select(text.title_to_url(F.col("s"))).first()[0]
    assert got == text.URL_PREFIX + "A_b/%C3%A9_(c)"


def model_bucket(token):
    raw = token.encode()
    if len(token) <= 4:
        return zlib.crc32(raw) & 0xFFFF
    return min(zlib.crc32(raw[i:i + 4]) & 0xFFFF for i in range(min(10, len(token)) - 4))


def test_minhash(spark):
    words = ["a", "abcd", "abcde", "abcdefghijklmnop", "straße", "élève", "日本語テキスト", "ü", "", "ab"]
    expected = {"a": 48707, "abcd": 52497, "abcde": 52497, "abcdefghijklmnop": 31669, "straße": 23128, "élève": 20410,
                "日本語テキスト": 4751, "ü": 27093}
    df = spark.createDataFrame([(w,) for w in words], "t string")
    got = dict(df.select("t", text.minhash_bucket(F.col("t"))).collect())
    assert got == {w: model_bucket(w) for w in words}
    assert all(got[w] == b for w, b in expected.items())


def test_pad_or_truncate(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],)], "a array<bigint>")
    assert [r[0] for r in df.select(text.pad_or_truncate(F.col("a"), 2)).collect()] == [[1, 2], [0, 0]]


def test_articles(spark):
    from affinia.schemas import PAGE

    rev = [{"text": "x"}]
    pages = spark.createDataFrame([
        ("Ok", 0, 1, None, rev), ("", 0, 2, None, rev), (None, 0, 3, None, rev), ("Moved", 0, 4, "Ok", rev),
        ("Empty", 0, 5, None, []), ("None", 0, 6, None, None), ("User:me", 0, 7, None, rev), ("Talk:x", 0, 8, "", rev),
    ], PAGE)
    assert rows(O.keep_article(pages), "id") == [(1,), (8,)]
    assert rows(O.keep_article(pages, None), "id") == [(1,), (7,), (8,)]


DOCS = [
    (0, "the cat sat on the mat the end".split()), (1, "the dog and the cat".split()), (2, []), (3, "x x x".split()),
    (4, ("a b c d e f g h i j k l m n o p q r s t u v w x y z " * 60).split()),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, tokens array<string>")


def model_dictionary(least):
    f, d = Counter(), Counter()
    for _, tokens in DOCS:
        f.update(tokens)
        d.update(set(tokens))
    order = sorted((t for t in f if f[t] >= least), key=lambda t: (-f[t], t))
    return {t: i for i, t in enumerate(order)}, f, d


def test_dictionary(spark, docs):
    index, f, d = model_dictionary(2)
    got = {r["token"]: (r["index"], r["frequency"], r["doc_frequency"]) for r in D.token_dictionary(docs, 2).collect()}
    assert got == {t: (i, f[t], d[t]) for t, i in index.items()}
    assert sorted(v[0] for v in got.values()) == list(range(len(got)))
    assert {r["index"] for r in D.token_dictionary(docs, 2, cap=3).collect()} == {0, 1, 2}


def model_embedding(index, token):
    return 1 + index[token] if token in index else 1 + len(index) + model_bucket(token)


def model_cooccurrence(index, window):
    total = defaultdict(float)
    for _, tokens in DOCS:
        ids = [model_embedding(index, t) for t in tokens]
        for i in range(len(ids)):
            for j in range(max(0, i - window), min(len(ids), i + window)):
                if ids[i] > ids[j]:
                    total[ids[i], ids[j]] += 1 / abs(i - j)
    return total


@pytest.mark.parametrize("window,fragment", [(10, 1024), (10, 16), (3, 7), (1, 1024)])
def test_cooccurrence(spark, docs, window, fragment):
    """Whole documents, also where they are cut into small overlapping fragments."""
    index, _, _ = model_dictionary(2)
    d = D.token_dictionary(docs, 2)
    got = {(r["i"], r["j"]): r["x"] for r in C.token_cooccurrence(docs, d, window, fragment=fragment).collect()}
    expected = model_cooccurrence(index, window)
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_window_edge(spark):
    """At distance exactly the window only the pair with the larger later index counts."""
    for order, count in ((("b", "a"), 0), (("a", "b"), 1)):
        tokens = [order[0]] + ["f"] * 9 + [order[1]]
        df = spark.createDataFrame([(0, tokens)], "doc_id bigint, tokens array<string>")
        d = spark.createDataFrame([("f", 0), ("a", 1), ("b", 2)], "token string, index bigint")
        got = C.token_cooccurrence(df, d).where((F.col("i") == 3) & (F.col("j") == 2)).count()
        assert got == count


def test_sparse_documents(spark):
    docs = spark.createDataFrame([
        ("u1", "A", ["B", "X", "B"], ["p", "q", "zzzzz"]), ("u2", "B", ["X"], ["p"]), ("u3", "Q", ["A"], ["p"]), ("u4", "A", ["B"], []),
    ], "url string, primary string, secondary array<string>, tokens array<string>")
    titles = spark.createDataFrame([("A", 0), ("B", 1)], "token string, index bigint")
    tokens = spark.createDataFrame([("p", 0), ("q", 1)], "token string, index bigint")
    got = {r["url"]: (r["primary_index"], r["token_index"]) for r in O.txt2url(docs, tokens, titles).collect()}
    assert got == {"u1": (0, [1, 2, 3 + model_bucket("zzzzz")]), "u2": (1, [1])}
    links = {r["url"]: (r["primary_index"], r["secondary_index"]) for r in O.url2url(docs, titles).collect()}
    assert links == {"u1": (0, [1, 1]), "u4": (0, [1])}


def test_tfidf_of_unknown_tokens_is_empty(spark):
    docs = spark.createDataFrame([(0, ["p", "p", "q"]), (1, ["zz"])], "doc_id bigint, tokens array<string>")
    d = spark.createDataFrame([("p", 0, 1), ("q", 1, 1)], "token string, index bigint, doc_frequency bigint")
    got = rows(O.tfidf(docs, d), "doc_id", "index", F.round("weight", 6))
    assert got == [(0, 0, round(2 / 5 ** 0.5, 6)), (0, 1, round(1 / 5 ** 0.5, 6))]


def test_sentence_examples(spark):
    sparse = spark.createDataFrame([("s", 1, [1, 2]), ("e", 2, [1, 2, 3, 4]), ("l", 3, list(range(1, 11)))],
                                   "url string, primary_index bigint, token_index array<bigint>")
    got = defaultdict(list)
    for r in O.sentence_examples(sparse, 4, 8).collect():
        got[r["url"]].append(r["tokens"])
    assert got["s"] == [[1, 2, 0, 0]] and got["e"] == [[1, 2, 3, 4]]
    assert len(got["l"]) == 8
    assert all(t == list(range(t[0], t[0] + 4)) and 1 <= t[0] <= 7 for t in got["l"])


@pytest.mark.parametrize("limit", [512, 2])
def test_title_pairs(spark, limit):
    """Small sets inside their row, large ones through block products: the same counts."""
    sets = [("u1", 0, [1, 2, 3, 1]), ("u2", 1, [2, 0]), ("u3", 3, [4]), ("u4", 5, [5])]
    df = spark.createDataFrame(sets, "url string, primary_index bigint, secondary_index array<bigint>")
    expected = Counter()
    for _, p, s in sets:
        m = sorted({p, *s})
        expected.update((a, b) for i, a in enumerate(m) for b in m[i + 1:])
    got = {(r["i"], r["j"]): r["count"] for r in C.title_cooccurrence(df, group_limit=limit, block=2).collect()}
    assert got == dict(expected)
    assert all(i < j for i, j in got)


def test_pack_and_unpack(spark):
    triples = [(i, j, float(i * j)) for i in range(5) for j in range(i)] + [(9, j, 1.0) for j in range(9)]
    df = spark.createDataFrame(triples, "i bigint, j bigint, x double")
    packed = C.pack_rows(df, 4)
    sizes = {(r["index"], r["chunk"]): len(r["other_index"]) for r in packed.collect()}
    assert sizes[9, 0] == 4 and sizes[9, 1] == 4 and sizes[9, 2] == 1
    assert rows(C.unpack_rows(packed), "i", "j", "x") == sorted(triples)


def test_text_operators_need_no_python(spark, docs):
    d = D.token_dictionary(docs, 2)
    plan = C.token_cooccurrence(docs, d)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow", plan)


@pytest.mark.parametrize("limit", [1 << 20, 8, 1])
def test_rows_are_packed_in_order_of_their_entries(spark, monkeypatch, limit):
    """Light rows without a global order, heavy ones by it."""
    monkeypatch.setattr(C, "ROW_LIMIT", limit)
    ordered = []
    real = C.place_in_group
    monkeypatch.setattr(C, "place_in_group", lambda df, *a: (ordered.append(df.count()), real(df, *a))[1])
    triples = [(i, j, float(i * j)) for i in range(12) for j in range(i)]
    df = spark.createDataFrame(triples[::-1], "i bigint, j bigint, x double")
    packed = {(r["index"], r["chunk"]): (r["other_index"], r["count"]) for r in C.pack_rows(df, 4).collect()}
    expected = {(i, c): (list(range(c * 4, min(i, c * 4 + 4))), [float(i * j) for j in range(c * 4, min(i, c * 4 + 4))])
                for i in range(12) for c in range(-(-i // 4))}
    assert packed == expected
    assert ordered == [sum(i for i in range(12) if i > limit)] * (limit < 11)
