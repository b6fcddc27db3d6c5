"""Quality classifier by co-training of two views of a document.

One classifier sees the text only, the other the page's metadata only (source,
language, declared length). Over a few rounds each labels the pool documents it is sure
of for the other. Both are then calibrated on labelled rows that neither was fitted on,
and their calibrated log-odds are combined. Fitting works on a bounded sample of
feature rows; scoring is one pass over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.hashing import word_hashes
from affinia.llm.tables import blocks, utf8

#: Bytes by kind: 0 other, 1 space, 2 line end, 3 digit, 4 upper, 5 lower, 6 beyond
#: ASCII, 7 sentence marks, 8 exclamation, 9 bar, 10 signs, 11 quotes and brackets.
KINDS = np.zeros(256, dtype=np.int64)
for _low, _high, _kind in ((0x30, 0x39, 3), (0x41, 0x5A, 4), (0x61, 0x7A, 5), (0x80, 0xFF, 6)):
    KINDS[_low:_high + 1] = _kind
for _bytes, _kind in ((b" ", 1), (b"\n\r", 2), (b".,;:?", 7), (b"!", 8), (b"|", 9), (b"#$%&*@^~`+=_", 10), (b"\"'()[]{}<>", 11)):
    KINDS[list(_bytes)] = _kind
N_KINDS = 12
PLAIN = np.zeros(256, dtype=np.int64)
PLAIN[0x20:0x7F] = np.arange(1, 96)
#: Shares of the printable ASCII bytes, of neighbouring kinds, and of words that repeat
#: the word before, one of the eight before, or any earlier one.
N_TEXT = 96 + N_KINDS * N_KINDS + 3
#: Added to the length that shares are of, so that a few bytes cannot decide.
PRIOR = 48
N_META = 64 + 16 + 24


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of bytes, of neighbouring kinds and of repeated words in every text, as square roots."""
    kinds, plain = KINDS[data], PLAIN[data]
    words, counts = word_hashes(data, offsets)
    out = np.zeros((len(offsets) - 1, N_TEXT), dtype=np.float32)
    at = 0
    for i, count in enumerate(counts.tolist()):
        own = kinds[offsets[i]:offsets[i + 1]]
        if len(own):
            out[i, :96] = np.bincount(plain[offsets[i]:offsets[i + 1]], minlength=96) / (len(own) + PRIOR)
            out[i, 96:-3] = np.bincount(own[:-1] * N_KINDS + own[1:], minlength=N_KINDS**2) / (len(own) + PRIOR)
        if count > 1:
            said = words[at:at + count]
            near = np.zeros(count, dtype=bool)
            for back in range(1, min(9, count)):
                near[back:] |= said[back:] == said[:-back]
            again = [(said[1:] == said[:-1]).sum(), near.sum(), count - len(np.unique(said))]
            out[i, -3:] = np.array(again) / (count + PRIOR / 6)
        at += count
    return np.sqrt(out)


def meta_features(source: list, lang: list, n_chars: list) -> np.ndarray:
    """One slot each for the hashed source, the hashed language and the length's magnitude; null has its own."""
    import zlib

    out = np.zeros((len(source), N_META), dtype=np.float32)
    for i, (s, g, n) in enumerate(zip(source, lang, n_chars)):
        out[i, 0 if s is None else 1 + zlib.crc32(str(s).encode()) % 63] = 1
        out[i, 64 + (0 if g is None else 1 + zlib.crc32(str(g).encode()) % 15)] = 1
        out[i, 80 + (0 if n is None else 1 + min(22, int(max(n, 0)).bit_length()))] = 1
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 300, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression, the last one the intercept, by full-batch Adam."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    y, weight = y.astype(np.float32), weight.astype(np.float32)
    w = np.zeros(x.shape[1], dtype=np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - y) * weight) / weight.sum() + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w.astype(np.float64)


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


@dataclass
class Model:
    """Weights of both views, their calibration (slope, intercept) and the combination."""

    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    both: np.ndarray

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = np.clip(logits(text, self.text) * self.text_scale[0] + self.text_scale[1], -12, 12)
        b = np.clip(logits(meta, self.meta) * self.meta_scale[0] + self.meta_scale[1], -12, 12)
        c = self.both[0] * a + self.both[1] * b + self.both[2]
        return tuple(1 / (1 + np.exp(-z)) for z in (a, b, c))


def co_train(
    text: np.ndarray, meta: np.ndarray, label: np.ndarray, fold: np.ndarray, rounds: int = 4, sure: float = 0.95,
    each: int = 400,
) -> Model:
    """Fits both views. ``label`` is 1, 0 or -1 (pool); rows with ``fold`` 1 calibrate.

    Each round every view hands over up to ``each`` pool rows per class to which its
    calibrated probability gives at least ``sure``.
    """
    fitting, held = (label >= 0) & (fold == 0), (label >= 0) & (fold == 1)
    if not held.any() or len(set(label[held].tolist())) < 2:
        held = fitting = label >= 0
    views, given = [text, meta], [label.copy(), label.copy()]
    weights, scales = [None, None], [None, None]

    def fit(k: int) -> None:
        rows = np.flatnonzero((given[k] >= 0) & ((label < 0) | fitting))
        y = given[k][rows].astype(np.float64)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        weights[k] = fit_logistic(views[k][rows], y, np.where(y == 1, 0.5 / share, 0.5 / (1 - share)))
        z = logits(views[k][held], weights[k])[:, None]
        scales[k] = fit_logistic(z, label[held].astype(np.float64), np.ones(held.sum()), 500)

    if len(set(label[label >= 0].tolist())) < 2:  # nothing to tell apart: the labels' own class for all
        only = 12.0 if (label == 1).any() or not (label == 0).any() else -12.0
        flat = np.zeros(2)
        return Model(np.zeros(N_TEXT + 1), np.zeros(N_META + 1), flat, flat, np.array([0.0, 0.0, only]))
    for k in (0, 1):
        fit(k)
    for _ in range(rounds):
        for k in (0, 1):
            other = 1 - k
            p = 1 / (1 + np.exp(-np.clip(logits(views[k], weights[k]) * scales[k][0] + scales[k][1], -30, 30)))
            for value, q in ((1, p), (0, 1 - p)):
                free = np.flatnonzero((given[other] < 0) & (q >= sure))
                best = free[np.argsort(-q[free], kind="stable")][:each]
                given[other][best] = value
        for k in (0, 1):
            fit(k)
    pair = np.stack([
        np.clip(logits(v, w) * s[0] + s[1], -12, 12) for v, w, s in zip([text[held], meta[held]], weights, scales)
    ], axis=1)
    both = fit_logistic(pair, label[held].astype(np.float64), np.ones(held.sum()), 500)
    if both[1] < 0:  # a view that says nothing may not count against itself
        both = np.append(fit_logistic(pair[:, :1], label[held].astype(np.float64), np.ones(held.sum()), 500), 0)[[0, 2, 1]]
    return Model(weights[0], weights[1], scales[0], scales[1], both)


def _columns(docs: DataFrame) -> DataFrame:
    """The columns that are looked at; one that is missing counts as null."""
    kinds = {"doc_id": "bigint", "text": "string", "source": "string", "lang": "string", "n_chars": "bigint"}
    return docs.select(*[
        (F.col(f"`{c}`") if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()
    ])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        meta = meta_features(*[batch.column(k).to_pylist() for k in (2, 3, 4)])
        text = [text_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in blocks(offsets)]
        rows = np.hstack([np.vstack(text) if text else np.zeros((0, N_TEXT), np.float32), meta]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())],
                                         names=["doc_id", "features"])


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", most: int = 4000, pool: int = 4000) -> Model:
    """Fits on at most ``most`` labelled rows and a pool of at most ``pool`` others.

    Both samples are the rows whose id has the smallest hash; a quarter of the labelled
    ones calibrates. Only feature vectors of the sample reach the driver.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    place = F.xxhash64("doc_id", F.lit("quality"))
    chosen = known.orderBy(place, "doc_id").limit(most)
    free = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null")
    free = free.orderBy(F.xxhash64("doc_id", F.lit("pool")), "doc_id").limit(pool).distinct()
    wanted = chosen.unionByName(free.withColumn("label", F.lit(-1))).groupBy("doc_id").agg(F.max("label").alias("label"))
    # At most most + pool rows of two numbers.
    rows = _columns(docs).join(F.broadcast(wanted.select("doc_id")), "doc_id", "left_semi")
    got = rows.mapInArrow(_features, "doc_id bigint, features binary").join(F.broadcast(wanted), "doc_id")
    got = got.select("label", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)).alias("fold"), "features", "doc_id")
    # A repeated id could bring more rows than ids, so the bound is set on the rows too.
    got = got.orderBy("doc_id").limit(2 * (most + pool)).collect()
    if not got:
        return co_train(np.zeros((0, N_TEXT)), np.zeros((0, N_META)), np.zeros(0, int), np.zeros(0, int))
    x = np.frombuffer(b"".join(r["features"] for r in got), np.float32).reshape(len(got), -1)
    label = np.array([r["label"] for r in got])
    fold = np.array([int(r["fold"] == 0) for r in got])
    return co_train(x[:, :N_TEXT], x[:, N_TEXT:], label, fold)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, model: Model | None = None) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) for every row of ``docs``.

    Scores are calibrated probabilities of good quality, of the text view, the metadata
    view and both; ``kept`` says that both together reach ``threshold``.

    Null and empty texts have no text features and are scored by the intercept and the
    metadata; null metadata is a value of its own. Repeated rows score alike, rows
    without an id are scored too. Other columns are ignored. Labels that are null, not 0
    or 1, or of unknown documents are left out; without labels of both kinds every
    document gets the class of the labels there are (good, if there are none).
    """
    fitted = model or fit_quality(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            meta = meta_features(*[batch.column(k).to_pylist() for k in (2, 3, 4)])
            for i, j in blocks(offsets):
                text = text_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                a, b, c = fitted.scores(text, meta[i:j])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(a), pa.array(b), pa.array(c), pa.array(c >= threshold)],
                    names=["doc_id", "text_score", "meta_score", "score", "kept"])

    return _columns(docs).mapInArrow(
        run, "doc_id bigint, text_score double, meta_score double, score double, kept boolean")


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_scores` keeps, with their columns.

    The whole row passes through the scoring, so nothing is shuffled and rows without
    an id or with a repeated one are judged one by one.
    """
    fitted = fit_quality(docs, labels)
    viewed = ("text", "source", "lang", "n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            view = {c: batch.column(names.index(c)) if c in names else pa.nulls(batch.num_rows) for c in viewed}
            data, offsets = utf8(view["text"])
            meta = meta_features(*[view[c].to_pylist() for c in viewed[1:]])
            for i, j in blocks(offsets):
                text = text_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield batch.slice(i, j - i).filter(pa.array(fitted.scores(text, meta[i:j])[2] >= threshold))

    return docs.mapInArrow(run, docs.schema)
