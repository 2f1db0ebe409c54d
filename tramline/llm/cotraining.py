"""Quality classifier by co-training: a text-content view and a page-metadata view teach each other on unlabelled documents.

Labelled documents for fitting are a bounded sample, MAX_LABELLED at most, those with the smallest hash of their id; a part of them is held out for calibration. All
other documents are unlabelled and all of them take part: in every round both classifiers are fitted on the driver and calibrated, and the
executors score every document. A document about which a view is confident (calibrated probability of CONFIDENT or more) is handed to the other view with that
label. What the other view gets are the mean features of the documents handed to it, by label and by hash of language and source (BUCKETS), weighted by
their number, so a rare source has a part of its own and the driver's share doesn't grow with the corpus. Sums are whole numbers and don't depend on the
order of tasks. In the end both views are calibrated again and a logistic combination of their scores, fitted on the held-out labels, scores every document.
A view that knows nothing calibrates to the base rate: it never is confident, and gets no weight.

Defined results: null or empty text has the features of no text, and texts of any length are read whole; null metadata is a value of its own; labels without a value are
ignored, contradicting labels of one document count as bad; rows of one labelled document with different texts count by one of them; ties in the hash of ids are
settled by the id; without labels of both kinds in both parts every document gets the base rate (1 without any) as its score, which is what the labels say and
no failure; repeated rows get equal results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import materialise, ship

MAX_LABELLED = 3000
ROUNDS = 2
#: Weight of all pseudo-labels together, as a share of that of the labels.
PSEUDO_SHARE = 0.5
BUCKETS = 32
CONFIDENT = 0.97
THRESHOLD = 0.5
UNIT = 1 << 24

PAIRS = 1024
PAIR_SLOT = np.random.default_rng(4242).integers(0, PAIRS, 65536).astype(np.int64)
KINDS = np.zeros(256, np.int64)  # classes of bytes: other, blank, upper, lower, digit, sentence mark, symbol, beyond ASCII
for _k, _chars in enumerate((" \t\n\r\v\f", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", ".,;:!?'\"()-", "#*$%&|<>=+~^_/\\{}[]@`"), 1):
    KINDS[list(_chars.encode())] = _k
KINDS[128:] = 7
SHAPE = 16
TEXT_DIMENSIONS = PAIRS + SHAPE
SLOTS = 64
PAGE_DIMENSIONS = 2 * SLOTS + 3


def text_features(text: bytes) -> np.ndarray:
    """Square roots of hashed byte-pair frequencies, and the shape of the text."""
    out = np.zeros(TEXT_DIMENSIONS, np.float32)
    buf = np.frombuffer(text, np.uint8)
    if not len(buf):
        return out
    if len(buf) > 1:
        pair = buf[:-1].astype(np.uint16) << 8 | buf[1:]
        out[:PAIRS] = np.sqrt(np.bincount(PAIR_SLOT[pair], minlength=PAIRS) / len(pair))
    kinds = np.bincount(KINDS[buf], minlength=8) / len(buf)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n = max(1, len(words))
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out[PAIRS:] = [*np.sqrt(kinds), np.log1p(len(words)) / 10, len(set(words)) / n, again / n, min(2.0, len(buf) / n / 10), 1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)) / 5, kinds[2] / max(0.01, kinds[2] + kinds[3]), 1.0]
    return out


def page_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed language and source, and the length on a logarithmic scale."""
    out = np.zeros(PAGE_DIMENSIONS, np.float32)
    out[zlib.crc32(f"l{lang}".encode()) % SLOTS] = 1
    out[SLOTS + zlib.crc32(f"s{source}".encode()) % SLOTS] = 1
    size = np.log1p(max(0, n_chars or 0)) / 10
    out[-3:] = size, size * size, n_chars is None
    return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 3e-5, rounds: int = 400) -> np.ndarray:
    """Logistic regression with a bias (last weight) by accelerated full-batch descent; deterministic."""
    weight = weight / weight.sum()
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros(x.shape[1], np.float32)
    rate = 4.0 / float((x * x).sum(axis=1).max())
    v = w
    for t in range(rounds):
        error = (1 / (1 + np.exp(-np.clip(x @ v, -30, 30))) - y) * weight
        fresh = v - rate * (x.T @ error.astype(np.float32) + penalty * v)
        v = fresh + t / (t + 3) * (fresh - w)
        w = fresh
    return w


def raw(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def platt(columns: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 1e-3) -> np.ndarray:
    """Calibration: logistic regression on few scores by Newton steps, with a ridge and smoothed targets."""
    x = np.hstack([columns, np.ones((len(columns), 1))]).astype(float)
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target, w = np.where(y > 0.5, hi, lo), np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x.T @ (p - target) + ridge * w)
    return w


def chance(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.column_stack([z, np.ones(len(z))]) @ w, -30, 30)))


Sums = dict[tuple[int, int, int], tuple[int, np.ndarray]]


def handed_on(weights: list[np.ndarray], scales: list[np.ndarray], text: np.ndarray, page: np.ndarray, bucket: np.ndarray) -> Sums:
    """(view that learns, label, bucket) -> number and summed features (in units of 1 / UNIT) of the documents about which the other view is confident."""
    views, found = (text, page), {}
    for k in (0, 1):
        p = chance(raw(views[k], weights[k]), scales[k])
        for label, sure in ((1, p), (0, 1 - p)):
            for at in np.unique(bucket[sure >= CONFIDENT]).tolist():
                rows = np.flatnonzero((sure >= CONFIDENT) & (bucket == at))
                found[1 - k, label, at] = len(rows), np.rint(views[1 - k][rows].astype(np.float64) * UNIT).astype(np.int64).sum(axis=0)
    return found


def added(one: Sums, two: Sums) -> Sums:
    return one | {k: (n + one[k][0], x + one[k][1]) if k in one else (n, x) for k, (n, x) in two.items()}


def train(text: np.ndarray, page: np.ndarray, y: np.ndarray, held: np.ndarray, exchange: Callable[[list[np.ndarray], list[np.ndarray]], Sums]) -> dict:
    """The model from features of labelled rows (y 0/1); ``held`` marks those kept for calibration. ``exchange(weights, scales)`` is handed_on() over all unlabelled documents."""
    base = float(y.mean()) if len(y) else 1.0
    own = ~held
    if len(set(y[own])) < 2 or len(set(y[held])) < 2:
        return {"base": base}
    views, taught, handed = (text, page), {}, 0
    for r in range(ROUNDS + 1):
        weights = []
        for k, v in enumerate(views):
            x, target, weight = [v[own]], [y[own].astype(float)], [np.ones(own.sum())]
            for label, share in ((1, base), (0, 1 - base)):
                parts = [(n, s) for (view, given, _), (n, s) in sorted(taught.items()) if view == k and given == label]
                total = sum(n for n, _ in parts)
                x += [(s / (n * UNIT)).astype(np.float32)[None] for n, s in parts]
                target.append(np.full(len(parts), float(label)))
                weight.append(np.array([PSEUDO_SHARE * share * own.sum() * n / total for n, _ in parts]))
            weights.append(fit(np.concatenate(x), np.concatenate(target), np.concatenate(weight)))
        scores = [raw(v, w) for v, w in zip(views, weights, strict=True)]
        scales = [platt(s[held][:, None], y[held].astype(float)) for s in scores]
        if r < ROUNDS:
            taught = exchange(weights, scales)
            handed += sum(n for n, _ in taught.values())
    both = platt(np.column_stack([chance_logit(s, c) for s, c in zip(scores, scales, strict=True)])[held], y[held].astype(float), ridge=1.0)  # a view that hardly varies gets no large weight
    return {"base": base, "weights": weights, "scales": scales, "both": both, "handed": handed}


def chance_logit(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(z * w[0] + w[1], -30, 30)


def apply(model: dict, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Calibrated probabilities of good quality by text, by page and by both."""
    if "both" not in model:
        flat = np.full(len(text), model["base"])
        return flat, flat, flat
    z = [chance_logit(raw(v, w), c) for v, w, c in zip((text, page), model["weights"], model["scales"], strict=True)]
    return *(1 / (1 + np.exp(-x)) for x in z), chance(np.column_stack(z), model["both"])


FEATURES = "doc_id long, label int, held boolean, text array<float>, page array<float>"
SUMS = "view int, label int, bucket int, n long, sums array<long>"


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _features(text: pa.Array, lang: pa.Array, source: pa.Array, n: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.stack([text_features(t or b"") for t in text.cast(pa.binary()).to_pylist()]), np.stack([page_features(*r) for r in zip(lang.to_pylist(), source.to_pylist(), n.to_pylist(), strict=True)])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            text, page = _features(*(batch.column(k) for k in (3, 4, 5, 6)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), _lists(text), _lists(page)], names=["doc_id", "label", "held", "text", "page"])


def _batch_of(found: Sums) -> Iterator[pa.RecordBatch]:
    for (view, label, bucket), (n, sums) in sorted(found.items()):
        yield pa.RecordBatch.from_arrays([pa.array([view], pa.int32()), pa.array([label], pa.int32()), pa.array([bucket], pa.int32()), pa.array([n], pa.int64()), _lists(sums[None])], names=["view", "label", "bucket", "n", "sums"])


def _sums_of(batch: pa.RecordBatch) -> Sums:
    rows = batch.to_pydict()
    return {(v, y, b): (n, np.array(s, np.int64)) for v, y, b, n, s in zip(*(rows[c] for c in ("view", "label", "bucket", "n", "sums")), strict=True)}


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Sums = {}
    for batch in batches:
        for at in range(batch.num_rows):
            total = added(total, _sums_of(batch.slice(at, 1)))
    yield from _batch_of(total)


def exchanged(docs: DataFrame, weights: list[np.ndarray], scales: list[np.ndarray]) -> Sums:
    """handed_on() over all of ``docs``: sums a task, then sums of those; the driver gets a row for each view, label and bucket at most."""
    model = docs.sparkSession.sparkContext.broadcast((weights, scales))  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Sums = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                text, page = _features(*(part.column(k) for k in range(4)))
                total = added(total, handed_on(*model.value, text, page, part.column(4).to_numpy()))
        yield from _batch_of(total)

    bucket = F.pmod(F.xxhash64("lang", "source"), F.lit(BUCKETS)).alias("bucket")
    sums = docs.select("text", "lang", "source", F.col("n_chars").cast("long"), bucket).mapInArrow(run, SUMS)
    got: Sums = {}
    for batch in sums.repartition(BUCKETS, "view", "label", "bucket").mapInArrow(_summed, SUMS).toArrow().to_batches():
        for at in range(batch.num_rows):
            got = added(got, _sums_of(batch.slice(at, 1)))
    return got


def train_on(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, label: str = "quality") -> dict:
    """The model, fitted on ``labels`` (doc_id, 0/1) of at most ``max_labelled`` documents and on all other ``docs`` (doc_id, text, lang, source, n_chars)."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    chosen = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64(F.lit(91), "doc_id"), "doc_id").limit(max_labelled)
    chosen = materialise(chosen.select(F.col("doc_id").alias("s_id"), "label", (F.pmod(F.xxhash64(F.lit(92), "doc_id"), F.lit(10)) < 3).alias("held")))
    sample = F.broadcast(chosen)  # at most max_labelled rows
    one = F.min_by(F.struct("label", "held", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars")), F.xxhash64("text", "lang", "source", "n_chars")).alias("r")
    rows = docs.join(sample, F.col("doc_id") == F.col("s_id")).groupBy("doc_id").agg(one).select("doc_id", "r.*")
    got = rows.mapInArrow(_featured, FEATURES).toArrow().sort_by([("doc_id", "ascending")])
    if not got.num_rows:
        return {"base": 1.0}
    matrix = lambda c, n: got.column(c).combine_chunks().flatten().to_numpy().reshape(-1, n)
    free = docs.join(F.broadcast(chosen.select("s_id")), F.col("doc_id") == F.col("s_id"), "left_anti")
    return train(matrix("text", TEXT_DIMENSIONS), matrix("page", PAGE_DIMENSIONS), got.column("label").to_numpy(), got.column("held").to_numpy(), lambda weights, scales: exchanged(free, weights, scales))


def scored(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with a column ``_quality``: struct of text, page and score, each a calibrated probability of good quality."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train_on(docs, labels, **options))  # a fixed number of weights

    @F.arrow_udf("struct<text:double,page:double,score:double>")
    def quality(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        m = model.value
        for text, lang, source, n in batches:
            parts = [np.zeros((0, 3))]
            for a in range(0, len(text), 512):
                cut = lambda c, a=a: c.slice(a, 512)
                parts.append(np.column_stack(apply(m, *_features(cut(text), cut(lang), cut(source), cut(n)))))
            got = np.concatenate(parts)
            yield pa.StructArray.from_arrays([pa.array(got[:, k]) for k in range(3)], names=["text", "page", "score"])

    return docs.withColumn("_quality", quality("text", "lang", "source", F.col("n_chars").cast("long")))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, text_score, page_score, score, kept): one row per input row."""
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    out = scored(own, labels, **options).select("doc_id", "_quality")
    return out.select("doc_id", F.col("_quality.text").alias("text_score"), F.col("_quality.page").alias("page_score"), F.col("_quality.score").alias("score"), (F.col("_quality.score") >= threshold).alias("kept"))


def kept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents of good quality, in the columns of ``docs``."""
    return scored(docs, labels, **options).filter(F.col("_quality.score") >= threshold).drop("_quality")
