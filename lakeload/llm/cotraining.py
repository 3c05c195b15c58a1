"""Quality classifier by co-training.

Two classifiers see different views of a document: its words, and its page (source, language, length and layout
numbers).  They are fitted on a bounded sample of labelled documents.  In each round both score every document of the
corpus on Spark; those that one view is sure of are pseudo-labels for the other.  No such document leaves its task: a task
sums, for each view and class, the gradient and the diagonal curvature of the logistic loss on the pseudo-labels that it
met, the sums are added on Spark, and a view is fitted again to its labelled documents and to the quadratic that these
sums give (a surrogate of the loss on all pseudo-labels).  Both views are calibrated on labelled documents kept aside, their
calibrated log odds are added (less the prior's, which both hold), and all documents are scored.

Edge cases: a NULL or empty text has no words and zero layout numbers; a NULL source or language is a value of its own;
labels that are NULL or of no id are left out, several labels of one document are averaged; of rows with one labelled id
that of the smallest text is learnt from; without labels of both classes every score is the share of good labels, or 0.5
without any; repeated rows are scored one by one and give a pseudo-label each; a document at a threshold is sure, or kept;
texts are read whole, in memory of their own size; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import join_small, unit_hash

# Bound of the sample of labelled documents that the models are fitted on.
LABELLED = 12_000
HELD_OUT = 0.25
# Each round reads the corpus once.
ROUNDS = 2
STEPS = 200
# How sure a view must be to give a pseudo-label, and the weight of all pseudo-labels against the labelled documents.
SURE = 0.97
PSEUDO_WEIGHT = 0.25
# Tasks that add up the sums of all tasks; each gives the driver one row.
FOLDS = 32
WORD_DIMS = 1024
NAME_DIMS = 64
TABLE_SIZE = 200_000
# Documents of a score below this are not kept.
MIN_SCORE = 0.5


class Words(dict):
    """The feature number of a word; a bounded table of what was asked before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_SIZE:
            self.clear()
        n = self[word] = xxhash.xxh3_64_intdigest(word) % WORD_DIMS
        return n


def text_view(words: list[bytes], known: Words) -> np.ndarray:
    """Word features: damped counts by hashed word, of unit length, and four numbers on how words repeat."""
    out = np.zeros(WORD_DIMS + 4, np.float32)
    if words:
        counts = Counter(words)
        at = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
        n = np.fromiter(counts.values(), np.float64, len(counts))
        v = np.bincount(at, np.log1p(n), WORD_DIMS)
        out[:WORD_DIMS] = v / math.sqrt(float(v @ v))
        same = sum(a == b for a, b in zip(words, words[1:]))
        out[WORD_DIMS:] = [len(counts) / len(words), n.max() / len(words), same / len(words), min(len(words), 200) / 200]
    return out


def page_view(text: bytes, words: list[bytes], source: str | None, lang: str | None) -> np.ndarray:
    """Page features: source and language by hash, length, and layout numbers."""
    out = np.zeros(2 * NAME_DIMS + 8, np.float32)
    out[xxhash.xxh3_64_intdigest(f"s{source}") % NAME_DIMS] = 1
    out[NAME_DIMS + xxhash.xxh3_64_intdigest(f"l{lang}") % NAME_DIMS] = 1
    n, w = max(len(text), 1), max(len(words), 1)
    lines = text.count(b"\n") + 1
    marks = sum(text.count(c) for c in (b"|", b"#", b"*", b"$", b"%", b"&", b"<", b">"))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    spaces = text.count(b" ")
    out[2 * NAME_DIMS:] = [math.log10(n) / 5, math.log10(lines) / 4, min(n / lines, 1000) / 1000, min(20 * marks / n, 1), min(10 * digits / n, 1),
                           min(len(text) / w / 20, 2), min(spaces / w, 2) / 2, min(100 * text.count(b".") / n, 3) / 3]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_view(x: np.ndarray, y: np.ndarray, start: np.ndarray | None = None, pseudo: tuple[np.ndarray, np.ndarray] | None = None,
             penalty: float = 1e-4) -> np.ndarray:
    """Weights (the last the constant) of a logistic regression by Adam steps; classes count alike.  ``pseudo`` is the
    gradient and diagonal curvature, at ``start``, of the loss on pseudo-labels."""
    share = y.mean()
    weight = np.where(y > 0.5, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)) / len(y)
    w, m, v = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    if start is not None:
        w = start.copy()
    for t in range(1, (STEPS if start is None else STEPS // 4) + 1):
        e = ((sigmoid(margin(x, w)) - y) * weight).astype(np.float32)
        g = np.append(x.T @ e + np.float32(penalty) * w[:-1], e.sum())
        if pseudo is not None:
            g = g + PSEUDO_WEIGHT * (pseudo[0] + pseudo[1] * (w - start))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = (w - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return w


def margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def calibrate(m: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) with sigmoid(a * margin + b) the calibrated probability; Newton steps with slightly smoothed labels."""
    y = (y * (len(y) - 1) + 0.5) / max(len(y), 1)
    z = np.stack([m, np.ones_like(m)], 1)
    t = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(z @ t)
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        t = t - np.linalg.solve(h, z.T @ (p - y) + 1e-3 * (t - [1.0, 0.0]))
    return float(t[0]), float(t[1])


class Sums:
    """Of the pseudo-labels for both views: by view and class their number, and the sums of gradient and curvature."""

    def __init__(self, sizes: list[int], flat: np.ndarray | None = None):
        self.flat = np.zeros(sum(2 * (1 + 2 * n) for n in sizes)) if flat is None else flat
        self.of, at = [], 0
        for n in sizes:
            self.of.append(self.flat[at:at + 2 * (1 + 2 * n)].reshape(2, 1 + 2 * n))
            at += 2 * (1 + 2 * n)

    def add(self, views: tuple[np.ndarray, np.ndarray], models: list[np.ndarray]) -> None:
        """Add what one document gives: each view that is sure of its class labels it for the other."""
        p = [float(sigmoid(margin(x, w))) for x, w in zip(views, models)]
        for k in (0, 1):
            good = p[k] >= SURE
            if good or 1 - p[k] >= SURE:
                x, q, into = views[1 - k], p[1 - k], self.of[1 - k][int(good)]
                n, e, c = len(x), q - good, q * (1 - q)
                into[0] += 1
                into[1:n + 1] += e * x
                into[n + 1] += e
                into[n + 2:-1] += c * (x * x)
                into[-1] += c

    def pseudo(self, k: int) -> tuple[np.ndarray, np.ndarray] | None:
        """(gradient, curvature) of the mean loss on the pseudo-labels for view ``k``, classes alike; None without any."""
        means = [row[1:] / row[0] for row in self.of[k] if row[0]]
        if not means:
            return None
        both = sum(means) / len(means)
        return both[:len(both) // 2], both[len(both) // 2:]


def corpus_sums(docs: DataFrame, models: list[np.ndarray]) -> Sums:
    """The sums over all documents (text, source, lang).  A task gives one row, ``FOLDS`` tasks add the rows up."""
    sizes = [len(w) for w in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = Words(), Sums(sizes)
        for batch in batches:
            for text, source, lang in zip(batch.column(0).cast(pa.binary()), batch.column(1), batch.column(2)):
                data = text.as_py() or b""
                words = data.lower().split()
                sums.add((text_view(words, known), page_view(data, words, source.as_py(), lang.as_py())), models)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([sums.flat.tobytes()], pa.binary())], ["task", "sums"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Sums(sizes).flat
        for batch in batches:
            for one in batch.column(1):
                total += np.frombuffer(one.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    rows = docs.select("text", "source", "lang").mapInArrow(run, "task long, sums binary")
    folded = rows.repartition(FOLDS, "task").sortWithinPartitions("task").mapInArrow(fold, "sums binary")
    total = Sums(sizes)
    for row in folded.collect():
        total.flat += np.frombuffer(row.sums)
    return total


def co_train(views: list[np.ndarray], y: np.ndarray, docs: DataFrame, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The weights of both views after the rounds over ``docs`` (text, source, lang)."""
    models = [fit_view(v, y) for v in views]
    for _ in range(rounds):
        sums = corpus_sums(docs, models)
        models = [fit_view(views[k], y, models[k], p) if (p := sums.pseudo(k)) else models[k] for k in (0, 1)]
    return models


def _views(docs: DataFrame) -> DataFrame:
    """(h, label, text_view, page_view) of (h, label, text, source, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            a, b = [], []
            for text, source, lang in zip(batch.column(2).cast(pa.binary()), batch.column(3), batch.column(4)):
                data = text.as_py() or b""
                words = data.lower().split()
                a.append(text_view(words, known).tobytes())
                b.append(page_view(data, words, source.as_py(), lang.as_py()).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                             ["h", "label", "text_view", "page_view"])

    return docs.select("h", "label", "text", "source", "lang").mapInArrow(run, "h double, label double, text_view binary, page_view binary")


def _collected(df: DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    got = _views(df).toArrow()
    h, y = got.column("h").to_numpy(), got.column("label").to_numpy()
    order = np.argsort(h, kind="stable")
    take = lambda c: np.stack([np.frombuffer(v, np.float32) for v in got.column(c).to_pylist()])[order] if len(h) else np.zeros((0, 1))
    return [take("text_view"), take("page_view")], y[order], h[order]


def labelled_sample(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(h, label, text, source, lang): one row for each of about ``labelled`` labelled ids, chosen by hash.  Rows of one id
    are reduced in the tasks that read them before any is shuffled."""
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg((F.avg("quality") >= 0.5).cast("double").alias("label")))
    n = known.count()
    marked = known.withColumn("h", unit_hash("quality", F.col("doc_id"))).where(F.col("h") < (min(1.0, labelled / n) if n else 0.0))
    one = join_small(docs, marked, "doc_id", "inner").groupBy("doc_id", "h", "label").agg(F.min(F.struct("text", "source", "lang")).alias("d"))
    return one.select("h", "label", "d.text", "d.source", "d.lang")


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> dict:
    """The model: weights and calibration of both views and the prior, or only the prior where it can't be fitted."""
    d = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"),
                    F.col("lang").cast("string").alias("lang"))
    views, y, _ = _collected(labelled_sample(d, labels, labelled))
    prior = float(y.mean()) if len(y) else 0.5
    if len(y) < 20 or prior in (0.0, 1.0):
        return {"prior": prior}
    aside = np.random.default_rng(1).permutation(len(y)) < HELD_OUT * len(y)
    models = co_train([v[~aside] for v in views], y[~aside], d, rounds)
    scales = [calibrate(margin(v[aside], m), y[aside]) for v, m in zip(views, models)]
    both = added([margin(v[aside], m) for v, m in zip(views, models)], scales, prior)
    return {"prior": prior, "models": models, "scales": scales, "both": calibrate(both, y[aside])}


def added(margins: list[np.ndarray], scales: list[tuple[float, float]], prior: float) -> np.ndarray:
    """Log odds of both views together."""
    return sum(a * m + b for m, (a, b) in zip(margins, scales)) - math.log(prior / (1 - prior))


def score(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, text_score, page_score, score, kept for every row of ``docs`` (doc_id, text, source, lang)."""
    model = train(docs, labels, labelled, rounds)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            n = batch.num_rows
            out = np.full((3, n), model["prior"])
            if "models" in model:
                margins = np.zeros((2, n))
                for i, (text, source, lang) in enumerate(zip(batch.column(1).cast(pa.binary()), batch.column(2), batch.column(3))):
                    data = text.as_py() or b""
                    words = data.lower().split()
                    margins[0, i] = margin(text_view(words, known), model["models"][0])
                    margins[1, i] = margin(page_view(data, words, source.as_py(), lang.as_py()), model["models"][1])
                for k, (a, b) in enumerate(model["scales"]):
                    out[k] = sigmoid(a * margins[k] + b)
                a, b = model["both"]
                out[2] = sigmoid(a * added(list(margins), model["scales"], model["prior"]) + b)
            kept = pa.array(out[2] >= min_score)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x) for x in out], kept],
                                             ["doc_id", "text_score", "page_score", "score", "kept"])

    d = docs.select("doc_id", *[F.col(c).cast("string").alias(c) for c in ("text", "source", "lang")])
    return d.mapInArrow(run, f"doc_id {kind}, text_score double, page_score double, score double, kept boolean")
