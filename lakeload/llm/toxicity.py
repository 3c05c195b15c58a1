"""Toxicity by compression distance: windows of a text are compressed with a dictionary trained on toxic text and with
one trained on ordinary text; how many bytes the toxic one saves, calibrated on labelled documents, gives the score.

Both dictionaries end in the same base, trained on ordinary windows, so text that is common in both costs the same and
only what the special parts hold makes a difference.  They are used as raw content: no entropy tables, so a literal
costs the same under both.  Few words of a toxic document are toxic, so its windows are told apart in rounds: the
dictionaries of one half of the documents choose, by the difference in length, the windows of the other half that the
next dictionaries are trained on (toxic windows that the toxic dictionary shortens most, ordinary windows that it
shortens wrongly).  A third part of the documents calibrates: a logistic function of the largest difference, means and
the shares of windows above thresholds, measured on whole texts.  Scores are chances if there
were ``ODDS`` toxic documents per ordinary one, so that rare ones are found.

Fitting takes about ``LABELLED`` documents of each class at most, chosen by hash, one row per id, and up to ``WINDOWS``
windows of each, evenly spread; everything else covers every window of every text.

Edge cases: a NULL or empty text has one empty window; texts of any length are read window by window; repeated rows
are scored one by one; rows with a NULL id are scored and learned from never; a label other than 0 or 1 is none, of
contradicting labels of an id 1 holds; without labelled documents of both classes to learn and calibrate on, all
get the score of the larger class (0 without any); an empty table gives no rows; other columns are ignored.  Ties at 0.5 count as toxic.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import join_small, unit_hash

LABELLED = 4000
WINDOWS = 40
# Words of a window, and bytes of the base and of a special part of a dictionary.
WORDS = 24
BASE_SIZE, SPECIAL_SIZE = 131_072, 16_384
# COVER's segment and k-mer sizes.
SEGMENT, KMER = 12, 6
ROUNDS = 2
# The share of a half's windows that a special part is trained on.
CHOSEN = 0.2
# Windows that the toxic dictionary shortens by so many bytes or more are counted.
SAVED = (1, 2, 3, 4, 5, 6, 8)
# Differences are clipped to this range for one of the means; windows beyond this number add no certainty.
CLIP, MOST = (-2, 8), 400
RIDGE = 1e-2
# Scores are chances for documents of which so many are toxic per ordinary one.
ODDS = 0.5
# Documents whose hash is below the first border are one half, below the second the other half; the others calibrate.
PARTS = (0.4, 0.8)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Matches of four bytes and more, lazily searched; frames without any optional field.
HOW = dict(window_log=20, chain_log=16, hash_log=17, search_log=5, min_match=4, target_length=64, strategy=zstandard.STRATEGY_LAZY2,
           write_content_size=False, write_dict_id=False, write_checksum=False)


def windows(text: str, words: int = WORDS) -> Iterator[bytes]:
    """The text in windows of ``words`` words, lower-cased; the last one may be shorter."""
    found = (m.group() for m in WORD.finditer(text)) if len(text) > 1 << 20 else iter(WORD.findall(text))
    own = list(islice(found, words))
    while True:
        yield (" ".join(own).lower() + " ").encode("utf-8", "replace") if own else b""
        own = list(islice(found, words))
        if not own:
            return


def train(samples: list[bytes], size: int) -> bytes:
    """The content of a dictionary of about ``size`` bytes trained on distinct samples; too few are taken whole."""
    distinct = sorted(set(samples))
    random.Random(len(distinct)).shuffle(distinct)
    if sum(map(len, distinct)) > 4 * size:
        try:
            return zstandard.train_dictionary(size, distinct, k=SEGMENT, d=KMER).as_bytes()
        except zstandard.ZstdError:  # COVER wants more samples
            pass
    return b"".join(distinct)[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters(**HOW)
    if len(content) < 8:
        return zstandard.ZstdCompressor(compression_params=how)
    kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    kept.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=kept, compression_params=how)


def saved(pair: tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor], found) -> np.ndarray:
    """How many bytes shorter each window is under the toxic (second) than under the ordinary dictionary."""
    ordinary, toxic = pair[0].compress, pair[1].compress
    return np.array([len(ordinary(w)) - len(toxic(w)) for w in found], np.int64)


def features(found: np.ndarray) -> list[float]:
    """Of the windows' differences: the largest, means, shares above thresholds, and how many windows they rest on."""
    top, size = np.sort(found)[::-1][:3], float(np.sqrt(min(len(found), MOST)))
    shares = [float((found >= k).mean()) for k in SAVED]
    return [float(top[0]), float(top.mean()), float(found.mean()), float(np.clip(found, *CLIP).mean()), *shares, size, shares[4] * size]


def dictionaries(ordinary: tuple[list, list], toxic: tuple[list, list]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents from the windows of two halves of the documents of each class."""
    base = train([w for half in ordinary for w in half], BASE_SIZE)
    chosen = [(ordinary[h], toxic[h]) for h in (0, 1)]
    for _ in range(ROUNDS):
        pairs = [[compressor(train(part, SPECIAL_SIZE) + base) for part in chosen[h]] for h in (0, 1)]
        chosen = []
        for h in (0, 1):
            own = []
            for part in (ordinary[h], toxic[h]):
                part = sorted(set(part))
                gain = saved(pairs[1 - h], part)
                own.append([part[i] for i in np.argsort(-gain, kind="stable")[:max(100, int(len(part) * CHOSEN))]])
            chosen.append(own)
    return tuple(train(chosen[0][k] + chosen[1][k], SPECIAL_SIZE) + base for k in (0, 1))


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last one constant) of a ridge logistic regression of standardised features, by Newton's method."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(z) + RIDGE * np.eye(len(w)), z.T @ (p - y) / len(z) + RIDGE * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def _held_out(doc_id: str):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[tuple[bytes, bytes] | None, np.ndarray | float]:
    """(dictionaries, weights), or (None, the score of all) without documents of both classes.  ``docs`` (doc_id, text),
    ``labels`` (doc_id, toxic)."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~_held_out("doc_id")).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None, float(sizes.get(1, 0) > 0)
    share = F.when(F.col("toxic") == 1, min(1.0, labelled / sizes[1])).otherwise(min(1.0, labelled / sizes[0]))
    place = unit_hash("fold", F.col("doc_id"))
    fold = F.when(place < PARTS[0], 0).when(place < PARTS[1], 1).otherwise(2).alias("fold")
    sample = known.where(unit_hash("toxic", F.col("doc_id")) < share).select("doc_id", "toxic", fold)
    texts = join_small(docs.select("doc_id", F.col("text").cast("string").alias("text")), sample, "doc_id", "inner")
    texts = texts.groupBy("doc_id", "toxic", "fold").agg(F.min("text").alias("text"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(2).to_pylist():
                n = max(1, -(-len(WORD.findall(t or "")) // WORDS))
                step = -(-n // WINDOWS)
                out.append(list(islice(windows(t or ""), 0, None, step)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.binary()))], ["toxic", "fold", "windows"])

    got = texts.where("fold < 2").select("toxic", "fold", "text").mapInArrow(spread, "toxic int, fold int, windows array<binary>").toArrow().to_pylist()
    of = lambda toxic: tuple([w for r in got if (r["toxic"], r["fold"]) == (toxic, half) for w in r["windows"]] for half in (0, 1))
    pair = dictionaries(of(0), of(1))
    held = measured(texts.where("fold = 2").select("doc_id", "toxic", "text"), pair, "toxic").drop("doc_id").toPandas()
    if held["toxic"].nunique() < 2:
        return None, float(sizes[1] > sizes[0])
    y = held["toxic"].to_numpy()
    w = calibrate(np.stack(held["features"].to_numpy()), y)
    w[-1] += np.log(ODDS) - np.log(y.sum() / (1 - y).sum())
    return pair, w


def measured(docs: DataFrame, pair: tuple[bytes, bytes], *carried: str) -> DataFrame:
    """doc_id, the ``carried`` columns and the features of every text."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tuple(compressor(p) for p in pair)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [features(saved(both, windows(t.as_py() or ""))) for t in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(made, pa.list_(pa.float64()))], ["doc_id", *carried, "features"])

    schema = ", ".join(f"{c} {fields[c]}" for c in ("doc_id", *carried)) + ", features array<double>"
    return docs.select("doc_id", *carried, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text); ``labels`` (doc_id, toxic)."""
    pair, w = fit(docs, labels, labelled)
    if pair is None:
        value, found = F.lit(float(w)), docs.select("doc_id")
    else:
        found = measured(docs.select("doc_id", "text"), pair)
        z = F.lit(float(w[-1]))
        for i in range(len(w) - 1):
            z = z + F.lit(float(w[i])) * F.element_at("features", i + 1)
        value = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return found.select("doc_id", F.coalesce(_held_out("doc_id"), F.lit(False)).alias("held_out"), value.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
