"""Suffix-array deduplication: bytes covered by a long string that also starts elsewhere are removed.

Prefix doubling over anchored positions: see ``repeats``.  Every byte position has an owner among the sampled ones, so
the result is that of the whole suffix array at the threshold.

Edge cases: a NULL text is empty; texts below the threshold lose nothing; equal rows lose everything the strings
cover, each of them; overlapping occurrences in one text count; matches never cross texts; an empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import dropped, join_small, stored
from lakeload.llm.repeats import ROWS, Units, compared, keyed, repeated_rows

THRESHOLD = 200
CORE = 64


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by the ranges; ranges that touch are one run."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1])))
    return list(zip(starts[new].tolist(), ends[np.append(new[1:] - 1, len(ends) - 1)].tolist()))


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD, core: int = CORE) -> tuple[DataFrame, DataFrame, list[str]]:
    """(keyed documents, spans, paths): spans (rkey, s, e) of bytes, overlapping, that cover all repeated strings;
    ``paths`` are the tables that they are computed from."""
    units = Units(words=False, window=threshold, core=core)
    k = keyed(docs, "doc_id", "text")
    again, contexts, paths = repeated_rows(k, units)
    whole = F.struct(F.shiftright("pos", 12).alias("s"),
                     (F.shiftright("pos", 12) + F.col("pos").bitwiseAND(F.lit(4095)) - 1 + threshold).alias("e"))
    plain = again.where(~F.col("mixed")).select("rkey", whole.alias("x"))
    many = contexts.where(F.col("mixed") & (F.col("n") > 1)).select("core", "ctx")
    copies = join_small(again.where("mixed"), many, ["core", "ctx"], "left_semi").select("rkey", whole.alias("x"))
    some = compared(k, contexts, units, earlier=False).where(F.col("n") == 1).select("rkey", "s", F.explode("ranges").alias("r"))
    some = some.select("rkey", F.struct((F.col("s") + F.col("r.a")).alias("s"), (F.col("s") + F.col("r.b") - 1 + threshold).alias("e")).alias("x"))
    return k, plain.union(copies).union(some).select("rkey", "x.s", "x.e"), paths


def span_lists(spans: DataFrame) -> DataFrame:
    """(rkey, x): the spans of a row key, each once; equal rows have one row key and the same spans."""
    return spans.groupBy("rkey").agg(F.collect_set(F.struct("s", "e")).alias("x"))


def deduplicate(docs: DataFrame, threshold: int = THRESHOLD, core: int = CORE, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) per row of ``docs`` (doc_id, text); with ``digest``
    kept_sha256 instead of kept."""
    k, spans, paths = repeated_spans(docs.select("doc_id", "text"), threshold, core)
    lists, _ = stored(span_lists(spans), "spans")
    for path in paths:
        dropped(docs.sparkSession, path)
    lists = lists.select("rkey", F.col("x.s").alias("starts"), F.col("x.e").alias("ends"))
    joined = k.join(lists, "rkey", "left").select("doc_id", "text", "starts", "ends")
    kind = docs.schema["doc_id"].dataType.simpleString()
    last = "kept_sha256 string" if digest else "kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part, rows = batch.slice(begin, ROWS), []
                for text, a, b in zip(part.column(1).cast(pa.binary()), part.column(2), part.column(3)):
                    data, n_removed, found = text.as_py(), 0, []
                    if a.is_valid:
                        found = merged(a.values.to_numpy(), b.values.to_numpy())
                    pieces, at = [], 0
                    for s, e in found:
                        pieces.append(data[at:s])
                        n_removed, at = n_removed + e - s, e
                    pieces.append(data[at:])
                    kept = b"".join(pieces)
                    rows.append((len(data), n_removed, len(found), hashlib.sha256(kept).hexdigest() if digest else kept))
                types = [pa.int64()] * 3 + [pa.string() if digest else pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", last.split(" ")[0]])

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, {last}")
