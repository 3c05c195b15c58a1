"""Windows that occur more than once: the engine under the two substring deduplications.

Texts are sequences of units (bytes or words).  Ranks of anchored positions are refined like the ranks of prefix
doubling: first by the core's units, positions of unique rank leave; then by the pair of that rank and the whole
context, which is past the window's length, so rows of equal pairs repeat as a whole.  What is left are distinct contexts with a
core in common; their windows are compared unit by unit.  Ranks are 64-bit hashes, so a row's pair has 128 bits.

Hot passages: cores and contexts are counted with partial aggregates, joins have a kept side so that AQE splits
skewed keys, and distinct contexts of one core are dealt into cells.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.anchors import all_owned, byte_grams, mix
from lakeload.llm.common import dropped, stored
from lakeload.llm.graphs import cells
from lakeload.llm.simhash import runs

# Row keys that stand for "no id" come after all ids.
LAST_ID = (1 << 63) - 1
ROWS = 256


@dataclass(frozen=True)
class Units:
    """How texts are cut: words (of ASCII white space) or bytes; a window's and a core's length in units."""

    words: bool
    window: int
    core: int

    def cut(self, text: bytes) -> tuple[bytes, np.ndarray | None, list[bytes] | None]:
        """(text of the units, their offsets (None: one byte each), the words if units are words)."""
        if not self.words:
            return text, None, None
        words = text.split()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return b" ".join(words), np.concatenate(([0], np.cumsum(lengths + 1))), words

    def hashes(self, body: bytes, words: list[bytes] | None) -> tuple[np.ndarray, int]:
        """(hash by position, number of units)."""
        if words is None:
            return byte_grams(body), len(body)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        return mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) else h, len(words)

    def part(self, body: bytes, at: np.ndarray | None, a: int, b: int) -> bytes:
        """The bytes of units a .. b - 1."""
        return body[a:b] if at is None else body[at[a]:at[b] - 1]


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(rkey, doc_id, oid, text): rkey a 64-bit hash of id and text that stands for the row (equal rows have equal
    results), oid the id for comparisons (NULL after all)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.xxhash64(F.lit(11), F.col(doc_id), body).alias("rkey"), F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("oid"), body.alias("text"))


def position_rows(keyed_docs: DataFrame, units: Units) -> DataFrame:
    """(core, ctx, rkey, oid, pos): a row for each run of windows with one owner; pos = first window << 12 | number."""
    width = units.window - units.core + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                cores, contexts, pos, counts = [], [], [], []
                for value in part.column(2).cast(pa.binary()):
                    body, at, words = units.cut(value.as_py())
                    hashes, n = units.hashes(body, words)
                    before = len(cores)
                    for first, count, owner in all_owned(hashes, n - units.window + 1, width):
                        pos.append(first << 12 | count)
                        last = first + count - 1 + units.window
                        bounds = [owner, owner + units.core, first, last]
                        if at is not None:
                            bounds = [at[b] - (k & 1) for k, b in enumerate(bounds)]
                        for a, b, c, d in zip(*(x.tolist() for x in bounds)):
                            cores.append(digest(body[a:b]))
                            contexts.append(digest(body[c:d]))
                    counts.append(len(cores) - before)
                whole = np.concatenate(pos) if pos else np.zeros(0, np.int64)
                own = lambda k: np.repeat(part.column(k).to_numpy(), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(cores, np.uint64).view(np.int64)), pa.array(np.array(contexts, np.uint64).view(np.int64)),
                     pa.array(own(0)), pa.array(own(1)), pa.array(whole)], ["core", "ctx", "rkey", "oid", "pos"])

    return keyed_docs.select("rkey", "oid", "text").mapInArrow(run, "core long, ctx long, rkey long, oid long, pos long")


def repeated_rows(keyed_docs: DataFrame, units: Units) -> tuple[DataFrame, DataFrame, list[str]]:
    """(rows, contexts, paths): the rows whose core repeats, with ``mixed`` where the core has several contexts, and
    per context its number of rows and first row; ``paths`` are the tables kept."""
    rows, path = stored(position_rows(keyed_docs, units), "positions")
    ranks = rows.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi"))
    ranks, ranks_path = stored(ranks.where(F.col("n") > 1).select("core", (F.col("lo") != F.col("hi")).alias("mixed")), "ranks")
    again, again_path = stored(rows.join(ranks, "core"), "repeated")
    dropped(rows.sparkSession, path)
    dropped(rows.sparkSession, ranks_path)
    contexts = again.groupBy("core", "ctx").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("oid", F.shiftright("pos", 12).alias("s"), "rkey", "pos")).alias("f"),
        F.first("mixed").alias("mixed"))
    contexts, contexts_path = stored(contexts.select("core", "ctx", "n", "f.oid", "f.s", "f.rkey", "f.pos", "mixed"), "contexts")
    return again, contexts, [again_path, contexts_path]


def compared(keyed_docs: DataFrame, contexts: DataFrame, units: Units, earlier: bool) -> DataFrame:
    """(core, ctx, rkey, s, n, ranges): for the first row of contexts in mixed cores the ranges (a, b) of its windows
    that another context of the core has too; with ``earlier`` only where that other one starts earlier.  Of equal rows
    a task fetches one, and a cell takes one."""
    narrow = cells(contexts.where("mixed").select("core", "ctx", "n", "oid", "s", "rkey", "pos"), ["core"], "ctx")
    fields = ["core", "ctx", "lo", "hi", "block", "n", "oid", "s", "pos"]
    asked = narrow.groupBy("rkey").agg(F.collect_list(F.struct(*[F.col(c).cast("long").alias(c) for c in fields])).alias("asked"))
    asked = asked.select("rkey", *[F.col(f"asked.{c}").alias(f"a_{c}") for c in fields])
    joined = keyed_docs.join(asked, "rkey")
    names = ["core", "lo", "hi", "ctx", "block", "n", "oid", "s", "rkey", "body"]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had: set[int] = set()
        for batch in batches:
            new = [i for i, k in enumerate(batch.column(0).to_pylist()) if not (k in had or had.add(k))]
            if len(new) < batch.num_rows:
                batch = batch.take(pa.array(new, pa.int64()))
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                lists = {n[2:]: part.column(i) for i, n in enumerate(part.schema.names) if n.startswith("a_")}
                flat = {k: v.flatten() for k, v in lists.items()}
                sizes = lists["pos"].value_lengths().to_numpy(zero_copy_only=False)
                pos, bodies, k = flat["pos"].to_numpy(zero_copy_only=False).tolist(), [], 0
                for value, many in zip(part.column(1).cast(pa.binary()), sizes.tolist()):
                    body, at, _ = units.cut(value.as_py())
                    for p in pos[k:k + many]:
                        first = p >> 12
                        bodies.append(units.part(body, at, first, first + (p & 4095) - 1 + units.window))
                    k += many
                own = pa.array(np.repeat(part.column(0).to_numpy(), sizes))
                yield pa.RecordBatch.from_arrays([*[flat[n] for n in names[:8]], own, pa.array(bodies, pa.binary())], names)

    bodies = joined.drop("doc_id", "oid").mapInArrow(fetch, ", ".join(f"{n} long" for n in names[:-1]) + ", body binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part in runs(batches, 3):
            out = same_windows(part, int(key[1]), int(key[2]), units, earlier)
            if out is not None:
                yield out

    dealt = bodies.repartition("core", "lo", "hi").sortWithinPartitions("core", "lo", "hi")
    return dealt.mapInArrow(compare, "core long, ctx long, n long, rkey long, s long, ranges array<struct<a:int,b:int>>")


def _spaces(body: bytes) -> list[int]:
    """The end of each word of words joined by single spaces."""
    return [*np.flatnonzero(np.frombuffer(body, np.uint8) == 32).tolist(), len(body)]


def same_windows(part: pa.RecordBatch, lo: int, hi: int, units: Units, earlier: bool) -> pa.RecordBatch | None:
    """The ranges of windows that contexts of one cell share."""
    one = np.sort(np.unique(part.column("ctx").to_numpy(zero_copy_only=False), return_index=True)[1])
    if len(one) < part.num_rows:
        part = part.take(pa.array(one))
    col = {n: part.column(i) for i, n in enumerate(part.schema.names)}
    oid, start = col["oid"].to_numpy(zero_copy_only=False).tolist(), col["s"].to_numpy(zero_copy_only=False).tolist()
    windows = []
    for body in col["body"].to_pylist():
        if units.words:
            ends = _spaces(body)
            at = [0, *(e + 1 for e in ends)]
            windows.append([body[at[i]:ends[i + units.window - 1]] for i in range(len(ends) - units.window + 1)])
        else:
            windows.append([body[i:i + units.window] for i in range(len(body) - units.window + 1)])
    keep, ranges = [], []
    if earlier:
        first: dict[bytes, tuple[int, int]] = {}
        for own, o, s in zip(windows, oid, start):
            for p, w in enumerate(own, s):
                had = first.get(w)
                if had is None or had > (o, p):
                    first[w] = (o, p)
        again = [[first[w] < (o, p) for p, w in enumerate(own, s)] for own, o, s in zip(windows, oid, start)]
    else:
        seen = Counter(w for own in windows for w in own)  # a context has no window twice
        again = [[seen[w] > 1 for w in own] for own in windows]
    for k, flags in enumerate(again):
        if any(flags):
            edge = np.flatnonzero(np.diff(np.array([0, *flags, 0], np.int8))).tolist()
            keep.append(k)
            ranges.append([{"a": a, "b": b} for a, b in zip(edge[::2], edge[1::2])])
    if not keep:
        return None
    take = pa.array(keep)
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    return pa.RecordBatch.from_arrays([*[col[n].take(take) for n in ("core", "ctx", "n", "rkey", "s")], pa.array(ranges, kind)],
                                      ["core", "ctx", "n", "rkey", "s", "ranges"])
