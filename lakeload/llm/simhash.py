"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints that differ in at most k of 64 bits are linked.  Distinct fingerprints are routed by bits that such a
pair must share (k + 1 blocks, and k + 1 blocks of the rest), so linked ones meet in a group; within a cell of a
group they are sorted by Gray rank, and a tree over runs of that order holds at each node the bits that all below
share beyond its parent's.  Differences accumulate down the tree and a whole subtree is left once they exceed k.
A cell returns a spanning forest of its links, never all pairs; components are joined over all cells.

Edge cases: no words (NULL or empty text) give the fingerprint 0, linked like any other; fewer words than a shingle
give one shingle of all words; equal fingerprints are one node however many rows have them; a NULL id is linked
like others but is never a component's id (NULL when all ids are); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import join_small, release, shared
from lakeload.llm.graphs import cells, components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
LEAF = 64
FAN = 8
BITS = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text: a bit is 1 if set in over half of the shingles' XXH64."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    total, counts = len(words) - shingle + 1, np.zeros(BITS, np.int64)
    for at in range(0, total, 1 << 16):
        part = words[at:min(at + (1 << 16), total) + shingle - 1]
        h = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(shingle)))]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * counts > total).tolist())


def with_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp the fingerprint as a signed long."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found = [fingerprint(v.as_py() or b"", shingle) for v in batch.column(1).cast(pa.binary())]
            fps = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, fp long")


def masks(k: int) -> list[int]:
    """Masks of which one at least is equal in any two fingerprints that differ in at most ``k`` bits."""
    cut = lambda bits: [bits[len(bits) * i // (k + 1):len(bits) * (i + 1) // (k + 1)] for i in range(k + 1)]
    out = []
    for own in cut(list(range(BITS))):
        rest = [b for b in range(BITS) if b not in own]
        out += [sum(1 << b for b in own + more) for more in cut(rest)]
    return out


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """The position of each fingerprint in the Gray code."""
    out = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class GrayIndex:
    """The tree over fingerprints in Gray order: per level, from the top, each node's pattern, its mask of shared
    bits beyond its parent's, and its range of nodes on the level below."""

    def __init__(self, fps: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        self.fps = fps[self.order]
        shared_bits = lambda lo, hi: ~(lo ^ hi)  # noqa: E731  all agree where AND and OR agree
        starts = np.arange(0, len(fps), leaf)
        low, high = np.bitwise_and.reduceat(self.fps, starts), np.bitwise_or.reduceat(self.fps, starts)
        levels = [(low, shared_bits(low, high), starts, np.append(starts[1:], len(fps)))]
        while len(levels[-1][0]) > fan:
            n = len(low)
            starts = np.arange(0, n, fan)
            low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
            levels.append((low, shared_bits(low, high), starts, np.append(starts[1:], n)))
        self.levels = []
        above = None
        for pattern, mask, begin, end in reversed(levels):
            own = mask if above is None else mask & ~np.repeat(above[0], above[2] - above[1])
            self.levels.append((pattern, own, begin, end))
            above = (mask, begin, end)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, position in the input) of all pairs within ``k`` bits."""
        n = len(self.levels[0][0])
        q, node = np.repeat(np.arange(len(queries)), n), np.tile(np.arange(n), len(queries))
        seen = np.zeros(len(q), np.int64)
        for pattern, own, begin, end in self.levels:
            seen = seen + np.bitwise_count((queries[q] ^ pattern[node]) & own[node])
            near = seen <= k
            q, node, seen = q[near], node[near], seen[near]
            width = end[node] - begin[node]
            first = np.repeat(begin[node], width)
            step = np.arange(len(first)) - np.repeat(np.cumsum(width) - width, width)
            q, seen, node = np.repeat(q, width), np.repeat(seen, width), first + step
        near = np.bitwise_count(queries[q] ^ self.fps[node]) <= k
        return q[near], self.order[node[near]]


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels after linking a[i] with b[i]."""
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return labels
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]


def cell_links(fps: np.ndarray, block: np.ndarray, lo: int, hi: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in one cell, as positions (member, root).  A cell of two blocks compares one
    with the other; the pairs within each block are those of the cells (lo, lo) and (hi, hi)."""
    n = len(fps)
    labels = np.arange(n)
    own, asked = (np.arange(n),) * 2 if lo == hi else (np.flatnonzero(block == lo), np.flatnonzero(block == hi))
    if len(own) and len(asked):
        index = GrayIndex(fps[own])
        for at in range(0, len(asked), 256):
            part = asked[at:at + 256]
            q, found = index.search(fps[part], k)
            labels = merge_labels(labels, part[q], own[found])
    member = np.flatnonzero(labels != np.arange(n))
    return member, labels[member]


def links(fps: DataFrame, k: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect what fingerprints within ``k`` bits connect; ``fps`` has distinct fp."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(k)]
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    rows = fps.select("fp", F.inline(keys))
    dealt = cells(rows, ["t", "key"], "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part in runs(batches, 4):
            f = part.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
            a, b = cell_links(f, part.column(5).to_numpy(zero_copy_only=False), key[2], key[3], k)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(f[a].view(np.int64)), pa.array(f[b].view(np.int64))], ["a", "b"])

    ordered = dealt.select("t", "key", "lo", "hi", "fp", "block").repartition("t", "key", "lo", "hi")
    return ordered.sortWithinPartitions("t", "key", "lo", "hi").mapInArrow(run, "a long, b long").distinct()


def runs(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The runs of equal first ``n`` columns in sorted batches, with the values of those columns."""
    held: list[pa.RecordBatch] = []
    last = None

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n)]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist()]
        for s, e in zip(starts, [*starts[1:], batch.num_rows]):
            key = tuple(c[s] for c in cols)
            if held and key != last:
                yield last, joined()
                held = []
            held.append(batch.slice(s, e - s))
            last = key
    if held:
        yield last, joined()


def groups(prints: DataFrame, k: int = MAX_BITS) -> DataFrame:
    """(fp, component_fp, component_id) for each distinct fp of (doc_id, fp)."""
    fps = shared(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(fps.select("fp"), k)).select(F.col("node").alias("fp"), "root")
    rooted = shared(fps.join(shared(roots), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    ids = shared(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return rooted.join(ids, "root").select("fp", F.col("root").alias("component_fp"), "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    k: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest id reachable), one row per row of ``docs``."""
    prints = shared(with_fingerprints(docs, doc_id, text, shingle))
    found = prints.join(shared(groups(prints, k)), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, k: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per component, that of the smallest id (of rows that share it, any one; a component
    without ids keeps one row)."""
    prints = shared(with_fingerprints(docs, doc_id, text, shingle))
    best = shared(groups(prints, k).where(F.col("fp").isNotNull()))
    # the fingerprint of the row to keep: one per component
    owners = prints.join(best, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    owners = shared(owners.groupBy("component_fp").agg(F.min(F.struct("doc_id", "fp")).alias("own")).select("own.doc_id", "own.fp"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("doc_id"),
                       F.col(text).alias("text"))
    # an id whose rows have different fingerprints doesn't tell its rows apart, nor does NULL
    one = prints.groupBy("doc_id").agg((F.min("fp") == F.max("fp")).alias("one"))
    ids = shared(one.join(owners.select("doc_id").distinct(), "doc_id"))
    plain = ids.where("one").select("doc_id")
    named = rows.join(plain, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("row.*")
    shared_ids = ids.where(~F.col("one")).select("doc_id")
    odd = rows.where(F.col("doc_id").isNull()).unionByName(join_small(rows, shared_ids, "doc_id", "left_semi").select(rows.columns))
    return named.unionByName(_by_fingerprint(odd, owners, shingle))


def _by_fingerprint(rows: DataFrame, owners: DataFrame, shingle: int) -> DataFrame:
    """One of ``rows`` (row, doc_id, text) for each of their ids and fingerprints that ``owners`` names."""
    schema = rows.select("row", "doc_id", F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found = [fingerprint(v.as_py() or b"", shingle) for v in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())], ["row", "doc_id", "fp"])

    own = owners.select(F.col("doc_id").alias("own_id"), F.col("fp").alias("own_fp"))
    marked = rows.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)
    found = marked.join(own, (F.col("fp") == F.col("own_fp")) & F.col("doc_id").eqNullSafe(F.col("own_id")), "left_semi")
    return found.dropDuplicates(["doc_id", "fp"]).select("row.*")
