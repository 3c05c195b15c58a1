"""Near-duplicate embeddings: iterative quantisation codes, multi-index Hamming tables, exact reranking.

A rotation of the centred, normalised vectors is learned on a bounded sample so that signs give balanced codes of
little quantisation error.  Every distinct vector is indexed in several tables, each keyed by a few bits of its code;
vectors that share a key are compared by cosine in double precision with the original vectors.  Pairs at the very
threshold are made from the sample and coded; tables are added until a share 1 - MISS of these pairs meets in one.  The
number of bits is the one of least cost for the largest label; without bits a label is compared whole, in cells.  A
pair is counted in the first table it shares.

Rotation, bits and tables are chosen for each vector length by itself.

Edge cases: vectors that are NULL, empty, zero or hold NULL, NaN or infinite components, and rows without a label,
link with nothing and are their own component; vectors of different length never link; equal vectors of a label are
one node however many rows have them; a NULL id is linked like others but never a component's id (NULL when all are);
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import shared, unit_hash
from lakeload.llm.graphs import SPLIT, cells, components
from lakeload.llm.simhash import merge_labels, runs

THRESHOLD = 0.93
# At most about this many vectors are used to learn a rotation.
SAMPLE = 20_000
ROUNDS = 50
MISS = 0.01
MAX_BITS = 24
# Pairs at the threshold that tables are measured on, of each kind.
PAIRS = 4096
# The cost of a copy of a vector in a cell, in comparisons of two vectors.
COPY = 256
SEED = 7


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def learn(x: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection to at most 64 signed coordinates) of unit vectors by iterative quantisation."""
    mean = x.mean(axis=0)
    c = x - mean
    _, axes = np.linalg.eigh(c.T @ c)
    axes = axes[:, ::-1][:, :64]
    v = c @ axes
    turn = np.linalg.qr(np.random.default_rng(SEED).standard_normal((v.shape[1],) * 2))[0]
    for _ in range(rounds):
        signs = np.where(v @ turn >= 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(signs.T @ v)
        turn = (u @ w).T
    return mean, axes @ turn


def codes(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    bits = ((x - model[0]) @ model[1] >= 0).astype(np.uint8)
    full = np.zeros((len(x), 64), np.uint8)
    full[:, :bits.shape[1]] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u8").ravel()


def threshold_pairs(x: np.ndarray, model: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """The bits that differ in pairs of cosine ``threshold``: a row for partners of vectors of ``x`` in any direction,
    a row for partners towards other vectors of ``x``."""
    rng = np.random.default_rng(SEED)
    own, out = x[rng.integers(len(x), size=PAIRS)], []
    free = rng.standard_normal(own.shape)
    for way in (free, x[rng.integers(len(x), size=PAIRS)]):
        way = way - (way * own).sum(axis=1, keepdims=True) * own
        size = np.sqrt((way * way).sum(axis=1, keepdims=True))
        way = np.where(size > 1e-6, way / np.maximum(size, 1e-6), 0.0)  # no other direction: the partner is the vector itself
        out.append(codes(own, model) ^ codes(unit(threshold * own + math.sqrt(1 - threshold ** 2) * way), model))
    return np.stack(out)


def random_pairs(width: int, threshold: float = THRESHOLD) -> np.ndarray:
    """The bits that differ in pairs of cosine ``threshold`` if each of ``width`` bits is the side of a random plane."""
    differ = np.zeros((PAIRS, 64), np.uint8)
    differ[:, :width] = np.random.default_rng(SEED).random((PAIRS, width)) < math.acos(threshold) / math.pi
    return np.packbits(differ, axis=1, bitorder="little").view("<u8").reshape(1, -1)


def tables_needed(n: int, width: int, differ: np.ndarray, most: int = 1 << 16) -> int | None:
    """How many tables of ``n`` of ``width`` bits, drawn without replacement, let 1 - MISS of each row's pairs meet."""
    shares = np.array([np.bincount(np.bitwise_count(row), minlength=width + 1) / len(row) for row in differ])
    alike = np.array([math.comb(width - d, n) / math.comb(width, n) for d in range(width + 1)])
    meet = lambda t: (shares @ (1 - (1 - alike) ** t)).min()
    lo, hi = 1, min(most, math.comb(width, n))
    if meet(hi) < 1 - MISS:
        return None
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if meet(mid) >= 1 - MISS else (mid + 1, hi)
    return lo


def drawn_masks(n: int, width: int, differ: np.ndarray, most: int) -> list[int] | None:
    """Distinct masks of ``n`` bits, until 1 - MISS of each row's pairs meet; None if ``most`` draws are too few."""
    rng, pool, out = np.random.default_rng(SEED), [], []
    met = np.zeros(differ.shape, bool)
    for _ in range(most):
        if len(pool) < n:
            more = rng.permutation(width).tolist()
            pool += [b for b in more if b not in pool] + [b for b in more if b in pool]
        own, rest = [], []
        for b in pool:
            (own if len(own) < n and b not in own else rest).append(b)
        pool = rest
        mask = sum(1 << b for b in own)
        if mask not in out:
            out.append(mask)
            met |= (differ & np.uint64(mask)) == 0
            if met.mean(axis=1).min() >= 1 - MISS:
                return out
    return None


def table_masks(width: int, largest: int, threshold: float = THRESHOLD, differ: np.ndarray | None = None) -> list[int]:
    """The bits of each table: ``width`` bits are in use, ``largest`` vectors in the largest label, ``differ`` the bits
    that differ in pairs at the threshold.  One mask without bits compares all vectors of a label."""
    differ = random_pairs(width, threshold) if differ is None else differ
    ways = []
    for n in range(min(MAX_BITS, width) + 1):
        tables, group = tables_needed(n, width, differ), max(largest, 1) / 2 ** n
        if tables:
            ways.append((tables * (math.ceil(math.sqrt(group) / SPLIT) * COPY + group), n, tables))
    for _, n, tables in sorted(ways):
        found = drawn_masks(n, width, differ, 4 * tables)
        if found:
            return found
    return [0]


def cell_pairs(x: np.ndarray, code: np.ndarray, weight: np.ndarray, block: np.ndarray, lo: int, hi: int, earlier: list[int],
               threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links counted here by weight, component label) of each vector of a cell."""
    n = len(x)
    links, labels = np.zeros(n, np.int64), np.arange(n)
    own, asked = (np.arange(n),) * 2 if lo == hi else (np.flatnonzero(block == lo), np.flatnonzero(block == hi))
    masks = [np.uint64(m) for m in earlier]
    for at in range(0, len(asked), 512):
        part = asked[at:at + 512]
        i, j = np.nonzero(x[part] @ x[own].T >= threshold)
        i, j = part[i], own[j]
        if lo == hi:
            i, j = i[i < j], j[i < j]
        differ, new = code[i] ^ code[j], np.ones(len(i), bool)
        for m in masks:
            new &= (differ & m) != 0
        i, j = i[new], j[new]
        links += np.bincount(i, weight[j], n).astype(np.int64) + np.bincount(j, weight[i], n).astype(np.int64)
        labels = merge_labels(labels, i, j)
    return links, labels


def nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, distinct): rows (vec_id, h1, h2; NULL hashes where the vector links with nothing), and distinct vectors
    (node, h1, h2, label, dim, weight, first_id, embedding).  Two 64-bit hashes stand for label and vector."""
    e = F.col("embedding")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ok = F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0) & F.forall(e, fine) & F.exists(e, lambda x: x != 0)
    ok = F.coalesce(ok, F.lit(False))
    marked = vectors.select("vec_id", "label", "embedding", ok.alias("ok")).select(
        "vec_id", "label", "embedding", *[F.when(F.col("ok"), F.xxhash64(F.lit(k), "label", "embedding")).alias(f"h{k}") for k in (1, 2)])
    groups = marked.where(F.col("h1").isNotNull()).groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("weight"),
        F.min("vec_id").alias("first_id"))
    distinct = shared(groups.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "label", F.size("embedding").alias("dim"),
                                    "weight", "first_id", "embedding"))
    return marked.select("vec_id", "h1", "h2"), distinct


def fit(distinct: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> tuple[dict[int, tuple], dict[int, np.ndarray]]:
    """(rotations, differing bits of pairs at the threshold) for each vector length, learned on about ``sample`` vectors
    at most, chosen by hash."""
    models, differ = {}, {}
    for dim, n in [tuple(r) for r in distinct.groupBy("dim").count().collect()]:
        part = distinct.where((F.col("dim") == dim) & (unit_hash("itq", F.col("h1"), F.col("h2")) < min(1.0, sample / n))).select("embedding")
        got = part.toArrow().column(0).combine_chunks()
        x = unit(matrix(got, dim)) if len(got) else np.eye(dim)
        models[dim] = learn(x)
        differ[dim] = threshold_pairs(x, models[dim], threshold)
    return models, differ


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors`` (vec_id, embedding, label)."""
    rows, distinct = nodes(vectors)
    models, differ = fit(distinct, sample, threshold)
    largest = distinct.groupBy("label", "dim").count().groupBy("dim").agg(F.max("count"))
    masks = {dim: table_masks(min(64, dim), n, threshold, differ[dim]) for dim, n in [tuple(r) for r in largest.collect()]}
    signed = {dim: [m - (1 << 64) if m >> 63 else m for m in own] for dim, own in masks.items()}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, out = batch.column(1).to_numpy(), np.zeros(batch.num_rows, np.uint64)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                out[at] = codes(unit(matrix(batch.column(2).take(pa.array(at)), d)), models[d])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], ["node", "code"])

    code = distinct.select("node", "dim", "embedding").mapInArrow(encode, "node long, code long")
    tables = F.create_map(*[c for dim, own in {0: [], **signed}.items() for c in (F.lit(dim), F.array(*map(F.lit, own)).cast("array<bigint>"))])
    coded = shared(code)
    entries = coded.join(distinct.select("node", "label", "dim"), "node").select(
        "node", "code", "label", "dim", F.posexplode(F.element_at(tables, F.col("dim"))).alias("t", "mask"))
    entries = entries.select("node", "code", "label", "dim", "t", F.col("code").bitwiseAND(F.col("mask")).alias("key"))
    dealt = cells(entries, ["label", "dim", "t", "key"], "node").join(distinct.select("node", "weight", "embedding"), "node")
    order = ["label", "dim", "t", "key", "lo", "hi"]

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part in runs(batches, 6):
            node, own = part.column(6).to_numpy(), part.column(7).to_numpy().view(np.uint64)
            links, labels = cell_pairs(unit(matrix(part.column(10), int(key[1]))), own, part.column(9).to_numpy(),
                                       part.column(8).to_numpy(), key[4], key[5], masks[int(key[1])][:int(key[2])], threshold)
            at = np.flatnonzero(links)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node[at], links[at], node[labels[at]])], ["node", "links", "root"])

    found = dealt.select(*order, "node", "code", "block", "weight", "embedding").repartition(*order).sortWithinPartitions(*order)
    found = shared(found.mapInArrow(rerank, "node long, links long, root long"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = shared(distinct.select("node", "h1", "h2", "weight", "first_id").join(counted, "node", "left")
                   .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    ids = whole.groupBy("root").agg(F.min("first_id").alias("component_id"))
    side = shared(whole.join(ids, "root").select(
        F.col("h1").alias("k1"), F.col("h2").alias("k2"), "component_id",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")))
    out = rows.join(side, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    alone = F.col("h1").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
