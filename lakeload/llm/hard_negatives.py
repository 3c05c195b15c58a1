"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates are laid out in the order of a Hilbert curve over the leading principal axes (learned on a bounded sample)
and stored as a Parquet table of blocks of at most ``BLOCK`` vectors of one label, each with the minimum and maximum of
every dimension.  Interval arithmetic over these gives the least and the largest score that an anchor can have with a
block.  An anchor reads the blocks of its label that can hold one of its best partners (the floor comes from its own
block), and of other labels those whose range meets one of its score windows; blocks that certainly lie inside a window
raise the floor that others must reach.  Only chosen blocks are scored.  All scores are exact integers.

Anchors and blocks meet in cells of bounded size: zone maps and anchors are dealt over a grid of hashes, chosen blocks
and the anchors that need them over (pack of anchors, hash of the block).  A cell gives each anchor's best rows only.

Edge cases: rows without an id, a label or a vector, and vectors that are empty or hold NULL, NaN or infinite components
take no part; vectors of different length never meet; repeated rows are rows of their own (of equal score and id it does
not matter which is first), also as anchors; ties go by the smaller id; anchors without positives, and positives without
negatives in their window, give no rows; scores beyond 2^61 either way count as that; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.common import stored, unit_hash

POSITIVES, NEGATIVES = 5, 10
# A negative's score is at least 30 and at most 90 percent of the positive's.
LEAST, MOST = 30, 90
SCALE = 256
BLOCK = 512
SAMPLE = 20_000
# Axes and bits of the Hilbert key: at most 63 bits in all.
AXES, KEY_BITS = 9, 63
# Blocks whose anchors are one pack, packs and zone maps of a cell, and chosen blocks of a cell (about, by hash).
PACK_BLOCKS, CELL_PACKS, CELL_ZONES, CELL_BLOCKS = 64, 16, 512, 64
# Anchors scored at a time.
SLICE = 1024
# Scores are cut to this range, components (as integers) to 64 bits.
BIG = 1 << 61


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """The place on a Hilbert curve of points with integer coordinates of ``bits`` bits (Skilling's transposition)."""
    x = x.astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(len(x)):
            on, p = (x[i] & q) != 0, q - 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | axis >> b & 1
    return key


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, exact: in double precision where that holds all sums, else with Python's integers (objects)."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    size = [max(float(x.max()), -float(x.min())) for x in (a, b)]
    if size[0] * size[1] * a.shape[1] < 2.0 ** 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(object) @ b.astype(object).T


def cut(scores: np.ndarray) -> np.ndarray:
    return np.clip(scores, -BIG, BIG).astype(np.int64) if scores.dtype == object else scores


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest possible score of each anchor with each block, by interval arithmetic."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return cut(product(up, lo) + product(down, hi)), cut(product(up, hi) + product(down, lo))


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The places of the ``n`` highest scores, of equal ones those of the smallest ids."""
    keep = np.arange(len(scores))
    if len(scores) > 4 * n:
        keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
    return keep[np.lexsort((ids[keep], -scores[keep]))[:n]]


def pack_ints(x: np.ndarray) -> bytes:
    return x.astype("<i2" if not x.size or max(x.max(), -x.min()) < 1 << 15 else "<i8").tobytes()


def unpack_ints(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<i2" if len(data) == 2 * n * dim else "<i8").reshape(n, dim).astype(np.int64)


def prepared(vectors: DataFrame) -> DataFrame:
    """row, vec_id, label, dim, q: the rows that take part."""
    e = F.col("embedding")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0) & F.forall(e, fine)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", "label", "embedding").where(ok).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.size(e).alias("dim"), F.transform(e, lambda x: F.floor(x.cast("double") * SCALE)).alias("q"))


def axes(rows: DataFrame, sample: int = SAMPLE) -> dict[int, tuple]:
    """(mean, axes, least, width) for each vector length, learned on about ``sample`` vectors at most, chosen by hash."""
    models = {}
    for dim, n in [tuple(r) for r in rows.groupBy("dim").count().collect()]:
        part = rows.where((F.col("dim") == dim) & (unit_hash("hilbert", F.col("vec_id"), F.col("row")) < min(1.0, sample / n)))
        got = part.select("q").toArrow().column(0).combine_chunks()
        x = got.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64) if len(got) else np.eye(dim)
        mean = x.mean(axis=0)
        main = np.linalg.eigh((x - mean).T @ (x - mean))[1][:, ::-1][:, :AXES]
        y = (x - mean) @ main
        models[dim] = mean, main, y.min(axis=0), np.maximum(np.ptp(y, axis=0), 1e-9)
    return models


def keyed(rows: DataFrame, models: dict[int, tuple]) -> DataFrame:
    """``rows`` with their Hilbert key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, out = batch.column(3).to_numpy(), np.zeros(batch.num_rows, np.int64)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = batch.column(4).take(pa.array(at)).flatten().to_numpy().reshape(-1, d)
                mean, main, least, width = models[d]
                bits = min(16, KEY_BITS // main.shape[1])
                out[at] = hilbert(np.clip(((x - mean) @ main - least) / width, 0, 1) * ((1 << bits) - 1), bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], ["row", "vec_id", "label", "dim", "q", "key"])

    return rows.mapInArrow(run, "row long, vec_id long, label long, dim int, q array<long>, key long")


def blocks(rows: DataFrame) -> DataFrame:
    """The stored table of blocks: block, pack, label, dim, n, rows, ids, data, and the zone map lo, hi."""
    order = ["dim", "label", "key", "vec_id", "row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("dim", "label", "row", "vec_id", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, key = TaskContext.get().partitionId(), 0, None, None

        def block(own: pa.Table) -> pa.RecordBatch:
            own = own.combine_chunks()
            dim, x = key[0], own.column(4).combine_chunks().flatten().to_numpy().reshape(-1, key[0])
            at = part << 32 | seq
            cells = [at, part << 32 | seq // PACK_BLOCKS, key[1], dim, len(x), own.column(2).to_pylist(), own.column(3).to_pylist(),
                     pack_ints(x), pack_ints(x.min(axis=0)[None]), pack_ints(x.max(axis=0)[None])]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)],
                                              ["block", "pack", "label", "dim", "n", "rows", "ids", "data", "lo", "hi"])

        for batch in batches:
            dims, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            change = np.flatnonzero((dims[1:] != dims[:-1]) | (labels[1:] != labels[:-1])) + 1
            starts = [0, *change.tolist()] if batch.num_rows else []
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                now = (int(dims[s]), int(labels[s]))
                if held is not None and now != key:
                    yield block(held)
                    seq, held = seq + 1, None
                key, piece = now, pa.Table.from_batches([batch.slice(s, e - s)])
                held = piece if held is None else pa.concat_tables([held, piece])
                while held.num_rows >= BLOCK:
                    yield block(held.slice(0, BLOCK))
                    seq, held = seq + 1, held.slice(BLOCK)
                if not held.num_rows:
                    held = None
        if held is not None:
            yield block(held)

    sheet = ("block long, pack long, label long, dim int, n int, rows array<long>, ids array<long>, data binary, lo binary, hi binary")
    return stored(dealt.mapInArrow(run, sheet), "blocks")[0]


def anchors_of(table: DataFrame, every: int, positives: int) -> DataFrame:
    """The anchors in the blocks: row, id, label, dim, pack, vec, and the score that a best partner has at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                ids, x = np.array(r["ids"]), unpack_ints(r["data"], r["n"], r["dim"])
                at = np.flatnonzero(ids % every == 0)
                out = []
                for j in at.tolist():
                    s = np.delete(cut(product(x[j:j + 1], x))[0], j)
                    floor = -BIG if len(s) < positives else int(np.partition(s, len(s) - positives)[len(s) - positives])
                    out.append((r["rows"][j], int(ids[j]), r["label"], r["dim"], r["pack"], pack_ints(x[j:j + 1]), floor))
                if out:
                    kinds = [pa.int64()] * 3 + [pa.int32(), pa.int64(), pa.binary(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                     ["row", "id", "label", "dim", "pack", "vec", "floor"])

    sheet = "row long, id long, label long, dim int, pack long, vec binary, floor long"
    found = table.select("rows", "ids", "label", "dim", "pack", "n", "data").mapInArrow(run, sheet)
    return stored(found, "anchors")[0]


def _windows(anchors: dict) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) score of each anchor's windows, an empty one where an anchor has fewer."""
    width = max([1, *map(len, anchors["scores"])])
    lo, hi = np.full((len(anchors["row"]), width), BIG + 1), np.full((len(anchors["row"]), width), -BIG - 1)
    for i, scores in enumerate(anchors["scores"]):
        for w, s in enumerate(scores):
            lo[i, w], hi[i, w] = -(-LEAST * s // 100), MOST * s // 100
    return lo, hi


def _vectors(anchors: dict, dim: int) -> np.ndarray:
    return np.concatenate([unpack_ints(v, 1, dim) for v in anchors["vec"]])


def choose(table: DataFrame, anchors: DataFrame, negatives: int | None) -> DataFrame:
    """(block, pack, needed): the blocks that anchors of a pack must read, and which anchors.  Without ``negatives`` the
    blocks of an anchor's label that reach its floor, else those of other labels that meet one of its windows."""
    zones, packs = table.count(), anchors.select("pack").distinct().count()
    g, h = max(1, math.ceil(zones / CELL_ZONES)), max(1, math.ceil(packs / CELL_PACKS))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = table.select("dim", "block", "label", "n", "lo", "hi", F.pmod(F.xxhash64("block"), F.lit(g)).cast("int").alias("g"), spread(h).alias("h"))
    own = ["row", "label", "pack", "vec", "floor", *(["scores"] if negatives else [])]
    right = anchors.select("dim", *own, F.pmod(F.xxhash64("pack"), F.lit(h)).cast("int").alias("h"), spread(g).alias("g"))

    def cell(key: tuple, zone: pa.Table, asked: pa.Table) -> pa.Table:
        dim, z, a, out = key[0].as_py(), zone.to_pydict(), asked.to_pydict(), {}
        if z["block"] and a["row"]:
            lo, hi = (np.concatenate([unpack_ints(v, 1, dim) for v in z[c]]) for c in ("lo", "hi"))
            labels, sizes = np.array(z["label"]), np.array(z["n"])
            for at in range(0, len(a["row"]), SLICE):
                part = {c: v[at:at + SLICE] for c, v in a.items()}
                least, most = bounds(_vectors(part, dim), lo, hi)
                same = np.array(part["label"])[:, None] == labels
                if negatives is None:
                    need = same & (most >= np.array(part["floor"])[:, None])
                else:
                    need, (low, high) = np.zeros_like(same), _windows(part)
                    for w in range(low.shape[1]):
                        l, u = low[:, w, None], high[:, w, None]  # noqa: E741
                        inside = ~same & (least >= l) & (most <= u) & (sizes >= negatives)
                        floor = np.where(inside, least, l).max(axis=1, keepdims=True)
                        need |= ~same & (least <= u) & (most >= floor) & (l <= u)
                for i, j in zip(*np.nonzero(need)):
                    out.setdefault((z["block"][j], part["pack"][i]), []).append(part["row"][i])
        return pa.table([pa.array([k[0] for k in out], pa.int64()), pa.array([k[1] for k in out], pa.int64()),
                         pa.array(list(out.values()), pa.list_(pa.int64()))], ["block", "pack", "needed"])

    keys = ["dim", "g", "h"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "block long, pack long, needed array<long>")


def read(table: DataFrame, anchors: DataFrame, chosen: DataFrame, positives: int, negatives: int | None) -> DataFrame:
    """(row, place, other, other_id, score): each anchor's best rows in each cell of chosen blocks; ``place`` is the window
    (0 for positives)."""
    s = max(1, math.ceil(table.count() / CELL_BLOCKS))
    left = chosen.join(table.select("block", "dim", "n", "rows", "ids", "data"), "block").select(
        "pack", F.pmod(F.xxhash64("block"), F.lit(s)).cast("int").alias("s"), "needed", "dim", "n", "rows", "ids", "data")
    own = ["row", "vec", *(["scores"] if negatives else [])]
    right = anchors.select("pack", F.explode(F.sequence(F.lit(0), F.lit(s - 1))).alias("s"), "dim", *own)

    def cell(picked: pa.Table, asked: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], list] = {}
        a = asked.select(own).to_pydict()
        place = {r: i for i, r in enumerate(a["row"])}
        low, high = _windows(a) if negatives and a["row"] else (None, None)
        n = negatives or positives
        for p in (picked.slice(i, 1).to_pylist()[0] for i in range(picked.num_rows)):
            x, ids, rows = unpack_ints(p["data"], p["n"], p["dim"]), np.array(p["ids"]), np.array(p["rows"])
            needed = [place[r] for r in p["needed"]]
            for at in range(0, len(needed), SLICE):
                part = needed[at:at + SLICE]
                scores = cut(product(np.concatenate([unpack_ints(a["vec"][i], 1, p["dim"]) for i in part]), x))
                for i, got in zip(part, scores):
                    for w in range(low.shape[1] if negatives else 1):
                        keep = np.flatnonzero((got >= low[i, w]) & (got <= high[i, w]) if negatives else rows != a["row"][i])
                        if len(keep):
                            keep = keep[best(got[keep], ids[keep], n)]
                            found.setdefault((a["row"][i], w), []).extend(zip((-got[keep]).tolist(), ids[keep].tolist(), rows[keep].tolist()))
        out = []
        for (r, w), rows in found.items():
            out += [(r, w, other, i, -m) for m, i, other in sorted(rows)[:n]]
        cols = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], ["row", "place", "other", "other_id", "score"])

    keys = ["pack", "s"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "row long, place int, other long, other_id long, score long")


def ranked(found: DataFrame, n: int) -> DataFrame:
    """The best ``n`` rows of each anchor and window, with their rank."""
    order = Window.partitionBy("row", "place").orderBy(F.col("score").desc(), "other_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for ``vectors`` (vec_id, embedding,
    label); anchors are rows whose id ``every`` divides."""
    rows = prepared(vectors)
    table = blocks(keyed(rows, axes(rows)))
    anchors = anchors_of(table, every, positives)
    near = ranked(read(table, anchors, choose(table, anchors, None), positives, None), positives)
    lists = near.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "other_id", "score"))).alias("near"))  # at most ``positives``
    own = stored(anchors.join(lists, "row").withColumn("scores", _of("near", "score")), "windows")[0]
    far = ranked(read(table, own, choose(table, own, negatives), positives, negatives), negatives)
    found = far.join(own.select("row", F.col("id").alias("anchor_id"), "near"), "row")
    pair = F.element_at("near", F.col("place") + 1)
    return found.select("anchor_id", pair["other_id"].alias("positive_id"), "rank", F.col("other_id").alias("negative_id"),
                        pair["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def _of(array: str, field: str) -> Column:
    return F.transform(array, lambda x: x[field])
