"""Hard-negative mining against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeload.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(rows):
    fine = []
    for vec_id, e, label in rows:
        if vec_id is None or label is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        fine.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in e]))
    out = []
    for i, (a, label, q) in enumerate(fine):
        if a % 100:
            continue
        cut = lambda s: min(max(s, -H.BIG), H.BIG)
        scored = sorted((-cut(sum(x * y for x, y in zip(q, r))), b, other) for j, (b, other, r) in enumerate(fine) if j != i and len(r) == len(q))
        for p, (m, pid, _) in enumerate([s for s in scored if s[2] == label][:5]):
            window = [s for s in scored if s[2] != label and 30 * -m <= 100 * -s[0] <= 90 * -m][:10]
            out += [(a, pid, k, s[1], -m, -s[0]) for k, s in enumerate(window, 1)]
    return sorted(out)


def vectors(n, dim=12, seed=3):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rnd.choice(centres)
        rows.append((i * 5, [x + rnd.gauss(0, 0.5) for x in c], rnd.choice([0, 1, 2, None])))
    rows += [(20_000 + i, rows[4][1], i % 2) for i in range(150)]  # ties
    rows += [rows[3], rows[40], rows[40], (None, rows[5][1], 1), (7, None, 1), (8, [], 1), (9, [1.0, None], 1), (11, [float("nan")] * dim, 1),
             (100, [0.5, 0.5], 1), (300, [0.5, 0.4], 1), (301, [0.3, 0.4], 2), (500, [0.0] * dim, 2), (600, [1e15] * dim, 1), (601, [9e14] * dim, 1),
             (602, [5e14 + i for i in range(dim)], 2)]
    return rows


@pytest.mark.parametrize("block", [8, 512])
def test_against_loops(spark, monkeypatch, block):
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "CELL_ZONES", 8 * block // 8 if block > 8 else 8)
    monkeypatch.setattr(H, "CELL_BLOCKS", 4)
    monkeypatch.setattr(H, "PACK_BLOCKS", 3)
    monkeypatch.setattr(H, "CELL_PACKS", 2)
    monkeypatch.setattr(H, "SLICE", 5)
    rows = vectors(400)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(0), "key": F.lit("x"), "block": F.lit(1)})
    assert sorted(map(tuple, H.mine(frame).collect())) == expected(rows)


def test_empty_table(spark):
    assert H.mine(spark.createDataFrame([], SCHEMA)).collect() == []


def test_blocks_outside_the_windows_are_not_read(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    rnd = random.Random(1)
    rows = []
    for i in range(1600):  # well apart: most blocks lie certainly outside
        c = i % 16
        rows.append((i, [(8.0 if d == c else 0.0) + rnd.uniform(-0.2, 0.2) for d in range(16)], i % 3))
    frame = spark.createDataFrame(rows, SCHEMA)
    made = H.prepared(frame)
    table = H.blocks(H.keyed(made, H.axes(made)))
    anchors = H.anchors_of(table, 100, 5)
    chosen = H.choose(table, anchors, None)
    pairs = chosen.select(F.explode("needed")).count()
    assert pairs < anchors.count() * table.count() / 8
    assert sorted(map(tuple, H.mine(frame).collect())) == expected(rows)


def test_hilbert_neighbours_are_one_step_apart():
    side, dims = 3, 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = H.hilbert(grid, side)
    assert sorted(key.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_all_scores():
    rng = np.random.default_rng(2)
    x, a = rng.integers(-50, 50, (40, 6)), rng.integers(-9, 9, (7, 6))
    least, most = H.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    s = a @ x.T
    assert (s >= least).all() and (s <= most).all()
