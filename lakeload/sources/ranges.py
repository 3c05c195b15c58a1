"""Key ranges that hold about the same number of rows (S5), however the key is distributed.

The splitters of an n-way split are the keys that hold rows ``N/n, 2N/n, ...`` of the ordered table.  They are found
without sorting: rows are counted in bins between the smallest and the largest key, then only the bins that hold a
splitter are counted more finely, until a bin is one key value.  A pass reads the key column alone, aggregates
partially in each task, and brings at most ``BINS`` counts to the driver; keys of 64 bits take at most five passes.

A range begins with the whole key value that holds its splitter, so a value's rows stay together.  A value with more than
1/``SHARE`` of a mean range would make ranges uneven: given a second column, it is split there in the same way.
Equal (key, second) pairs stay together.

Edge cases: NULL keys (and NULLs of the second column) come before all values and are split like a value; an empty
table has no splitters, and no row of it a range; a range may be empty when one pair of values has more rows than a range.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Counts that one pass brings to the driver, and the share of a mean range from which a key value is split.
BINS = 65_536
SHARE = 20
WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _whole(df: DataFrame, column: str) -> Column:
    if not isinstance(df.schema[column].dataType, WHOLE_TYPES):
        raise ValueError(f"{column}: balanced ranges need a column of whole numbers")
    return F.col(f"`{column}`").cast("bigint")


def _search(at: Column, bounds: Sequence[Column], lo: int = 0, hi: int | None = None) -> Column:
    """How many of the ascending ``bounds`` are at most ``at``: a tree of comparisons, log2(n) of them a row."""
    hi = len(bounds) if hi is None else hi
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(at >= bounds[mid], _search(at, bounds, mid + 1, hi)).otherwise(_search(at, bounds, lo, mid))


def _pair(key, second) -> Column:
    """A (key, second) pair; pairs compare in order, NULL before all values."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v).cast("bigint")
    return F.struct(lit(key).alias("k"), lit(second).alias("s"))


def values_at(df: DataFrame, group: Column, column: Column, targets: dict) -> dict:
    """For each group (a value of ``group``) and each of its target positions the value of ``column`` that holds the row
    at that position when the group's rows are ordered, with the rows before it and of it:
    {(group, target): (value, before, rows)}."""
    names = sorted(targets, key=lambda g: (g is not None, g))
    some = group.isin([g for g in names if g is not None])
    rows = df.where(some | group.isNull() if None in names else some).select(group.alias("g"), column.alias("v"))
    found, open_cells = {}, defaultdict(list)  # cells: (group, lo, hi, rows before) -> targets
    for g, n, have, lo, hi in rows.groupBy("g").agg(F.count(F.lit(1)), F.count("v"), F.min("v"), F.max("v")).collect():
        for t in targets.get(g, ()):
            if t < n - have:
                found[g, t] = (None, 0, n - have)
            elif t < n:
                open_cells[g, lo, hi, n - have].append(t)
    while open_cells:
        cells = sorted(open_cells, key=lambda c: (c[0] is not None, c[0], c[1]))
        bins = max(2, BINS // len(cells))
        widths = [(hi - lo) // bins + 1 for _, lo, hi, _ in cells]
        at = _search(_pair(F.col("g"), F.col("v")), [_pair(g, lo) for g, lo, _, _ in cells]) - 1
        kind = "decimal(20,0)"  # a difference of two 64-bit numbers may not fit into 64 bits
        of = lambda values: F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), F.col("cell") + 1)
        inside = (rows.where(F.col("v").isNotNull()).withColumn("cell", at).where("cell >= 0")
                  .withColumn("lo", of([c[1] for c in cells])).withColumn("hi", of([c[2] for c in cells]))
                  .where((F.col("v") <= F.col("hi")) & F.col("g").eqNullSafe(of([c[0] for c in cells]))))
        wide = any(hi - lo >= 1 << 62 for _, lo, hi, _ in cells)
        exact = (lambda c: c.cast(kind)) if wide else (lambda c: c)
        inside = inside.select("cell", (exact(F.col("v")) - exact(F.col("lo"))).alias("away"), exact(of(widths)).alias("w"))
        counts = defaultdict(list)
        for cell, b, n in inside.groupBy("cell", F.expr("away div w").alias("bin")).count().collect():
            counts[cell].append((b, n))
        closer = defaultdict(list)
        for i, cell in enumerate(cells):
            g, lo, hi, before = cell
            wanted = sorted(open_cells[cell])
            for b, n in sorted(counts[i]):
                here = [t for t in wanted if before <= t < before + n]
                if here and widths[i] == 1:
                    found.update({(g, t): (lo + b, before, n) for t in here})
                elif here:
                    first = lo + b * widths[i]
                    closer[g, first, min(hi, first + widths[i] - 1), before] += here
                before += n
        open_cells = closer
    return found


def splitters(df: DataFrame, key: str, n: int, second: str | None = None) -> list[tuple]:
    """The (key, second) pairs at which ranges 1 .. n - 1 begin, ascending; second is None where a range begins with a
    whole key value."""
    if n < 1:
        raise ValueError("a split has at least one range")
    k = _whole(df, key)
    total = df.count()
    cuts = [total * i // n for i in range(1, n)] if total else []
    at = values_at(df, F.lit(0).cast("bigint"), k, {0: cuts}) if cuts else {}
    hot: dict = defaultdict(list)
    if second is not None:
        for t in cuts:
            value, before, rows = at[0, t]
            if rows * n * SHARE > total:
                hot[value].append(t - before)
    inner = values_at(df, k, _whole(df, second), hot) if hot else {}
    out = []
    for t in cuts:
        value, before, _ = at[0, t]
        out.append((value, inner[value, t - before][0] if (value, t - before) in inner else None))
    return out


def with_balanced_ranges(df: DataFrame, key: str, n: int, second: str | None = None, name: str = "range_id",
                         cuts: list[tuple] | None = None) -> DataFrame:
    """Tag every row with its range (0 .. n - 1): a projection without a shuffle.  ``cuts`` are the splitters, found when
    they are not given."""
    cuts = splitters(df, key, n, second) if cuts is None else cuts
    own = _pair(_whole(df, key), _whole(df, second) if second else None)
    return df.withColumn(name, _search(own, [_pair(*c) for c in cuts]).cast("int"))


def balanced_ranges(df: DataFrame, key: str, n: int, second: str | None = None) -> DataFrame:
    """(range_id, rows, lo, hi) of an n-way balanced split of ``key``; ranges without rows are left out."""
    k = F.col(f"`{key}`")
    return with_balanced_ranges(df, key, n, second).groupBy("range_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min(k).cast("bigint").alias("lo"), F.max(k).cast("bigint").alias("hi"))
