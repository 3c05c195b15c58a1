"""The numeric profile of any number of columns in one scan of the source.

Every task folds the Arrow batches of its rows into one small state per column (counts and maxima, by vectorised
arithmetic on unscaled decimals and by exact double arithmetic) and emits one partial row per column; the partials
merge like those of buckets or load batches.  So a source that can't prune columns (text files, a join, a database
link) is read once however wide it is, and all columns are profiled from the same rows.

Same rows as ``lakeload.operators.profile.profile_numbers``, whose expressions suit few columns of a columnar source.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.numeric import FLOATING_TYPES, INT_MAX, INT_MIN, INTEGRAL_TYPES, LONG_MAX, LONG_MIN
from lakeload.operators.profile import PROFILE_COLUMNS, merge_profiles, numeric_columns

# Executors get this module with the functions that use it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Powers of ten that a long holds: the digits of a number are those of its place among them.
POWERS = 10 ** np.arange(19, dtype=np.int64)
# Doubles are decided by arithmetic up to this many fraction digits, while the scaled value is below 2^52.
FAST_SCALE, EXACT_LIMIT = 10, 4.0e15
VIEW_SCALE, VIEW_DIGITS = 10, 28
WIDE = Context(prec=800, rounding=ROUND_HALF_UP)
TEXT_NUMBER = re.compile(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)", re.ASCII)
SHEET = ("column_name string, position int, total_values long, null_values long, int_values long, long_values long, decimal_values long, "
         "max_precision int, max_scale int, max_int_digits int, unclassified_values long")


class Tally:
    """The profile of one column's values so far."""

    def __init__(self):
        self.total = self.nulls = self.ints = self.longs = self.unknown = self.precision = self.scale = self.digits = 0

    def widths(self, precision: np.ndarray, scale: np.ndarray) -> None:
        if len(precision):
            self.precision = max(self.precision, int(precision.max()))
            self.scale = max(self.scale, int(scale.max()))
            self.digits = max(self.digits, int((precision - scale).max()))

    def whole(self, lo: int, hi: int, ints: int, count: int) -> None:
        """``count`` whole values between lo and hi, of which ``ints`` are in the 32-bit range."""
        self.ints += ints
        self.longs += count - ints
        n = max(len(str(abs(lo))), len(str(abs(hi))))
        self.precision, self.digits = max(self.precision, n), max(self.digits, n)

    def exact(self, unscaled: int, scale: int, unknown: bool = False) -> None:
        """One value, unscaled * 10^-scale."""
        while scale > 0 and unscaled % 10 == 0:
            unscaled, scale = unscaled // 10, scale - 1
        n = len(str(abs(unscaled)))
        self.precision, self.scale, self.digits = max(self.precision, n), max(self.scale, scale), max(self.digits, n - scale)
        self.unknown += unknown
        if not scale:
            self.ints += INT_MIN <= unscaled <= INT_MAX
            self.longs += not INT_MIN <= unscaled <= INT_MAX and LONG_MIN <= unscaled <= LONG_MAX


def integral(t: Tally, values: pa.Array) -> None:
    v = values.to_numpy()
    t.whole(int(v.min()), int(v.max()), int(((v >= INT_MIN) & (v <= INT_MAX)).sum()), len(v))


def decimals(t: Tally, values: pa.Array, scale: int) -> None:
    words = np.frombuffer(values.buffers()[1], "<i8").reshape(-1, 2)[values.offset:values.offset + len(values)]
    low, high = words[:, 0], words[:, 1]
    short = (high == low >> 63) & (low != LONG_MIN)
    for lo, hi in words[~short].tolist():
        t.exact((hi << 64) + (lo & (1 << 64) - 1), scale)
    v = np.abs(low[short])
    places, rest = np.full(len(v), scale), np.arange(len(v))
    for _ in range(scale):  # fraction digits that are zero
        q, r = np.divmod(v[rest], 10)
        rest = rest[r == 0]
        if not len(rest):
            break
        v[rest] = q[r == 0]
        places[rest] -= 1
    t.widths(np.maximum(np.searchsorted(POWERS, v, "right"), 1), places)
    whole = v[places == 0]
    negative = low[short][places == 0] < 0
    ints = int((whole <= np.where(negative, -INT_MIN, INT_MAX)).sum())
    t.ints += ints
    t.longs += len(whole) - ints


def views(t: Tally, values: list, text, back) -> None:
    """Values (with how often each occurs) through their decimal(38,10) view."""
    for x, n in values:
        view = None
        if np.isfinite(x):
            d = Decimal(text(x)).quantize(Decimal(1).scaleb(-VIEW_SCALE), context=WIDE)
            view = int(d.scaleb(VIEW_SCALE, context=WIDE))
            view = view if abs(view) < 10 ** (VIEW_DIGITS + VIEW_SCALE) else None
        if view is None:
            t.unknown += n
            continue
        one = Tally()
        one.exact(view, VIEW_SCALE, back(d) != x)
        t.ints, t.longs, t.unknown = t.ints + n * one.ints, t.longs + n * one.longs, t.unknown + n * one.unknown
        t.precision, t.scale, t.digits = max(t.precision, one.precision), max(t.scale, one.scale), max(t.digits, one.digits)


def counted(v: np.ndarray) -> list:
    own, n = np.unique(v, return_counts=True)
    return list(zip(own, n.tolist()))


def doubles(t: Tally, values: pa.Array) -> None:
    v = values.to_numpy()
    rest = np.arange(len(v))
    size = np.abs(v)
    with np.errstate(invalid="ignore", over="ignore"):
        for k in range(FAST_SCALE + 1):
            x = size[rest]
            m = x * float(10 ** k)
            r = np.rint(m)
            ok = (m < EXACT_LIMIT) & (r / float(10 ** k) == x)
            if ok.any():
                own = r[ok].astype(np.int64)
                precision = np.maximum(np.searchsorted(POWERS, own, "right"), 1)
                t.widths(precision, np.full(len(own), k))
                if k == 0:
                    w = v[rest[ok]]
                    ints = int(((w >= INT_MIN) & (w <= INT_MAX)).sum())
                    t.ints += ints
                    t.longs += len(w) - ints
                rest = rest[~ok]
            if not len(rest):
                return
    views(t, counted(v[rest]), lambda x: repr(float(x)), float)


def floats(t: Tally, values: pa.Array) -> None:
    views(t, counted(values.to_numpy()), str, lambda d: np.float32(str(d)))


def whole_floats(t: Tally, values: pa.Array) -> None:
    """The branch of ``floating``: whole and finite values are int or long, no widths."""
    v = values.to_numpy().astype(np.float64)
    with np.errstate(invalid="ignore"):
        w = v[np.isfinite(v) & (v == np.rint(v))]
    ints = int(((w >= INT_MIN) & (w <= INT_MAX)).sum())
    t.ints += ints
    t.longs += int(((w >= -2.0 ** 63) & (w < 2.0 ** 63)).sum()) - ints


def texts(t: Tally, values: pa.Array) -> None:
    for entry in values.value_counts().to_pylist():
        x, n = entry["values"].strip(" "), entry["counts"]
        if not TEXT_NUMBER.fullmatch(x):
            t.unknown += n
            continue
        whole, _, part = x.lstrip("+-").partition(".")
        part = part.rstrip("0")
        p = max(1, len((whole + part).lstrip("0")))
        t.precision, t.scale, t.digits = max(t.precision, p), max(t.scale, len(part)), max(t.digits, p - len(part))
        if not part and whole:
            v = int(whole) * (-1 if x[0] == "-" else 1)
            t.ints += n * (INT_MIN <= v <= INT_MAX)
            t.longs += n * (not INT_MIN <= v <= INT_MAX and LONG_MIN <= v <= LONG_MAX)


def profile_one_scan(df: DataFrame, columns: Sequence[str] | None = None, table: str | None = None, floating: bool = False) -> DataFrame:
    """``profile_numbers`` of all numeric columns of ``df`` (and the string ``columns`` named) in one scan."""
    cols = numeric_columns(df, columns)
    if floating:
        cols = [c for c in cols if isinstance(c[2], FLOATING_TYPES)]
    if not cols:
        raise ValueError("no numeric columns to profile")

    def way(kind: T.DataType):
        if floating:
            return whole_floats
        if isinstance(kind, T.DecimalType):
            return lambda t, v, s=kind.scale: decimals(t, v, s)
        return (integral if isinstance(kind, INTEGRAL_TYPES) else doubles if isinstance(kind, T.DoubleType)
                else floats if isinstance(kind, T.FloatType) else texts)

    ways, places = [way(c[2]) for c in cols], [(name, pos) for pos, name, _ in cols]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = [Tally() for _ in ways]
        for batch in batches:
            for t, own, column in zip(tallies, ways, batch.columns):
                t.total += len(column)
                t.nulls += column.null_count
                if column.null_count < len(column):
                    own(t, column.drop_null())
        rows = [(name, pos, t.total, t.nulls, t.ints, t.longs, t.total - t.nulls - t.ints - t.longs, t.precision, t.scale, max(t.digits, 0), t.unknown)
                for (name, pos), t in zip(places, tallies)]
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 5, *[pa.int32()] * 3, pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in SHEET.split(", ")])

    spark = df.sparkSession
    none = spark.createDataFrame([(n, p, *[0] * 9) for n, p in places], SHEET)  # a source without tasks has a profile too
    src = df.select(*[F.col(f"`{c}`") for _, c, _ in cols])
    parts = src.mapInArrow(fold, SHEET).unionByName(none).withColumn("table_name", F.lit(table).cast("string"))
    return merge_profiles(parts).select(*PROFILE_COLUMNS)
