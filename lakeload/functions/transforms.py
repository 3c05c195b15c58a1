"""Partition transforms (identity, year, month, day, hour, bucket, truncate) as Column expressions.

Values follow the lake table format's published transform definitions, so files laid out here match
what a catalog would compute: years/months/days/hours since 1970-01-01 (UTC for zoned timestamps),
``bucket(n)`` = (murmur3_x86_32(value) & Integer.MAX_VALUE) % n, ``truncate(w)`` = value - (value mod w)
for integers and decimals (on the unscaled value), the first ``w`` characters for strings.

Integers, dates and timestamps are bucketed natively: Spark's seeded ``hash`` applied after a fixed
first argument whose own hash is 0 is murmur3 with seed 0 over the 8-byte long.  Spark hashes the tail
bytes of strings its own way, so strings, binary and decimals are bucketed by a vectorised murmur3
inside an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The int whose Murmur3 hash under Spark's default seed (42) is 0.  Hashing it first
# makes the seed of the following value 0, as the lake format's bucket transform requires.
ZERO_SEED_PREFIX = -1693959553
# murmur3_x86_32 constants.
_C1, _C2 = np.uint32(0xCC9E2D51), np.uint32(0x1B873593)
_M, _N = np.uint32(5), np.uint32(0xE6546B64)
_F1, _F2 = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)

TRANSFORMS = ("IDENTITY", "YEAR", "MONTH", "DAY", "HOUR", "BUCKET", "TRUNCATE")
_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint32(r)) | (x >> np.uint32(32 - r))


def murmur3_32(values: Sequence[bytes | None]) -> np.ndarray:
    """murmur3_x86_32 with seed 0 of each byte string, vectorised over the batch (NULL -> 0, masked
    by the caller).  One numpy pass per 4-byte block position, over the rows that still have one."""
    n = len(values)
    data = [b if b is not None else b"" for b in values]
    lengths = np.fromiter((len(b) for b in data), dtype=np.int64, count=n)
    buf = np.frombuffer(b"".join(data) + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    starts = np.zeros(n, dtype=np.int64)
    if n > 1:
        starts[1:] = np.cumsum(lengths)[:-1]
    h = np.zeros(n, dtype=np.uint32)
    blocks = lengths // 4
    order = np.argsort(-blocks, kind="stable")
    sorted_blocks = blocks[order]
    with np.errstate(over="ignore"):
        for j in range(int(blocks.max(initial=0))):
            active = order[: np.searchsorted(-sorted_blocks, -j, side="left")]
            p = starts[active] + 4 * j
            k = buf[p] | (buf[p + 1] << np.uint32(8)) | (buf[p + 2] << np.uint32(16)) | (buf[p + 3] << np.uint32(24))
            k = _rotl(k * _C1, 15) * _C2
            hh = _rotl(h[active] ^ k, 13)
            h[active] = hh * _M + _N
        rem = lengths % 4
        tail = starts + blocks * 4
        k1 = np.zeros(n, dtype=np.uint32)
        for r in (3, 2, 1):
            m = rem >= r
            k1[m] ^= buf[tail[m] + r - 1] << np.uint32(8 * (r - 1))
        m = rem > 0
        k1[m] = _rotl(k1[m] * _C1, 15) * _C2
        h[m] ^= k1[m]
        h ^= lengths.astype(np.uint32)
        h ^= h >> np.uint32(16)
        h *= _F1
        h ^= h >> np.uint32(13)
        h *= _F2
        h ^= h >> np.uint32(16)
    return h.view(np.int32)


def _decimal_bytes(d: Decimal, scale: int) -> bytes:
    unscaled = int(d.scaleb(scale).to_integral_value())
    size = max(1, (unscaled.bit_length() + 8) // 8)
    return unscaled.to_bytes(size, "big", signed=True)


def _bytes_of(s: pd.Series, kind: str, scale: int) -> list:
    if kind == "string":
        return [None if v is None else v.encode("utf-8") for v in s.tolist()]
    if kind == "binary":
        return [None if v is None else bytes(v) for v in s.tolist()]
    return [None if v is None else _decimal_bytes(v, scale) for v in s.tolist()]


def _hash_udf(kind: str, scale: int = 0):
    @F.pandas_udf(T.IntegerType())
    def lake_hash(s: pd.Series) -> pd.Series:
        h = murmur3_32(_bytes_of(s, kind, scale))
        out = pd.Series(h.astype(np.int64), dtype="Int64")
        out[s.isna().to_numpy()] = pd.NA
        return out.astype("Int32")
    return lake_hash


def _long_view(col: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.DateType):
        return F.datediff(col, F.lit("1970-01-01").cast("date")).cast("bigint")
    if isinstance(dt, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(col)
    return col.cast("bigint")


def lake_hash(col: Column, dt: T.DataType) -> Column:
    """The lake format's 32-bit bucket hash of a value."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampNTZType,
                       T.TimestampType)):
        return F.hash(F.lit(ZERO_SEED_PREFIX), _long_view(col, dt))
    if isinstance(dt, T.StringType):
        return _hash_udf("string")(col)
    if isinstance(dt, T.BinaryType):
        return _hash_udf("binary")(col)
    if isinstance(dt, T.DecimalType):
        return _hash_udf("decimal", dt.scale)(col)
    raise ValueError(f"bucket transform does not support {dt.simpleString()}")


def bucket(col: Column, dt: T.DataType, n: int) -> Column:
    if n <= 0:
        raise ValueError("bucket count must be positive")
    return (lake_hash(col, dt).bitwiseAND(F.lit(2147483647)) % F.lit(n)).cast("int")


def truncate(col: Column, dt: T.DataType, w: int) -> Column:
    if w <= 0:
        raise ValueError("truncate width must be positive")
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return (col - F.pmod(col, F.lit(w).cast(dt))).cast(dt)
    if isinstance(dt, T.StringType):
        return F.substring(col, 1, w)
    if isinstance(dt, T.BinaryType):
        return F.substring(col, 1, w)
    if isinstance(dt, T.DecimalType) and dt.precision + dt.scale + 1 > 38:
        # no decimal type holds the scaled value exactly: move the point in the text; beyond the type's range NULL
        whole = F.regexp_replace(col.cast("string"), "[.]", "").cast("decimal(38,0)")
        cut = F.try_subtract(whole, F.pmod(whole, F.lit(w).cast("decimal(38,0)")))
        digits = F.abs(cut).cast("string")
        digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(dt.scale + 1)), F.lit("0"))
        left = F.substring(digits, F.lit(1), F.length(digits) - dt.scale)
        text = F.concat(F.when(cut < 0, F.lit("-")).otherwise(F.lit("")), left, F.lit("."), F.right(digits, F.lit(dt.scale)))
        return text.try_cast(dt)
    if isinstance(dt, T.DecimalType):
        unscaled = (col * F.lit(10 ** dt.scale)).cast(T.DecimalType(38, 0))
        rem = F.pmod(unscaled, F.lit(w).cast(T.DecimalType(38, 0)))
        return (col - rem / F.lit(10 ** dt.scale)).cast(dt)
    raise ValueError(f"truncate transform does not support {dt.simpleString()}")


def year(col: Column) -> Column:
    return (F.year(col) - 1970).cast("int")


def month(col: Column) -> Column:
    return ((F.year(col) - 1970) * 12 + F.month(col) - 1).cast("int")


def day(col: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.TimestampType):
        return F.floor(F.unix_micros(col) / F.lit(86_400_000_000)).cast("int")
    return F.datediff(F.to_date(col), F.lit("1970-01-01").cast("date")).cast("int")


def hour(col: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.TimestampType):
        return F.floor(F.unix_micros(col) / F.lit(3_600_000_000)).cast("int")
    return (day(col, dt) * 24 + F.hour(col)).cast("int")


def parse_spec(spec) -> list[tuple[str, str, int | None]]:
    """Partition spec from ``[(column, transform, param)]`` or strings ``"col=TYPE[,n]"``."""
    out = []
    for item in spec:
        if isinstance(item, str):
            m = re.match(r"^\s*([^=]+?)\s*=\s*([A-Za-z]+)\s*(?:,\s*(-?\d+)\s*)?$", item)
            if not m:
                raise ValueError(f"bad partition spec {item!r}: expected column=TYPE[,n]")
            col, tr, p = m.group(1), m.group(2), m.group(3)
            item = (col, tr, int(p) if p is not None else None)
        col, tr, p = (tuple(item) + (None,))[:3]
        tr = tr.upper()
        if tr not in TRANSFORMS:
            raise ValueError(f"unknown partition transform {tr!r}; one of {', '.join(TRANSFORMS)}")
        if tr in ("BUCKET", "TRUNCATE") and (p is None or p <= 0):
            raise ValueError(f"{tr} needs a positive number, e.g. {col}={tr},16")
        out.append((col, tr, p))
    return out


def partition_column(name: str, transform: str, param: int | None) -> str:
    t = transform.upper()
    if t == "IDENTITY":
        return name
    if t == "BUCKET":
        return f"{name}_bucket_{param}"
    if t == "TRUNCATE":
        return f"{name}_trunc_{param}"
    return f"{name}_{t.lower()}"


def transform_expr(df: DataFrame, name: str, transform: str, param: int | None = None) -> Column:
    dt = df.schema[name].dataType
    c = F.col(f"`{name}`")
    t = transform.upper()
    if t == "IDENTITY":
        return c
    if t == "YEAR":
        return year(c)
    if t == "MONTH":
        return month(c)
    if t == "DAY":
        return day(c, dt)
    if t == "HOUR":
        return hour(c, dt)
    if t == "BUCKET":
        return bucket(c, dt, int(param))
    if t == "TRUNCATE":
        return truncate(c, dt, int(param))
    raise ValueError(f"unknown partition transform {transform!r}")


def add_partitions(df: DataFrame, spec) -> tuple[DataFrame, list[str]]:
    """Add the derived partition columns of ``spec`` (in order); returns (frame, partition columns)."""
    cols = []
    out = df
    for name, tr, p in parse_spec(spec):
        pc = partition_column(name, tr, p)
        if pc != name:
            out = out.withColumn(pc, transform_expr(df, name, tr, p))
        cols.append(pc)
    return out, cols


def prune_by(df: DataFrame, column: str, lo=None, hi=None, spec=None) -> DataFrame:
    """Filter ``lo <= column <= hi`` on a table partitioned by transforms of ``column``, adding the same
    range on each derived partition column so the scan prunes partition folders (``PartitionFilters``).

    Only monotonic transforms are used (identity, year, month, day, hour, integer truncate); a bucket
    column cannot narrow a range.  ``spec`` is the partition spec the table was written with.
    """
    c = F.col(f"`{column}`")
    out = df
    if lo is not None:
        out = out.where(c >= F.lit(lo))
    if hi is not None:
        out = out.where(c <= F.lit(hi))
    dt = df.schema[column].dataType
    for name, tr, p in parse_spec(spec or []):
        if name != column or tr in ("IDENTITY", "BUCKET"):
            continue
        pc = partition_column(name, tr, p)
        if pc not in df.columns:
            continue
        if tr == "TRUNCATE" and not isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            continue
        derived = F.col(f"`{pc}`")
        for bound, op in ((lo, "ge"), (hi, "le")):
            if bound is None:
                continue
            b = F.lit(bound).cast(dt)
            value = {"YEAR": lambda: year(b), "MONTH": lambda: month(b), "DAY": lambda: day(b, dt),
                     "HOUR": lambda: hour(b, dt), "TRUNCATE": lambda: truncate(b, dt, int(p))}[tr]()
            out = out.where(derived >= value if op == "ge" else derived <= value)
    return out
