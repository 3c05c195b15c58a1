"""Column listing, row counts, key checks and candidate-key discovery, verified in the data.

A file or lake table has no dictionary of keys, so key properties are checked as jobs:

* ``check_key``: one ``groupBy(key)`` with map-side partial counts.  A key value held by a third
  of all rows still becomes one partial row per task before the shuffle, so hot keys do not skew it.
* ``key_candidates``: single columns and, when none qualifies, pairs, or (``every``) all minimal keys, breadth-first.
* Whether sets of columns are unique is counted on 64-bit hashes of their values, a slice of the hashes at a time: equal
  values have equal hashes, so a set whose hashes are all different is unique, and of one with equal hashes two rows are
  fetched that show whether its values are equal too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JDBC type class names (java.sql.Types) and the column size JDBC reports for them.
SPARK_TO_CLASS = [
    (T.DecimalType, "NUMERIC"), (T.LongType, "BIGINT"), (T.IntegerType, "INTEGER"), (T.ShortType, "SMALLINT"),
    (T.ByteType, "TINYINT"), (T.DoubleType, "DOUBLE"), (T.FloatType, "FLOAT"), (T.BooleanType, "BOOLEAN"),
    (T.StringType, "VARCHAR"), (T.TimestampNTZType, "TIMESTAMP"), (T.TimestampType, "TIMESTAMP_WITH_TIMEZONE"),
    (T.DateType, "DATE"), (T.BinaryType, "BINARY"),
]
INTEGRAL_PRECISION = {"BIGINT": 19, "INTEGER": 10, "SMALLINT": 5, "TINYINT": 3}

# Sets of columns checked in one pass; bounds the copies of a row and the columns of a copy.
SETS = 16
# Rows of the slice of hashes that is counted first (most sets that are no key repeat there), and how far the next ones reach.
SLICE_ROWS, SLICE_GROWTH = 1 << 18, 8
# Rows of a value that make it a rare one: several such are compared for each set.
RARE_ROWS = 64


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def type_class(dt: T.DataType) -> tuple[str, int, int]:
    """(type class, precision, scale) of a Spark type, as a source dictionary would declare it."""
    for cls, name in SPARK_TO_CLASS:
        if isinstance(dt, cls):
            if name == "NUMERIC":
                return name, dt.precision, dt.scale
            return name, INTEGRAL_PRECISION.get(name, 0), 0
    return "OTHER", 0, 0


# Columns per describe aggregate: keeps each group's generated per-row code small.
DESCRIBE_GROUP = 24


def describe_columns(df: DataFrame, table: str) -> DataFrame:
    """One row per column: declared type, type class, precision, scale, nullable, and from the data
    the NULL count and the widest string/binary value (one aggregate per group of columns, each
    reading only its own columns)."""
    fields = list(enumerate(df.schema.fields))
    parts = []
    for g in range(0, len(fields), DESCRIBE_GROUP):
        group = fields[g:g + DESCRIBE_GROUP]
        aggs = ["count(1) AS __total"]
        for i, f in group:
            c = f"`{f.name.replace('`', '``')}`"
            aggs.append(f"count({c}) AS __n{i}")
            if isinstance(f.dataType, (T.StringType, T.BinaryType)):
                aggs.append(f"CAST(max(length({c})) AS INT) AS __w{i}")
        wide = df.selectExpr(*aggs)
        entries = []
        for i, f in group:
            cls, p, s_ = type_class(f.dataType)
            width = F.col(f"__w{i}") if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.lit(None).cast("int")
            entries.append(F.struct(
                F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("position"),
                F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(cls).alias("type_class"),
                F.lit(p).alias("precision"), F.lit(s_).alias("scale"), F.lit(bool(f.nullable)).alias("nullable"),
                (F.col("__total") - F.col(f"__n{i}")).alias("null_count"), width.alias("max_length")))
        parts.append(wide.select(F.lit(table).alias("table_name"), F.inline(F.array(*entries))))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for many tables in one job (a union of partial counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _key_groups(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(key..., rows, null_key) per distinct key value; NULL parts are a property of the group, so
    they are tested after grouping and the shuffle carries only the key and a partial count."""
    null_key = F.lit(False)
    for c in cols:
        null_key = null_key | _q(c).isNull()
    return (df.groupBy(*[_q(c) for c in cols]).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("null_key", null_key))


def check_key(df: DataFrame, cols: Sequence[str], table: str | None = None) -> DataFrame:
    """Is ``cols`` a key?  total rows, distinct non-NULL keys, duplicate groups and rows, rows with a
    NULL key part, and the verdict."""
    g = _key_groups(df, cols)
    dup = (F.col("rows") > 1) & ~F.col("null_key")
    return g.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count_if(~F.col("null_key")).alias("distinct_keys"),
        F.count_if(dup).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(dup, F.col("rows"))), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col("null_key"), F.col("rows"))), F.lit(0)).cast("bigint").alias("null_key_rows"),
    ).select(F.lit(table).cast("string").alias("table_name"), F.lit(",".join(cols)).alias("key_columns"), "*",
             ((F.col("duplicate_groups") == 0) & (F.col("null_key_rows") == 0)).alias("is_key"))


def key_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The key values that break ``cols`` as a key: duplicated values and NULL key parts."""
    g = _key_groups(df, cols)
    return (g.where((F.col("rows") > 1) | F.col("null_key"))
            .withColumn("violation", F.when(F.col("null_key"), F.lit("null_key")).otherwise(F.lit("duplicate")))
            .drop("null_key"))


def require_key(df: DataFrame, cols: Sequence[str], what: str = "source") -> None:
    """Raise when ``cols`` is not a key of ``df`` (used before a keyed merge)."""
    r = check_key(df, cols).first()
    if not r["is_key"]:
        raise ValueError(f"{what} is not keyed by {list(cols)}: {r['duplicate_groups']} duplicated keys, "
                         f"{r['null_key_rows']} rows with a NULL key part")


def _set_counts(df: DataFrame, sets: list[tuple[str, ...]]) -> dict[tuple[str, ...], tuple[int, int]]:
    """(distinct values, rows of the commonest one) of each set of columns, all of one size, up to ``SETS`` sets in one
    expand and groupBy (a grouping id has 64 columns at most)."""
    out, step = {}, max(1, min(SETS, 64 // len(sets[0])))
    for at in range(0, len(sets), step):
        part = sets[at:at + step]
        cols = sorted({c for s in part for c in s})
        by_id = {sum(1 << k for k, c in enumerate(reversed(cols)) if c not in s): s for s in part}
        g = df.groupingSets([[_q(c) for c in s] for s in part], *[_q(c) for c in cols])
        g = g.agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set"))
        for r in g.groupBy("__set").agg(F.count(F.lit(1)).alias("d"), F.max("__n").alias("m")).collect():
            out[by_id[r["__set"]]] = (r["d"], r["m"])
    return out


def _hash(c: str, place: int) -> Column:
    return F.xxhash64(F.lit(place), _q(c))


def _with_hashes(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> tuple[DataFrame, list[Column]]:
    """``df`` with a hash of each column of ``sets``, and the hashes of the sets, combined from those."""
    place = {c: i for i, c in enumerate(sorted({c for s in sets for c in s}))}
    of = lambda s: reduce(Column.bitwiseXOR, [F.col(f"__h{place[c]}") for c in s])
    return df.select("*", *[_hash(c, i).alias(f"__h{i}") for c, i in place.items()]), [of(s) for s in sets]


def _slices(total: int) -> list[int]:
    """Borders of the slices of hashes in which a set is counted, one after the other; the last one is their number."""
    number, borders = max(1, -(-total // SLICE_ROWS)), [0, 1]
    while borders[-1] < number:
        borders.append(min(number, borders[-1] * SLICE_GROWTH))
    return borders


def _refuted(df: DataFrame, sets: list[tuple[str, ...]], start: int, borders: list[int]) -> dict[tuple[str, ...], list[set[str]]]:
    """The ``sets`` whose values repeat in the slice of hashes from border ``start`` on, each with the columns in which some
    pairs of rows that share its values agree.  A pass sends at most a hash of each row through the shuffle, or ``SETS`` of
    each row in the first slice."""
    out: dict[tuple[str, ...], list[set[str]]] = {}
    lo, hi, number = *borders[start:start + 2], borders[-1]
    step = max(1, min(SETS, max(SETS, number) // (hi - lo)))
    lowest, highest = F.col("__pair.lo"), F.col("__pair.hi")
    row = F.struct(*map(_q, df.columns))
    pair = F.struct(F.min(row).alias("lo"), F.max(row).alias("hi")).alias("__pair")
    same = F.array(*[lowest[c].eqNullSafe(highest[c]) for c in df.columns]).alias("same")
    names = lambda r: {c for c, x in zip(df.columns, r["same"]) if x}
    for at in range(0, len(sets), step):
        part = sets[at:at + step]
        hashed, own = _with_hashes(df, part)
        each = F.posexplode(F.array(*own)).alias("__set", "__h")
        g = hashed.select(each)
        if number > 1:
            g = g.where(F.pmod("__h", F.lit(number)).between(lo, hi - 1))
        g = g.groupBy("__set", "__h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        # the rarest value of each set and up to two other rare ones
        rare = F.when(F.col("__n") <= RARE_ROWS, F.col("__h"))
        twice = {r["__set"]: sorted({r["a"], r["b"], r["c"]} - {None}) for r in g.groupBy("__set").agg(
            F.min_by("__h", "__n").alias("a"), F.min(rare).alias("b"), F.max(rare).alias("c")).collect()}
        if not twice:
            continue
        rows = hashed.where(reduce(Column.__or__, [own[k].isin(h) for k, h in twice.items()])).select(each, *map(_q, df.columns))
        rows = rows.where(reduce(Column.__or__, [(F.col("__set") == k) & F.col("__h").isin(h) for k, h in twice.items()]))
        for r in rows.groupBy("__set", "__h").agg(pair).select("__set", same).collect():
            if set(part[r["__set"]]) <= names(r):
                out.setdefault(part[r["__set"]], []).append(names(r))
        for s in [part[k] for k in twice if part[k] not in out]:  # different values with one hash: the values themselves decide
            equal = df.groupBy(*map(_q, s)).agg(F.count(F.lit(1)).alias("__n"), pair).where("__n > 1").limit(1)
            out |= {s: [names(r)] for r in equal.select(same).collect()}
    return out


def _unique(df: DataFrame, sets: list[tuple[str, ...]], total: int) -> list[tuple[str, ...]]:
    """Those of ``sets`` (without NULLs) whose values are all different."""
    borders = _slices(total)
    for k in range(len(borders) - 1):
        gone = _refuted(df, sets, k, borders)
        sets = [s for s in sets if s not in gone]
    return sets


def key_candidates(df: DataFrame, table: str, every: bool = False) -> DataFrame:
    """Sets of columns that are unique and never NULL: the single columns or, if none qualifies, the pairs; with
    ``every`` all minimal keys of any number of columns.

    All checks are exact, a level of sets in few passes.  With ``every`` a set goes on to the next level only if it is no
    key and each of its columns tells more rows apart than the others alone: a column that the others determine is in no
    minimal key with them.  If all columns together repeat there is no key, and ``every`` ends after that check."""
    names = [f.name for f in df.schema.fields
             if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.FloatType, T.DoubleType))]
    r = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count(_q(c)).alias(f"__n{i}") for i, c in enumerate(names)]).first()
    total = r["__total"]
    nonnull = [c for i, c in enumerate(names) if r[f"__n{i}"] == total] if total else []
    place = {c: i for i, c in enumerate(nonnull)}
    found, level, counts = [], [(c,) for c in nonnull], {(): 1}
    if nonnull and not every:
        df = df.select(*map(_q, nonnull))
        found = _unique(df, level, total) or _unique(df, [(a, b) for i, a in enumerate(nonnull) for b in nonnull[i + 1:]], total)
        level = []
    if every and nonnull and df.groupBy(*[_q(c) for c in nonnull]).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").limit(1).count():
        level = []
    while level:
        got = _set_counts(df, level)
        found += [s for s in level if got[s][1] == 1]
        less = lambda s: [s[:i] + s[i + 1:] for i in range(len(s))]
        free = {s for s in level if got[s][1] > 1 and all(got[s][0] > counts[x] for x in less(s))}
        counts = {s: d for s, (d, _) in got.items()}
        level = [s + (c,) for s in sorted(free, key=lambda s: [place[c] for c in s]) for c in nonnull[place[s[-1]] + 1:]
                 if all(x in free for x in less(s + (c,)))]
    rows = [(table, ",".join(s), len(s), total, total) for s in found]
    return df.sparkSession.createDataFrame(rows, "table_name string, key_columns string, column_count int, distinct_keys bigint, row_count bigint")


def minimal_hitting_sets(differences: Sequence[int]) -> set[int]:
    """The minimal sets (bit masks) that share an element with each of ``differences``, one of these at a time."""
    found = {0}
    for d in differences:
        hit = {t for t in found if t & d}
        wider = {t | 1 << k for t in found - hit for k in range(d.bit_length()) if d >> k & 1}
        # a widened set is minimal unless one that hits already, or a smaller widened one, lies in it
        found = hit
        for t in sorted(wider, key=int.bit_count):
            if not any(h & t == h for h in found):
                found.add(t)
    return found


def agreements(rows: Sequence[Sequence]) -> set[int]:
    """The maximal sets of columns (bit masks) in which two of ``rows`` agree."""
    codes = np.stack([np.unique([str(v) for v in column], return_inverse=True)[1] for column in zip(*rows)], axis=1)
    packed = {bytes(b) for i in range(len(codes) - 1)
              for b in np.unique(np.packbits(codes[i + 1:] == codes[i], axis=1, bitorder="little"), axis=0)}
    out: list[int] = []
    for m in sorted((int.from_bytes(b, "little") for b in packed), key=int.bit_count, reverse=True):
        if not any(m & o == m for o in out):
            out.append(m)
    return set(out)


# Rows whose pairs propose the first keys.
PROPOSING_ROWS = 400


def minimal_keys(df: DataFrame, table: str) -> DataFrame:
    """All minimal keys of any number of columns, for wide tables; the rows of ``key_candidates(every=True)``.

    Two rows that agree in some columns show that a key must hold one of the others.  Pairs of a bounded sample of rows
    propose keys (the minimal sets that meet all these differences); every proposal is checked exactly over all rows, a
    slice of its hashes after the other, and for one that fails rows that share its values are compared, whose differences
    correct the proposals, until all hold.  So passes follow the keys and near-keys, not the number of column sets."""
    names = [f.name for f in df.schema.fields
             if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.FloatType, T.DoubleType))]
    spark = df.sparkSession
    schema = "table_name string, key_columns string, column_count int, distinct_keys bigint, row_count bigint"
    r = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count(_q(c)).alias(f"__n{i}") for i, c in enumerate(names)]).first()
    total = r["__total"]
    cols = [c for i, c in enumerate(names) if r[f"__n{i}"] == total] if total else []
    if not cols:
        return spark.createDataFrame([], schema)
    every, place = (1 << len(cols)) - 1, {c: i for i, c in enumerate(cols)}
    df = df.select(*map(_q, cols))
    sample = df.orderBy(F.xxhash64(*map(_q, cols))).limit(PROPOSING_ROWS).collect()
    differences = {every & ~m for m in agreements(sample)} if len(sample) > 1 else set()
    borders = _slices(total)
    passed: dict[int, int] = {}  # slices in which a proposed set is unique
    mask = lambda own: sum(1 << place[c] for c in own)
    of = lambda m: tuple(c for c in cols if m >> place[c] & 1)
    while 0 not in differences:
        proposed = minimal_hitting_sets(sorted(differences, key=int.bit_count)) - {0} or {1 << i for i in range(len(cols))}
        rank = lambda m: (passed.get(m, 0), m.bit_count(), [place[c] for c in of(m)])
        sets = sorted(proposed, key=rank)
        start = passed.get(sets[0], 0)
        if start == len(borders) - 1:
            rows = [(table, ",".join(of(m)), m.bit_count(), total, total) for m in sets]
            return spark.createDataFrame(rows, schema)
        sets = [m for m in sets if passed.get(m, 0) == start][:SETS]
        got = _refuted(df, [of(m) for m in sets], start, borders)
        passed |= {m: start + 1 for m in sets if of(m) not in got}
        differences |= {every & ~mask(own) for pairs in got.values() for own in pairs}
    return spark.createDataFrame([], schema)  # two rows are equal in all columns


def split_key(candidates: DataFrame, columns: DataFrame) -> DataFrame:
    """The key to split a scan on: the first single-column candidate of an integral type."""
    c = candidates.where(F.col("column_count") == 1).select("table_name", F.col("key_columns").alias("column_name"))
    d = columns.where(F.col("type_class").isin("BIGINT", "INTEGER", "SMALLINT", "TINYINT")
                      | ((F.col("type_class") == "NUMERIC") & (F.col("scale") == 0)))
    j = c.join(d.select("table_name", "column_name", "position", "type_class"), ["table_name", "column_name"])
    return (j.groupBy("table_name")
            .agg(F.min_by(F.struct("column_name", "type_class"), F.col("position")).alias("k"))
            .select("table_name", F.col("k.column_name").alias("split_column"), F.col("k.type_class").alias("type_class")))
