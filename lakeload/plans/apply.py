"""Apply a type plan to a DataFrame: converted rows plus a reject table, from the same expressions.

The plan (one row per column, schema-sized) is read on the driver to build the projection; data rows
never leave the executors.  Converting and rejecting are both narrow projections of the source, so a
load that also keeps rejects scans the source once for the rows and once for the rejects (or derives
reject counts from the same pass with an ``Observation``, see ``lakeload.sinks.load``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.casts import NULL_REQUIRED, convert, raw_text, required

REJECT_COLUMNS = ["column_name", "raw_value", "target_type", "reason"]


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _conversions(df: DataFrame, targets: Mapping[str, str]):
    types = {f.name: f.dataType for f in df.schema.fields}
    return {name: convert(_col(name), types[name], t) for name, t in targets.items()}, types


def _reject_entries(conv, types, targets, required_cols: Sequence[str] = (), key: Sequence[str] = ()) -> list[Column]:
    """For each target the rejected value (after the row's ``key`` columns), NULL where the value converts."""
    entries = []
    for name, c in conv.items():
        reason = c.reason
        if name in required_cols:
            reason = F.when(_col(name).isNull(), F.lit(NULL_REQUIRED)).otherwise(c.reason)
        entries.append(F.when(reason.isNotNull(), F.struct(
            *[_col(k).alias(k) for k in key],
            F.lit(name).alias("column_name"), raw_text(_col(name), types[name]).alias("raw_value"),
            F.lit(targets[name]).alias("target_type"), reason.alias("reason"))))
    return entries


def cast_columns(df: DataFrame, targets: Mapping[str, str], keep: Sequence[str] = (),
                 required_cols: Sequence[str] = (), route_required: bool = False,
                 rename: Mapping[str, str] | None = None) -> DataFrame:
    """Convert ``targets`` (column -> Spark type) of ``df``; other columns in ``keep`` pass through.

    Nullable targets turn unconvertible values into NULL.  Required targets raise, or with
    ``route_required`` drop the row here (it appears in ``cast_rejects``).
    """
    rename = rename or {}
    conv, _ = _conversions(df, targets)
    cols = []
    for f in df.schema.fields:
        n = f.name
        out = rename.get(n, n)
        if n in conv:
            v = conv[n].value
            if n in required_cols and not route_required:
                v = required(v, conv[n].reason, _col(n), n)
            cols.append(v.alias(out))
        elif n in keep or not targets:
            cols.append(_col(n).alias(out))
    res = df
    if route_required and required_cols:
        ok = F.lit(True)
        for n in required_cols:
            ok = ok & _col(n).isNotNull() & conv[n].reason.isNull()
        res = df.where(ok)
    return res.select(*cols)


def cast_rejects(df: DataFrame, targets: Mapping[str, str], key: Sequence[str] = (),
                 required_cols: Sequence[str] = ()) -> DataFrame:
    """One row per value that failed conversion: key columns, column, raw text, target, reason.

    Each target's entry is NULL where its value converts, and dropped as soon as it is exploded, so the reject table
    costs a projection and a filter in generated code.
    """
    conv, types = _conversions(df, targets)
    arr = F.array(*_reject_entries(conv, types, targets, required_cols))
    return df.select(*[_col(k) for k in key], F.explode(arr).alias("r")).where(F.col("r").isNotNull()).select(
        *[_col(k) for k in key], *[F.col(f"r.{c}").alias(c) for c in REJECT_COLUMNS])


def reject_summary(rejects: DataFrame) -> DataFrame:
    return (rejects.groupBy("column_name", "target_type", "reason")
            .agg(F.count(F.lit(1)).alias("rejects")))


def plan_targets(plan: DataFrame, table: str | None = None) -> list[dict]:
    """The plan rows of one table as dicts (schema-sized metadata, read on the driver)."""
    p = plan if table is None else plan.where(F.col("table_name") == table)
    rows = p.select("column_name", "position", "spark_type", "nullable").orderBy("position").collect()
    return [r.asDict() for r in rows]


def apply_type_plan(df: DataFrame, plan: DataFrame, table: str | None = None, key: Sequence[str] = (),
                    route_required: bool = False, lower_names: bool = True):
    """(typed DataFrame, rejects DataFrame) for ``df`` under ``plan``.

    Column names are lower-cased (``lower_names``); non-nullable planned columns are required.
    Columns absent from the plan are dropped.
    """
    rows = plan_targets(plan, table)
    present = {f.name.lower(): f.name for f in df.schema.fields}
    targets, req = {}, []
    for r in rows:
        src = present.get(r["column_name"].lower())
        if src is None:
            raise ValueError(f"planned column {r['column_name']} is missing from the source")
        targets[src] = r["spark_type"]
        if r["nullable"] is False:
            req.append(src)
    rename = {n: (n.lower() if lower_names else n) for n in targets}
    typed = cast_columns(df, targets, required_cols=req, route_required=route_required, rename=rename)
    rejects = cast_rejects(df, targets, key=key, required_cols=req if route_required else ())
    return typed, rejects


def convert_counting_rejects(df: DataFrame, targets: Mapping[str, str], required_cols: Sequence[str] = (),
                             rename: Mapping[str, str] | None = None, keep_others: bool = True,
                             key: Sequence[str] | None = None) -> DataFrame:
    """``cast_columns`` plus a ``__rejects`` column (rejected values in the row), in one projection, so a
    load writes the rows and counts its rejects on the same pass.  With ``key`` also ``__reject_list``: an entry per target, the
    rejected value with the row's ``key`` columns (as they are in the source) or NULL.  Values are converted once, in a
    projection before the one that tells which failed."""
    rename = rename or {}
    fields = df.schema.fields
    conv, types = _conversions(df, targets)
    df = df.select("*", *[c.value.alias(f"__value{i}") for i, c in enumerate(conv.values())])
    conv = {n: convert(_col(n), types[n], targets[n], F.col(f"__value{i}")) for i, n in enumerate(conv)}
    cols = []
    for f in fields:
        n = f.name
        if n in conv:
            v = conv[n].value
            if n in required_cols:
                v = required(v, conv[n].reason, _col(n), n)
            cols.append(v.alias(rename.get(n, n)))
        elif keep_others:
            cols.append(_col(n).alias(rename.get(n, n)))
    failed = F.lit(0)
    for c in conv.values():
        failed = failed + F.when(c.reason.isNotNull(), 1).otherwise(0)
    cols.append(failed.alias("__rejects"))
    if key is not None:
        entry = T.StructType([T.StructField(k, types[k]) for k in key] + [T.StructField(c, T.StringType()) for c in REJECT_COLUMNS])
        entries = _reject_entries(conv, types, targets, key=key)
        cols.append((F.array(*entries) if entries else F.array().cast(T.ArrayType(entry))).alias("__reject_list"))
    return df.select(*cols)


def plan_conversion(df: DataFrame, plan: DataFrame, table: str | None = None, lower_names: bool = True):
    """(targets, required columns, rename map) of ``df`` under ``plan``."""
    rows = plan_targets(plan, table)
    present = {f.name.lower(): f.name for f in df.schema.fields}
    targets, req = {}, []
    for r in rows:
        src = present.get(r["column_name"].lower())
        if src is None:
            raise ValueError(f"planned column {r['column_name']} is missing from the source")
        targets[src] = r["spark_type"]
        if r["nullable"] is False:
            req.append(src)
    rename = {n: (n.lower() if lower_names else n) for n in targets}
    return targets, req, rename
