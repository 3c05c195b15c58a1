"""Loads: full replace, append, keyed merge; partitioned layout; file sizing; load summary.

``load`` is the one entry point.  Rows are converted, counted and their rejected values counted on
the same pass that writes them (an ``Observation`` rides on the write), so the summary needs no second
scan.  Partitioned writes are rebalanced on the partition columns with AQE's ``rebalance`` hint, which
splits a hot partition value over several tasks (and files) instead of sending it to one task.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeload.functions.transforms import add_partitions
from lakeload.operators.keys import require_key
from lakeload.plans.apply import convert_counting_rejects, plan_conversion
from lakeload.session import ensure_checkpoint_dir
from lakeload.sinks import table as tbl
from lakeload.sinks.naming import target_name

# Default target data file size (128 MiB) and the load modes.
TARGET_FILE_BYTES = 134_217_728
MODES = ("full", "incremental", "merge")
_REJ, _LIST = "__rejects", "__reject_list"

SUMMARY_SCHEMA = ("mode string, target string, version int, rows_written bigint, rejected_values bigint, "
                  "files_written int, bytes_written bigint, elapsed_ms bigint")


# Files sampled (evenly over the file list) to estimate stored bytes per row.
SIZE_SAMPLE_FILES = 64


def estimate_row_bytes(df: DataFrame) -> float | None:
    """Stored bytes per row of the files under ``df`` (compressed Parquet), or None when unknown.

    Looks at an even sample of at most ``SIZE_SAMPLE_FILES`` input files (sizes from the file system,
    rows from their Parquet footers), so the driver's work stays bounded on tables of millions of
    files; filters or joins in ``df`` are not evaluated.
    """
    files = sorted(set(df.inputFiles()))
    if not files:
        return None
    step = max(1, len(files) // SIZE_SAMPLE_FILES)
    sample = files[::step][:SIZE_SAMPLE_FILES]
    spark = df.sparkSession
    total = 0
    for f in sample:
        fs, p = tbl._fs(spark, f)
        total += int(fs.getFileStatus(p).getLen())
    try:
        rows = spark.read.parquet(*sample).count()
    except Exception:  # not Parquet: size unknown
        return None
    return (total / rows) if rows else None


def records_per_file(row_bytes: float | None, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rows per output file for a target file size (0 = no limit when the row size is unknown)."""
    if not row_bytes or not target_bytes:
        return 0
    return max(1, int(target_bytes // row_bytes))


def align_to(df: DataFrame, target_schema, carry: Sequence[str] = ()) -> DataFrame:
    """Append semantics: columns by name (case-insensitive); missing source columns become NULL;
    unknown source columns fail.  A value that the target column can't hold becomes NULL and adds to the reject count
    when that is carried; other ``carry`` columns pass through unchanged."""
    src = {c.lower(): c for c in df.columns if c not in carry}
    tgt = {f.name.lower() for f in target_schema.fields}
    unknown = [c for c in df.columns if c not in carry and c.lower() not in tgt]
    if unknown:
        raise ValueError(f"source columns not in the target table: {unknown}")
    cols, lost = [], F.lit(0)
    for f in target_schema.fields:
        s = src.get(f.name.lower())
        if s is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[s].dataType == f.dataType:
            cols.append(F.col(f"`{s}`").alias(f.name))
        else:
            value = F.col(f"`{s}`").try_cast(f.dataType)
            cols.append(value.alias(f.name))
            lost = lost + F.when(F.col(f"`{s}`").isNotNull() & value.isNull(), 1).otherwise(0)
    return df.select(*cols, *[(F.col(c) + lost if c == _REJ else F.col(c)).alias(c) for c in carry])


def merge_frames(target: DataFrame, source: DataFrame, key: Sequence[str], delete_col: str | None = None,
                 carry: Sequence[str] = ()) -> DataFrame:
    """New contents of a keyed upsert: target rows whose key is not in the source, plus the source rows
    not flagged for deletion.  One join on the key; Spark broadcasts the source keys by itself when
    their size estimate is under the broadcast threshold, else both sides shuffle on the key."""
    keys = list(key)
    kept = target.join(source.select(*[F.col(f"`{k}`") for k in keys]), keys, "left_anti")
    for c in carry:
        kept = kept.withColumn(c, F.lit(0) if c == _REJ else F.array().cast(source.schema[c].dataType))
    incoming = source
    if delete_col:
        incoming = source.where(~F.coalesce(F.col(f"`{delete_col}`"), F.lit(False))).drop(delete_col)
    return kept.unionByName(align_to(incoming, target.schema, carry))


def partition_columns_of(spark, target: str, version: int) -> list[str]:
    """Partition column names of a written version, read from its folder names (``col=value``)."""
    for v in [version, *tbl.meta_of(spark, target, version)["segments"]]:
        rest = tbl.first_file(spark, target, v)
        if rest is not None:  # a folder without rows has no files
            return [seg.split("=", 1)[0] for seg in rest.split("/")[:-1] if "=" in seg]
    return []


class Conflict(Exception):
    """Another writer published a version that this load should have seen."""


def _note(spark, target: str, mode: str, read: int | None, meta: dict, batch):
    """The meta data of a load that saw version ``read``, as a function of the version that it follows."""

    def note(current: int | None) -> dict | None:
        before = tbl.meta_of(spark, target, current) if current is not None else {"segments": [], "batches": {}}
        if batch and before["batches"].get(batch[0], -1) >= batch[1]:
            return None  # its rows are there already
        # an append goes on top of other appends, a merge only on what it has read
        if mode == "merge" and current != read or mode == "incremental" and read not in (current, *before["segments"]):
            raise Conflict
        batches = {**before["batches"], **({batch[0]: batch[1]} if batch else {})}
        kept = mode == "incremental" or "without" in meta
        segments = [*before["segments"], current] if kept and current is not None else []
        out = meta | {"segments": segments, "batches": batches}
        gone = {**before.get("without", {})} if segments else {}
        for seg in map(str, segments if "without" in meta else []):
            gone[seg] = gone.get(seg, []) + [v for v in meta["without"] if v not in gone.get(seg, [])]
        out.pop("without", None)
        if any(gone.values()):
            out["without"] = {k: v for k, v in gone.items() if v}
        return out

    return note


def load(df: DataFrame, target: str, mode: str = "full", key: Sequence[str] | None = None,
         partitions=None, target_bytes: int = TARGET_FILE_BYTES, targets: Mapping[str, str] | None = None,
         plan: DataFrame | None = None, table: str | None = None, delete_col: str | None = None,
         keep_versions: int | None = None, row_bytes: float | None = None, batch: tuple[str, int] | None = None,
         source_name: str | None = None, naming: str = "keep", rejects: Sequence[str] | None = None, tries: int = 5) -> DataFrame:
    """Load ``df`` into ``target`` and return a one-row load summary.

    * ``mode='full'``: the target becomes exactly ``df`` (a new committed version; older versions are
      kept unless ``keep_versions`` bounds them);
    * ``mode='incremental'``: ``df`` is appended, columns by name (the table is created when absent;
      pass the same ``partitions`` as at creation for a partitioned table), as a new version that has the
      rows of the current one too;
    * ``mode='merge'``: keyed upsert on ``key``; the source must be keyed (checked first); rows with a
      true ``delete_col`` delete their key.

    With ``source_name`` (``schema.object``) ``target`` is the folder or catalog in which the table is named after its
    source, as it is or (``naming='lower'``) in lower case; see ``lakeload.sinks.naming`` for other names.
    A merge into a partitioned table writes only the partitions that hold a key of the source; the others stay as files.
    ``rejects`` names the source columns that identify a row: rejected values are written in the same job as the rows,
    as a table of their own (``lakeload.sinks.table.read_rejects``).
    Writers at the same time lose nothing: an append is added to what is current when it is published, a merge is done
    again (up to ``tries`` times) when the table has changed since it was read.
    ``batch`` (stream, number) is noted in the version as the last batch that it holds of that stream.
    ``plan`` (a type plan) or ``targets`` (column -> Spark type) convert with checked casts; the
    summary counts rejected values.  ``partitions`` is a spec like ``["o_orderdate=MONTH",
    "o_orderkey=BUCKET,16"]``.  ``target`` is a folder (versioned Parquet table) or a catalog table.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    spark = df.sparkSession
    if source_name is not None:
        target = target_name(source_name, target, naming=naming)
    t0 = time.time()
    if row_bytes is None and target_bytes and tbl.is_path(target):
        row_bytes = estimate_row_bytes(df)

    if plan is not None:
        conv, req, rename = plan_conversion(df, plan, table)
        body = convert_counting_rejects(df, conv, req, rename, keep_others=False, key=rejects)
    elif targets or rejects is not None:
        body = convert_counting_rejects(df, targets or {}, key=rejects)
    else:
        body = df.withColumn(_REJ, F.lit(0))

    if not tbl.is_path(target):
        return _load_catalog(body.drop(_REJ, _LIST), target, mode, key, partitions, t0)
    carry = [_REJ] + ([_LIST] if rejects is not None else [])
    if mode == "merge":
        if not key:
            raise ValueError("merge needs key columns")
        ensure_checkpoint_dir(spark)
        body = body.checkpoint()  # the source is read once, however often its rows are used below
        require_key(body.drop(*carry), key, "merge source")

    for attempt in range(tries):
        current = tbl.current_version(spark, target)
        meta: dict = {}
        parts = partition_columns_of(spark, target, current) if current is not None else []
        if parts and not partitions and mode != "full":
            raise ValueError(f"target is partitioned by {parts}: pass the same partitions= spec to {'merge' if mode == 'merge' else 'append'}")
        # derived partition columns are made anew; an identity partition is a column of the rows
        derived = [p for p in parts if p.lower() not in {c.lower() for c in body.columns}]
        if mode == "merge" and current is None:
            out = body if not delete_col else body.where(~F.coalesce(F.col(f"`{delete_col}`"), F.lit(False))).drop(delete_col)
        elif mode == "merge":
            old = tbl.read_version(spark, target, current)
            if parts:
                gone = affected_partitions(old, body, key, parts)
                meta = {"without": gone, "partitions": parts}
                old = old.where(tbl.partition_filter(parts, gone)) if gone else old.limit(0)
            out = merge_frames(old.drop(*derived), body, key, delete_col, carry)
        elif mode == "incremental" and current is not None:
            out = align_to(body, tbl.read_version(spark, target, current).drop(*derived).schema, carry)
        else:
            out = body
        try:
            return _write(out, target, mode, current, meta, partitions, records_per_file(row_bytes, target_bytes), rejects is not None,
                          batch, keep_versions, t0)
        except Conflict:
            if attempt + 1 == tries:
                raise
    raise Conflict


def affected_partitions(old: DataFrame, source: DataFrame, key: Sequence[str], parts: list[str]) -> list[list]:
    """The partitions of ``old`` that hold a key of ``source``, as texts (one row per partition comes to the driver)."""
    keys = list(key)
    hit = old.join(source.select(*[F.col(f"`{k}`") for k in keys]), keys, "left_semi")
    return [list(r) for r in hit.select(*[F.col(f"`{p}`").cast("string").alias(p) for p in parts]).distinct().collect()]


def _write(out: DataFrame, target: str, mode: str, read: int | None, meta: dict, partitions, per_file: int, with_rejects: bool,
           batch, keep_versions: int | None, t0: float) -> DataFrame:
    """Write ``out`` as a data folder, publish it as the next version, and give the load's summary."""
    spark = out.sparkSession
    obs = Observation(f"lakeload_load_{uuid.uuid4().hex[:12]}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(_REJ).alias("rejects")).drop(_REJ)
    part_cols: list[str] = []
    if partitions:
        out, part_cols = add_partitions(out, partitions)
        out = out.hint("rebalance", *part_cols)
    folder = f"{tbl.LOAD}=w{uuid.uuid4().hex[:16]}"
    place = f"{target.rstrip('/')}/{folder}"
    shape = out.drop(_LIST).schema
    meta = meta | {"data": f"{folder}/{tbl.KIND}=rows", "schema": json.loads(shape.json()), "partitions": part_cols}
    if with_rejects:
        # one job, two outputs: each row, and each of its rejected values, under a folder level of their kind
        none = F.lit(None).cast(out.schema[_LIST].dataType.elementType)
        is_row = F.col("__pos") == 0
        out = out.select(*[F.col(f"`{c}`") for c in shape.names], F.posexplode(F.concat(F.array(none), F.col(_LIST))).alias("__pos", tbl.REJECT))
        out = out.where(is_row | F.col(tbl.REJECT).isNotNull()).select(
            *[F.when(is_row, F.col(f"`{c}`")).alias(c) for c in shape.names], F.col(tbl.REJECT),
            F.when(is_row, "rows").otherwise("rejects").alias(tbl.KIND))
        part_cols = [tbl.KIND, *part_cols]
    else:
        place += f"/{tbl.KIND}=rows"
    writer = out.write.format("parquet")
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    if part_cols:
        writer = writer.partitionBy(*part_cols)
    writer.mode("append").save(place)
    try:
        m = obs.get
    except Py4JJavaError:  # the optimiser found that there are no rows, and dropped the observation with the plan
        m = {}
    if with_rejects and not m.get("rows"):
        tbl.make_dir(spark, f"{place}/{tbl.KIND}=rows")

    version = tbl.publish(spark, target, _note(spark, target, mode, read, meta, batch))
    if version is None:
        version, files = tbl.current_version(spark, target), []
    else:
        files = tbl.files_of(spark, target, version)
    if keep_versions:
        tbl.remove_versions_before(spark, target, version - keep_versions + 1)
    row = (mode, target, int(version), int(m.get("rows") or 0), int(m.get("rejects") or 0), len(files),
           sum(b for _, b in files), int((time.time() - t0) * 1000))
    return spark.createDataFrame([row], SUMMARY_SCHEMA)


def _load_catalog(body: DataFrame, target: str, mode: str, key, partitions, t0) -> DataFrame:
    """Catalog (V2) tables: create-or-replace, append, or MERGE INTO through the configured catalog.

    Not exercised by the tests here (no lake catalog is installed); the file-table path is the tested one.
    """
    spark = body.sparkSession
    part_cols: list[str] = []
    if partitions:
        body, part_cols = add_partitions(body, partitions)
    w = body.writeTo(target)
    if part_cols:
        w = w.partitionedBy(*[F.col(c) for c in part_cols])
    if mode == "full":
        w.createOrReplace()
    elif mode == "incremental":
        if spark.catalog.tableExists(target):
            body.writeTo(target).append()
        else:
            w.create()
    else:
        require_key(body, key, "merge source")
        cond = " AND ".join(f"{target}.`{k}` <=> s.`{k}`" for k in key)
        (body.alias("s").mergeInto(target, F.expr(cond))
         .whenMatched().updateAll().whenNotMatched().insertAll().merge())
    rows = spark.table(target).count()
    return spark.createDataFrame([(mode, target, None, rows, 0, None, None, int((time.time() - t0) * 1000))],
                                 SUMMARY_SCHEMA)
