"""Compaction of a versioned table: the files of small loads become files of the target size.

Many small appends (a stream's batches) leave many small files and folders.  ``compact`` finds the loads whose files are on
average under half the target size, counts their bytes by partition, and writes their rows again, once, into as many files
as these bytes fill; other loads are kept as they are.  The result is a version with the same rows.

Sizes and counts come from file metadata in a Spark job, so no list of files passes through the driver, which gets a row
per load and per partition.  Rows are dealt to files by a hash of where they stood, so files of one partition are even
whatever the rows hold, a partition's files are written by tasks of their own, and a task that is run again deals alike.

Writers at the same time: appends published meanwhile stay; a merge or replacement of what was compacted makes the
compaction start anew.  Batches noted by streams and reject tables are carried over.

Edge cases: a table without versions is an error; loads without rows are dropped; a table whose small loads would need
as many files as they have is left alone (no new version).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.session import ensure_checkpoint_dir
from lakeload.sinks import table as tbl
from lakeload.sinks.load import TARGET_FILE_BYTES, Conflict

SUMMARY = "version int, loads_before int, loads_after int, files_before bigint, files_after bigint, bytes_before bigint"


def file_counts(spark: SparkSession, path: str, version: int) -> DataFrame:
    """(load, the partition columns, files, bytes, rows) of a version."""
    meta, dirs = tbl.meta_of(spark, path, version), tbl.segment_dirs(spark, path, version)
    if "schema" not in meta:
        raise ValueError(f"{path}: version {version} was not written by a load")
    by = [tbl.LOAD, *meta["partitions"]]
    one = tbl.read_segments(spark, path, meta, dirs).groupBy(*by, F.col("_metadata.file_path").alias("__file")).agg(
        F.first("_metadata.file_size").alias("size"), F.count(F.lit(1)).alias("n"))
    return one.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.sum("n").alias("rows"))


def _plan(spark: SparkSession, path: str, version: int, target_bytes: int) -> tuple[list[int], DataFrame, int, tuple]:
    """(the versions whose loads are written again, files and first file number by partition, all files, figures)."""
    meta, dirs = tbl.meta_of(spark, path, version), tbl.segment_dirs(spark, path, version)
    counts = file_counts(spark, path, version).checkpoint()
    loads = {r[0]: r for r in counts.groupBy(tbl.LOAD).agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes")).collect()}
    chosen = []
    for v, d in dirs.items():
        own = loads.get(tbl.load_of(d))
        if own is None or own["bytes"] < own["files"] * target_bytes / 2:
            chosen.append(v)
    parts = meta["partitions"]
    small = counts.where(F.col(tbl.LOAD).isin([tbl.load_of(dirs[v]) for v in chosen]))
    need = (small.groupBy(*parts) if parts else small.groupBy()).agg(F.sum("bytes").alias("bytes")).where("bytes IS NOT NULL").collect()
    plan, total = [], 0
    for r in need:
        n = max(1, round(r["bytes"] / target_bytes))
        plan.append((*r[:-1], n, total))
        total += n
    shape = ", ".join([*[f"`{p}` {small.schema[p].dataType.simpleString()}" for p in parts], "__files long", "__from long"])
    had = [loads[tbl.load_of(dirs[v])] for v in chosen if tbl.load_of(dirs[v]) in loads]
    return chosen, spark.createDataFrame(plan, shape), total, (
        sum(r["files"] for r in had), sum(r["bytes"] for r in had), len(chosen) - len(had))


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES, tries: int = 5) -> DataFrame:
    """Write the rows of a table's small loads into files of about ``target_bytes``; a one-row summary."""
    ensure_checkpoint_dir(spark)
    for attempt in range(tries):
        version = tbl.current_version(spark, path)
        if version is None:
            raise FileNotFoundError(f"no committed version under {path}")
        meta, dirs = tbl.meta_of(spark, path, version), tbl.segment_dirs(spark, path, version)
        chosen, plan, total, (files, size, empty) = _plan(spark, path, version, target_bytes)
        if files <= total and empty < 2:
            return spark.createDataFrame([(version, len(dirs), len(dirs), files, files, size)], SUMMARY)
        folder = _rewrite(spark, path, meta, {v: dirs[v] for v in chosen}, plan, total)
        try:
            published = tbl.publish(spark, path, _note(spark, path, meta, dirs, chosen, folder))
            return spark.createDataFrame([(published, len(dirs), len(dirs) - len(chosen) + 1, files, total, size)], SUMMARY)
        except Conflict:
            if attempt + 1 == tries:
                raise
    raise Conflict


def _rewrite(spark: SparkSession, path: str, meta: dict, dirs: dict[int, str], plan: DataFrame, total: int) -> str:
    """The rows of some loads in a new data folder, a task per file; its name."""
    parts = meta["partitions"]
    rows = tbl.read_segments(spark, path, meta, dirs)
    names = [f.name for f in rows.schema.fields if f.name not in (tbl.LOAD, tbl.KIND)]
    rows = rows.select(*[F.col(f"`{c}`") for c in names], F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("__place"))
    if parts:
        on = [rows[f"`{p}`"].eqNullSafe(plan[f"`{p}`"]) for p in parts]
        dealt = rows.join(plan, on).select(*[rows[f"`{c}`"] for c in names], "__place", "__files", "__from")
    else:
        dealt = rows.withColumns({"__files": F.lit(max(total, 1)), "__from": F.lit(0)})
    number = (F.col("__from") + F.pmod("__place", F.col("__files").cast("bigint"))).cast("int")
    out = dealt.repartitionById(max(total, 1), number).select(*[F.col(f"`{c}`") for c in names])
    folder = f"{tbl.LOAD}=w{uuid.uuid4().hex[:16]}/{tbl.KIND}=rows"
    writer = out.write.format("parquet").mode("append")
    (writer.partitionBy(*parts) if parts else writer).save(f"{path.rstrip('/')}/{folder}")
    return folder


def _note(spark: SparkSession, path: str, read: dict, dirs: dict[int, str], chosen: list[int], folder: str):
    """The note of the compaction, as a function of the version that it follows."""
    gone = {str(v) for v in chosen}

    def note(current: int | None) -> dict:
        before = tbl.meta_of(spark, path, current) if current is not None else {"segments": []}
        now = [*before["segments"], current]
        own = lambda m: {k: v for k, v in m.get("without", {}).items() if k in gone}
        if not set(chosen) <= set(now) or own(before) != own(read):
            raise Conflict
        notes = {v: tbl.meta_of(spark, path, v) for v in chosen}
        there = set(tbl.committed_versions(spark, path))
        base = path.rstrip("/") + "/"
        rejects = [tbl.rejects_dir(spark, dirs[v]) for v in chosen]
        return {
            "data": folder, "schema": before["schema"], "partitions": before["partitions"], "batches": before["batches"],
            "segments": [v for v in now if v not in chosen],
            "without": {k: v for k, v in before.get("without", {}).items() if k not in gone},
            # the loads whose rows these are, and the tables of rejected values that stay in their folders
            "replaces": sorted({w for v, n in notes.items() for w in n.get("replaces") or [v] if w in there}),
            "reject_dirs": [*[d for n in notes.values() for d in n.get("reject_dirs", [])], *[d.removeprefix(base) for d in rejects if d]]}

    return note

