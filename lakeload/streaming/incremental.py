"""Incremental loads of newly arrived source files with Structured Streaming.

The file stream source records which files each micro-batch consumed in its checkpoint (by default
``<target>/_checkpoint``, next to the data it describes), so every run loads only files it has not
loaded before.
Each micro-batch goes through ``lakeload.sinks.load.load`` (append or keyed merge) and, optionally,
adds its partial numeric profile to a profile table, so the profile of everything loaded so far is a
merge of small partial rows instead of a rescan.

Each load notes its stream (the query id that the checkpoint holds) and batch number in the table version that it
commits, so the note appears with the rows and a replayed batch is skipped exactly when its rows are there.  Streams
with checkpoints of their own don't take each other's batches for theirs.  A batch's profile is written before its
rows, to a place of its own that a replay overwrites.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.operators.profile import merge_profiles, profile_numbers
from lakeload.sinks import table as tbl
from lakeload.sinks.load import load


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The query id in a stream's checkpoint folder."""
    fs, p = tbl._fs(spark, f"{checkpoint.rstrip('/')}/metadata")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()))["id"]
    finally:
        stream.close()


def _done(spark: SparkSession, target: str, stream: str, batch_id: int) -> bool:
    current = tbl.current_version(spark, target)
    return current is not None and tbl.meta_of(spark, target, current)["batches"].get(stream, -1) >= batch_id


def profile_dir(profile_target: str, stream: str, batch_id: int) -> str:
    return f"{profile_target.rstrip('/')}/stream={stream}/batch={batch_id:012d}"


def stream_load(spark: SparkSession, source_dir: str, target: str, fmt: str = "parquet", schema=None,
                mode: str = "incremental", key=None, partitions=None, targets=None,
                profile_target: str | None = None, table: str | None = None,
                checkpoint: str | None = None, order_by: str | None = None, max_files_per_trigger: int | None = None) -> int:
    """Load the files of ``source_dir`` not loaded by earlier runs into ``target``; returns the number
    of micro-batches run.  ``mode`` is ``incremental`` (append) or ``merge`` (keyed upsert on ``key``).
    With ``profile_target``, each batch's partial numeric profile is written there.  ``order_by`` names the column by
    which a merge keeps the latest of several rows of one key in a batch."""
    if mode not in ("incremental", "merge"):
        raise ValueError("streaming loads append or merge")
    if schema is None:
        schema = spark.read.format(fmt).load(source_dir).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    batches = []

    checkpoint = checkpoint or f"{target.rstrip('/')}/_checkpoint"

    def run_batch(df: DataFrame, batch_id: int) -> None:
        stream_key = stream_id(spark, checkpoint)
        if _done(spark, target, stream_key, batch_id):
            return
        if profile_target is not None:
            profile_numbers(df, table=table).write.mode("overwrite").parquet(profile_dir(profile_target, stream_key, batch_id))
        if order_by is not None and key:
            df = latest_by_key(df, key, order_by)
        load(df, target, mode=mode, key=key, partitions=partitions, targets=targets, batch=(stream_key, batch_id))
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def latest_by_key(df: DataFrame, key, order_by: str) -> DataFrame:
    """One row per key, that of the largest ``order_by`` (of equal ones any; NULL is before all)."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rank = F.struct(F.col(f"`{order_by}`").isNotNull(), F.col(f"`{order_by}`"))
    return df.groupBy(*[F.col(f"`{k}`") for k in key]).agg(F.max_by(row, rank).alias("row")).select("row.*")


def loaded_profile(spark: SparkSession, profile_target: str) -> DataFrame:
    """Profile of everything loaded so far: the merge of the partial profiles, one for each stream's batch."""
    return merge_profiles(spark.read.option("basePath", profile_target).parquet(f"{profile_target.rstrip('/')}/*/*").drop("stream", "batch"))
