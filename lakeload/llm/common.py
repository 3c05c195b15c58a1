"""Helpers shared by the operators of this package: tables, shared checkpoints, hash columns, checked joins."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lakeload.llm
from lakeload.session import ensure_checkpoint_dir, work_path
from lakeload.sources.files import read_table

# Executors get the code of this package with the functions that use it, and need no copy of it on their path.
cloudpickle.register_pickle_by_value(lakeload.llm)

# Java pattern of the white space that separates words, and of a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

# A side of at most this many rows of a few numbers may be broadcast (some MB); larger sides are joined by shuffle.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def shared(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_of(column: str = "text") -> Column:
    """The text, a NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, SPACE), "")


def unit_hash(*parts) -> Column:
    """52 bits of MD5 over the parts joined by ':' (NULL as '~'), as a double in [0, 1)."""
    return bits52(*parts).cast("double") / F.lit(float(1 << 52))


def bits52(*parts) -> Column:
    """52 bits of MD5 over the parts joined by ':' (NULL as '~'), as a long."""
    cols = [F.coalesce((p if isinstance(p, Column) else F.lit(p)).cast("string"), F.lit("~")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *cols)), 1, 13), 16, 10).cast("long")


def join_small(df: DataFrame, side: DataFrame, on, how: str = "left") -> DataFrame:
    """Join with a side that is usually small: it is kept and counted, and broadcast only when it has at most
    ``BROADCAST_ROWS`` rows; beyond that the join shuffles both sides and AQE splits skewed keys."""
    side = shared(side)
    return df.join(F.broadcast(side) if side.count() <= BROADCAST_ROWS else side, on, how)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name one that no column of ``df`` has (columns compare without case)."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def stored(df: DataFrame, name: str = "step") -> tuple[DataFrame, str]:
    """``df`` written as a Parquet table in the shared folder and read again, and its path.

    Compact for many narrow rows.  Afterwards the driver's JVM is asked to collect garbage, upon which Spark removes
    the shuffle files of the plan that has ended."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a table that ``stored`` wrote."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def per_process(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a worker process and kept for the tasks that it runs later: tables that
    only save time (a compiled vocabulary and its memo), never data of a job."""
    state = sys.modules.setdefault("lakeload_worker_state", ModuleType("lakeload_worker_state")).__dict__
    if key not in state.setdefault("kept", {}):
        state["kept"] = {key: make()}  # one at a time bounds the memory
    return state["kept"][key]


def release() -> None:
    """Forget what ``per_process`` keeps in this worker process: for tasks of an operator that needs none of it."""
    sys.modules.get("lakeload_worker_state", ModuleType("none")).__dict__.pop("kept", None)
    pa.default_memory_pool().release_unused()
