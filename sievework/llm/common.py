"""What the training-data operators share: scratch tables, hashes and regular expressions for words."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of characters other than blank and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder that spark.checkpoint.dir names; a temporary folder only where that is unset and all runs on one machine."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sievework.scratch", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sievework-")
        spark.conf.set("spark.sievework.scratch", base)
    return f"{base.rstrip('/')}/sievework/{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2048, size: int = 8 << 20) -> Iterator[None]:
    """Bounds Arrow batches while a step is written: texts can be long, and what JVM and Python hold of a task grows with its batches. The caller's settings come back afterwards."""
    before = {}
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key)
        if not now.removesuffix("b").isdigit() or not 0 < int(now.removesuffix("b")) <= most:
            before[key] = now
            spark.conf.set(key, str(most))
    try:
        yield
    finally:
        for key, now in before.items():
            spark.conf.set(key, now)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, with the memory given back that a task leaves in a worker: workers are used again by later stages."""

    @wraps(run)
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
            if trim:
                trim(0)

    return over


#: For rows of megabytes. Parquet's writer looks at its size every 100 rows only, and its reader decodes up to 4096 rows of a row group at once; so a task would hold as many such rows as it writes or reads.
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.max": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false"}


def materialise(df: DataFrame, large_rows: bool = False) -> tuple[DataFrame, str]:
    """Writes `df` as Parquet to the shared scratch folder and reads it: cuts lineage and survives lost executors. With `large_rows`, row groups have a few rows."""
    path = scratch(df.sparkSession)
    with small_batches(df.sparkSession):
        df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes scratch tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Asks the driver for its garbage. Spark removes the shuffle files of a finished step only when the driver's objects for it are collected, which it may put off for long; a chain of steps would hold them all. The second time meets what the first has queued."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def fold(doc_id: Column | str) -> Column:
    """crc32(doc_id as text) mod 3; a null id counts as the empty text. Fold 1 is held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 3


def unit_hash(*cols: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns and the seed only."""
    return (F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / float(1 << 52)
