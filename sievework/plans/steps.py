"""Written intermediate tables: they cut lineage and survive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only where it is unset and all runs on one machine."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sievework.steps", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sievework-steps-")
        spark.conf.set("spark.sievework.steps", base)
    return base.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str, rows: int = 1 << 20) -> DataFrame:
    """Rows dealt to tasks by their keys, about `rows` to a task whatever the number of rows, and to no fewer tasks than a shuffle has: what a task sorts or groups has a size that doesn't grow with the table.

    Fixed shuffle partitions grow with it, and adaptive execution only ever makes them fewer. Counting a table of Parquet reads its footers.
    """
    return df.repartition(tasks(df, rows), *keys)


def tasks(df: DataFrame, rows: int = 1 << 20) -> int:
    """The number of tasks that `dealt` deals to."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def until_settled(state: DataFrame, step: Callable[[DataFrame], DataFrame], open_rows: str) -> DataFrame:
    """Applies `step`, writing each result, until no row meets the condition `open_rows`."""
    state = written(state)
    while state.where(open_rows).limit(1).count():
        state = written(step(state))
    return state
