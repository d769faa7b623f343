"""Reports as files: CSV with a byte-order mark and nested cells as JSON, JSON, and a text table."""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name) for f in df.schema])


def write_csv(df: DataFrame, folder: str) -> None:
    """Distributed CSV with a header in each part."""
    flat(df).write.mode("overwrite").option("header", True).csv(folder)


def report_csv(df: DataFrame) -> bytes:
    """A small report as one CSV file with a byte-order mark."""
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\r\n")
    w.writerow(df.columns)
    for r in flat(df).toLocalIterator():
        w.writerow(["" if v is None else v for v in r])
    return b"\xef\xbb\xbf" + out.getvalue().encode()


def report_json(reports: dict[str, DataFrame]) -> str:
    """Small reports by name as one JSON text."""
    return json.dumps({k: [json.loads(x) for x in df.toJSON().toLocalIterator()] for k, df in reports.items()}, ensure_ascii=False, indent=2)


def text_table(df: DataFrame, width: int = 24) -> str:
    """A small report in fixed-width columns."""
    lines = ["".join(c[:width].ljust(width) for c in df.columns).rstrip()]
    for r in df.toLocalIterator():
        lines.append("".join(("-" if v is None else str(v))[:width].ljust(width) for v in r).rstrip())
    return "\n".join(lines)


def write_all(reports: dict[str, DataFrame], folder: str) -> None:
    """Each report as Parquet under its name; the writer commits a report whole or not at all."""
    for name, df in reports.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
