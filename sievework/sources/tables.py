"""Reading tables and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The ledger's tables and their columns.
LEDGER = {
    "slots": "slot_id string, domain string, subtype string, status string, candidate_id string, document_id string",
    "candidates": "candidate_id string, slot_id string, domain string, subtype string, document_format string, layout_variant string, topic_id string, viewpoint string, status string, final_stage int, reasons string, condition_json string, created_at string, finished_at string",
    "stage_attempts": "id long, candidate_id string, stage int, attempt int, status string, started_at string, finished_at string, reasons string, metrics string, artifact string",
    "api_calls": "id long, candidate_id string, stage int, task string, model string, key_slot string, status string, started_at string, finished_at string, input_tokens long, cached_input_tokens long, output_tokens long, estimated_cost_usd double, error_code string, request_id string",
    "reviews": "id long, candidate_id string, version int, overall string, consistency string, fluency string, suitability string, semantic_passed int, format_passed int, response_valid int, reason string, created_at string",
    "accepted": "candidate_id string, slot_id string, document_id string, document_path string, document_sha256 string, plan_fingerprint string, structure_fingerprint string, normalized_text string, metrics string, created_at string",
    "events": "id long, candidate_id string, stage int, kind string, payload string, created_at string",
    "accepted_relations": "candidate_id string, relation_id string, relation string, privacy_label string, source string, target string, document_sha256 string",
    "coverage_slots": "slot_id string, required_types string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ledger(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a ledger folder."""
    return spark.read.schema(LEDGER[name]).parquet(f"{folder}/{name}")


def append(spark: SparkSession, folder: str, name: str, rows: DataFrame) -> None:
    """Appends rows to a ledger table; missing columns are null, the write is committed as a whole."""
    from pyspark.sql import functions as F

    kinds = spark.createDataFrame([], LEDGER[name]).schema
    cols = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds]
    rows.select(*cols).write.mode("append").parquet(f"{folder}/{name}")


def load_config(path: str) -> dict:
    """A JSON configuration; its paths to other files (fixed keys) count from its own folder."""
    import json
    from pathlib import Path

    at = Path(path)
    config = json.loads(at.read_text(encoding="utf-8"))
    return config | {k: str((at.parent / config[k]).resolve()) for k in ("pool_path", "reference_dataset") if config.get(k)}


def json_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON documents, one a file or an array a file; `path` may be a glob."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def zip_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(archive, name, text) of every *.json member of ZIP archives; an archive is read by one task, member by member."""
    import io
    import zipfile
    from collections.abc import Iterator

    import pyarrow as pa

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if name.endswith(".json"):
                            yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([name]), pa.array([z.read(name).decode("utf-8")])], names=["archive", "name", "text"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(members, "archive string, name string, text string")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    from pyspark.sql import functions as F

    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))
