"""Accepting documents with a commit marker, and recovery. A commit is three folders that are written one after the other: documents, audits, accepted. The audits are the marker: documents without audits were never accepted, and
audits without rows in accepted are completed by `recover`. Each folder is written whole under the commit's name, so a commit that is run again replaces itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "candidate_id string, slot_id string, document_id string, document_sha256 string"
DOCUMENT = "document_id string, document string"


class LedgerError(Exception):
    """code: what is wrong with the ledger, and where."""

    def __init__(self, code: str, target: str):
        super().__init__(f"{code}: {target}")
        self.code, self.target = code, target


def _read(spark: SparkSession, folder: str, part: str, kind: str) -> DataFrame:
    """All commits of a part; none where nothing was written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{part}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{kind}, commit string")
    return spark.read.schema(f"{kind}, commit string").parquet(f"{folder}/{part}")


def accepted(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "accepted", RECORD)


def refusals(records: DataFrame, taken: DataFrame) -> DataFrame:
    """(candidate_id, code, target): new candidates for a slot that another one has, or that two of them want: the first by id gets it."""
    other = taken.select("slot_id", F.col("candidate_id").alias("__by")).join(records.select("slot_id", "candidate_id"), "slot_id").where("__by <> candidate_id")
    first = records.groupBy("slot_id").agg(F.min("candidate_id").alias("__by"))
    twice = records.join(first, "slot_id").where("__by <> candidate_id")
    return other.select("candidate_id", "slot_id").union(twice.select("candidate_id", "slot_id")).distinct().select("candidate_id", F.lit("SLOT_COMMIT_CONFLICT").alias("code"), F.col("slot_id").alias("target"))


def commit(spark: SparkSession, folder: str, name: str, documents: DataFrame, upto: str = "accepted") -> DataFrame:
    """Accepts documents (candidate_id, slot_id, document_id, document) and gives what it refuses. Candidates that are accepted already stay as they are. `upto` ends it after a part, as a crash would."""
    before = accepted(spark, folder).where(F.col("commit") != name)
    new = documents.join(before.select("candidate_id"), "candidate_id", "left_anti").dropDuplicates(["candidate_id"]).withColumn("document_sha256", F.sha2("document", 256))
    no = refusals(new, before)
    good = new.join(no.select("candidate_id"), "candidate_id", "left_anti")
    for part, kind in (("documents", DOCUMENT), ("audits", RECORD), ("accepted", RECORD)):
        rows = good.select(*[c.split()[0] for c in kind.split(", ")]) if part != "accepted" else _read(spark, folder, "audits", RECORD).where(F.col("commit") == name).drop("commit")
        rows.write.mode("overwrite").parquet(f"{folder}/{part}/commit={name}")
        if part == upto:
            break
    return no


def recover(spark: SparkSession, folder: str) -> list[str]:
    """Completes commits that ended after their audits, and gives their names.

    It raises ACCEPTED_DOCUMENT_HASH where a document isn't what its audit says, AUDIT_SLOT_CONFLICT where an audit's slot has another candidate, and ACCEPTED_AUDIT_MISSING where what was accepted has no audit.
    """
    audits, rows = _read(spark, folder, "audits", RECORD), accepted(spark, folder)
    documents = _read(spark, folder, "documents", DOCUMENT).select("document_id", "commit", F.sha2("document", 256).alias("__sha"))

    def refuse(bad: DataFrame, code: str, target: str) -> None:
        if found := bad.select(target).limit(1).collect():
            raise LedgerError(code, found[0][0])

    refuse(audits.join(documents, ["document_id", "commit"], "left").where("NOT coalesce(__sha = document_sha256, false)"), "ACCEPTED_DOCUMENT_HASH", "document_id")
    on = ["candidate_id", "document_sha256"]
    refuse(rows.join(audits.select(*on), on, "left_anti"), "ACCEPTED_AUDIT_MISSING", "candidate_id")
    left = audits.join(rows.select("candidate_id"), "candidate_id", "left_anti")
    refuse(left.join(rows.select("slot_id"), "slot_id", "left_semi"), "AUDIT_SLOT_CONFLICT", "slot_id")
    names = sorted(r["commit"] for r in left.select("commit").distinct().collect())  # commits that a crash cut off
    for name in names:
        audits.where(F.col("commit") == name).drop("commit").write.mode("overwrite").parquet(f"{folder}/accepted/commit={name}")
    return names
