"""A training-data pipeline over `documents`: five stages, each on all that the one before kept.

1. language ID: rows whose language can't be told, or is told with a share under 0.3 (no language has a third of the letters, or none stands out), go; known languages mixed in one text stay. With no labelled rows there is nothing to tell by, and all stay.
2. n-gram Jaccard join: of each component (five-word shingles, similarity 0.8 or more) the row with the smallest id stays, and one of repeated rows. Rows that share an id are judged by their own texts.
3. secret scans: what a rule finds becomes [secret].
4. mixing sources to target weights: each row as often as the mix takes it, whole.
5. packing: the pieces of the sequences.

All stages but the last return the columns of `documents` as they are, whatever their names; n_chars follows the text where a stage changes it. Of the rows of a component that have a null id the second
stage keeps one besides the one with the smallest id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import jaccard, langid, mixing, packing, secrets
from sievework.llm.common import discard, fold, materialise
from sievework.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows with all columns but the text under private names, the document's id and source beside them, and how to get the rows back: no column can clash with what an operator adds."""
    held = [c for c in docs.columns if c != "text"]
    names = [f"__own_{i}" for i in range(len(held))]
    used = [F.col(c) for c in ("doc_id", "source") if c in held]
    apart = docs.select(*used, "text", *(F.col(c).alias(n) for c, n in zip(held, names, strict=True)))
    back = dict(zip(held, names, strict=True))
    return apart, lambda df: df.select(*(F.col(c) if c == "text" else F.col(back[c]).alias(c) for c in docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.where(fold("doc_id") != 1))
    if not model.langs:
        return docs
    apart, restored = _aside(docs)
    told = langid.identify(apart, model, spans=False, share="__share")
    return restored(told.where((F.col("lang_pred") != "und") & (F.col("__share") >= 0.3)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, size=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apart, restored = _aside(docs)
    clean = restored(secrets.redact(secrets.find(apart)))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apart, restored = _aside(docs)
    return restored(mixing.apply_mix(apart, mixing.mix(apart)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", mix),
    ("packing", pack),
]

#: SQL can't express the first, second and last stage; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs, path = materialise(stage(spark, docs, sf_dir))
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
