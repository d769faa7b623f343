"""The ledger: joins of accepted work, quotas, coverage, usage and budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.stats import rate


def accepted_relations(relations: DataFrame, accepted: DataFrame, candidates: DataFrame, domain: str | None = None) -> DataFrame:
    """Relations of accepted documents: id and content hash must both agree; the domain filter applies only if given."""
    c = candidates if domain is None else candidates.where(F.col("domain") == domain)
    return relations.join(accepted.select("candidate_id", "document_sha256", "document_id"), ["candidate_id", "document_sha256"]).join(c.select("candidate_id", "domain", "subtype"), "candidate_id")


def with_fallback(indexed: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """`indexed`, and the rows of `fallback` whose key it lacks."""
    return indexed.unionByName(fallback.join(indexed.select(key).distinct(), key, "left_anti"))


def base_slots(slots: DataFrame, supplemental: DataFrame, key: str) -> DataFrame:
    return slots.join(supplemental.select(key), key, "left_anti")


def zero_filled(required: DataFrame, rows: DataFrame, key: str, minimum: int, document: str) -> DataFrame:
    """Every required key with its rows and documents, 0 where it has none, and whether it reaches the minimum."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.count_distinct(document).alias("n_documents"))
    return required.join(counts, key, "left").select(
        *required.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_documents")], (F.coalesce("n_rows", F.lit(0)) >= minimum).alias("met")
    )


def label_counts(rows: DataFrame, key: str, label: str, labels: Sequence[str]) -> DataFrame:
    return rows.groupBy(key).agg(*[F.count_if(F.col(label) == v).alias(v) for v in labels])


def completion(slots: DataFrame, keys: list[str], done: Column) -> DataFrame:
    """By keys: slots, slots done, and whether there are any and all are done."""
    return slots.groupBy(*keys).agg(F.count("*").alias("slots"), F.count_if(done).alias("done"), F.bool_and(done).alias("complete"))


def usage(calls: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    return calls.groupBy(*keys).agg(F.count("*").alias("requests"), *[F.sum(c).alias(n) for n, c in sums.items()])


def call_cost(tokens_in: Column, cached: Column, tokens_out: Column, price_in: Column, price_cached: Column, price_out: Column) -> Column:
    """Price per million tokens; cached input tokens have a price of their own."""
    return ((tokens_in - cached) * price_in + cached * price_cached + tokens_out * price_out) / 1_000_000


def admitted(calls: DataFrame, group: list[str], order: list[str], cost: Column, cap: float, most_calls: int) -> DataFrame:
    """An ordered log with running count and cost by group, and whether each call is still within both budgets."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return calls.withColumns({"running_cost": F.sum(cost).over(w), "running_calls": F.count("*").over(w)}).withColumn(
        "admitted", (F.col("running_cost") <= cap) & (F.col("running_calls") <= most_calls)
    )


def next_attempt(attempts: DataFrame, keys: list[str]) -> DataFrame:
    return attempts.groupBy(*keys).agg((F.coalesce(F.max("attempt"), F.lit(0)) + 1).alias("next_attempt"))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "attempt") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def domain_rollup(slots: DataFrame, candidates: DataFrame, supplemental: DataFrame) -> DataFrame:
    """By domain of the slots: base and supplemental slots, slots left, candidates accepted and rejected, and their rate."""
    extra = supplemental.select("slot_id", F.lit(True).alias("__extra")).distinct()
    s = slots.join(extra, "slot_id", "left").groupBy("domain").agg(
        F.count("*").alias("slots"), F.count_if(F.col("__extra").isNull()).alias("base_slots"), F.count_if(F.col("__extra")).alias("supplemental_slots"),
        F.count_if(F.col("status") != "accepted").alias("remaining_slots"),
    )
    c = candidates.groupBy("domain").agg(F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "rejected").alias("rejected"))
    zero = [F.coalesce(x, F.lit(0)).alias(x) for x in ("accepted", "rejected")]
    joined = s.join(c, "domain", "left").select("domain", "slots", "base_slots", "supplemental_slots", "remaining_slots", *zero)
    return joined.withColumn("acceptance_rate", F.round(rate(F.col("accepted"), F.col("accepted") + F.col("rejected")), 6))


def complete_with_coverage(quota: DataFrame, coverage: DataFrame, keys: list[str], enabled: bool = True) -> DataFrame:
    """By keys: whether all slots are done (column complete of `completion`), whether every required label is met (column met of `zero_filled`, rows of the keys; none required counts as met), and both."""
    met = coverage.groupBy(*keys).agg(F.bool_and("met").alias("coverage_complete"))
    j = quota.join(met, keys, "left").withColumn("coverage_complete", F.coalesce("coverage_complete", F.lit(True)))
    return j.select(*keys, F.col("complete").alias("quota_complete"), "coverage_complete", (F.col("complete") & (F.col("coverage_complete") | F.lit(not enabled))).alias("complete"))
