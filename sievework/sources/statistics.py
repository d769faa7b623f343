"""The statistics of a ledger: one JSON summary of small reports, and reports and tables as CSV folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import audits, funnel, ledger
from sievework.sources import sinks, tables

# The states of candidates and attempts, the graded dimensions, and what a candidate without a grade counts as.
STATES = ["accepted", "rejected", "error", "running"]
PASSED, OPEN = ("passed", "cached"), ("running", "interrupted")
DIMENSIONS, UNGRADED = ("overall", "consistency", "fluency", "suitability"), "미판정"


def _codes(rows: DataFrame) -> DataFrame:
    """Rows with the codes of their issues."""
    return rows.withColumn("codes", F.transform(F.from_json("reasons", "array<struct<code:string>>"), lambda x: x["code"]))


def grades(candidates: DataFrame, reviews: DataFrame) -> DataFrame:
    """By dimension and grade: candidates, by their latest review."""
    last = reviews.groupBy("candidate_id").agg(F.max_by(F.struct(*DIMENSIONS), "id").alias("r"))
    each = candidates.join(last, "candidate_id", "left").select(F.inline(F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.nullif(F.col(f"r.{d}"), F.lit("")), F.lit(UNGRADED)).alias("grade")) for d in DIMENSIONS])))
    return each.groupBy("dimension", "grade").agg(F.count("*").alias("n"))


def mentions(accepted: DataFrame) -> DataFrame:
    """By entity type and number of mentions: entities of accepted documents."""
    each = accepted.select(F.explode(F.map_values(F.from_json("metrics", "entities map<string, struct<entity_type:string,mentions:long>>")["entities"])).alias("e"))
    return each.groupBy("e.entity_type", "e.mentions").agg(F.count("*").alias("n_entities"))


def summary(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The reports of a ledger's tables by name. Each has a row per domain, stage, state, code, model and the like, not per candidate."""
    c, attempts = t["candidates"], t["stage_attempts"]
    state = F.col("status")
    spent = {k: F.col(k) for k in ("input_tokens", "cached_input_tokens", "output_tokens", "estimated_cost_usd")}
    planned = t["events"].join(c.select("candidate_id"), "candidate_id", "left_semi")
    return {
        "candidate_status_counts": c.groupBy("status").agg(F.count("*").alias("n")),
        "stages": funnel.stage_funnel(attempts, "stage", "candidate_id", ("id",), state, state.isin(*PASSED), ~state.isin(*OPEN)),
        "stage_reasons": funnel.row_reasons(_codes(attempts).where("codes is not null"), "codes"),
        "final_rejection_reasons": funnel.row_reasons(_codes(c.where("status = 'rejected'")).where("codes is not null"), "codes"),
        "selections": funnel.status_counts(c, ["domain", "subtype", "document_format", "layout_variant"], "status", STATES),
        "by_domain": ledger.domain_rollup(t["slots"], c, t["coverage_slots"]),
        "completion": ledger.completion(t["slots"], ["domain"], state == "accepted"),
        "forecast": funnel.forecast(c, t["slots"]),
        "usage": ledger.usage(t["api_calls"], ["model", "key_slot"], spent),
        "quality_latest_per_candidate": grades(c, t["reviews"]),
        "accepted_mentions": mentions(t["accepted"]),
        "repair_audit": audits.repair_audit(planned),
        "dataset_design": audits.design_counts(c, "relation_count"),
    }


def files(t: dict[str, DataFrame], reports: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What is written as CSV, by name; rows of the repairs and documents come with their JSON as it is."""
    repairs = t["events"].where("kind = 'repair_evaluated'").select("id", "candidate_id", "payload")
    kept = t["accepted"].select("candidate_id", "document_id", "document_sha256")
    whole = ledger.accepted_relations(t["accepted_relations"], kept, t["candidates"])
    coverage = t["accepted_relations"].groupBy("relation", "privacy_label").agg(F.count("*").alias("n_relations"), F.count_distinct("candidate_id").alias("n_documents"))
    return {
        "stages": reports["stages"], "selections": reports["selections"], "domains": reports["by_domain"], **{k: t[k] for k in ("candidates", "stage_attempts", "reviews", "api_calls", "slots", "events")},
        "accepted_distribution": t["accepted"].select("candidate_id", "document_id", "metrics"), "repair_progress": repairs, "accepted_relations": whole, "relation_coverage": coverage,
    }


def export(spark: SparkSession, folder: str, out: str) -> None:
    """Writes summary.json (a folder of one part) and NAME.csv for each of `files` below `out`. Tables are written by the tasks; only the summary, of small reports, passes the driver."""
    t = {k: tables.ledger(spark, folder, k) for k in tables.LEDGER}
    reports = summary(t)
    body = sinks.report_json(reports)
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/summary.json")
    for name, df in files(t, reports).items():
        sinks.write_csv(df, f"{out}/{name}.csv")
