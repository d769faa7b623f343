"""Audits: latest against ever, selection outcomes, repairs, design allocations, mention positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.stats import rate


def latest_grade(items: DataFrame, grades: DataFrame, key: str, grade: str, ungraded: str) -> DataFrame:
    """Items by grade; those without one count as `ungraded`."""
    return items.join(grades.select(key, grade), key, "left").groupBy(F.coalesce(F.col(grade).cast("string"), F.lit(ungraded)).alias("grade")).agg(F.count("*").alias("n"))


def ever_vs_latest(rows: DataFrame, key: str, order: tuple[str, ...], flag: Column) -> DataFrame:
    """By outcome (ever and latest): how many keys had the flag in any row, and in their last row."""
    per = rows.groupBy(key).agg(F.bool_or(flag).alias("ever"), F.max_by(flag, F.struct(*order)).alias("latest"))
    return per.groupBy("ever", "latest").agg(F.count("*").alias("n_keys"))


def selection_audit(candidates: DataFrame, reviews: DataFrame, relations: DataFrame) -> DataFrame:
    """One row: reviewed candidates, those whose latest review is valid, and how many were judged ambiguous by the latest valid review or ever.

    `relations`: candidate_id, review_version, response_valid, observed_privacy, planned_privacy, mode and confirmed.
    """
    last = reviews.groupBy("candidate_id").agg(F.max_by(F.struct("version", (F.col("response_valid") == 1).alias("ok")), "id").alias("__last"))
    here = F.col("__last.ok") & (F.col("review_version") == F.col("__last.version"))
    ambiguous = F.col("observed_privacy") == "AMBIGUOUS"
    per = last.join(relations, "candidate_id", "left").groupBy("candidate_id").agg(
        F.first("__last.ok").alias("valid"), F.bool_or(F.when(here, ambiguous)).alias("ambiguous"), F.bool_or(here).alias("seen"), F.bool_or((F.col("response_valid") == 1) & ambiguous).alias("ever")
    )
    flags = per.join(candidates.select("candidate_id", "status"), "candidate_id", "left")
    out = flags.agg(
        F.count("*").alias("reviewed"), F.count_if("valid").alias("valid_latest"), F.count_if(~F.coalesce("valid", F.lit(False))).alias("invalid_latest"),
        F.count_if("seen").alias("observed"), F.count_if("ambiguous").alias("latest_ambiguous"), F.count_if("ever").alias("ever_ambiguous"),
        F.count_if(F.col("ever") & (F.col("status") == "accepted")).alias("ever_ambiguous_accepted"),
        F.count_if(F.col("ever") & (F.col("status") == "rejected")).alias("ever_ambiguous_rejected"),
    )
    return out.withColumn("ambiguity_rate", rate(F.col("latest_ambiguous"), F.col("observed")))


def latest_judgements(candidates: DataFrame, reviews: DataFrame, relations: DataFrame) -> DataFrame:
    """By the candidate's outcome, mode and observed privacy: relations of each candidate's latest review, where that is valid."""
    last = reviews.groupBy("candidate_id").agg(F.max_by(F.struct("version", "response_valid"), "id").alias("__last"))
    now = last.where("__last.response_valid = 1").select("candidate_id", F.col("__last.version").alias("review_version"))
    return relations.join(now, ["candidate_id", "review_version"]).join(candidates.select("candidate_id", "status"), "candidate_id").groupBy("status", "mode", "observed_privacy").agg(F.count("*").alias("n"))


def confirmed_modes(relations: DataFrame, candidates: DataFrame) -> DataFrame:
    """Confirmed relations of accepted candidates by how their evidence is laid out."""
    ok = candidates.where("status = 'accepted'").select("candidate_id")
    return relations.join(ok, "candidate_id", "left_semi").where(F.col("confirmed") & (F.col("observed_privacy") == F.col("planned_privacy"))).groupBy("mode").agg(F.count("*").alias("n"))


def repair_audit(events: DataFrame) -> DataFrame:
    """One row over repair_evaluated events: how many attempts met each check, and what they left over."""
    kind = "structural_targets_satisfied boolean, all_code_checks_passed boolean, no_effective_progress boolean, length_only_progress boolean, remaining_missing_entities array<string>, remaining_invalid_relation_ids array<string>"
    p = events.where("kind = 'repair_evaluated'").select(F.from_json("payload", kind).alias("p")).select("p.*")
    flags = ("structural_targets_satisfied", "all_code_checks_passed", "no_effective_progress", "length_only_progress")
    return p.agg(
        F.count("*").alias("evaluated_attempts"), *[F.count_if(f).alias(f) for f in flags],
        F.coalesce(F.sum(F.greatest(F.size("remaining_missing_entities"), F.lit(0))), F.lit(0)).alias("remaining_missing_entities"),
        F.coalesce(F.sum(F.greatest(F.size("remaining_invalid_relation_ids"), F.lit(0))), F.lit(0)).alias("remaining_invalid_relations"),
    )


def design_counts(candidates: DataFrame, field: str) -> DataFrame:
    """Candidates, refused ones too, by a field of their condition JSON; those without a condition are left out."""
    return candidates.where(F.col("condition_json").isNotNull() & (F.col("condition_json") != "")).groupBy(F.get_json_object("condition_json", f"$.{field}").alias("value")).agg(F.count("*").alias("n"))


def thirds(mentions: DataFrame, doc: str, at: Column, length: Column) -> DataFrame:
    """By document third (0 to 2): mentions and documents."""
    third = F.least(F.lit(2), F.floor(at * 3 / F.greatest(F.lit(1), length))).cast("int")
    return mentions.groupBy(third.alias("third")).agg(F.count("*").alias("n_mentions"), F.count_distinct(doc).alias("n_documents"))


def with_offsets(sentences: DataFrame, doc: str, order: str, text: str) -> DataFrame:
    """Adds where each sentence starts in its document, sentences set end to end."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sentences.withColumn("start", F.coalesce(F.sum(F.length(text)).over(w), F.lit(0)))


def delta(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that went and keys that came, with which of both."""
    gone = before.select(*keys).distinct().join(after.select(*keys).distinct(), keys, "left_anti").withColumn("change", F.lit("resolved"))
    new = after.select(*keys).distinct().join(before.select(*keys).distinct(), keys, "left_anti").withColumn("change", F.lit("new"))
    return gone.unionByName(new)


def grouped_issues(issues: DataFrame) -> DataFrame:
    """Equal (code, message, action) once, with their different targets."""
    return issues.groupBy("code", "message", "action").agg(F.array_sort(F.collect_set("target")).alias("targets"), F.count("*").alias("n"))


def section_shortage(rows: DataFrame, keys: list[str], length: Column, least: Column) -> DataFrame:
    """By keys: characters there, and how many are missing to the target."""
    per = rows.groupBy(*keys).agg(F.sum(length).alias("n_chars"), F.max(least).alias("target"))
    return per.withColumn("shortage", F.greatest(F.lit(0), F.col("target") - F.col("n_chars")))


def design(candidates: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, n): `design_counts` of several fields of the condition in one pass over the candidates."""
    known = candidates.where(F.col("condition_json").isNotNull() & (F.col("condition_json") != ""))
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.get_json_object("condition_json", f"$.{f}").alias("value")) for f in fields])
    return known.select(F.explode(each).alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


def mention_distribution(sentences: DataFrame, mentions: DataFrame, labels: DataFrame) -> DataFrame:
    """By document: mentions of personal and other entities, the personal share (0 without mentions), and per group the scenes and thirds of the document that have some, and the entities mentioned more than once.

    sentences: doc_id, position, sentence, scene_id; mentions: doc_id, entity_id, position, begin; labels: doc_id, entity_id, privacy. Sentences stand end to end.
    """
    placed = with_offsets(sentences, "doc_id", "position", "sentence")
    total = sentences.groupBy("doc_id").agg(F.sum(F.length("sentence")).alias("__total"))
    j = mentions.join(placed.select("doc_id", "position", "start", "scene_id"), ["doc_id", "position"]).join(total, "doc_id").join(labels, ["doc_id", "entity_id"])
    third = F.least(F.lit(2), F.floor((F.col("start") + F.col("begin")) * 3 / F.greatest(F.lit(1), F.col("__total")))).cast("int")
    entity = j.withColumn("third", third).groupBy("doc_id", "entity_id", "privacy").agg(F.count("*").alias("n"), F.collect_set("scene_id").alias("s"), F.collect_set("third").alias("t"))
    out = []
    for p, name in (("PII", "pii"), ("NON_PII", "non_pii")):
        own = F.col("privacy") == p
        both = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(own, F.col(c))))))
        out += [F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(f"{name}_mentions"), F.count_if(own & (F.col("n") > 1)).alias(f"{name}_repeated"), both("s").alias(f"{name}_scenes"), both("t").alias(f"{name}_thirds")]
    per = sentences.select("doc_id").distinct().join(entity.groupBy("doc_id").agg(*out), "doc_id", "left")
    counts = {c: F.coalesce(c, F.lit(0).cast("long")) for n in ("pii", "non_pii") for c in (f"{n}_mentions", f"{n}_repeated")}
    per = per.withColumns(counts)
    share = F.try_divide(F.col("pii_mentions"), F.col("pii_mentions") + F.col("non_pii_mentions"))
    return per.withColumn("pii_share", F.coalesce(share, F.lit(0.0)))
