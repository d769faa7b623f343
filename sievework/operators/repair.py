"""What a repair of a draft has to touch, what it must leave alone, and how far it got.

Rows: segments (plan_id, position, sentence_id, section_id, scene_id, kind, text), entities (plan_id, entity_id, entity_type), relations (plan_id, relation_id, ord, source, target, scene_id), scenes (plan_id,
scene_id, section_id), evidence (plan_id, relation_id, g, ids), issues (plan_id, code, entity_id, relation_id, sentence_id, section_id; null where an issue has no such target), refs (plan_id, ref_id, entity_id, surface).
All joins are by plan; what is collected into arrays is of one document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators import document

# Issues that only another text or reference can mend, and the one that new text alone mends.
SEMANTIC = (
    "PRIVACY_AMBIGUOUS", "RELATION_MEANING", "REVIEW_ENDPOINT_EVIDENCE", "REFERENCE_MEANING", "UNPLANNED_RELATIONS", "UNREGISTERED_ENTITIES", "CONTRADICTIONS", "FORMAT_MEANING", "QUALITY_GRADE",
    "REPAIR_BODY_UNCHANGED", "PERSON_COUNT_MEANING", "PERSON_ROLE_MEANING", "TEXT_FLUENCY", "TEXT_CONSISTENCY", "TEXT_FORMAT",
)
SHORT = "LENGTH_SHORTAGE"
TARGETS = ("entity_id", "relation_id", "sentence_id", "section_id")


def _all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).distinct()


def _named(issues: DataFrame, target: str) -> DataFrame:
    """The targets of one sort; an empty name is none."""
    return issues.where(F.col(target) != "").select("plan_id", target).distinct()


def mentioned(segments: DataFrame, entities: DataFrame) -> DataFrame:
    """(plan_id, entity_id) of the entities that some text names by a slot of their own type; a reference is no mention."""
    slots = segments.select("plan_id", F.explode(F.arrays_zip(F.regexp_extract_all("text", F.lit(document.SLOT), F.lit(1)).alias("k"), F.regexp_extract_all("text", F.lit(document.SLOT), F.lit(2)).alias("e"))).alias("x"))
    named = slots.select("plan_id", F.col("x.k").alias("entity_type"), F.col("x.e").alias("entity_id")).distinct()
    return entities.join(named, ["plan_id", "entity_type", "entity_id"], "left_semi").select("plan_id", "entity_id").distinct()


def missing(segments: DataFrame, entities: DataFrame) -> DataFrame:
    """(plan_id, entity_id) of the entities that no text names."""
    return entities.select("plan_id", "entity_id").distinct().join(mentioned(segments, entities), ["plan_id", "entity_id"], "left_anti")


def faulty_relations(issues: DataFrame, segments: DataFrame, entities: DataFrame, relations: DataFrame, evidence: DataFrame) -> DataFrame:
    """(plan_id, relation_id): relations that an issue names, that have an end which an issue names or no text does, or whose evidence is a sentence that an issue names."""
    ends = relations.select("plan_id", "relation_id", F.explode(F.array("source", "target")).alias("entity_id"))
    lost = _all(_named(issues, "entity_id"), missing(segments, entities))
    cited = evidence.select("plan_id", "relation_id", F.explode("ids").alias("sentence_id")).join(_named(issues, "sentence_id"), ["plan_id", "sentence_id"], "left_semi")
    named = _all(_named(issues, "relation_id"), cited.select("plan_id", "relation_id"), ends.join(lost, ["plan_id", "entity_id"], "left_semi").select("plan_id", "relation_id"))
    return relations.select("plan_id", "relation_id").distinct().join(named, ["plan_id", "relation_id"], "left_semi")


def touched_scenes(issues: DataFrame, segments: DataFrame, scenes: DataFrame, relations: DataFrame, faulty: DataFrame) -> DataFrame:
    """(plan_id, scene_id): scenes of faulty relations, of sentences and sections that issues name, scenes without a segment, and all of a plan with an issue that names nothing and isn't of length."""
    known = scenes.select("plan_id", "scene_id").distinct()
    of_relations = relations.join(faulty, ["plan_id", "relation_id"], "left_semi").select("plan_id", "scene_id")
    of_sentences = segments.join(_named(issues, "sentence_id"), ["plan_id", "sentence_id"], "left_semi").select("plan_id", "scene_id").join(known, ["plan_id", "scene_id"], "left_semi")
    of_sections = scenes.join(_named(issues, "section_id"), ["plan_id", "section_id"], "left_semi").select("plan_id", "scene_id")
    whole = issues.where((F.concat_ws("", *TARGETS) == "") & (F.col("code") != SHORT)).select("plan_id").distinct()
    return _all(of_relations, of_sentences, of_sections, known.join(segments, ["plan_id", "scene_id"], "left_anti"), known.join(whole, "plan_id", "left_semi"))


def insertion_scenes(issues: DataFrame, scenes: DataFrame, touched: DataFrame) -> DataFrame:
    """(plan_id, scene_id) where new text may go: touched scenes, and all of a plan that is too short."""
    short = issues.where(F.col("code") == SHORT).select("plan_id").distinct()
    return _all(touched, scenes.join(short, "plan_id", "left_semi").select("plan_id", "scene_id"))


def open_sentences(issues: DataFrame, segments: DataFrame, touched: DataFrame) -> DataFrame:
    """(plan_id, sentence_id, editable): sentences in touched scenes or named by an issue. Those that are named may be rewritten, the others only if the plan has an issue of meaning that names no relation."""
    named = _named(issues, "sentence_id").withColumn("__named", F.lit(True))
    wide = issues.where(F.col("code").isin(*SEMANTIC) & (F.coalesce("relation_id", F.lit("")) == "")).select("plan_id", F.lit(True).alias("__wide")).distinct()
    here = touched.select("plan_id", "scene_id", F.lit(True).alias("__here")).distinct()
    each = segments.join(here, ["plan_id", "scene_id"], "left").join(named, ["plan_id", "sentence_id"], "left").where("__here or __named").join(wide, "plan_id", "left")
    return each.groupBy("plan_id", "sentence_id").agg(F.coalesce(F.bool_or(F.col("__named").isNotNull() | F.col("__wide").isNotNull()), F.lit(False)).alias("editable"))


def relation_tasks(relations: DataFrame, evidence: DataFrame, faulty: DataFrame, touched: DataFrame, open_: DataFrame) -> DataFrame:
    """(plan_id, relation_id, operation): faulty relations are to fix, others in touched scenes or with evidence in open sentences to preserve."""
    here = relations.join(touched, ["plan_id", "scene_id"], "left_semi").select("plan_id", "relation_id")
    cited = evidence.select("plan_id", "relation_id", F.explode("ids").alias("sentence_id")).join(open_, ["plan_id", "sentence_id"], "left_semi").select("plan_id", "relation_id")
    mine = relations.select("plan_id", "relation_id").distinct().join(_all(here, cited, faulty), ["plan_id", "relation_id"], "left_semi")
    return mine.join(faulty.withColumn("__f", F.lit(True)), ["plan_id", "relation_id"], "left").select("plan_id", "relation_id", F.when(F.col("__f"), F.lit("fix")).otherwise(F.lit("preserve")).alias("operation"))


def _held(segments: DataFrame, refs: DataFrame) -> DataFrame:
    """(doc_id, sentence_id, entity_ids): what a sentence names, by slots or by references."""
    slots = segments.select("plan_id", "sentence_id", F.explode_outer(F.regexp_extract_all("text", F.lit(r"<(?:[A-Z][A-Z0-9_]*):(E[0-9]+|C[0-9]+)>"), F.lit(1))).alias("ref_id"))
    known = refs.groupBy("plan_id", "ref_id").agg(F.min("entity_id").alias("__e"))
    return slots.join(known, ["plan_id", "ref_id"], "left").groupBy(F.col("plan_id").alias("doc_id"), "sentence_id").agg(F.collect_set(F.coalesce("__e", "ref_id")).alias("entity_ids"))


def invalid_evidence(segments: DataFrame, relations: DataFrame, evidence: DataFrame, refs: DataFrame) -> DataFrame:
    """(plan_id, relation_id) of the relations whose evidence doesn't hold."""
    bad = document.evidence_issues(evidence.withColumnRenamed("plan_id", "doc_id"), _held(segments, refs), relations.select(F.col("plan_id").alias("doc_id"), "relation_id", "source", "target"))
    return bad.select(F.col("doc_id").alias("plan_id"), F.col("target").alias("relation_id"))


def protected(segments: DataFrame, relations: DataFrame, evidence: DataFrame, refs: DataFrame, faulty: DataFrame) -> DataFrame:
    """(plan_id, sentence_id): the evidence of relations that are sound."""
    sound = relations.join(faulty, ["plan_id", "relation_id"], "left_anti").join(invalid_evidence(segments, relations, evidence, refs), ["plan_id", "relation_id"], "left_anti").select("plan_id", "relation_id")
    return evidence.join(sound, ["plan_id", "relation_id"], "left_semi").select("plan_id", F.explode("ids").alias("sentence_id")).distinct()


def replacements(segments: DataFrame, entities: DataFrame, relations: DataFrame, tasks: DataFrame, kept: DataFrame) -> DataFrame:
    """(plan_id, relation_id, sentence_id): for each relation to fix, in order, the sentence to rewrite: of those of its scene that name an end, aren't protected (`kept`), headings, questions or taken by an
    earlier relation, the first that names both ends, else the first; null if there is none."""
    slot = entities.select("plan_id", "entity_id", F.concat(F.lit("<"), "entity_type", F.lit(":"), "entity_id", F.lit(">")).alias("__slot")).dropDuplicates(["plan_id", "entity_id"])
    fix = relations.join(tasks.where("operation = 'fix'").select("plan_id", "relation_id"), ["plan_id", "relation_id"], "left_semi")
    fix = fix.join(slot.toDF("plan_id", "source", "__a"), ["plan_id", "source"], "left").join(slot.toDF("plan_id", "target", "__b"), ["plan_id", "target"], "left")
    free = segments.where(~F.col("kind").isin("heading", "question")).join(kept, ["plan_id", "sentence_id"], "left_anti").select("plan_id", "scene_id", "position", "sentence_id", "text")
    names = lambda c: F.coalesce(F.contains("text", c).cast("int"), F.lit(0))
    met = free.join(fix.select("plan_id", "scene_id", "relation_id", "__a", "__b"), ["plan_id", "scene_id"]).withColumn("__n", names(F.col("__a")) + names(F.col("__b"))).where("__n > 0")
    options = met.groupBy("plan_id", "relation_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("__n")).alias("n"), "position", "sentence_id"))), lambda x: x["sentence_id"]).alias("__o"))
    per = fix.select("plan_id", "relation_id", "ord").join(options, ["plan_id", "relation_id"], "left").groupBy("plan_id").agg(F.array_sort(F.collect_list(F.struct("ord", "relation_id", F.coalesce("__o", F.array().cast("array<string>")).alias("o")))).alias("r"))
    kind = "struct<taken:array<string>,out:array<struct<relation_id:string,sentence_id:string>>>"
    start = F.struct(F.array().cast("array<string>").alias("taken"), F.array().cast("array<struct<relation_id:string,sentence_id:string>>").alias("out")).cast(kind)

    def take(state: Column, r: Column) -> Column:
        chosen = F.get(F.array_except(r["o"], state["taken"]), F.lit(0))
        taken = F.when(chosen.isNull(), state["taken"]).otherwise(F.array_append(state["taken"], chosen))
        return F.struct(taken.alias("taken"), F.array_append(state["out"], F.struct(r["relation_id"].alias("relation_id"), chosen.alias("sentence_id"))).alias("out")).cast(kind)

    return per.select("plan_id", F.inline(F.aggregate("r", start, take, lambda s: s["out"])))


def length_mode(issues: DataFrame) -> DataFrame:
    """(plan_id, mode): a plan whose only issues are of length is appended to, others are repaired."""
    return issues.groupBy("plan_id").agg(F.when(F.bool_and(F.col("code") == SHORT), F.lit("append_only")).otherwise(F.lit("targeted_repair_with_additions")).alias("mode"))


def changed_sentences(before: DataFrame, after: DataFrame) -> DataFrame:
    """(plan_id, sentence_id, scene_id) of the sentences that are new or differ from what they were."""
    same = ["sentence_id", "section_id", "scene_id", "kind", "text"]
    rows = lambda df, c: df.select("plan_id", "sentence_id", F.struct(*same).alias(c))
    j = rows(after, "__new").join(rows(before, "__old"), ["plan_id", "sentence_id"], "left").withColumn("scene_id", F.col("__new.scene_id"))
    return j.groupBy("plan_id", "sentence_id", "scene_id").agg(F.bool_or(F.col("__new").eqNullSafe(F.col("__old"))).alias("__same")).where("not __same").select("plan_id", "sentence_id", "scene_id")


def _changed_refs(before: DataFrame, after: DataFrame) -> DataFrame:
    """(plan_id) of the plans whose references differ."""
    whole = lambda df, c: df.groupBy("plan_id").agg(F.array_sort(F.collect_list(F.struct("ref_id", "entity_id", "surface"))).alias(c))
    return whole(before, "x").join(whole(after, "y"), "plan_id", "full").where(~F.col("x").eqNullSafe(F.col("y"))).select("plan_id")


def unchanged_meaning(issues: DataFrame, relations: DataFrame, changed: DataFrame, refs_changed: DataFrame) -> DataFrame:
    """Issues of meaning that a repair can't have mended: nothing changed in the scene of the relation they name (in the whole plan, if they name none) nor in the references. Each comes with a
    REPAIR_BODY_UNCHANGED, and each (code, relation, sentence) once."""
    asked = issues.where(F.col("code").isin(*SEMANTIC)).join(refs_changed, "plan_id", "left_anti")
    scenes = changed.select("plan_id", "scene_id", F.lit(True).alias("__scene")).distinct()
    plans = changed.select("plan_id", F.lit(True).alias("__any")).distinct()
    own = relations.select("plan_id", "relation_id", "scene_id").dropDuplicates(["plan_id", "relation_id"]).withColumn("__planned", F.lit(True))
    j = asked.join(own, ["plan_id", "relation_id"], "left").join(scenes, ["plan_id", "scene_id"], "left").join(plans, "plan_id", "left")
    idle = j.where(F.when(F.col("__planned"), F.col("__scene").isNull()).otherwise(F.col("__any").isNull()))
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    stay = idle.select("plan_id", "code", text("relation_id"), text("sentence_id"))
    return _all(stay, idle.select("plan_id", F.lit("REPAIR_BODY_UNCHANGED").alias("code"), text("relation_id"), F.lit("").alias("sentence_id")))


def progress(plans: DataFrame, entities: DataFrame, relations: DataFrame, tasks: DataFrame, before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """A row for each of `plans` (plan_id): what a repair left open, changed and mended. `before` and `after` hold segments, evidence, refs and issues; `tasks` are those of the repair."""
    was, left = missing(before["segments"], entities), missing(after["segments"], entities)
    wrong = tasks.join(invalid_evidence(after["segments"], relations, after["evidence"], after["refs"]), ["plan_id", "relation_id"], "left_semi")
    changed, refs_changed = changed_sentences(before["segments"], after["segments"]), _changed_refs(before["refs"], after["refs"])
    guards = unchanged_meaning(before["issues"], relations, changed, refs_changed)
    keys = ["plan_id", "code", *TARGETS]
    key = lambda df: df.select("plan_id", "code", *[F.coalesce(c, F.lit("")).alias(c) for c in TARGETS]).distinct()
    old, new = key(before["issues"]), key(after["issues"])

    def listed(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.groupBy("plan_id").agg(F.array_sort(F.collect_set(column)).alias(name))

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("plan_id").agg(F.count("*").alias(name))

    lists = {"requested_missing_entities": (was, "entity_id"), "remaining_missing_entities": (left, "entity_id"), "remaining_invalid_relation_ids": (wrong, "relation_id"), "changed_sentence_ids": (changed, "sentence_id")}
    shorts = lambda df: counted(df.where(F.col("code") == SHORT), "__x")
    counts = {
        "resolved_issue_count": old.join(new, keys, "left_anti"), "new_issue_count": new.join(old, keys, "left_anti"), "unresolved_semantic_issues": guards, "__after": after["issues"],
    }
    out = plans.select("plan_id").distinct()
    for name, (df, column) in lists.items():
        out = out.join(listed(df, column, name), "plan_id", "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    for name, df in counts.items():
        out = out.join(counted(df, name), "plan_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    out = out.join(shorts(before["issues"]).toDF("plan_id", "__s"), "plan_id", "left").join(shorts(after["issues"]).toDF("plan_id", "__t"), "plan_id", "left").join(refs_changed.withColumn("__r", F.lit(True)), "plan_id", "left")
    met = (F.size("remaining_missing_entities") == 0) & (F.size("remaining_invalid_relation_ids") == 0) & (F.col("unresolved_semantic_issues") == 0)
    named = F.size(F.array_except("requested_missing_entities", "remaining_missing_entities")) > 0
    return out.select(
        "plan_id", *lists, F.array_except("remaining_missing_entities", "requested_missing_entities").alias("new_missing_entities"), F.coalesce("__r", F.lit(False)).alias("refs_changed"),
        "resolved_issue_count", "new_issue_count", "unresolved_semantic_issues", met.alias("structural_targets_satisfied"), ((F.col("__after") == 0) & (F.col("unresolved_semantic_issues") == 0)).alias("all_code_checks_passed"),
        ((F.col("resolved_issue_count") == 0) & ~named).alias("no_effective_progress"), (~met & (F.coalesce("__s", F.lit(0)) > F.coalesce("__t", F.lit(0)))).alias("length_only_progress"),
    )
