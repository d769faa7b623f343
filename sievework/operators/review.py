"""Gates over reviews. Issues are (doc_id, code, target); `document.gate` turns them into a verdict per document.

A reviewed item is a relation, a reference, a person or a relation that wasn't planned, each with quotes (sentence_id, quote) and groups of sentence ids as evidence. A document's sentences and its
mentions are brought to an item as one row of the document, so joins are by doc_id and grow with the items.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.operators.document import issues
from sievework.plans.steps import written

# Codes by the kind of a text finding; the best grade and the one below.
TEXT_CODES = {"fluency": "TEXT_FLUENCY", "consistency": "TEXT_CONSISTENCY", "format": "TEXT_FORMAT"}
TOP, MIDDLE, LOW = "상", "중", "하"
_IDS = "array<string>"


def _issue(df: DataFrame, code: Column | str, target: Column | str = "") -> DataFrame:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select("doc_id", as_column(code).alias("code"), F.coalesce(as_column(target).cast("string"), F.lit("")).alias("target"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def coverage(checked: DataFrame, expected: DataFrame, column: str, code: str) -> DataFrame:
    """Ids that are expected and not checked just once, or checked and not expected."""
    n = checked.groupBy("doc_id", column).agg(F.count("*").alias("__k"))
    want = expected.select("doc_id", column, F.lit(True).alias("__want")).distinct()
    return _issue(want.join(n, ["doc_id", column], "full").where(F.col("__want").isNull() | (F.coalesce("__k", F.lit(0)) != 1)), code, F.col(column))


def by_document(sentences: DataFrame, mentions: DataFrame) -> DataFrame:
    """(doc_id, texts, held): a document's sentences by id, and for each sentence the entities that it mentions or refers to. mentions: doc_id, sentence_id, entity_id."""
    texts = sentences.groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct("sentence_id", "sentence"))).alias("texts"))
    per = mentions.groupBy("doc_id", "sentence_id").agg(F.collect_set("entity_id").alias("e"))
    held = per.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("sentence_id", "e"))).alias("held"))
    return texts.join(held, "doc_id", "left").withColumn("held", F.coalesce("held", F.create_map().cast("map<string,array<string>>")))


def covered(group: Column) -> Column:
    """The entities of a group's sentences."""
    return F.array_distinct(F.flatten(F.transform(group, lambda s: F.coalesce(F.try_element_at("held", s), F.array().cast(_IDS)))))


def quote_issues(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Quotes that aren't in their sentence, groups that are empty or repeat a sentence, and sentences of groups without a true quote. items: doc_id, item_id, quotes, groups."""
    i = items.join(documents, "doc_id")
    true = lambda q: F.coalesce((q["quote"] != "") & F.contains(F.try_element_at("texts", q["sentence_id"]), q["quote"]), F.lit(False))
    i = i.select("doc_id", "item_id", "groups", F.transform(F.filter("quotes", true), lambda q: q["sentence_id"]).alias("good"), F.transform(F.filter("quotes", lambda q: ~true(q)), lambda q: q["sentence_id"]).alias("bad"))
    odd = F.filter("groups", lambda g: (F.size(g) == 0) | (F.size(F.array_distinct(g)) < F.size(g)))
    bare = F.filter(F.flatten("groups"), lambda s: ~F.array_contains("good", s))
    return _union([
        _issue(i.select("doc_id", F.explode("bad").alias("s")), "REVIEW_QUOTE", F.col("s")),
        _issue(i.select("doc_id", "item_id", F.explode(odd)), "REVIEW_EVIDENCE_GROUP", F.col("item_id")),
        _issue(i.select("doc_id", F.explode(bare).alias("s")), "REVIEW_EVIDENCE_QUOTE_MISSING", F.col("s")),
    ])


def relation_meaning(checks: DataFrame, planned: DataFrame, documents: DataFrame) -> DataFrame:
    """checks: doc_id, relation_id, extractable, direction_supported, coreference_unambiguous, observed_privacy, groups; planned: doc_id, relation_id, source, target, target_privacy."""
    j = checks.join(planned, ["doc_id", "relation_id"]).join(documents, "doc_id")
    usable = F.filter("groups", lambda g: (F.size(g) > 0) & F.forall(g, lambda s: F.map_contains_key("texts", s)))
    tied = F.exists(usable, lambda g: F.array_contains(covered(g), F.col("source")) & F.array_contains(covered(g), F.col("target")))
    sound = F.col("extractable") & F.col("direction_supported") & F.col("coreference_unambiguous") & F.col("observed_privacy").isin("AMBIGUOUS", F.col("target_privacy"))
    rules = {
        "PRIVACY_AMBIGUOUS": F.col("observed_privacy") == "AMBIGUOUS",
        "RELATION_MEANING": ~sound,
        "REVIEW_MISSING_EVIDENCE": F.col("extractable") & (F.size("groups") == 0),
        "REVIEW_ENDPOINT_EVIDENCE": (F.size(usable) > 0) & ~tied,
    }
    return issues(j, "doc_id", rules, F.col("relation_id"))


def reference_meaning(checks: DataFrame, refs: DataFrame, mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """checks: doc_id, ref_id, observed_entity_id, unambiguous, groups; refs: doc_id, ref_id, entity_id (intended), sentence_ids; mentions: doc_id, sentence_id, entity_id, of actual values only."""
    where = mentions.groupBy("doc_id", F.col("entity_id").alias("observed_entity_id")).agg(F.collect_set("sentence_id").alias("__at"))
    j = checks.join(refs, ["doc_id", "ref_id"], "left").join(where, ["doc_id", "observed_entity_id"], "left")
    none = F.array().cast(_IDS)
    apart = F.filter("groups", lambda g: ~(F.arrays_overlap(g, F.coalesce("sentence_ids", none)) & F.arrays_overlap(g, F.col("__at"))))
    per = issues(
        j, "doc_id",
        {
            "REVIEW_REFERENCE_ENTITY": F.col("observed_entity_id").isNotNull() & F.col("__at").isNull(),
            "REFERENCE_MEANING": ~F.col("unambiguous") | ~F.col("observed_entity_id").eqNullSafe(F.col("entity_id")),
            "REVIEW_REFERENCE_EVIDENCE": F.col("unambiguous") & (F.size("groups") == 0),
        },
        F.col("ref_id"),
    )
    far = j.where(F.col("unambiguous") & F.col("__at").isNotNull()).select("doc_id", "ref_id", F.explode(apart))
    return per.unionByName(_issue(far, "REVIEW_REFERENCE_CONNECTION", F.col("ref_id")))


def person_meaning(persons: DataFrame, planned: DataFrame, names: DataFrame, counts: DataFrame) -> DataFrame:
    """persons: doc_id, name_entity_id, role, context_kind, groups; planned: doc_id, name_entity_id, role, context_kind; names: doc_id, name_entity_id, sentence_ids; counts: doc_id, actual_person_count,
    n_parties (null: as observed), unregistered_names."""
    j = persons.join(planned.toDF("doc_id", "name_entity_id", "__role", "__kind"), ["doc_id", "name_entity_id"], "left").join(names, ["doc_id", "name_entity_id"], "left")
    seen = F.coalesce("sentence_ids", F.array().cast(_IDS))
    rules = {
        "REVIEW_PERSON_EVIDENCE": (F.size("groups") == 0) | F.exists("groups", lambda g: ~F.arrays_overlap(g, seen)),
        "PERSON_ROLE_MEANING": F.col("__role").isNotNull() & ((F.col("role") != F.col("__role")) | (F.col("context_kind") != F.col("__kind"))),
    }
    n = counts.join(persons.groupBy("doc_id").agg(F.count_if(F.col("context_kind") == "actual_party").alias("__n")), "doc_id", "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    whole = issues(n, "doc_id", {"REVIEW_PERSON_COUNT": (F.col("unregistered_names") == 0) & (F.col("actual_person_count") != F.col("__n")), "PERSON_COUNT_MEANING": F.col("actual_person_count") != F.coalesce("n_parties", "__n")}, F.lit(""))
    return _union([issues(j, "doc_id", rules, F.col("name_entity_id")), whole, coverage(persons, names, "name_entity_id", "REVIEW_PERSON_COVERAGE")])


def text_findings(findings: DataFrame) -> DataFrame:
    """One issue for each sentence of a text finding (doc_id, kind, sentence_ids), or one for the document."""
    code = reduce(lambda c, kv: c.when(F.col("kind") == kv[0], F.lit(kv[1])), TEXT_CODES.items(), F)
    each = findings.withColumn("__c", code).select("doc_id", "__c", F.explode(F.when(F.size("sentence_ids") > 0, F.col("sentence_ids")).otherwise(F.array(F.lit("")))).alias("s"))
    return _issue(each, F.col("__c"), F.col("s"))


def quality(reviews: DataFrame, found: DataFrame) -> DataFrame:
    """A grade below the best is an issue, and one that no finding explains can't be repaired. reviews: doc_id, overall, consistency, suitability, fluency."""
    wide = ("TEXT_CONSISTENCY", "CONTRADICTIONS", "PRIVACY_AMBIGUOUS", "RELATION_MEANING", "REVIEW_ENDPOINT_EVIDENCE", "REFERENCE_MEANING", "PERSON_COUNT_MEANING", "PERSON_ROLE_MEANING", "UNPLANNED_RELATIONS", "UNREGISTERED_ENTITIES")
    of = {"consistency": wide, "fluency": ("TEXT_FLUENCY",), "suitability": ("TEXT_FORMAT", "FORMAT_MEANING", "DOCUMENT_SPEC_INCOMPLETE")}
    codes = found.groupBy("doc_id").agg(F.collect_set("code").alias("__codes"))
    told = {k: F.arrays_overlap(F.coalesce("__codes", F.array().cast(_IDS)), F.array(*map(F.lit, v))) for k, v in of.items()}
    worst = {"consistency": F.col("consistency") != TOP, "fluency": F.col("fluency") == LOW, "suitability": F.col("suitability") != TOP}
    low = reduce(lambda a, b: a | b, [F.col("overall") != TOP, F.col("consistency") != TOP, F.col("suitability") != TOP, ~F.col("fluency").isin(TOP, MIDDLE)])
    unsaid = reduce(lambda a, b: a | b, [worst[k] & ~told[k] for k in of]) | ((F.col("overall") != TOP) & ~reduce(lambda a, b: a | b, told.values()))
    return issues(reviews.join(codes, "doc_id", "left"), "doc_id", {"QUALITY_GRADE": low, "REVIEW_QUALITY_TARGET": low & unsaid}, F.lit(""))


def privacy_gate(checks: DataFrame, planned: DataFrame, reviews: DataFrame, findings: DataFrame) -> DataFrame:
    """The default gate: every relation checked once, supported, in its direction, attributed, and of the planned label.

    checks: doc_id, relation_id, relation_supported, direction_supported, attribution_supported, observed_privacy; planned: doc_id, relation_id, target_privacy; reviews: doc_id, n_unplanned, format_ok, overall;
    findings: doc_id, kind, sentence_ids. A null answer doesn't support.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    ok = yes("relation_supported") & yes("direction_supported") & yes("attribution_supported")
    torn = F.coalesce(F.col("observed_privacy") == "AMBIGUOUS", F.lit(False))
    per = issues(checks.join(planned, ["doc_id", "relation_id"]), "doc_id", {"RELATION_MEANING": ~ok | (~torn & ~F.col("observed_privacy").eqNullSafe(F.col("target_privacy"))), "PRIVACY_AMBIGUOUS": ~ok | torn}, F.col("relation_id"))
    extra = reviews.select("doc_id", F.explode(F.array_repeat(F.lit(""), F.col("n_unplanned"))).alias("x"))
    whole = issues(reviews, "doc_id", {"FORMAT_MEANING": ~yes("format_ok"), "QUALITY_GRADE": ~F.col("overall").eqNullSafe(TOP)}, F.lit(""))
    return _union([coverage(checks, planned, "relation_id", "REVIEW_RELATION_COVERAGE"), per, _issue(extra, "UNPLANNED_RELATIONS"), whole, text_findings(findings)])


def _without(c: Column, kind: T.DataType, hidden: tuple[str, ...]) -> Column:
    """A value without the hidden fields at any depth: in structs, arrays and map values."""
    if not any(f'"name":"{h}"' in kind.json() for h in hidden):
        return c
    if isinstance(kind, T.StructType):
        kept = [f for f in kind.fields if f.name not in hidden]
        whole = F.struct(*[_without(c[f.name], f.dataType, hidden).alias(f.name) for f in kept]) if kept else F.lit(None).cast("void")
        return F.when(c.isNotNull(), whole)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _without(x, kind.elementType, hidden))
    return F.transform_values(c, lambda _, x: _without(x, kind.valueType, hidden))


def reviewer_view(plan: DataFrame, hidden: tuple[str, ...] = ("target_privacy", "context_reason", "scene_id")) -> DataFrame:
    """Planned relations without what a reviewer mustn't see; copies of the hidden fields inside structs, arrays and map values go too."""
    kept = plan.drop(*hidden)
    return kept.select(*[_without(F.col(f.name), f.dataType, hidden).alias(f.name) for f in kept.schema.fields])


def consumer_view(plan: DataFrame, allowed: dict) -> DataFrame:
    """The columns that `allowed` names, and of nested values only the fields named below them: {"id": None, "entities": {"entity_id": None}}. None keeps a value whole; arrays are gone through."""

    def only(c: Column, kind: T.DataType, part: dict | None) -> Column:
        if part is None:
            return c
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: only(x, kind.elementType, part))
        return F.when(c.isNotNull(), F.struct(*[only(c[k], kind[k].dataType, v).alias(k) for k, v in part.items()]))

    return plan.select(*[only(F.col(k), plan.schema[k].dataType, v).alias(k) for k, v in allowed.items()])


def extra_relations(missing: DataFrame) -> DataFrame:
    """Relations that a review found and the plan hasn't (doc_id, item_id, groups): one issue for each sentence of their evidence; without evidence the review says too little."""
    each = missing.select("doc_id", "item_id", F.explode(F.when(F.size("groups") > 0, F.array_distinct(F.flatten("groups"))).otherwise(F.array(F.lit("")))).alias("s"))
    return _issue(each, "UNPLANNED_RELATIONS", F.col("s")).unionByName(_issue(missing.where(F.size("groups") == 0), "REVIEW_EXTRA_EVIDENCE", F.col("item_id")))


def contradictions(found: DataFrame, documents: DataFrame) -> DataFrame:
    """found: doc_id, sentence_ids. An issue for each sentence, or one for the document; a sentence that isn't there is the review's fault."""
    each = found.join(documents.select("doc_id", "texts"), "doc_id").select("doc_id", "texts", F.explode(F.when(F.size("sentence_ids") > 0, F.col("sentence_ids")).otherwise(F.array(F.lit("")))).alias("s"))
    known = (F.col("s") == "") | F.map_contains_key("texts", F.col("s"))
    return _issue(each, F.when(known, F.lit("CONTRADICTIONS")).otherwise(F.lit("REVIEW_TEXT_TARGET")), F.col("s"))


def targeted_findings(findings: DataFrame, planned: DataFrame, documents: DataFrame) -> DataFrame:
    """findings: doc_id, kind, sentence_ids, relation_ids. Text findings need sentences, all of them known, and known relations; else REVIEW_TEXT_TARGET stands for them."""
    rids = planned.groupBy("doc_id").agg(F.collect_set("relation_id").alias("__r"))
    j = findings.join(documents.select("doc_id", "texts"), "doc_id").join(rids, "doc_id", "left")
    good = (F.size("sentence_ids") > 0) & F.forall("sentence_ids", lambda s: F.map_contains_key("texts", s)) & F.forall("relation_ids", lambda r: F.array_contains(F.coalesce("__r", F.array().cast(_IDS)), r))
    return _issue(j.where(~good), "REVIEW_TEXT_TARGET").unionByName(text_findings(j.where(good).select("doc_id", "kind", "sentence_ids")))


@dataclass
class Reviewed:
    """What a full review says, and what it is about. Items with evidence have quotes, array<struct<sentence_id, quote>>, and groups, array<array<sentence id>>.

    relations: doc_id, relation_id, extractable, direction_supported, coreference_unambiguous, observed_privacy; references: doc_id, ref_id, observed_entity_id, unambiguous; extra: doc_id, item_id; persons:
    doc_id, name_entity_id, role, context_kind - all with evidence. counts: see `person_meaning`; unregistered: doc_id, sentence_id; contradictions: doc_id, sentence_ids; findings: see `targeted_findings`;
    grades: doc_id, format_ok, overall, consistency, suitability, fluency.
    planned, refs, people, names, mentions, documents: the plan and the document, as the single rules take them.
    """

    relations: DataFrame
    references: DataFrame
    extra: DataFrame
    persons: DataFrame
    counts: DataFrame
    unregistered: DataFrame
    contradictions: DataFrame
    findings: DataFrame
    grades: DataFrame
    planned: DataFrame
    refs: DataFrame
    people: DataFrame
    names: DataFrame
    mentions: DataFrame
    documents: DataFrame


def full_gate(r: Reviewed) -> DataFrame:
    """All issues of the gate with full evidence: coverage of relations, references and people, quotes, meaning, what the plan hasn't, findings, format and grades.

    All tables have rows for every document, and such as compress well look small enough to be broadcast, which would take them through the driver: they are joined by sorting. What is found is written, since grades ask for it again.
    """
    r = Reviewed(**{f.name: getattr(r, f.name).hint("merge") for f in fields(r)})
    evidence = [df.select("doc_id", F.col(c).alias("item_id"), "quotes", "groups") for df, c in ((r.relations, "relation_id"), (r.references, "ref_id"), (r.extra, "item_id"), (r.persons, "name_entity_id"))]
    found = _union([
        coverage(r.relations, r.planned, "relation_id", "REVIEW_RELATION_COVERAGE"), coverage(r.references, r.refs, "ref_id", "REVIEW_REFERENCE_COVERAGE"), quote_issues(_union(evidence), r.documents),
        relation_meaning(r.relations, r.planned, r.documents), reference_meaning(r.references, r.refs, r.mentions, r.documents), person_meaning(r.persons, r.people, r.names, r.counts), extra_relations(r.extra),
        _issue(r.unregistered, "UNREGISTERED_ENTITIES", F.col("sentence_id")), contradictions(r.contradictions, r.documents), targeted_findings(r.findings, r.planned, r.documents),
        _issue(r.grades.where(~F.coalesce("format_ok", F.lit(False))), "FORMAT_MEANING"),
    ])
    found = written(found)
    return found.unionByName(quality(r.grades, found.hint("merge")))
