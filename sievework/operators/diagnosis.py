"""What a draft lacks as a whole: its sections, scenes, references, evidence and length. `drafts.draft_issues` has the rules of single segments.

Rows: segments (plan_id, position, sentence_id, section_id, scene_id, kind, text), sections (plan_id, section_id, ord, allowed_kinds, mode), scenes (plan_id, scene_id, section_id), refs (plan_id, ref_id,
entity_id, surface), entities (plan_id, entity_id), values (plan_id, value), evidence and relations (plan_id, relation_id), wanted (plan_id, layout_variant, domain, subtype, min_chars, rendered_chars).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import PARTICLE_PAIRS
from sievework.operators import document

# The document kind whose recommending lines are counted, the word, and how many there may be; the share of near copies that is too much.
RECOMMENDATION = ("career_education", "recommendation", "추천", 6)
REPEATED, REPEATED_SHARE = 2, 0.08


def in_section_order(segments: DataFrame, sections: DataFrame) -> DataFrame:
    """Segments numbered anew by the order of their sections; those of unknown sections come last, and within a section their order stays."""
    joined = segments.join(sections.select("plan_id", "section_id", F.col("ord").alias("__ord")), ["plan_id", "section_id"], "left")
    w = Window.partitionBy("plan_id").orderBy(F.col("__ord").asc_nulls_last(), "position")
    return joined.withColumn("position", F.row_number().over(w) - 1).select(*segments.columns)


def repetition(segments: DataFrame) -> DataFrame:
    """(plan_id, sentences, repeated, share): how many sentences that are no headings are near copies of an earlier one. A plan's sentences are compared in one task, as they are one document."""
    per = segments.where("kind <> 'heading'").groupBy("plan_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda x: x["text"]).alias("texts"))
    later = F.size(F.array_distinct(F.transform(document.near_duplicates("texts"), lambda x: x["later"])))
    return per.select("plan_id", F.size("texts").alias("sentences"), later.alias("repeated")).withColumn("share", F.round(F.col("repeated") / F.greatest(F.col("sentences"), F.lit(1)), 4))


# what is known of a plan, an array of each, as `plan_issues` reads it
SHAPES = {
    "segments": "struct<position:int,sentence_id:string,section_id:string,scene_id:string,kind:string,text:string>",
    "sections": "struct<section_id:string,ord:int,allowed_kinds:array<string>,mode:string>",
    "scenes": "struct<scene_id:string,section_id:string>",
    "refs": "struct<ref_id:string,entity_id:string,surface:string>",
    "entities": "struct<entity_id:string>", "held": "struct<value:string>", "evidence": "struct<relation_id:string>", "relations": "struct<relation_id:string>",
    "wanted": "struct<layout_variant:string,domain:string,subtype:string,min_chars:bigint,rendered_chars:bigint>",
}


def _issues(array: str, code: str, target: str, name: str = "x") -> str:
    return f"transform({array}, {name} -> named_struct('code', '{code}', 'target', cast({target} AS string)))"


def _one(condition: str, code: str) -> str:
    return f"IF({condition}, array(named_struct('code', '{code}', 'target', cast('' AS string))), array())"


def _bad_ids(array: str, field: str, pattern: str, code: str) -> str:
    """Ids that repeat or aren't of their form."""
    ids = f"transform({array}, x -> x.{field})"
    return _one(f"size(array_distinct(filter({ids}, x -> x IS NOT NULL))) <> size({array}) OR exists({array}, x -> NOT coalesce(rlike(x.{field}, '^{pattern}$'), false))", code)


def plan_issues(plans: DataFrame) -> DataFrame:
    """(plan_id, code, target) of plans, a row each, with arrays as `SHAPES` has them, null where there is nothing; nothing is moved.

    A plan without segments is EMPTY_DOCUMENT and nothing else, if it is wanted; segments that are out of place count for no section.
    """
    p = plans.select("plan_id", *(F.coalesce(F.col(c), F.array()).cast(f"array<{t}>").alias(c) for c, t in SHAPES.items()))
    prose = "filter(segments, x -> x.kind <> 'heading')"
    p = p.withColumn("__texts", F.expr(f"transform(array_sort(transform({prose}, x -> struct(x.position, x.text))), x -> x.text)"))
    p = p.withColumn("__later", F.size(F.array_distinct(F.transform(document.near_duplicates("__texts"), lambda x: x["later"])))).withColumn("__n", F.size("__texts"))
    # a segment is there once for each section and scene of its ids, as a join would give it
    some = lambda array, same: f"transform(array(filter({array}, x -> {same})), l -> IF(size(l) = 0, array(NULL), l))[0]"
    at = f"""flatten(transform(segments, s -> flatten(transform({some('sections', 'x.section_id = s.section_id')}, y -> transform({some('scenes', 'x.scene_id = s.scene_id')}, z -> named_struct(
        'position', s.position, 'sentence_id', s.sentence_id, 'section_id', s.section_id, 'kind', s.kind, 'text', s.text, 'ord', y.ord, 'kinds', y.allowed_kinds, 'placed', coalesce(y.ord IS NOT NULL AND z.section_id = s.section_id, false)))))))"""
    asked = lambda kinds: f"NOT (array_contains({kinds}, 'question') AND array_contains({kinds}, 'answer'))"
    kinds_of = lambda array: f"transform(filter({array}, x -> x.kind IS NOT NULL), x -> x.kind)"
    blank = r"(q.surface IS NULL OR regexp_replace(q.surface, '(?U)^\\s+|\\s+$', '') = '' OR rlike(q.surface, '[<>]'))"
    found = r"flatten(transform(filter(w.here, x -> x.text IS NOT NULL), x -> regexp_extract_all(x.text, '<REF:(C[0-9]+)>', 1)))"
    slot = document.SLOT.replace("\\", "\\\\")
    pairs = f"filter(flatten(transform(filter(w.here, x -> x.text IS NOT NULL), x -> regexp_extract_all(x.text, '{slot}', 3))), x -> x <> '' AND NOT array_contains(array({', '.join(repr(v) for v in PARTICLE_PAIRS)}), x))"
    domain, subtype, word, most = RECOMMENDATION
    lines = f"filter(w.here, x -> x.kind <> 'heading' AND contains(x.text, '{word}'))"
    cited = "filter(evidence, x -> exists(relations, y -> y.relation_id = x.relation_id))"
    rules = [
        "flatten(transform(w.at, x -> concat(" + ", ".join(f"IF({c}, array(named_struct('code', '{code}', 'target', x.sentence_id)), array())" for code, c in (("SEGMENT_SCENE_SECTION", "NOT x.placed"), ("SEGMENT_KIND", "x.placed AND x.kind <> 'heading' AND NOT array_contains(x.kinds, x.kind)"))) + ")))",
        _bad_ids("segments", "sentence_id", "S[1-9][0-9]*", "DRAFT_SENTENCE_ID"), _bad_ids("refs", "ref_id", "C[1-9][0-9]*", "REFERENCE_ID"),
        _issues(f"filter(refs, q -> NOT coalesce(exists(entities, y -> y.entity_id = q.entity_id), false) OR {blank})", "REFERENCE_TARGET", "x.ref_id"),
        _issues("filter(refs, x -> coalesce(exists(held, y -> y.value = x.surface), false))", "REFERENCE_ACTUAL_VALUE", "x.ref_id"),
        _one(f"size(array_distinct(filter(transform(evidence, x -> x.relation_id), x -> x IS NOT NULL))) <> size(evidence) OR size({cited}) <> size(evidence)", "EVIDENCE_ID"),
        _issues(f"filter({found}, u -> NOT coalesce(exists(refs, y -> y.ref_id = u), false))", "MISSING_REFERENCE", "x"), _issues(pairs, "JOSA_MARKER", "x"),
        _issues("filter(sections, x -> NOT coalesce(exists(w.here, y -> y.section_id = x.section_id), false))", "MISSING_SECTION", "x.section_id"),
        _one("exists(transform(w.here, (x, i) -> i > 0 AND w.here[greatest(i - 1, 0)].ord > x.ord), x -> x)", "SECTION_ORDER"),
        _issues("filter(scenes, x -> NOT coalesce(exists(segments, y -> y.scene_id = x.scene_id), false))", "MISSING_SCENE", "x.scene_id"),
        _issues(f"filter(wanted, x -> x.layout_variant = 'question_answer' AND {asked(kinds_of('segments'))})", "QUESTION_ANSWER_LAYOUT", "''"),
        _issues(f"filter(sections, q -> q.mode = 'qa' AND {asked(kinds_of('filter(segments, y -> y.section_id = q.section_id)'))})", "SPEC_QUESTION_ANSWER", "x.section_id"),
        _issues("filter(wanted, x -> x.min_chars > x.rendered_chars)", "LENGTH_SHORTAGE", "x.min_chars - x.rendered_chars"),
        _issues(f"IF(exists(wanted, x -> x.domain = '{domain}' AND x.subtype = '{subtype}'), slice({lines}, {most + 1}, greatest(size(w.here), 1)), slice(w.here, 1, 0))", "PROSE_REPETITION", "x.sentence_id"),
        _one(f"__later >= {REPEATED} AND round(__later / greatest(__n, 1), 4) >= {REPEATED_SHARE}", "PROSE_REPETITION"),
    ]
    kind = "array<struct<code:string,target:string>>"
    every = "concat(" + ", ".join(f"cast({r} AS {kind})" for r in rules) + ")"
    whole = f"transform(array({at}), a -> transform(array(named_struct('at', a, 'here', array_sort(filter(a, x -> x.placed), (x, y) -> CASE WHEN x.position < y.position OR x.position IS NULL AND y.position IS NOT NULL THEN -1 WHEN x.position <=> y.position THEN 0 ELSE 1 END))), w -> {every})[0])[0]"
    empty = _issues("wanted", "EMPTY_DOCUMENT", "''")
    return p.select("plan_id", F.explode(F.expr(f"IF(size(segments) = 0, cast({empty} AS {kind}), {whole})")).alias("i")).select("plan_id", "i.code", "i.target")


def diagnose(segments: DataFrame, sections: DataFrame, scenes: DataFrame, refs: DataFrame, entities: DataFrame, values: DataFrame, evidence: DataFrame, relations: DataFrame, wanted: DataFrame) -> DataFrame:
    """`plan_issues` of tables: all rows of a plan become one in a single shuffle."""
    tables = dict(zip(SHAPES, (segments, sections, scenes, refs, entities, values, evidence, relations, wanted), strict=True))
    fields = lambda t: re.findall(r"[<,](\w+):", t)
    rows = [df.select("plan_id", *((F.struct(*fields(t)) if c == name else F.lit(None)).cast(t).alias(c) for c, t in SHAPES.items())) for name, df in tables.items()]
    return plan_issues(reduce(DataFrame.unionByName, rows).groupBy("plan_id").agg(*(F.collect_list(c).alias(c) for c in SHAPES)))
