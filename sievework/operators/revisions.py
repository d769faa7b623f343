"""Patches of drafts: text, references and evidence change together under one base version, or not at all.

A draft is one row, and so is its patch, so a revision is one join and everything else happens inside the row: the new row holds all parts and says whether the patch was taken, which is the commit marker. A refused patch
leaves its draft as it is. Rows may be of any number; a draft's own lists are scanned for ids, so they should have some thousands of entries at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: what texts are compared without.
SET_ASIDE = r"(?U)<[^>]+>|\{josa:[^}]+\}|\s+"
_SEGMENTS = "array<struct<sentence_id:string,text:string>>"
_REFS = "array<struct<ref_id:string,value:string>>"
_EVIDENCE = "array<struct<relation_id:string,ids:array<string>>>"
#: What a patch holds besides doc_id and base_version; a null list is an empty one.
PATCH = {
    "replacements": _SEGMENTS, "insertions": f"array<struct<after:string,segments:{_SEGMENTS}>>", "ref_updates": _REFS, "evidence_updates": _EVIDENCE, "protected": "array<array<string>>",
}


def _each(code: str, targets: str) -> str:
    return f"transform({targets}, t -> named_struct('code', '{code}', 'target', cast(t AS string)))"


def _repeated(ids: str) -> str:
    """Ids that come more than once."""
    return f"transform(array({ids}), l -> filter(array_distinct(l), t -> size(filter(l, u -> u = t)) > 1))[0]"


def _refusals() -> str:
    old = "transform(segments, s -> s.sentence_id)"
    replaced = "transform(replacements, s -> s.sentence_id)"
    added = "flatten(transform(insertions, i -> i.segments))"
    new = f"transform({added}, s -> s.sentence_id)"
    # of a protected group, sentences that stand next to each other: nothing goes between
    places = f"array_sort(filter(transform(g, x -> array_position({old}, x)), p -> p > 0))"
    closed = f"flatten(transform(protected, g -> transform(array({places}), l -> transform(filter(l, p -> array_contains(l, p + 1)), p -> segments[cast(p AS int) - 1].sentence_id))[0]))"
    plain = lambda text: f"regexp_replace({text}, r'{SET_ASIDE}', '')"
    texts = f"transform({added}, s -> {plain('s.text')})"
    rewrites = "size(replacements) + size(ref_updates) + size(evidence_updates) > 0"
    parts = [
        f"IF(length_only AND {rewrites}, {_each('LENGTH_REWRITE_FORBIDDEN', "array('')")}, none)",
        f"IF(length_only AND size({added}) = 0, {_each('LENGTH_ADDITION_EMPTY', "array('')")}, none)",
        f"IF(length_only, {_each('LENGTH_ADDITION_REPEATED', f'''transform(filter({texts}, (x, i) -> exists(segments, s -> {plain('s.text')} = x) OR array_position({texts}, x) <= i), x -> x)''')}, none)",
        f"IF(base_version IS NULL OR base_version <> draft_version, {_each('PATCH_BASE_VERSION', 'array(base_version)')}, none)",
        _each("PATCH_REPLACEMENT_ID", f"array_union({_repeated(replaced)}, filter({replaced}, t -> NOT array_contains({old}, t)))"),
        _each("PATCH_DUPLICATE_UPDATE", f"concat({_repeated('transform(ref_updates, r -> r.ref_id)')}, {_repeated('transform(evidence_updates, r -> r.relation_id)')})"),
        _each("PATCH_ANCHOR", f"array_distinct(filter(transform(insertions, i -> i.after), t -> t <> '' AND NOT array_contains({old}, t)))"),
        _each("PATCH_PROTECTED_GAP", f"array_distinct(filter(transform(insertions, i -> i.after), t -> array_contains({closed}, t)))"),
        _each("PATCH_NEW_ID", f"array_union({_repeated(new)}, filter({new}, t -> array_contains({old}, t)))"),
    ]
    return f"concat({', '.join(parts)})"


def _merged(old: str, new: str, key: str) -> str:
    """Entries of `old`, in their order, as `new` has them, and then those that only `new` has."""
    return f"""concat(transform({old}, o -> coalesce(try_element_at(filter({new}, n -> n.{key} = o.{key}), -1), o)), filter({new}, n -> NOT exists({old}, o -> o.{key} = n.{key})))"""


def revised(drafts: DataFrame, patches: DataFrame) -> DataFrame:
    """doc_id, draft_version, segments, refs, evidence, committed and refusals, array<struct<code, target>>, of every draft.

    drafts: doc_id, draft_version, segments, refs, evidence. patches: doc_id, base_version, length_only, and the lists of PATCH; one a draft at most. A draft without a patch stays, committed is null. Replaced
    sentences keep their place, insertions follow their anchor ('' is the start) in the order of the patch. References that no sentence names any more go, but where only length was added; updates win over what was there.
    """
    kinds = {"segments": _SEGMENTS, "refs": _REFS, "evidence": _EVIDENCE}
    d = drafts.select("doc_id", "draft_version", *(F.coalesce(F.col(c).cast(t), F.array().cast(t)).alias(c) for c, t in kinds.items()))
    p = patches.select(F.col("doc_id").alias("__doc"), F.col("base_version"), F.coalesce("length_only", F.lit(False)).alias("length_only"), *(F.col(c).cast(t).alias(c) for c, t in PATCH.items()))
    joined = d.join(p, F.col("doc_id") == F.col("__doc"), "left").withColumns({c: F.coalesce(F.col(c), F.array().cast(t)) for c, t in PATCH.items()})
    joined = joined.withColumn("none", F.array().cast("array<struct<code:string,target:string>>"))
    checked = joined.withColumn("refusals", F.when(F.col("__doc").isNull(), F.col("none")).otherwise(F.expr(_refusals())))
    checked = checked.withColumn("committed", F.when(F.col("__doc").isNotNull(), F.size("refusals") == 0))
    behind = lambda anchor: f"flatten(transform(filter(insertions, i -> i.after = {anchor}), i -> i.segments))"
    texts = f"""concat({behind("''")}, flatten(transform(segments, s -> concat(array(coalesce(try_element_at(filter(replacements, r -> r.sentence_id = s.sentence_id), 1), s)), {behind('s.sentence_id')}))))"""
    changed = checked.withColumn("__segments", F.when(F.col("committed"), F.expr(texts)).otherwise(F.col("segments")))
    used = "array_distinct(flatten(transform(__segments, s -> regexp_extract_all(s.text, '<REF:(C[0-9]+)>', 1))))"
    refs = f"transform(array({used}), u -> filter({_merged('refs', 'ref_updates', 'ref_id')}, r -> length_only OR array_contains(u, r.ref_id)))[0]"
    return changed.select(
        "doc_id", F.when(F.col("committed"), F.col("draft_version") + 1).otherwise(F.col("draft_version")).alias("draft_version"), F.col("__segments").alias("segments"),
        F.when(F.col("committed"), F.expr(refs)).otherwise(F.col("refs")).alias("refs"), F.when(F.col("committed"), F.expr(_merged("evidence", "evidence_updates", "relation_id"))).otherwise(F.col("evidence")).alias("evidence"),
        "committed", "refusals",
    )
