"""Documents: filling slots with offsets, character labels, patches, and rules that yield issues.

Issues are rows (doc_id, code, target); a gate is `bool_and` over them, which `gate` does.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.text import PARTICLE_PAIRS, particle, strip

# The entity types of a document.
TYPES = (
    "NAME", "AGE", "DATE_OF_BIRTH", "RRN", "PASSPORT_NUMBER", "DRIVER_LICENSE_NUMBER", "MOBILE_PHONE", "TELEPHONE", "EMAIL", "ADDRESS",
    "WORKPLACE", "DEPARTMENT", "POSITION", "SCHOOL", "MAJOR", "BANK_ACCOUNT_NUMBER", "CARD_NUMBER", "VEHICLE_NUMBER",
)
SLOT = r"<([A-Z][A-Z0-9_]*):(E[0-9]+|C[0-9]+)>(?:\{josa:([^}]+)\})?"
PLACEHOLDER = r"<(?:[A-Z][A-Z0-9_]*:E\d+|REF:C\d+)>|[〈＜][A-Z][A-Z0-9_]*:E\d+[〉＞]|\{josa:"
INTERNAL_ID = r"(?U)(?<![\w:])E[1-9][0-9]*(?![A-Za-z0-9_])"


def render(segments: DataFrame, values: DataFrame) -> DataFrame:
    """(doc_id, position, sentence, mentions, refs): each slot of a segment replaced by its value and the fitting particle, with the code-point span of every value.

    segments: doc_id, position, text; values: doc_id, slot (E1, C2), kind (an entity type, or REF), value. A slot without a value of its kind, or with a pair of particles that isn't known, makes the sentence and its lists null.
    """
    each = segments.select("doc_id", "position", "text", F.regexp_extract_all("text", F.lit(SLOT), F.lit(2)).alias("ids"), F.regexp_extract_all("text", F.lit(SLOT), F.lit(1)).alias("kinds"), F.regexp_extract_all("text", F.lit(SLOT), F.lit(3)).alias("pairs"))
    gaps = each.withColumn("gaps", F.split("text", SLOT, -1))
    slots = gaps.select("doc_id", "position", F.posexplode(F.arrays_zip("ids", "kinds", "pairs")).alias("i", "s")).select("doc_id", "position", "i", F.col("s.ids").alias("slot"), F.col("s.kinds").alias("kind"), F.col("s.pairs").alias("pair"))
    filled = slots.join(values, ["doc_id", "slot", "kind"], "left")
    with_particle = filled.withColumn("tail", F.when(F.coalesce("pair", F.lit("")) == "", F.lit("")).when(F.col("pair").isin(*PARTICLE_PAIRS), particle(F.col("value"), F.col("pair"))))
    per = with_particle.groupBy("doc_id", "position").agg(F.array_sort(F.collect_list(F.struct("i", "slot", "kind", "value", "tail"))).alias("v"))
    span = "array<struct<slot:string,kind:string,form:string,begin:int,end:int>>"
    state = f"struct<out:string,m:{span}>"
    begin = F.struct(F.element_at("gaps", 1).alias("out"), F.array().cast(span).alias("m")).cast(state)

    def step(a: Column, x: Column) -> Column:
        at = F.length(a["out"])
        one = F.array(F.struct(x["slot"], x["kind"], x["value"].alias("form"), at.alias("begin"), (at + F.length(x["value"])).alias("end"))).cast(span)
        return F.struct(F.concat(a["out"], x["value"], x["tail"], F.element_at("gaps", x["i"] + 2)).alias("out"), F.concat(a["m"], one).alias("m")).cast(state)

    done = gaps.join(per, ["doc_id", "position"], "left").withColumn("r", F.aggregate(F.coalesce("v", F.array().cast("array<struct<i:int,slot:string,kind:string,value:string,tail:string>>")), begin, step))
    return done.select(
        "doc_id", "position", F.col("r.out").alias("sentence"),
        F.when(F.col("r.out").isNotNull(), F.filter("r.m", lambda m: m["kind"] != "REF")).alias("mentions"),
        F.when(F.col("r.out").isNotNull(), F.filter("r.m", lambda m: m["kind"] == "REF")).alias("refs"),
    )


def char_sequence(text: Column) -> Column:
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))


def bio(text: Column, spans: Column) -> Column:
    """A label for each character: B- where a span (begin, end, label) begins, I- inside, else O."""

    def label(i: Column) -> Column:
        own = F.filter(spans, lambda s: (s["begin"] <= i) & (i < s["end"]))
        first = F.get(own, F.lit(0))
        return F.when(first.isNull(), F.lit("O")).when(first["begin"] == i, F.concat(F.lit("B-"), first["label"])).otherwise(F.concat(F.lit("I-"), first["label"]))

    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.length(text) - 1), label))


def annotate(sentences: DataFrame, mentions: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds PII_set (spans of PII entities by begin, numbered), sent_seq and labelling_seq. mentions: doc_id, position, entity_id, entity_type, form, begin, end; labels: doc_id, node, privacy."""
    pii = mentions.join(labels.where("privacy = 'PII'").select("doc_id", F.col("node").alias("entity_id")), ["doc_id", "entity_id"], "left_semi")
    per = pii.groupBy("doc_id", "position").agg(F.array_sort(F.collect_list(F.struct("begin", "end", "form", F.col("entity_type").alias("label")))).alias("s"))
    spans = F.coalesce("s", F.array().cast("array<struct<begin:int,end:int,form:string,label:string>>"))
    joined = sentences.join(per, ["doc_id", "position"], "left").withColumn("s", spans)
    numbered = F.transform("s", lambda x, i: F.struct(x["form"].alias("form"), x["label"].alias("label"), x["begin"].alias("begin"), x["end"].alias("end"), i.alias("id")))
    return joined.select(*sentences.columns, numbered.alias("PII_set"), char_sequence(F.col("sentence")).alias("sent_seq"), bio(F.col("sentence"), F.col("s")).alias("labelling_seq"))


def issues(rows: DataFrame, key: str, rules: dict[str, Column], target: Column) -> DataFrame:
    """(key, code, target) for each rule that a row breaks, in one pass over the rows."""
    broken = F.filter(F.array(*[F.when(c, F.lit(code)) for code, c in rules.items()]), lambda x: x.isNotNull())
    return rows.select(key, F.explode(broken).alias("code"), target.cast("string").alias("target"))


def gate(items: DataFrame, key: str, *found: DataFrame) -> DataFrame:
    """Each item with its number of issues and whether it passes."""
    every = reduce(DataFrame.unionByName, found).groupBy(key).agg(F.count("*").alias("n_issues"))
    return items.select(key).join(every, key, "left").select(key, F.coalesce("n_issues", F.lit(0)).alias("n_issues"), F.col("n_issues").isNull().alias("passed"))


def sentence_issues(sentences: DataFrame) -> DataFrame:
    """Of annotated sentences (doc_id, position, sent_idx, sentence, PII_set, sent_seq, labelling_seq)."""
    s, t = F.col("PII_set"), F.col("sentence")
    bad_span = F.exists(
        F.transform(s, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
        lambda y: (y["x"]["begin"] < 0) | (y["x"]["begin"] >= y["x"]["end"]) | (y["x"]["end"] > F.length(t)) | (y["x"]["id"] != y["i"])
        | ~y["x"]["label"].isin(*TYPES) | (F.substring(t, y["x"]["begin"] + 1, y["x"]["end"] - y["x"]["begin"]) != y["x"]["form"])
        | ((y["i"] > 0) & (y["x"]["begin"] < F.get(s, y["i"] - 1)["end"])),
    )
    rules = {
        "FINAL_SENTENCE_INDEX": ~F.col("sent_idx").rlike(r"^.+_\d+$") | (F.regexp_extract("sent_idx", r"_(\d+)$", 1) != F.col("position").cast("string")),
        "FINAL_CHAR_SEQUENCE": F.col("sent_seq") != char_sequence(t),
        "FINAL_PLACEHOLDER": t.rlike(PLACEHOLDER),
        "FINAL_INTERNAL_ENTITY_ID": t.rlike(INTERNAL_ID),
        "FINAL_PII_SPAN": bad_span,
        "FINAL_BIO": F.col("labelling_seq") != bio(t, s),
    }
    return issues(sentences, "doc_id", rules, F.col("sent_idx"))


def overlaps(mentions: DataFrame) -> DataFrame:
    """Mentions of a sentence that overlap one that begins before: of (doc_id, position, entity_id, begin, end)."""
    w = Window.partitionBy("doc_id", "position").orderBy("begin", "end", "entity_id").rowsBetween(Window.unboundedPreceding, -1)
    return mentions.withColumn("__e", F.max("end").over(w)).where(F.col("begin") < F.col("__e")).select("doc_id", F.lit("FINAL_MENTION_OVERLAP").alias("code"), F.col("entity_id").alias("target"))


def relation_issues(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Ends that are missing, equal or of another type, unknown labels, repeated relations, and entities without a relation."""
    e = entities.select("doc_id", "entity_id", "entity_type")
    s, t = e.toDF("doc_id", "entity", "__s"), e.toDF("doc_id", "target_entity", "__t")
    joined = relations.join(s, ["doc_id", "entity"], "left").join(t, ["doc_id", "target_entity"], "left")
    bad = (
        F.col("__s").isNull() | F.col("__t").isNull() | (F.col("entity") == F.col("target_entity")) | ~F.col("privacy_label").isin("PII", "NON_PII")
        | (F.col("__s") != F.col("entity_type")) | (F.col("__t") != F.col("target_entity_type"))
    )
    ends = joined.where(bad).select("doc_id", F.lit("FINAL_RELATION_ENDPOINT").alias("code"), F.concat_ws("/", "entity", "target_entity").alias("target"))
    good = joined.where(~bad)
    twice = good.groupBy("doc_id", "entity", "relation", "target_entity").agg(F.count("*").alias("k")).where("k > 1")
    repeated = twice.select("doc_id", F.lit("FINAL_DUPLICATE_RELATION").alias("code"), F.concat_ws("/", "entity", "relation", "target_entity").alias("target"))
    touched = good.select("doc_id", F.explode(F.array("entity", "target_entity")).alias("entity_id")).distinct()
    alone = e.join(touched, ["doc_id", "entity_id"], "left_anti").select("doc_id", F.lit("FINAL_ISOLATED_ENTITY").alias("code"), F.col("entity_id").alias("target"))
    return ends.unionByName(repeated).unionByName(alone)


def spec_issues(findings: DataFrame, sentences: DataFrame) -> DataFrame:
    """Spec findings (doc_id, check_id, section_id, passed, reason, evidence ids) without valid evidence, and failed ones. Passing takes a sentence that isn't a heading, over 8 characters, in the check's section."""
    each = findings.select("doc_id", "check_id", "section_id", F.explode_outer("evidence").alias("sentence_id")).join(sentences.select("doc_id", "sentence_id", F.col("section_id").alias("__sec"), "kind", "sentence"), ["doc_id", "sentence_id"], "left")
    body = (F.col("kind") != "heading") & (F.length(strip(F.col("sentence"))) > 8) & ((F.coalesce("section_id", F.lit("")) == "") | (F.col("section_id") == F.col("__sec")))
    per = each.groupBy("doc_id", "check_id").agg(F.bool_or(F.col("sentence_id").isNotNull() & F.col("kind").isNull()).alias("unknown"), F.coalesce(F.bool_or(body), F.lit(False)).alias("body"))
    j = findings.join(per, ["doc_id", "check_id"])
    invalid = F.col("unknown") | (F.size(F.array_distinct("evidence")) < F.size("evidence")) | (strip(F.col("reason")) == "")
    return issues(j, "doc_id", {"SPEC_REVIEW_EVIDENCE": invalid | (F.col("passed") & ~F.col("body")), "DOCUMENT_SPEC_INCOMPLETE": ~F.col("passed")}, F.col("check_id"))


def concrete(c: Column) -> Column:
    """A fact of 8 characters or more that isn't an instruction to write one."""
    return (F.length(strip(c)) >= 8) & ~strip(c).rlike(r"^.*(?:기재한다|서술한다|작성한다|명시한다|설명한다|기재해야 한다)[.!。]?\s*$")


def evidence_issues(groups: DataFrame, sentences: DataFrame, ends: DataFrame) -> DataFrame:
    """Relations (doc_id, relation_id, source, target) without evidence, or with a group (doc_id, relation_id, g, ids) that is empty, repeats a sentence, has one that is unknown, or doesn't hold both ends. sentences: doc_id, sentence_id, entity_ids."""
    each = groups.select("doc_id", "relation_id", "g", F.explode_outer("ids").alias("sentence_id")).join(sentences, ["doc_id", "sentence_id"], "left")
    per = each.groupBy("doc_id", "relation_id", "g").agg(F.count("*").alias("n"), F.count_distinct("sentence_id").alias("d"), F.count_if(F.col("entity_ids").isNull()).alias("unknown"), F.flatten(F.collect_list("entity_ids")).alias("all"))
    j = ends.join(per, ["doc_id", "relation_id"], "left")
    sound = (F.col("n") == F.col("d")) & (F.col("unknown") == 0) & F.array_contains("all", F.col("source")) & F.array_contains("all", F.col("target"))
    bad = j.where(~F.coalesce(sound, F.lit(False))).select("doc_id", "relation_id").distinct()
    return bad.select("doc_id", F.lit("RELATION_EVIDENCE").alias("code"), F.col("relation_id").alias("target"))


def direct_evidence(sentences: DataFrame, ends: DataFrame) -> DataFrame:
    """(doc_id, relation_id, ids): the sentences that hold both ends of a relation."""
    held = sentences.select("doc_id", "sentence_id", "entity_ids")
    both = ends.join(held, "doc_id").where(F.array_contains("entity_ids", F.col("source")) & F.array_contains("entity_ids", F.col("target")))
    return both.groupBy("doc_id", "relation_id").agg(F.array_sort(F.collect_set("sentence_id")).alias("ids"))


def apply_patch(segments: DataFrame, replaced: DataFrame, inserted: DataFrame) -> DataFrame:
    """(doc_id, position, sentence_id, text) after a patch: replacements by id, insertions after an anchor ('' is the start) in their order.

    segments: doc_id, position, sentence_id, text; replaced: doc_id, sentence_id, text; inserted: doc_id, anchor, ordinal, sentence_id, text.
    """
    old = segments.join(replaced.select("doc_id", "sentence_id", F.col("text").alias("__new")), ["doc_id", "sentence_id"], "left")
    kept = old.select("doc_id", F.col("position").alias("__p"), F.lit(0).alias("__o"), "sentence_id", F.coalesce("__new", "text").alias("text"))
    anchors = segments.select("doc_id", F.col("sentence_id").alias("anchor"), F.col("position").alias("__p")).unionByName(segments.select("doc_id").distinct().select("doc_id", F.lit("").alias("anchor"), F.lit(-1).cast(segments.schema["position"].dataType).alias("__p")))
    new = inserted.join(anchors, ["doc_id", "anchor"]).select("doc_id", "__p", F.col("ordinal").cast("int").alias("__o"), "sentence_id", "text")
    w = Window.partitionBy("doc_id").orderBy("__p", "__o")
    return kept.unionByName(new).select("doc_id", (F.row_number().over(w) - 1).alias("position"), "sentence_id", "text")


def patch_issues(segments: DataFrame, replaced: DataFrame, inserted: DataFrame, versions: DataFrame) -> DataFrame:
    """Why a patch is refused: a stale base, unknown or repeated replacements, unknown anchors, new ids that exist or repeat. versions: doc_id, draft_version, base_version."""
    ids = segments.select("doc_id", "sentence_id")
    issue = lambda df, code: df.select("doc_id", F.lit(code).alias("code"), F.col("sentence_id").alias("target"))
    stale = versions.where("draft_version <> base_version").select("doc_id", F.lit("PATCH_BASE_VERSION").alias("code"), F.col("base_version").cast("string").alias("target"))
    twice = lambda df: df.groupBy("doc_id", "sentence_id").agg(F.count("*").alias("k")).where("k > 1")
    unknown = replaced.join(ids, ["doc_id", "sentence_id"], "left_anti")
    anchor = inserted.where("anchor <> ''").select("doc_id", F.col("anchor").alias("sentence_id")).join(ids, ["doc_id", "sentence_id"], "left_anti")
    taken = inserted.join(ids, ["doc_id", "sentence_id"], "left_semi")
    parts = [issue(unknown, "PATCH_REPLACEMENT_ID"), issue(twice(replaced), "PATCH_REPLACEMENT_ID"), issue(anchor, "PATCH_ANCHOR"), issue(taken, "PATCH_NEW_ID"), issue(twice(inserted), "PATCH_NEW_ID")]
    return reduce(DataFrame.unionByName, parts, stale)


def unique_ids(segments: DataFrame) -> DataFrame:
    """Adds new_id: the first of equal ids keeps it; others, and ids that aren't S1, S2, ..., get the next numbers in order."""
    w = Window.partitionBy("doc_id", "sentence_id").orderBy("position")
    form = F.col("sentence_id").rlike("^S[1-9][0-9]*$")
    flagged = segments.withColumn("__bad", ~form | (F.row_number().over(w) > 1))
    doc = Window.partitionBy("doc_id")
    top = F.coalesce(F.max(F.when(form, F.substring("sentence_id", 2, 18).cast("long"))).over(doc), F.lit(0))
    nth = F.sum(F.col("__bad").cast("int")).over(doc.orderBy("position"))
    return flagged.withColumn("__top", top).withColumn("new_id", F.when(F.col("__bad"), F.concat(F.lit("S"), (F.col("__top") + nth).cast("string"))).otherwise(F.col("sentence_id"))).drop("__bad", "__top")


def remaining_tags(text: Column) -> Column:
    return text.rlike(r"<[^>]+>|\{josa:")


@F.pandas_udf(T.DoubleType())
def ratcliff(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; no built-in function has it."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def _masks(text: str) -> dict[str, int]:
    """For each character where it stands, as bits."""
    at: dict[str, int] = {}
    for j, x in enumerate(text):
        at[x] = at.get(x, 0) | (1 << j)
    return at


def _common(a: str, n: int, at: dict[str, int], needed: float) -> bool:
    """Whether the longest common subsequence of `a` and a text of n characters, `at` its masks, may have `needed` characters: bit-parallel rows, given up when too few are left."""
    full = v = (1 << n) - 1
    for k in range(0, len(a), 32):
        for x in a[k : k + 32]:
            if x in at:
                u = v & at[x]
                v = ((v + u) | (v - u)) & full
        if n - v.bit_count() + max(0, len(a) - k - 32) < needed:
            return False
    return n - v.bit_count() >= needed


def near_texts(texts: list[str], least: int = 24, threshold: float = 0.82) -> list[tuple[int, int, float]]:
    """(earlier, later, ratio) of all pairs of a document's texts that reach the threshold, white space and slots' ids aside; both have `least` characters or more.

    Two bounds of the ratio come first, and no pair is lost by them: the characters in common, and the longest common subsequence, as matching blocks are one.
    """
    plain = [re.sub(r"\s+", "", re.sub(r"\{josa:[^}]+\}", "", re.sub(r"<([A-Z_]+):[EC]\d+>", r"<\1>", x or ""))) for x in texts]
    place = [i for i, x in enumerate(plain) if len(x) >= least]
    kept = [plain[i] for i in place]
    number = {c: k for k, c in enumerate(sorted(set("".join(kept))))}
    counts = np.zeros((len(kept), len(number)), np.int32)
    for i, x in enumerate(kept):
        for c, k in Counter(x).items():
            counts[i, number[c]] = k
    size = np.array([len(x) for x in kept], np.int64)
    out: list[tuple[int, int, float]] = []
    for i, x in enumerate(kept):
        need = threshold * (size[:i] + size[i]) / 2 - 1e-9
        may = np.flatnonzero(np.minimum(size[:i], size[i]) >= need)
        may = may[np.minimum(counts[may], counts[i]).sum(1) >= need[may]]
        at = _masks(x) if len(may) else {}
        for j in may.tolist():
            y = kept[j]
            ratio = 1.0
            if x != y:
                if not _common(y, len(x), at, need[j]):
                    continue
                ratio = difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()
            if ratio >= threshold:
                out.append((place[j], place[i], ratio))
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("earlier", T.IntegerType()), T.StructField("later", T.IntegerType()), T.StructField("ratio", T.DoubleType())])))
def near_duplicates(texts: pd.Series) -> pd.Series:
    """near_texts of each row's array of texts."""
    return pd.Series([[] if t is None else [{"earlier": a, "later": b, "ratio": r} for a, b, r in near_texts(list(t))] for t in texts])


def remapped_evidence(evidence: DataFrame, mapping: DataFrame) -> DataFrame:
    """Evidence (doc_id, relation_id, groups) after sentences got new ids or went. mapping: doc_id, old_id, new_id; an id without a row stays.

    A relation any of whose ids stands for several sentences now loses its groups: which one was meant isn't known. Groups name a sentence once.
    """
    per = mapping.groupBy("doc_id", "old_id").agg(F.collect_set("new_id").alias("n"), F.count("*").alias("k")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("old_id", F.struct("n", "k")))).alias("__m"))
    j = evidence.join(per, "doc_id", "left")
    torn = F.exists(F.flatten("groups"), lambda s: F.coalesce(F.try_element_at("__m", s)["k"] > 1, F.lit(False)))
    new = F.transform("groups", lambda g: F.array_distinct(F.transform(g, lambda s: F.coalesce(F.get(F.try_element_at("__m", s)["n"], F.lit(0)), s))))
    return j.withColumn("groups", F.when(torn, F.slice("groups", 1, 0)).otherwise(new)).drop("__m")
