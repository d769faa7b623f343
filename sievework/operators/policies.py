"""Plan rules that depend on people, constraints and groups; `drafts` has those of ids, edges, scenes and counts. Rows are as there, with

constraints (plan_id, constraint_id, kind, entity_ids), allowed (plan_id, entity_type), groups (plan_id, entity_id, value_group) and wanted (plan_id, reference_link_policy,
organization_bridge_target, n_parties, max_example_persons, max_public_reference_persons). Issues are (plan_id, code, target).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The policy under which a party may cite a reference person, and by which relation for each kind of person.
LINK_POLICY = "party_link_v1"
LINK_RELATIONS = {"example_person": "GUIDANCE_SUPPORT", "public_reference": "INFORMATION_GOVERNANCE"}


def _issue(df: DataFrame, code: str, target: Column | str = "") -> DataFrame:
    return df.select("plan_id", F.lit(code).alias("code"), (F.lit(target) if isinstance(target, str) else target.cast("string")).alias("target"))


def with_people(relations: DataFrame, persons: DataFrame, wanted: DataFrame) -> DataFrame:
    """Relations with the kind of person at either end (source_kind, target_kind) and whether they are party links: public relations by which an actual party cites a reference person."""
    kinds = persons.groupBy("plan_id", "name_entity_id").agg(F.min("context_kind").alias("k"))
    policy = wanted.select("plan_id", "reference_link_policy")
    j = relations.join(kinds.toDF("plan_id", "source", "source_kind"), ["plan_id", "source"], "left").join(kinds.toDF("plan_id", "target", "target_kind"), ["plan_id", "target"], "left").join(policy, "plan_id", "left")
    cites = reduce(lambda a, b: a | b, [(F.col("target_kind") == k) & (F.col("relation") == r) for k, r in LINK_RELATIONS.items()])
    link = (F.col("reference_link_policy") == LINK_POLICY) & (F.col("target_privacy") == "NON_PII") & (F.col("source_kind") == "actual_party") & cites
    return j.withColumn("party_link", F.coalesce(link, F.lit(False))).drop("reference_link_policy")


def type_and_name_issues(entities: DataFrame, relations: DataFrame, persons: DataFrame, allowed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Types that the subtype doesn't offer, and public relations of names that are neither of reference persons nor party links."""
    names = entities.where("entity_type = 'NAME'").select("plan_id", F.col("entity_id").alias("source"))
    barred = entities.where("entity_type <> 'NAME'").join(allowed, ["plan_id", "entity_type"], "left_anti")
    public = with_people(relations, persons, wanted).where("target_privacy = 'NON_PII' and not party_link").join(names, ["plan_id", "source"], "left_semi")
    actual = public.where(~F.coalesce(F.col("source_kind").isin(*LINK_RELATIONS), F.lit(False)))
    return _issue(barred, "PLAN_TYPE_POLICY", F.col("entity_id")).unionByName(_issue(actual, "NAME_CONTEXT_POLICY", F.col("relation_id")))


def constraint_issues(constraints: DataFrame, entities: DataFrame) -> DataFrame:
    """Constraints on unknown entities, and constraints to one persona that hold two entities of a type."""
    each = constraints.select("plan_id", "constraint_id", "kind", F.explode("entity_ids").alias("entity_id")).join(entities.select("plan_id", "entity_id", "entity_type").distinct(), ["plan_id", "entity_id"], "left")
    per = each.groupBy("plan_id", "constraint_id", "kind").agg(F.count("*").alias("n"), F.count("entity_type").alias("known"), F.count_distinct("entity_type").alias("types"))
    lost, twice = per.where("known < n"), per.where("known = n and kind = 'same_persona' and types <> n")
    return _issue(lost, "CONSTRAINT_ENDPOINT", F.col("constraint_id")).unionByName(_issue(twice, "SAME_PERSONA_DUPLICATE_TYPE", F.col("constraint_id")))


def bridge_issues(bridges: DataFrame, groups: DataFrame, wanted: DataFrame) -> DataFrame:
    """Plans that want bridges and have another number, and bridges within one value group. bridges: plan_id, relation_id, source, target."""
    asked = wanted.where("organization_bridge_target > 0").select("plan_id", "organization_bridge_target")
    n = asked.join(bridges.groupBy("plan_id").agg(F.count("*").alias("n")), "plan_id", "left").where(F.coalesce("n", F.lit(0)) != F.col("organization_bridge_target"))
    own = groups.select("plan_id", "entity_id", "value_group")
    ends = bridges.join(asked.select("plan_id"), "plan_id").join(own.toDF("plan_id", "source", "a"), ["plan_id", "source"]).join(own.toDF("plan_id", "target", "b"), ["plan_id", "target"])
    return _issue(n, "ORGANIZATION_BRIDGE_COUNT").unionByName(_issue(ends.where("a = b"), "ORGANIZATION_BRIDGE_VALUE_GROUP", F.col("relation_id")))


def party_issues(persons: DataFrame, links: DataFrame, entities: DataFrame, relations: DataFrame, slots: DataFrame, wanted: DataFrame) -> DataFrame:
    """People against the condition: their number, the roles assigned (slots: plan_id, person_id, name_entity_id, role), and the relations of actual parties: public ones are barred, personal ones need a link to
    both ends, and an owned attribute needs a personal relation of that person."""
    count = persons.groupBy("plan_id").agg(F.count_if(F.col("context_kind") == "actual_party").alias("n"), F.count_if(F.col("context_kind") != "actual_party").alias("m"))
    per = wanted.join(count, "plan_id", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "m": F.coalesce("m", F.lit(0))})
    most = F.coalesce("max_example_persons", F.lit(0)) + F.coalesce("max_public_reference_persons", F.lit(0))
    parties = persons.where("context_kind = 'actual_party'").select("plan_id", "person_id", "name_entity_id", "role")
    ends = F.explode(F.array_distinct(F.array("source", "target")))
    mine = with_people(relations, persons, wanted).withColumn("name_entity_id", ends).join(parties, ["plan_id", "name_entity_id"])
    cited = links.select("plan_id", "person_id", "entity_id", "link_kind", F.explode("relation_ids").alias("relation_id"))
    held = cited.groupBy("plan_id", "person_id", "relation_id").agg(F.array_sort(F.collect_set("entity_id")).alias("held"))
    both = F.array_sort(F.array_distinct(F.array("source", "target")))
    loose = mine.where("target_privacy = 'PII'").join(held, ["plan_id", "person_id", "relation_id"], "left").where(~F.coalesce(F.col("held") == both, F.lit(False)))
    names = entities.where("entity_type = 'NAME'").select("plan_id", F.col("entity_id").alias("__n"), F.lit(True).alias("__is"))
    owned = cited.where("link_kind = 'personal_attribute'").join(relations.select("plan_id", "relation_id", "source", "target", "target_privacy"), ["plan_id", "relation_id"])
    owned = owned.where((F.col("entity_id") == F.col("source")) | (F.col("entity_id") == F.col("target"))).join(persons.select("plan_id", "person_id", "name_entity_id"), ["plan_id", "person_id"])
    of_name = owned.join(names.toDF("plan_id", "source", "s"), ["plan_id", "source"], "left").join(names.toDF("plan_id", "target", "t"), ["plan_id", "target"], "left")
    elsewhere = (F.col("s").isNotNull() | F.col("t").isNotNull()) & (F.col("name_entity_id") != F.col("source")) & (F.col("name_entity_id") != F.col("target"))
    return reduce(DataFrame.unionByName, [
        _issue(per.where(F.col("n") != F.coalesce("n_parties", "n")), "PERSON_COUNT"), _issue(per.where(F.col("m") > most), "EXAMPLE_PERSON_COUNT"),
        _issue(slots.join(parties, ["plan_id", "person_id", "name_entity_id", "role"], "left_anti"), "PERSON_ROLE_PLAN", F.col("name_entity_id")),
        _issue(mine.where("target_privacy = 'NON_PII' and not party_link"), "NAME_CONTEXT_POLICY", F.col("relation_id")), _issue(loose, "PERSON_RELATION_LINK", F.col("relation_id")),
        _issue(of_name.where((F.col("target_privacy") != "PII") | elsewhere), "PERSON_OWNERSHIP", F.col("relation_id")),
    ])


def nearest_pair(mentions: DataFrame, relations: DataFrame) -> DataFrame:
    """(plan_id, relation_id, i, j): for each relation the two mentions of its ends that lie best: fewest outside of the relation's scene, then nearest, then first. A relation without a mention of both is left out.

    mentions: plan_id, entity_id, position, scene_id; relations: plan_id, relation_id, source, target, scene_id. The pairs of a relation are those of one document.
    """
    a, b = mentions.toDF("plan_id", "source", "i", "__si"), mentions.toDF("plan_id", "target", "j", "__sj")
    pairs = relations.join(a, ["plan_id", "source"]).join(b, ["plan_id", "target"])
    outside = (~F.col("__si").eqNullSafe(F.col("scene_id"))).cast("int") + (~F.col("__sj").eqNullSafe(F.col("scene_id"))).cast("int")
    best = pairs.groupBy("plan_id", "relation_id").agg(F.min(F.struct(outside.alias("o"), F.abs(F.col("i") - F.col("j")).alias("d"), "i", "j")).alias("x"))
    return best.select("plan_id", "relation_id", "x.i", "x.j")


def same_multiset(a: Column, b: Column) -> Column:
    """Whether two arrays hold the same elements as often."""
    return F.array_sort(a).eqNullSafe(F.array_sort(b))
