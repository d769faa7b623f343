"""Scenario profiles and registered reference people, both of them tables.

profiles: domain, subtype, privacy, ord, source_type, relation, target_type. registered: profile, context_kind, role, relation, target_type. Plans, persons, entities and relations are as in `policies`; entities also have
context_role, and wanted has reference_profile and reference_link_policy.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.policies import LINK_POLICY, _issue, with_people

# Fixed value: the graph policy under which profiles apply.
PROFILE_POLICY = "scenario_v1"


def profiled(conditions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Conditions (domain, subtype, graph_policy, ...) with profile_applied: whether the policy asks for profiles and there is one for the subtype."""
    known = profiles.select("domain", "subtype", F.lit(True).alias("__known")).distinct()
    on = ["domain", "subtype"]
    return conditions.join(known, on, "left").withColumn("profile_applied", F.coalesce((F.col("graph_policy") == PROFILE_POLICY) & F.col("__known"), F.lit(False))).select(*conditions.columns, "profile_applied")


def narrowed(conditions: DataFrame, triples: DataFrame, profiles: DataFrame, key: str) -> DataFrame:
    """(key, privacy, source_type, relation, target_type, ord): the triples that a document may use, narrowed to those of its profile and in the profile's order; without a profile all of them, ord null.

    triples: key, privacy, source_type, relation, target_type.
    """
    edge = ["source_type", "relation", "target_type"]
    own = profiled(conditions, profiles).select(key, "domain", "subtype", "profile_applied")
    held = triples.select(key, "privacy", *edge).distinct().join(own, key)
    inside = held.where("profile_applied").join(profiles.groupBy("domain", "subtype", "privacy", *edge).agg(F.min("ord").alias("ord")), ["domain", "subtype", "privacy", *edge])
    outside = held.where("not profile_applied").withColumn("ord", F.lit(None).cast(profiles.schema["ord"].dataType))
    cols = [key, "privacy", *edge, "ord"]
    return inside.select(*cols).unionByName(outside.select(*cols))


def reference_issues(persons: DataFrame, entities: DataFrame, relations: DataFrame, registered: DataFrame, wanted: DataFrame) -> DataFrame:
    """People who are no parties against the one registered person that a plan may cite.

    REFERENCE_MISSING: it is asked for and not there; REFERENCE_PROVENANCE: people without a registered profile; REFERENCE_COUNT: more than one; REFERENCE_FACT_SCOPE: another kind, role or entity than
    registered, not just the one public relation of the profile to the profile's attribute, or not just one party link where the policy has them.
    """
    asked = wanted.select("plan_id", F.nullif("reference_profile", F.lit("")).alias("profile"), F.coalesce(F.col("reference_link_policy") == LINK_POLICY, F.lit(False)).alias("__linked"))
    facts = registered.select("profile", F.col("context_kind").alias("__kind"), F.col("role").alias("__role"), F.col("relation").alias("__relation"), F.col("target_type").alias("__type"))
    others = persons.where("context_kind <> 'actual_party'")
    n = others.groupBy("plan_id").agg(F.count("*").alias("n"))
    plans = asked.join(n, "plan_id", "left").join(facts, "profile", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    lacking = plans.where("n = 0 and profile is not null")
    unknown = plans.where("n > 0 and __kind is null")
    judged = plans.where("n > 0 and __kind is not null")
    roles = entities.groupBy("plan_id", "entity_id").agg(F.min("entity_type").alias("__t"), F.min("context_role").alias("__c"))
    name, attribute = F.concat(F.lit("reference:"), "profile", F.lit(":name")), F.concat(F.lit("reference:"), "profile", F.lit(":attribute"))
    each = others.join(judged, "plan_id").join(roles.toDF("plan_id", "name_entity_id", "__nt", "__nc"), ["plan_id", "name_entity_id"], "left")
    edges = with_people(relations, persons, wanted).join(roles.toDF("plan_id", "target", "__tt", "__tc"), ["plan_id", "target"], "left")
    ends = edges.select("plan_id", "relation", "source", "target_privacy", "party_link", "__tt", "__tc", F.explode(F.array_distinct(F.array("source", "target"))).alias("name_entity_id"))
    fact = (F.col("source") == F.col("name_entity_id")) & (F.col("relation") == F.col("__relation")) & (F.col("target_privacy") == "NON_PII") & (F.col("__tt") == F.col("__type")) & (F.col("__tc") == attribute)
    met = each.select("plan_id", "name_entity_id", "profile", "__relation", "__type").distinct().join(ends, ["plan_id", "name_entity_id"])
    per = met.groupBy("plan_id", "name_entity_id").agg(F.count_if("party_link").alias("__links"), F.count_if(~F.col("party_link")).alias("__edges"), F.count_if(~F.col("party_link") & fact).alias("__facts"))
    j = each.join(per, ["plan_id", "name_entity_id"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    sound = (F.col("context_kind") == F.col("__kind")) & (F.col("role") == F.col("__role")) & (F.col("__nc") == name) & (zero("__edges") == 1) & (zero("__facts") == 1) & (zero("__links") == F.col("__linked").cast("int"))
    return reduce(DataFrame.unionByName, [
        _issue(lacking, "REFERENCE_MISSING"), _issue(unknown, "REFERENCE_PROVENANCE"), _issue(judged.where("n > 1"), "REFERENCE_COUNT"),
        _issue(j.where(~F.coalesce(sound, F.lit(False))), "REFERENCE_FACT_SCOPE", F.col("name_entity_id")),
    ])


def reference_values(entities: DataFrame, registered: DataFrame, values: DataFrame, wanted: DataFrame) -> DataFrame:
    """(plan_id, entity_id, value): the registered values of a plan's reference entities. values: profile, name, target_value."""
    own = entities.join(wanted.where("reference_profile <> ''").select("plan_id", F.col("reference_profile").alias("profile")), "plan_id").join(registered.select("profile"), "profile", "left_semi").join(values, "profile")
    return own.where(F.startswith("context_role", F.concat(F.lit("reference:"), "profile", F.lit(":")))).select("plan_id", "entity_id", F.when(F.col("entity_type") == "NAME", F.col("name")).otherwise(F.col("target_value")).alias("value"))
