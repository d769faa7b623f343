from pyspark.sql import functions as F

from sievework.operators import dedup, policies


def rows(spark):
    entities = spark.createDataFrame([("p", "E1", "NAME"), ("p", "E2", "EMAIL"), ("p", "E3", "NAME"), ("p", "E4", "SCHOOL")], "plan_id string, entity_id string, entity_type string")
    relations = spark.createDataFrame([("p", "R1", "E1", "has", "E2", "PII"), ("p", "R2", "E1", "GUIDANCE_SUPPORT", "E3", "NON_PII"), ("p", "R3", "E3", "at", "E4", "NON_PII")], "plan_id string, relation_id string, source string, relation string, target string, target_privacy string")
    persons = spark.createDataFrame([("p", "P1", "E1", "user", "actual_party"), ("p", "P2", "E3", "model", "example_person")], "plan_id string, person_id string, name_entity_id string, role string, context_kind string")
    wanted = spark.createDataFrame([("p", "party_link_v1", 1, 1, 1, 0)], "plan_id string, reference_link_policy string, organization_bridge_target int, n_parties int, max_example_persons int, max_public_reference_persons int")
    links = spark.createDataFrame([("p", "P1", "E1", "identity", ["R1"]), ("p", "P1", "E2", "personal_attribute", ["R1"])], "plan_id string, person_id string, entity_id string, link_kind string, relation_ids array<string>")
    slots = spark.createDataFrame([("p", "P1", "E1", "user")], "plan_id string, person_id string, name_entity_id string, role string")
    return entities, relations, persons, wanted, links, slots


def found(df):
    return sorted((r["code"], r["target"]) for r in df.collect())


def test_types_names_and_links(spark):
    e, r, p, w, links, slots = rows(spark)
    allowed = spark.createDataFrame([("p", "EMAIL"), ("p", "SCHOOL")], "plan_id string, entity_type string")
    assert found(policies.type_and_name_issues(e, r, p, allowed, w)) == []
    assert found(policies.type_and_name_issues(e, r, p, allowed.limit(0), w)) == [("PLAN_TYPE_POLICY", "E2"), ("PLAN_TYPE_POLICY", "E4")]
    free = w.withColumn("reference_link_policy", F.lit(None).cast("string"))
    assert found(policies.type_and_name_issues(e, r, p, allowed, free)) == [("NAME_CONTEXT_POLICY", "R2")]
    assert found(policies.party_issues(p, links, e, r, slots, w)) == []
    assert found(policies.party_issues(p, links, e, r, slots, free)) == [("NAME_CONTEXT_POLICY", "R2")]


def test_parties(spark):
    e, r, p, w, links, slots = rows(spark)
    assert found(policies.party_issues(p, links.where("entity_id = 'E2'"), e, r, slots, w)) == [("PERSON_RELATION_LINK", "R1")]
    assert found(policies.party_issues(p, links, e, r, slots.withColumn("role", F.lit("x")), w.withColumn("n_parties", F.lit(2)))) == [("PERSON_COUNT", ""), ("PERSON_ROLE_PLAN", "E1")]
    assert found(policies.party_issues(p, links, e, r, slots, w.withColumn("max_example_persons", F.lit(None).cast("int")))) == [("EXAMPLE_PERSON_COUNT", "")]
    other = links.unionByName(spark.createDataFrame([("p", "P2", "E2", "personal_attribute", ["R1"]), ("p", "P2", "E4", "personal_attribute", ["R3"])], links.schema))
    assert found(policies.party_issues(p, other, e, r, slots, w)) == [("PERSON_OWNERSHIP", "R1"), ("PERSON_OWNERSHIP", "R3")]


def test_constraints_and_bridges(spark):
    e, r, p, w, *_ = rows(spark)
    c = spark.createDataFrame([("p", "K1", "same_persona", ["E1", "E2"]), ("p", "K2", "same_persona", ["E1", "E3"]), ("p", "K3", "other", ["E9"]), ("p", "K4", "other", ["E1", "E3"])], "plan_id string, constraint_id string, kind string, entity_ids array<string>")
    assert found(policies.constraint_issues(c, e)) == [("CONSTRAINT_ENDPOINT", "K3"), ("SAME_PERSONA_DUPLICATE_TYPE", "K2")]
    bridges = r.where("relation_id = 'R3'").select("plan_id", "relation_id", "source", "target")
    groups = spark.createDataFrame([("p", "E3", "g1"), ("p", "E4", "g2")], "plan_id string, entity_id string, value_group string")
    assert found(policies.bridge_issues(bridges, groups, w)) == []
    assert found(policies.bridge_issues(bridges, groups.withColumn("value_group", F.lit("g")), w)) == [("ORGANIZATION_BRIDGE_VALUE_GROUP", "R3")]
    assert found(policies.bridge_issues(bridges.limit(0), groups, w)) == [("ORGANIZATION_BRIDGE_COUNT", "")]


def test_plan_nearest_and_content_check(spark):
    schema = "id int, features array<string>"
    got = dedup.plan_nearest(spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, ["z"]), (4, ["a"])], schema), "id", spark.createDataFrame([(10, ["a"]), (11, ["a", "b"]), (12, ["a", "b"]), (13, [])], schema), "id")
    assert {r["id"]: (r["nearest"], r["jaccard"]) for r in got.collect()} == {1: (11, 1.0), 2: (13, 1.0), 3: (None, 0.0), 4: (10, 1.0)}
    docs = spark.createDataFrame([(1, "the same words here"), (2, "nothing alike")], "id int, text string")
    t = dedup.gram_table(docs, "id", F.col("text"))
    ref = dedup.gram_table(docs.where("id = 1").withColumnRenamed("id", "ref"), "ref", F.col("text"))
    assert {r["id"]: r["passed"] for r in dedup.content_check(t, "id", ref, "ref").collect()} == {1: False, 2: True}


def test_same_multiset(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["a", "a", "b"]), (["a"], ["a", "a"]), (None, None)], "x array<string>, y array<string>")
    assert [r[0] for r in df.select(policies.same_multiset(F.col("x"), F.col("y"))).collect()] == [True, False, True]
