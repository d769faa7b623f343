from pyspark.sql import functions as F

from sievework.functions.text import normalise_particles
from sievework.operators import drafts


def plan(spark):
    entities = spark.createDataFrame([("p", "E1", "NAME"), ("p", "E2", "EMAIL"), ("p", "E3", "WORKPLACE")], "plan_id string, entity_id string, entity_type string")
    relations = spark.createDataFrame([("p", "R1", "E1", "E2", "has", "PII", "SC1", "why"), ("p", "R2", "E3", "E2", "lists", "NON_PII", "SC1", "why")], "plan_id string, relation_id string, source string, target string, relation string, target_privacy string, scene_id string, context_reason string")
    scenes = spark.createDataFrame([("p", "SC1", "A", 1, ["R1", "R2"])], "plan_id string, scene_id string, section_id string, ord int, relation_ids array<string>")
    triples = spark.createDataFrame([("NAME", "has", "EMAIL"), ("WORKPLACE", "lists", "EMAIL")], "source_type string, relation string, target_type string")
    wanted = spark.createDataFrame([("p", 2, 1, 1, 1, ["A"], ["has"])], "plan_id string, relation_count int, pii_relation_target int, non_pii_relation_target int, non_pii_only_min int, sections array<string>, required_relations array<string>")
    return entities, relations, scenes, triples, wanted


def codes(df):
    return sorted(r["code"] for r in df.collect())


def test_plan_rules(spark):
    e, r, s, t, w = plan(spark)
    assert codes(drafts.plan_issues(e, r, s, t, w)) == []
    bad = r.unionByName(spark.createDataFrame([("p", "R2", "E9", "E9", "zzz", "PII", "SC7", "")], r.schema))
    assert {"PLAN_ENDPOINT", "PLAN_ID", "RELATION_COUNT", "PRIVACY_RELATION_COUNT", "ISOLATED_ENTITY"} <= set(codes(drafts.plan_issues(e, bad, s, t, w)))
    assert "PLAN_TRIPLE" in codes(drafts.plan_issues(e, r, s, t.where("relation = 'has'"), w))
    assert "SCENE_COVERAGE" in codes(drafts.plan_issues(e, r, s.withColumn("relation_ids", F.array(F.lit("R1"))), t, w))
    assert "REQUIRED_RELATION_MISSING" in codes(drafts.plan_issues(e, r, s, t, w.withColumn("required_relations", F.array(F.lit("x")))))


def test_person_rules(spark):
    e, r, *_ = plan(spark)
    persons = spark.createDataFrame([("p", "P1", "E1", "user", "actual_party")], "plan_id string, person_id string, name_entity_id string, role string, context_kind string")
    links = spark.createDataFrame([("p", "P1", "E1", "user", "identity", ["R1"]), ("p", "P1", "E2", "user", "personal_attribute", ["R1"])], "plan_id string, person_id string, entity_id string, role string, link_kind string, relation_ids array<string>")
    assert codes(drafts.person_issues(persons, links, e, r)) == []
    assert codes(drafts.person_issues(persons, links.where("link_kind <> 'identity'"), e, r)) == ["PERSON_IDENTITY_COVERAGE"]
    assert codes(drafts.person_issues(persons, links.withColumn("relation_ids", F.array(F.lit("R2"))), e, r)) == ["PERSON_LINK_RELATION"]
    assert "PERSON_PII_CONTEXT" in codes(drafts.person_issues(persons, links, e, r.where("relation_id = 'R2'")))


def test_draft_rules_and_repairs(spark):
    e, r, *_ = plan(spark)
    rows = [("p", 0, "S1", "prose", "<NAME:E1>의 이메일은 <EMAIL:E2>이다."), ("p", 1, "S2", "prose", "주소: <EMAIL:E3> <X> E2 a@b.kr"), ("p", 2, "S3", "prose", "하나다. 둘이다."), ("p", 3, "S4", "form", " \n")]
    seg = spark.createDataFrame(rows, "plan_id string, position int, sentence_id string, kind string, text string")
    got = {(x["code"], x["target"]) for x in drafts.draft_issues(seg, e).collect()}
    assert got == {("UNKNOWN_TAG", "S2"), ("ENTITY_TYPE_CONTEXT", "S2"), ("LITERAL_IDENTIFIER", "S2"), ("PLACEHOLDER_TYPE_ID", "EMAIL:E3"), ("PROSE_MULTIPLE_SENTENCES", "S3"), ("EMPTY_SEGMENT", "S4"), ("MULTILINE_SEGMENT", "S4")}
    two = spark.createDataFrame([("p", "S1", "<NAME:E1> <EMAIL:E2> <WORKPLACE:E3>")], "plan_id string, sentence_id string, text string")
    assert [(x["a"], x["b"]) for x in drafts.suspected_pairs(two, r).collect()] == [("E1", "E3")]
    typed = drafts.typed_ids(spark.createDataFrame([("p", "E1이 E2와 E9, <NAME:E1>")], "plan_id string, text string"), e).first()["text"]
    assert typed == "<NAME:E1>이 <EMAIL:E2>와 E9, <NAME:E1>"
    split = drafts.split_sentences(seg).orderBy("position").collect()
    assert [(x["sentence_id"], x["text"]) for x in split][-3:] == [("S3", "하나다."), ("S5", "둘이다."), ("S4", " \n")]


def test_tokens_for_surfaces(spark):
    texts = spark.createDataFrame([("p", "Kim Lee met Kim and Park; Lee")], "plan_id string, text string")
    surfaces = spark.createDataFrame([("p", "Kim", "<NAME:E1>"), ("p", "Kim Lee", "<NAME:E2>"), ("p", "Lee", "<NAME:E3>"), ("p", "Lee", "<NAME:E4>"), ("p", "E1", "<X:E9>")], "plan_id string, surface string, token string")
    assert drafts.with_tokens(texts, surfaces).first()["text"] == "<NAME:E2> met <NAME:E1> and Park; Lee"


def test_additions_golden(spark):
    old = spark.createDataFrame([("p", "금액: 100원 이라고 적혀 있다"), ("p", "이 문장은 서른 글자가 넘는 아주 긴 문장으로서 반복을 알아보기 위해 쓴다.")], "plan_id string, text string")
    new = spark.createDataFrame([("p", 0, "mail a@b.kr"), ("p", 1, "이 문장은 서른 글자가 넘는 아주 긴 문장으로서 반복을 알아보기 위해 쓴다!"), ("p", 2, "금액: 200원"), ("p", 3, "새로운 내용이다")], "plan_id string, ord int, text string")
    got = {r["ord"]: r["outcome"] for r in drafts.additions(new, old).collect()}
    assert got == {0: "identifier", 1: "repeat", 2: "conflict", 3: "kept"}


def test_role_values_and_address(spark):
    e = spark.createDataFrame([("p", "E1", "POSITION"), ("p", "E2", "POSITION"), ("p", "E3", "NAME")], "plan_id string, entity_id string, entity_type string")
    choices = spark.createDataFrame([("POSITION", ["a", "b", "c"])], "entity_type string, options array<string>")
    got = {r["entity_id"]: r["value"] for r in drafts.role_values(e, choices, F.lit(2)).collect()}
    assert got == {"E1": "c", "E2": "a", "E3": None}
    schema = "address struct<sido:string,sigungu:string,road_address:struct<road_name:string,building_main_no:string,building_sub_no:string>,legal_area:struct<eupmyeondong:string,ri:string>,jibun_address:struct<jibun_main_no:string,jibun_sub_no:string,is_mountain:boolean>,detail_address:struct<building_name:string,detail_text:string>>"
    road = (("서울", "중구", ("세종대로", "110", "0"), (None, None), (None, None, None), (None, "3층")),)
    lot = (("강원", "평창군", (None, None, None), ("대관령면", "횡계리"), ("12", "3", True), (None, None)),)
    bare = (("강원", "평창군", (None, None, None), ("대관령면", None), (None, None, None), (None, "NA")),)
    got = [r[0] for r in spark.createDataFrame([road, lot, bare], schema).select(drafts.address()).collect()]
    assert got == ["서울 중구 세종대로 110 3층", "강원 평창군 대관령면 횡계리 산12-3", "강원 평창군 대관령면"]


def test_particles_in_drafts(spark):
    cases = {
        "〈NAME:E1〉은 왔다": "<NAME:E1>{josa:은/는} 왔다",
        "<NAME:E1>{josa:는/은} <EMAIL:E2> {josa:을}": "<NAME:E1>{josa:은/는} <EMAIL:E2>{josa:을/를}",
        "<NAME:E1>{josa:에/에} <NAME:E1>{josa: 에서 }": "<NAME:E1>에 <NAME:E1>에서",
        "<REF:C1>으로서, <REF:C2>와의 <NAME:E1>가나": "<REF:C1>{josa:으로서/로서}, <REF:C2>{josa:과의/와의} <NAME:E1>가나",
        "<NAME:E1>{josa:zz} <X>은 나는": "<NAME:E1>{josa:zz} <X>은 나는",
        "": "",
    }
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(cases)], "i int, t string").orderBy("i")
    assert [r[0] for r in rows.select(normalise_particles(F.col("t"))).collect()] == list(cases.values())
    assert spark.createDataFrame([(None,)], "t string").select(normalise_particles(F.col("t"))).first()[0] is None


def test_person_cues(spark):
    texts = ["환자 <NAME:E1>", "환자: <RRN:E2>", "고객은 <WORKPLACE:E3>에서 산다", "고객은 <WORKPLACE:E3>이다", "고객 <WORKPLACE:E3>에서"]
    rows = spark.createDataFrame([("p", f"S{i}", "prose", t) for i, t in enumerate(texts)], "plan_id string, sentence_id string, kind string, text string")
    e = spark.createDataFrame([("p", "E1", "NAME"), ("p", "E2", "RRN"), ("p", "E3", "WORKPLACE")], "plan_id string, entity_id string, entity_type string")
    assert sorted((r["code"], r["target"]) for r in drafts.draft_issues(rows, e).collect()) == [("ENTITY_TYPE_CONTEXT", s) for s in ("S1", "S3", "S4")]


def test_address_of_text(spark):
    assert spark.createDataFrame([(" 서울 중구 ",)], "address string").select(drafts.address(nested=False)).first()[0] == "서울 중구"
