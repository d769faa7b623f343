"""Reviews with quotes, evidence, references and people."""

import pytest

from sievework.plans import rules
from sievework.operators import diagnosis, review


@pytest.fixture(scope="module")
def docs(spark):
    sentences = spark.createDataFrame([("d", "S1", "Kim works at ACME."), ("d", "S2", "He calls 010.")], "doc_id string, sentence_id string, sentence string")
    mentions = spark.createDataFrame([("d", "S1", "E1"), ("d", "S1", "E2"), ("d", "S2", "E3")], "doc_id string, sentence_id string, entity_id string")
    return review.by_document(sentences, mentions), mentions


def found(df):
    return sorted((r["code"], r["target"]) for r in df.collect())


def test_quotes_and_groups(spark, docs):
    schema = "doc_id string, item_id string, quotes array<struct<sentence_id:string,quote:string>>, groups array<array<string>>"
    rows = [
        ("d", "ok", [("S1", "Kim works")], [["S1"]]),
        ("d", "wrong", [("S1", "Lee"), ("S2", ""), ("S9", "x")], []),
        ("d", "odd", [("S1", "Kim")], [[], ["S1", "S1"]]),
        ("d", "bare", [("S1", "Kim")], [["S1", "S2"]]),
    ]
    got = found(review.quote_issues(spark.createDataFrame(rows, schema), docs[0]))
    assert got == [("REVIEW_EVIDENCE_GROUP", "odd"), ("REVIEW_EVIDENCE_GROUP", "odd"), ("REVIEW_EVIDENCE_QUOTE_MISSING", "S2"), ("REVIEW_QUOTE", "S1"), ("REVIEW_QUOTE", "S2"), ("REVIEW_QUOTE", "S9")]


def test_relations(spark, docs):
    schema = "doc_id string, relation_id string, extractable boolean, direction_supported boolean, coreference_unambiguous boolean, observed_privacy string, groups array<array<string>>"
    planned = spark.createDataFrame([("d", f"R{i}", "E1", "E2", "PII") for i in range(1, 6)], "doc_id string, relation_id string, source string, target string, target_privacy string")
    rows = [
        ("d", "R1", True, True, True, "PII", [["S1"]]),
        ("d", "R2", True, True, True, "AMBIGUOUS", [["S1", "S2"]]),
        ("d", "R3", True, True, True, "NON_PII", []),
        ("d", "R4", True, False, True, "PII", [["S2"]]),
        ("d", "R5", False, True, True, "PII", [["S9"]]),
    ]
    got = found(review.relation_meaning(spark.createDataFrame(rows, schema), planned, docs[0]))
    assert got == [("PRIVACY_AMBIGUOUS", "R2"), ("RELATION_MEANING", "R3"), ("RELATION_MEANING", "R4"), ("RELATION_MEANING", "R5"), ("REVIEW_ENDPOINT_EVIDENCE", "R4"), ("REVIEW_MISSING_EVIDENCE", "R3")]


def test_references(spark, docs):
    refs = spark.createDataFrame([("d", c, "E1", ["S2"]) for c in ("C1", "C2", "C3", "C4", "C5")], "doc_id string, ref_id string, entity_id string, sentence_ids array<string>")
    rows = [("d", "C1", "E1", True, [["S1", "S2"]]), ("d", "C2", "E1", True, [["S2"], ["S1"]]), ("d", "C3", "E9", True, [["S1"]]), ("d", "C4", "E2", False, []), ("d", "C5", "E1", True, [])]
    checks = spark.createDataFrame(rows, "doc_id string, ref_id string, observed_entity_id string, unambiguous boolean, groups array<array<string>>")
    got = found(review.reference_meaning(checks, refs, docs[1], docs[0]))
    assert got == [("REFERENCE_MEANING", "C3"), ("REFERENCE_MEANING", "C4"), ("REVIEW_REFERENCE_CONNECTION", "C2"), ("REVIEW_REFERENCE_CONNECTION", "C2"), ("REVIEW_REFERENCE_ENTITY", "C3"), ("REVIEW_REFERENCE_EVIDENCE", "C5")]


def test_persons(spark):
    persons = spark.createDataFrame([("d", "E1", "user", "actual_party", [["S1"]]), ("d", "E2", "user", "actual_party", [["S2"]]), ("d", "E7", "x", "public", [])], "doc_id string, name_entity_id string, role string, context_kind string, groups array<array<string>>")
    planned = spark.createDataFrame([("d", "E1", "user", "actual_party"), ("d", "E2", "owner", "actual_party")], "doc_id string, name_entity_id string, role string, context_kind string")
    names = spark.createDataFrame([("d", "E1", ["S1"]), ("d", "E2", ["S1"]), ("d", "E3", ["S1"])], "doc_id string, name_entity_id string, sentence_ids array<string>")
    counts = spark.createDataFrame([("d", 3, 2, 0), ("e", 0, None, 0)], "doc_id string, actual_person_count int, n_parties int, unregistered_names int")
    got = found(review.person_meaning(persons, planned, names, counts))
    assert got == [("PERSON_COUNT_MEANING", ""), ("PERSON_ROLE_MEANING", "E2"), ("REVIEW_PERSON_COUNT", ""), ("REVIEW_PERSON_COVERAGE", "E3"), ("REVIEW_PERSON_COVERAGE", "E7"), ("REVIEW_PERSON_EVIDENCE", "E2"), ("REVIEW_PERSON_EVIDENCE", "E7")]


def test_quality(spark):
    grades = spark.createDataFrame([("a", "상", "상", "상", "중"), ("b", "중", "중", "상", "상"), ("c", "중", "상", "상", "하"), ("d", "중", "상", "상", "상")], "doc_id string, overall string, consistency string, suitability string, fluency string")
    seen = spark.createDataFrame([("b", "CONTRADICTIONS", ""), ("c", "FORMAT_MEANING", "")], "doc_id string, code string, target string")
    got = sorted((r["doc_id"], r["code"]) for r in review.quality(grades, seen).collect())
    assert got == [("b", "QUALITY_GRADE"), ("c", "QUALITY_GRADE"), ("c", "REVIEW_QUALITY_TARGET"), ("d", "QUALITY_GRADE"), ("d", "REVIEW_QUALITY_TARGET")]


def test_reviewer_sees_no_labels(spark):
    plan = spark.createDataFrame([("p", "R1", "PII", "why", ("a", "PII"))], "plan_id string, relation_id string, target_privacy string, context_reason string, more struct<x:string,target_privacy:string>")
    out = review.reviewer_view(plan)
    assert out.columns == ["plan_id", "relation_id", "more"] and out.schema["more"].dataType.names == ["x"]


def test_section_order_and_repetition(spark):
    text = "이 문장은 스물네 글자보다 길어서 반복을 알아볼 수 있는 문장이다"
    rows = [("p", 0, "S1", "B", "prose", text), ("p", 1, "S2", "A", "prose", text + "."), ("p", 2, "S3", "Z", "heading", text), ("p", 3, "S4", "A", "prose", text + "!")]
    segments = spark.createDataFrame(rows, "plan_id string, position int, sentence_id string, section_id string, kind string, text string")
    sections = spark.createDataFrame([("p", "A", 0), ("p", "B", 1)], "plan_id string, section_id string, ord int")
    assert [r["sentence_id"] for r in diagnosis.in_section_order(segments, sections).orderBy("position").collect()] == ["S2", "S4", "S1", "S3"]
    r = diagnosis.repetition(segments).first()
    assert (r["sentences"], r["repeated"], r["share"]) == (3, 2, 0.6667)


def test_the_full_gate_broadcasts_nothing(spark):
    """Tables of a row per document compress well and look small; broadcast, they went through the driver."""
    plan = rules.full_review(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_a_draft_is_diagnosed_within_its_row(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, "plan_id long, " + schema)
    segments = make([(1, 0, "S1", "A", "A", "prose", "<REF:C1>{josa:x/y} t"), (1, 1, "S1", "Z", "A", "heading", "t"), (1, 2, "S3", "B", "B", "question", "<REF:C9>"), (3, 0, "S1", "A", "A", "prose", "t")], "position int, sentence_id string, section_id string, scene_id string, kind string, text string")
    sections = make([(p, k, i, ["prose"], m) for p in (1, 2) for k, i, m in (("A", 1, ""), ("B", 0, "qa"), ("D", 2, ""))], "section_id string, ord int, allowed_kinds array<string>, mode string")
    scenes = make([(1, k, k) for k in "ABD"], "scene_id string, section_id string")
    refs = make([(1, "C1", "E9", "it"), (1, "C2", "E1", "　"), (1, "C3", "E1", "Kim")], "ref_id string, entity_id string, surface string")
    wanted = make([(p, "question_answer", "d", "s", 100, 40) for p in (1, 2)], "layout_variant string, domain string, subtype string, min_chars int, rendered_chars int")
    one = lambda value, column: make([(1, value)], f"{column} string")
    got = diagnosis.diagnose(segments, sections, scenes, refs, one("E1", "entity_id"), one("Kim", "value"), make([(1, "R1"), (1, "R1")], "relation_id string"), one("R1", "relation_id"), wanted)
    want = {("SEGMENT_SCENE_SECTION", "S1"), ("SEGMENT_KIND", "S3"), ("DRAFT_SENTENCE_ID", ""), ("REFERENCE_TARGET", "C1"), ("REFERENCE_TARGET", "C2"), ("REFERENCE_ACTUAL_VALUE", "C3"), ("EVIDENCE_ID", ""), ("MISSING_REFERENCE", "C9"), ("JOSA_MARKER", "x/y")}
    want |= {("MISSING_SECTION", "D"), ("SECTION_ORDER", ""), ("MISSING_SCENE", "D"), ("QUESTION_ANSWER_LAYOUT", ""), ("SPEC_QUESTION_ANSWER", "B"), ("LENGTH_SHORTAGE", "60")}
    assert sorted(map(tuple, got.collect())) == sorted({(1, *x) for x in want} | {(2, "EMPTY_DOCUMENT", ""), (3, "SEGMENT_SCENE_SECTION", "S1")})
    from sievework.plans import documents

    plan = documents.draft_diagnosis(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2  # lines and orders are moved once each
