from sievework.operators import references, repair

SEG = "plan_id string, position int, sentence_id string, section_id string, scene_id string, kind string, text string"
ISSUE = "plan_id string, code string, entity_id string, relation_id string, sentence_id string, section_id string"


def draft(spark):
    segments = spark.createDataFrame([
        ("p", 0, "S1", "A", "s1", "heading", "Title <NAME:E1>"), ("p", 1, "S2", "A", "s1", "prose", "<NAME:E1> at <EMAIL:E2>"), ("p", 2, "S3", "A", "s1", "prose", "<NAME:E1> again"),
        ("p", 3, "S4", "B", "s2", "prose", "<REF:C1> of <SCHOOL:E4>"), ("p", 4, "S5", "B", "s2", "prose", "<EMAIL:E3> wrong type"),
    ], SEG)
    entities = spark.createDataFrame([("p", "E1", "NAME"), ("p", "E2", "EMAIL"), ("p", "E3", "MAJOR"), ("p", "E4", "SCHOOL")], "plan_id string, entity_id string, entity_type string")
    relations = spark.createDataFrame([("p", "R1", 0, "E1", "E2", "s1"), ("p", "R2", 1, "E1", "E3", "s2"), ("p", "R3", 2, "E1", "E4", "s2"), ("p", "R4", 3, "E2", "E1", "s3")], "plan_id string, relation_id string, ord int, source string, target string, scene_id string")
    scenes = spark.createDataFrame([("p", "s1", "A"), ("p", "s2", "B"), ("p", "s3", "B")], "plan_id string, scene_id string, section_id string")
    evidence = spark.createDataFrame([("p", "R1", 0, ["S2"]), ("p", "R3", 0, ["S4"]), ("p", "R4", 0, ["S2"])], "plan_id string, relation_id string, g int, ids array<string>")
    refs = spark.createDataFrame([("p", "C1", "E1", "they")], "plan_id string, ref_id string, entity_id string, surface string")
    return segments, entities, relations, scenes, evidence, refs


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_targets(spark):
    segments, entities, relations, scenes, evidence, refs = draft(spark)
    issues = spark.createDataFrame([("p", "MISSING_ENTITY_MENTION", "E3", None, None, None)], ISSUE)
    assert values(repair.missing(segments, entities), "entity_id") == [("E3",)]  # a slot of another type is no mention
    faulty = repair.faulty_relations(issues, segments, entities, relations, evidence)
    assert values(faulty, "relation_id") == [("R2",)]
    touched = repair.touched_scenes(issues, segments, scenes, relations, faulty)
    assert values(touched, "scene_id") == [("s2",), ("s3",)]  # s3 has no segment
    open_ = repair.open_sentences(issues, segments, touched)
    assert values(open_, "sentence_id", "editable") == [("S4", False), ("S5", False)]
    tasks = repair.relation_tasks(relations, evidence, faulty, touched, open_)
    assert values(tasks, "relation_id", "operation") == [("R2", "fix"), ("R3", "preserve"), ("R4", "preserve")]
    kept = repair.protected(segments, relations, evidence, refs, faulty)
    assert values(kept, "sentence_id") == [("S2",), ("S4",)]  # by a reference, too
    assert values(repair.replacements(segments, entities, relations, tasks, kept), "relation_id", "sentence_id") == [("R2", None)]
    assert [tuple(r) for r in repair.length_mode(issues).collect()] == [("p", "targeted_repair_with_additions")]


def test_sentences_and_wide_issues(spark):
    segments, entities, relations, scenes, evidence, refs = draft(spark)
    sentence = spark.createDataFrame([("p", "TEXT_FLUENCY", None, None, "S2", None)], ISSUE)
    faulty = repair.faulty_relations(sentence, segments, entities, relations, evidence)
    assert values(faulty, "relation_id") == [("R1",), ("R2",), ("R4",)]
    touched = repair.touched_scenes(sentence, segments, scenes, relations, faulty)
    assert all(x[1] for x in values(repair.open_sentences(sentence, segments, touched), "sentence_id", "editable"))
    tasks = repair.relation_tasks(relations, evidence, faulty, touched, repair.open_sentences(sentence, segments, touched))
    kept = repair.protected(segments, relations, evidence, refs, faulty)
    # R1 takes the sentence that names both its ends
    assert repair.replacements(segments, entities, relations, tasks, kept).where("relation_id = 'R1'").first()["sentence_id"] == "S2"
    twice = relations.where("relation_id <> 'R4'").replace({"E3": "E2", "s2": "s1"})
    got = repair.replacements(segments, entities, twice, tasks, kept.limit(0))
    assert dict(values(got.where("relation_id <> 'R3'"), "relation_id", "sentence_id")) == {"R1": "S2", "R2": "S3"}
    short = spark.createDataFrame([("p", "LENGTH_SHORTAGE", None, None, None, None)], ISSUE)
    clean = entities.where("entity_id <> 'E3'")
    none = repair.faulty_relations(short, segments, clean, relations, evidence)
    assert none.count() == 0
    touched = repair.touched_scenes(short, segments, scenes, relations, none)
    assert values(touched, "scene_id") == [("s3",)] and repair.insertion_scenes(short, scenes, touched).count() == 3
    assert repair.length_mode(short).first()["mode"] == "append_only"
    wide = spark.createDataFrame([("p", "SECTION_ORDER", None, None, "", None)], ISSUE)
    assert repair.touched_scenes(wide, segments, scenes, relations, none).count() == 3


def test_progress(spark):
    segments, entities, relations, scenes, evidence, refs = draft(spark)
    issues = spark.createDataFrame([("p", "MISSING_ENTITY_MENTION", "E3", None, None, None), ("p", "RELATION_MEANING", None, "R1", None, None), ("p", "LENGTH_SHORTAGE", None, None, None, None)], ISSUE)
    tasks = spark.createDataFrame([("p", "R1", "fix"), ("p", "R2", "fix")], "plan_id string, relation_id string, operation string")
    before = {"segments": segments, "evidence": evidence, "refs": refs, "issues": issues}
    same = repair.progress(entities, entities, relations, tasks, before, before).first()
    assert same["no_effective_progress"] and not same["structural_targets_satisfied"] and same["unresolved_semantic_issues"] == 2 and same["changed_sentence_ids"] == [] and same["remaining_invalid_relation_ids"] == ["R2"]
    mended = segments.replace({"<EMAIL:E3> wrong type": "<NAME:E1> reads <MAJOR:E3>", "<NAME:E1> at <EMAIL:E2>": "<NAME:E1> writes from <EMAIL:E2>"})
    more = evidence.unionByName(spark.createDataFrame([("p", "R2", 0, ["S5"])], evidence.schema))
    done = repair.progress(entities, entities, relations, tasks, before, before | {"segments": mended, "evidence": more, "issues": issues.limit(0)}).first()
    assert done["structural_targets_satisfied"] and done["all_code_checks_passed"] and done["resolved_issue_count"] == 3 and done["changed_sentence_ids"] == ["S2", "S5"] and not done["refs_changed"]
    longer = repair.progress(entities, entities, relations, tasks, before, before | {"issues": issues.where("code <> 'LENGTH_SHORTAGE'")}).first()
    assert longer["length_only_progress"] and not longer["no_effective_progress"]
    other = repair.progress(entities, entities, relations, tasks, before, before | {"refs": refs.replace({"they": "she"})}).first()
    assert other["refs_changed"] and other["unresolved_semantic_issues"] == 0


def test_profiles(spark):
    conditions = spark.createDataFrame([(1, "D", "x", "scenario_v1"), (2, "D", "y", "scenario_v1"), (3, "D", "x", None)], "id int, domain string, subtype string, graph_policy string")
    profiles = spark.createDataFrame([("D", "x", "PII", 0, "NAME", "b", "EMAIL"), ("D", "x", "PII", 1, "NAME", "a", "AGE"), ("D", "x", "PII", 2, "NAME", "z", "AGE")], "domain string, subtype string, privacy string, ord int, source_type string, relation string, target_type string")
    edges = [("NAME", "a", "AGE"), ("NAME", "b", "EMAIL"), ("NAME", "c", "AGE")]
    triples = spark.createDataFrame([(i, "PII", *e) for i in (1, 2, 3) for e in edges], "id int, privacy string, source_type string, relation string, target_type string")
    got = references.narrowed(conditions, triples, profiles, "id")
    assert values(got.where("id = 1"), "ord", "relation") == [(0, "b"), (1, "a")]
    assert got.where("id = 2 and ord is null").count() == 3 and got.where("id = 3").count() == 3


def test_reference_people(spark):
    persons = spark.createDataFrame([("p", "P1", "E1", "user", "actual_party"), ("p", "P2", "E3", "model", "example_person")], "plan_id string, person_id string, name_entity_id string, role string, context_kind string")
    entities = spark.createDataFrame([("p", "E1", "NAME", "user"), ("p", "E3", "NAME", "reference:k:name"), ("p", "E4", "SCHOOL", "reference:k:attribute")], "plan_id string, entity_id string, entity_type string, context_role string")
    relations = spark.createDataFrame([("p", "R1", "E3", "at", "E4", "NON_PII"), ("p", "R2", "E1", "GUIDANCE_SUPPORT", "E3", "NON_PII")], "plan_id string, relation_id string, source string, relation string, target string, target_privacy string")
    registered = spark.createDataFrame([("k", "example_person", "model", "at", "SCHOOL")], "profile string, context_kind string, role string, relation string, target_type string")
    wanted = spark.createDataFrame([("p", "k", "party_link_v1")], "plan_id string, reference_profile string, reference_link_policy string")
    check = lambda **k: values(references.reference_issues(**({"persons": persons, "entities": entities, "relations": relations, "registered": registered, "wanted": wanted} | k)), "code", "target")
    assert check() == []
    assert check(persons=persons.where("person_id = 'P1'")) == [("REFERENCE_MISSING", "")]
    assert check(wanted=wanted.replace({"k": "q"})) == check(wanted=wanted.replace({"k": ""})) == [("REFERENCE_PROVENANCE", "")]
    assert check(relations=relations.where("relation_id = 'R1'")) == check(relations=relations.where("relation_id = 'R2'")) == check(registered=registered.replace({"model": "x"})) == [("REFERENCE_FACT_SCOPE", "E3")]
    assert check(relations=relations.replace({"at": "near"})) == check(wanted=wanted.replace({"party_link_v1": "none"})) == [("REFERENCE_FACT_SCOPE", "E3")]
    twice = persons.unionByName(spark.createDataFrame([("p", "P3", "E1", "model", "example_person")], persons.schema))
    assert ("REFERENCE_COUNT", "") in check(persons=twice)
    names = spark.createDataFrame([("k", "Ada", "Old School")], "profile string, name string, target_value string")
    assert values(references.reference_values(entities, registered, names, wanted), "entity_id", "value") == [("E3", "Ada"), ("E4", "Old School")]
