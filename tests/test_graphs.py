import random

from pyspark.sql import functions as F

from sievework.functions import nested
from sievework.operators import document, graph, review, sampling


def test_masking_groups_and_bridges(spark):
    e = spark.createDataFrame([("p", "E1", "E2", "PII"), ("p", "E1", "E3", "PII"), ("p", "E3", "E4", "NON_PII")], "plan string, s string, t string, label string")
    pii = F.col("label") == "PII"
    labels = {r["node"]: r["privacy"] for r in graph.node_labels(e, ["plan"], "s", "t", pii).collect()}
    assert labels == {"E1": "PII", "E2": "PII", "E3": "PII", "E4": "NON_PII"}
    assert [r["t"] for r in graph.bridges(e, ["plan"], "s", "t", pii, F.col("s") == "E3").collect()] == ["E4"]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(20)]
    edges = [e for e in edges if e[0] != e[1]]
    least = {v: v for e in edges for v in e}
    for _ in range(200):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == least


def test_evidence_modes(spark):
    cases = [([["S8", "S9"], ["S4"]], "single", 1), ([["S8", "S9"], ["S4", "S1"]], "adjacent", 2), ([["S8", "S9"]], "nonadjacent", 2), ([["UNKNOWN"]], "unresolved", None), ([["S1", "S1"]], "unresolved", None), ([], "unresolved", None)]
    positions = F.map_from_arrays(F.array(*map(F.lit, ("S9", "S4", "S1", "S8"))), F.array(*map(F.lit, (0, 1, 2, 3))))
    df = spark.createDataFrame([(i, g) for i, (g, _, _) in enumerate(cases)], "i int, g array<array<string>>")
    got = df.orderBy("i").select(graph.evidence_mode(F.col("g"), positions), graph.smallest_evidence(F.col("g"), positions)).collect()
    assert [tuple(r) for r in got] == [(m, n) for _, m, n in cases]


def test_plan_fingerprint_invariance(spark):
    nodes, edges = [("a", "N"), ("b", "O"), ("c", "O"), ("d", "O")], [("a", "b", "r"), ("a", "c", "r"), ("a", "d", "r")]
    new = {"a": "z", "b": "y", "c": "x", "d": "w"}
    same = graph.fingerprint([(new[v], k) for v, k in reversed(nodes)], [(new[s], new[t], e) for s, t, e in reversed(edges)])
    assert graph.fingerprint(nodes, edges) == same
    assert graph.fingerprint(nodes, [("a", "b", "r"), ("b", "c", "r"), ("c", "d", "r")]) != same
    ring = lambda *o: [(o[i], o[(i + 1) % len(o)], "r") for i in range(len(o))]
    six = [(v, "N") for v in "abcdef"]
    assert graph.fingerprint(six, ring(*"abcdef")) != graph.fingerprint(six, ring(*"abc") + ring(*"def"))
    assert graph.fingerprint(six, ring(*"abcdef")) == graph.fingerprint(six, ring(*"fcbade"))
    df = graph.plan_fingerprints(spark.createDataFrame([("p", *n) for n in nodes] + [("q", "k", "N")], "plan_id string, node string, label string"), spark.createDataFrame([("p", *e) for e in edges], "plan_id string, source string, target string, label string"))
    assert {r["plan_id"]: r["fingerprint"] for r in df.collect()} == {"p": same, "q": graph.fingerprint([("k", "N")], [])}


def test_parts_under_other_names_are_searched_once(monkeypatch):
    searched, search = [], graph._Search
    monkeypatch.setattr(graph, "_Search", lambda *a: searched.append(1) or search(*a))
    graph._known.cache_clear()
    rng, found = random.Random(7), {}
    for i in range(200):
        names = [f"n{k}" for k in rng.sample(range(1000), 7)]
        a, b, c, s, t, u, v = names
        edges = [(a, s, "N"), (b, s, "R"), (c, t, "N"), (c, u, "A"), (v, v, "N")] + ([(b, t, "N")] if i % 2 else [])
        rng.shuffle(names), rng.shuffle(edges)
        found.setdefault(i % 2, set()).add(graph.fingerprint([(x, "P" if x in (a, b, c) else "S") for x in names], edges))
    graph._known.cache_clear()
    assert len(found[0]) == len(found[1]) == 1 and found[0] != found[1] and len(searched) == 4
    # what a cached part gives is what a search gives
    label = {"P1": "P", "S1": "S", "S2": "S"}
    out, into = {"P1": [("N", "S1"), ("R", "S2")], "S1": [], "S2": []}, {"P1": [], "S1": [("N", "P1")], "S2": [("R", "P1")]}
    assert graph.fingerprint(label.items(), [("P1", "S1", "N"), ("P1", "S2", "R")]) == graph._digest([search(label, out, into).best])


def test_value_groups(spark):
    entities = spark.createDataFrame([("p", "E1", "NAME", ""), ("p", "E2", "EMAIL", ""), ("p", "E3", "AGE", "g"), ("p", "E4", "AGE", "g"), ("p", "E5", "SCHOOL", None), ("p", "E6", "NAME", ""), ("p", "E7", "RRN", "")], "plan_id string, entity_id string, entity_type string, slot_group string")
    constraints = spark.createDataFrame([("p", "K1", "same_persona", ["E1", "E3"], "", []), ("p", "K2", "occupation", ["E3"], "", ["a", "b"]), ("p", "K3", "occupation", ["E4"], "occupation", ["c"])], "plan_id string, constraint_id string, kind string, entity_ids array<string>, field string, allowed_values array<string>")
    relations = spark.createDataFrame([("p", "E1", "E2", "PII"), ("p", "E1", "E7", "PII"), ("p", "E6", "E7", "PII")], "plan_id string, source string, target string, target_privacy string")
    links = spark.createDataFrame([("p", "E6", "E5", "personal_attribute")], "plan_id string, name_entity_id string, entity_id string, link_kind string")
    pairs = graph.value_group_edges(entities, constraints, relations, links)
    groups = graph.value_groups(entities, pairs)
    assert {r["entity_id"]: r["value_group"] for r in groups.collect()} == {"E1": "E1", "E2": "E1", "E3": "E1", "E4": "E1", "E5": "E5", "E6": "E5", "E7": "E7"}
    found = {(r["code"], r["detail"]) for r in graph.group_conflicts(entities, groups, constraints).collect()}
    assert found == {("VALUE_GROUP_TYPE_CONFLICT", "AGE"), ("VALUE_ALLOWED_CONFLICT", "occupation")}
    kinds = {(r["name"], r["entity_id"]): r["link_kind"] for r in graph.person_links(relations, entities).collect()}
    assert kinds[("E1", "E1")] == "identity" and kinds[("E1", "E2")] == "personal_attribute"


def test_value_groups_take_no_rounds(spark):
    """A path, a star, parts that meet late, repeated and null ids: found in few jobs, whatever their shape."""
    rng = random.Random(5)
    plans = {"path": [(f"E{i:03}", f"E{i + 1:03}") for i in range(299)], "star": [("E150", f"E{i:03}") for i in range(300)], "none": [], **{f"r{k}": [(f"E{rng.randrange(300):03}", f"E{rng.randrange(300):03}") for _ in range(60 * k)] for k in range(1, 6)}}
    rng.shuffle(plans["path"])
    entities = spark.createDataFrame([(p, f"E{i:03}", i) for p in plans for i in range(300)] + [("path", None, -1), (None, "E000", -2), ("star", "E007", -3)], "plan_id string, entity_id string, i int")
    pairs = spark.createDataFrame([(p, a, b) for p, e in plans.items() for a, b in e if a != b], "plan_id string, a string, b string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rounds", "value groups")
    got = graph.value_groups(entities, pairs, ("i",)).collect()
    jobs = len(tracker.getJobIdsForGroup("rounds"))
    spark.sparkContext.setJobGroup("tests", "")
    want = {}
    for p, edges in plans.items():
        head = {f"E{i:03}": f"E{i:03}" for i in range(300)}
        while any(head[a] != head[b] for a, b in edges):
            for a, b in edges:
                head[a] = head[b] = min(head[a], head[b])
        want |= {(p, k): v for k, v in head.items()}
    want |= {("path", None): None, (None, "E000"): "E000"}
    assert len(got) == 300 * len(plans) + 3 and all(r["value_group"] == want[r["plan_id"], r["entity_id"]] for r in got)
    assert {r["i"] for r in got} == {*range(-3, 300)} and jobs <= 6


def test_render_and_annotate(spark):
    segments = spark.createDataFrame([("d", 0, "<NAME:E1>{josa:은/는} <REF:C1> 😀 <EMAIL:E2>."), ("d", 1, "plain")], "doc_id string, position int, text string")
    values = spark.createDataFrame([("d", "E1", "NAME", "홍길동"), ("d", "C1", "REF", "팀장"), ("d", "E2", "EMAIL", "a@b.kr")], "doc_id string, slot string, kind string, value string")
    out = document.render(segments, values).orderBy("position").collect()
    assert out[0]["sentence"] == "홍길동은 팀장 😀 a@b.kr." and out[1]["sentence"] == "plain"
    for m in [*out[0]["mentions"], *out[0]["refs"]]:
        assert out[0]["sentence"][m["begin"] : m["end"]] == m["form"]
    assert [m["slot"] for m in out[0]["mentions"]] == ["E1", "E2"] and [m["slot"] for m in out[0]["refs"]] == ["C1"]
    sentences = spark.createDataFrame([("d", 0, "D_0", out[0]["sentence"]), ("d", 1, "D_1", "")], "doc_id string, position int, sent_idx string, sentence string")
    mentions = spark.createDataFrame([("d", 0, m["slot"], m["kind"], m["form"], m["begin"], m["end"]) for m in out[0]["mentions"]], "doc_id string, position int, entity_id string, entity_type string, form string, begin int, end int")
    labels = spark.createDataFrame([("d", "E1", "PII"), ("d", "E2", "NON_PII")], "doc_id string, node string, privacy string")
    a = document.annotate(sentences, mentions, labels)
    r = a.orderBy("position").collect()
    assert r[0]["labelling_seq"] == ["B-NAME", "I-NAME", "I-NAME"] + ["O"] * (len(out[0]["sentence"]) - 3) and r[0]["sent_seq"] == list(out[0]["sentence"])
    assert r[1]["labelling_seq"] == [] and document.sentence_issues(a).count() == 0
    broken = a.withColumn("labelling_seq", F.array(F.lit("O"))).withColumn("sent_idx", F.lit("D_7"))
    assert {x["code"] for x in document.sentence_issues(broken).collect()} == {"FINAL_BIO", "FINAL_SENTENCE_INDEX"}
    assert document.overlaps(mentions).count() == 0


def test_relation_rules_and_review(spark):
    entities = spark.createDataFrame([("d", "E1", "NAME"), ("d", "E2", "EMAIL"), ("d", "E3", "AGE")], "doc_id string, entity_id string, entity_type string")
    relations = spark.createDataFrame([("d", "E1", "E2", "NAME", "EMAIL", "has", "PII"), ("d", "E1", "E2", "NAME", "EMAIL", "has", "PII"), ("d", "E1", "E9", "NAME", "AGE", "has", "PII")], "doc_id string, entity string, target_entity string, entity_type string, target_entity_type string, relation string, privacy_label string")
    assert sorted(r["code"] for r in document.relation_issues(relations, entities).collect()) == ["FINAL_DUPLICATE_RELATION", "FINAL_ISOLATED_ENTITY", "FINAL_RELATION_ENDPOINT"]
    checks = spark.createDataFrame([("d", "R1", True, True, True, "PII"), ("e", "R1", True, False, True, "PII"), ("f", "R1", True, True, True, "AMBIGUOUS")], "doc_id string, relation_id string, relation_supported boolean, direction_supported boolean, attribution_supported boolean, observed_privacy string")
    planned = spark.createDataFrame([("d", "R1", "PII"), ("e", "R1", "PII"), ("f", "R1", "PII"), ("f", "R2", "PII")], "doc_id string, relation_id string, target_privacy string")
    reviews = spark.createDataFrame([("d", 0, True, "상"), ("e", 0, True, "상"), ("f", 0, True, "중")], "doc_id string, n_unplanned int, format_ok boolean, overall string")
    findings = spark.createDataFrame([("f", "fluency", ["S1", "S2"]), ("f", "format", [])], "doc_id string, kind string, sentence_ids array<string>")
    found = review.privacy_gate(checks, planned, reviews, findings)
    assert sorted((r["code"], r["target"]) for r in found.where("code like 'TEXT%'").collect()) == [("TEXT_FLUENCY", "S1"), ("TEXT_FLUENCY", "S2"), ("TEXT_FORMAT", "")]
    by = {}
    for r in found.collect():
        by.setdefault(r["doc_id"], set()).add(r["code"])
    assert by == {"e": {"RELATION_MEANING", "PRIVACY_AMBIGUOUS"}, "f": {"PRIVACY_AMBIGUOUS", "REVIEW_RELATION_COVERAGE", "QUALITY_GRADE", "TEXT_FLUENCY", "TEXT_FORMAT"}}
    assert {r["doc_id"]: r["passed"] for r in document.gate(reviews, "doc_id", found).collect()} == {"d": True, "e": False, "f": False}


def _isomorphic(a, b):
    """By all orders of the nodes."""
    from itertools import permutations

    (n, e), (m, f) = a, b
    if sorted(x for _, x in n) != sorted(x for _, x in m) or len(e) != len(f):
        return False
    return any(all(x == y for (_, x), (_, y) in zip(n, p, strict=True)) and sorted((dict(zip([v for v, _ in n], [v for v, _ in p], strict=True))[s], dict(zip([v for v, _ in n], [v for v, _ in p], strict=True))[t], k) for s, t, k in e) == sorted(f) for p in permutations(m))


def test_fingerprints_tell_small_graphs_apart_as_all_orders_do():
    r = random.Random(5)
    graphs = [([(f"n{i}", r.choice("AB")) for i in range(4)], [(f"n{r.randrange(4)}", f"n{r.randrange(4)}", r.choice("xy")) for _ in range(r.randint(2, 4))]) for _ in range(60)]
    for _ in range(3):
        names = dict(zip([f"n{i}" for i in range(4)], r.sample([f"n{i}" for i in range(4)], 4), strict=True))
        graphs += [(r.sample([(names[v], x) for v, x in n], 4), r.sample([(names[s], names[t], k) for s, t, k in e], len(e))) for n, e in graphs[:20]]
    marks = [graph.fingerprint(*g) for g in graphs]
    pairs = [(i, j) for i in range(len(graphs)) for j in range(i)]
    assert all((marks[i] == marks[j]) == _isomorphic(graphs[i], graphs[j]) for i, j in r.sample(pairs, 1500) + [(60 + k, k % 20) for k in range(60)])


def test_symmetric_graphs_take_few_steps():
    import time

    r = random.Random(1)
    ring = [(i, (i + 1) % 40) for i in range(40)]
    cube = [(i, i ^ (1 << b)) for i in range(32) for b in range(5) if i < i ^ (1 << b)]
    grid = [(10 * a + i, 10 * a + (i + 1) % 10) for a in range(4) for i in range(10)] + [(10 * a + i, 10 * ((a + 1) % 4) + i) for a in range(4) for i in range(10)]
    full = [(i, 20 + j) for i in range(20) for j in range(20)]
    for edges, n in ((ring, 40), (cube, 32), (grid, 40), (full, 40)):
        both = [(f"v{x}", f"v{y}", "e") for s, t in edges for x, y in ((s, t), (t, s))]
        nodes = [(f"v{i}", "N") for i in range(n)]
        began = time.time()
        mark = graph.fingerprint(nodes, both)
        assert time.time() - began < 5
        names = dict(zip([v for v, _ in nodes], r.sample([v for v, _ in nodes], n), strict=True))
        assert graph.fingerprint(r.sample(nodes, n), [(names[s], names[t], k) for s, t, k in r.sample(both, len(both))]) == mark
        assert graph.fingerprint(nodes, [*both[:-2], ("v0", "v7", "e"), ("v7", "v0", "e")]) != mark


def test_scenes_count_in_fingerprints(spark):
    nodes = spark.createDataFrame([(p, v, "N") for p in (1, 2, 3) for v in "abc"], "plan_id long, node string, label string")
    rows = [(1, "a", "b", "r", 1), (1, "b", "c", "r", 2), (2, "c", "a", "r", 1), (2, "a", "b", "r", 2), (3, "a", "b", "r", 2), (3, "b", "c", "r", 1)]
    edges = spark.createDataFrame(rows, "plan_id long, source string, target string, label string, scene int")
    got = {r["plan_id"]: r["fingerprint"] for r in graph.plan_fingerprints(nodes, edges).collect()}
    assert got[1] == got[2] != got[3] and len({r["fingerprint"] for r in graph.plan_fingerprints(nodes, edges.drop("scene")).collect()}) == 1


def test_patch_and_ids(spark):
    segments = spark.createDataFrame([("d", 0, "S1", "a"), ("d", 1, "S2", "b")], "doc_id string, position int, sentence_id string, text string")
    replaced = spark.createDataFrame([("d", "S2", "B")], "doc_id string, sentence_id string, text string")
    inserted = spark.createDataFrame([("d", "", 1, "S3", "start"), ("d", "S1", 1, "S4", "x"), ("d", "S1", 2, "S5", "y")], "doc_id string, anchor string, ordinal int, sentence_id string, text string")
    out = document.apply_patch(segments, replaced, inserted).orderBy("position").collect()
    assert [(r["position"], r["sentence_id"], r["text"]) for r in out] == [(0, "S3", "start"), (1, "S1", "a"), (2, "S4", "x"), (3, "S5", "y"), (4, "S2", "B")]
    versions = spark.createDataFrame([("d", 2, 1)], "doc_id string, draft_version int, base_version int")
    bad = spark.createDataFrame([("d", "S9", "q")], "doc_id string, sentence_id string, text string")
    assert sorted(r["code"] for r in document.patch_issues(segments, bad, inserted, versions).collect()) == ["PATCH_BASE_VERSION", "PATCH_REPLACEMENT_ID"]
    same = spark.createDataFrame([("d", 0, "S1", "a"), ("d", 1, "S1", "b"), ("d", 2, "X", "c"), ("d", 3, "S7", "e")], "doc_id string, position int, sentence_id string, text string")
    assert [r["new_id"] for r in document.unique_ids(same).orderBy("position").collect()] == ["S1", "S8", "S9", "S7"]


def test_schema_and_specs(spark):
    schema = {"type": "object", "properties": {"id": {"type": "string", "pattern": "S[0-9]+"}, "n": {"type": ["integer", "null"]}, "xs": {"type": "array", "items": {"anyOf": [{"type": "string", "enum": ["a"]}, {"type": "integer"}]}, "minItems": 1}}}
    texts = ['{"id":"S1","n":null,"xs":["a",3]}', '{"id":"T","n":1.5,"xs":[]}', '{"id":"S1"}', "nope", '{"id":"S2","n":true,"xs":["b"]}']
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(nested.violations(F.try_parse_json("t"), schema)).collect()]
    assert got == [[], ["SCHEMA_PATTERN $.id", "SCHEMA_TYPE $.n", "SCHEMA_ARRAY_LENGTH $.xs"], ["SCHEMA_KEYS $"], ["SCHEMA_JSON $"], ["SCHEMA_TYPE $.n", "SCHEMA_ANY_OF $.xs[0]"]]
    sentences = spark.createDataFrame([("d", "S1", "A", "prose", "long enough sentence"), ("d", "S2", "A", "heading", "a long heading here")], "doc_id string, sentence_id string, section_id string, kind string, sentence string")
    findings = spark.createDataFrame([("d", "k1", "A", True, "ok", ["S1"]), ("d", "k2", "", True, "ok", ["S2"]), ("d", "k3", "", False, "no", ["S1"])], "doc_id string, check_id string, section_id string, passed boolean, reason string, evidence array<string>")
    assert {(r["code"], r["target"]) for r in document.spec_issues(findings, sentences).collect()} == {("SPEC_REVIEW_EVIDENCE", "k2"), ("DOCUMENT_SPEC_INCOMPLETE", "k3")}
    held = spark.createDataFrame([("d", "S1", ["E1", "E2"]), ("d", "S2", ["E1"])], "doc_id string, sentence_id string, entity_ids array<string>")
    ends = spark.createDataFrame([("d", "R1", "E1", "E2")], "doc_id string, relation_id string, source string, target string")
    groups = spark.createDataFrame([("d", "R1", 0, ["S1"]), ("d", "R1", 1, ["S2", "S9"])], "doc_id string, relation_id string, g int, ids array<string>")
    assert [tuple(r) for r in document.evidence_issues(groups, held, ends).collect()] == [("d", "RELATION_EVIDENCE", "R1")]
    assert document.evidence_issues(groups.where("g = 0"), held, ends).count() == 0 and document.evidence_issues(groups.where("g = 9"), held, ends).count() == 1
    assert document.direct_evidence(held, ends).first()["ids"] == ["S1"]


def test_sampling(spark):
    r = spark.range(1).select(sampling.apportion(F.lit(10).cast("long"), F.array(F.lit(0.33), F.lit(0.33), F.lit(0.34))).alias("x")).first()["x"]
    assert r == [3, 3, 4]
