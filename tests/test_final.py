"""The last check of documents: a sound document, then one with each rule broken."""

import copy
import json

from sievework.operators import final


def sentence(i, text, *spans):
    labels = ["O"] * len(text)
    for b, e, label in spans:
        labels[b:e] = ["B-" + label] + ["I-" + label] * (e - b - 1)
    return {
        "sent_idx": f"d_{i}", "sentence": text, "sent_seq": list(text), "labelling_seq": labels,
        "PII_set": [{"id": n, "begin": b, "end": e, "form": text[b:e], "label": label} for n, (b, e, label) in enumerate(spans)],
    }


def entity(eid, kind, form, *mentions):
    return {"entity_id": eid, "entity_type": kind, "canonical_form": form, "mentions": [{"sent_idx": s, "begin": b, "end": b + len(form), "form": form} for s, b in mentions]}


def relation(a, ta, b, tb, privacy):
    return {"entity": a, "entity_type": ta, "target_entity": b, "target_entity_type": tb, "relation": "has", "privacy_label": privacy}


SOUND = {
    "sentences": [sentence(0, "😀 Kim calls 010.", (2, 5, "NAME"), (12, 15, "TELEPHONE")), sentence(1, "At ACME, sales.")],
    "entities": [entity("E1", "NAME", "Kim", ("d_0", 2)), entity("E2", "TELEPHONE", "010", ("d_0", 12)), entity("E3", "WORKPLACE", "ACME", ("d_1", 3)), entity("E4", "DEPARTMENT", "sales", ("d_1", 9))],
    "relations": [relation("E1", "NAME", "E2", "TELEPHONE", "PII"), relation("E3", "WORKPLACE", "E4", "DEPARTMENT", "NON_PII")],
}


def broken(change):
    d = copy.deepcopy(SOUND)
    change(d)
    return d


def put(path, value):
    def change(d):
        for k in path[:-1]:
            d = d[k]
        d[path[-1]] = value

    return change


def drop(path):
    def change(d):
        for k in path[:-1]:
            d = d[k]
        del d[path[-1]]

    return change


def add(path, value):
    def change(d):
        for k in path:
            d = d[k]
        d.append(value)

    return change


S, E, R = "sentences", "entities", "relations"
INDEX, MASK, SPAN, BIO = "FINAL_SENTENCE_INDEX", "FINAL_MASKING_GROUP", "FINAL_PII_SPAN", "FINAL_BIO"
CASES = [
    (lambda d: None, []),
    (put(["extra"], 1), ["FINAL_SCHEMA"]),
    (drop([R]), ["FINAL_SCHEMA"]),
    (put([S], []), ["FINAL_LISTS"]),
    (put([R], None), ["FINAL_LISTS"]),
    (drop([S, 1, "sent_seq"]), ["FINAL_MENTION_SPAN", "FINAL_MENTION_SPAN", "FINAL_SENTENCE_SCHEMA"]),
    (put([S, 1], 7), ["FINAL_MENTION_SPAN", "FINAL_MENTION_SPAN", "FINAL_SENTENCE_SCHEMA"]),
    (put([S, 1, "sentence"], 7), ["FINAL_MENTION_SPAN", "FINAL_MENTION_SPAN", "FINAL_SENTENCE_TYPES"]),
    (put([S, 1, "sent_idx"], "x_1"), ["FINAL_MENTION_SPAN", "FINAL_MENTION_SPAN", INDEX]),
    (put([S, 1, "sent_seq"], ["A"]), ["FINAL_CHAR_SEQUENCE"]),
    (put([S, 1], sentence(1, "At ACME, sales. <NAME:E1>")), ["FINAL_PLACEHOLDER"]),
    (put([S, 1], sentence(1, "At ACME, sales. E12")), ["FINAL_INTERNAL_ENTITY_ID"]),
    (put([S, 0, "PII_set", 1, "id"], 5), [BIO, SPAN]),
    (put([S, 0, "PII_set", 1, "begin"], 12.0), [BIO, MASK, SPAN]),
    (put([S, 0, "PII_set", 0, "end"], 13), [BIO, MASK, SPAN]),
    (put([S, 0, "PII_set", 0, "begin"], True), [BIO, MASK, SPAN]),
    (put([S, 1, "labelling_seq", 3], "B-NAME"), [BIO]),
    (add([S, 1, "labelling_seq"], "O"), [BIO]),
    (put([S, 1, "PII_set"], [{"id": 0, "begin": 3, "end": 7, "form": "ACME", "label": "WORKPLACE"}]), [BIO, MASK]),
    (drop([E, 0, "mentions"]), ["FINAL_ENTITY_SCHEMA", "FINAL_ISOLATED_ENTITY", MASK, "FINAL_RELATION_ENDPOINT"]),
    (put([E, 3, "entity_id"], "X4"), ["FINAL_ENTITY_ID_TYPE", "FINAL_ISOLATED_ENTITY", "FINAL_ISOLATED_ENTITY", "FINAL_RELATION_ENDPOINT"]),
    (put([E, 2, "entity_type"], "SHOP"), ["FINAL_ENTITY_ID_TYPE", "FINAL_ISOLATED_ENTITY", "FINAL_ISOLATED_ENTITY", "FINAL_RELATION_ENDPOINT"]),
    (add([E], entity("E4", "DEPARTMENT", "sales", ("d_1", 9))), ["FINAL_ENTITY_ID_TYPE", "FINAL_MENTION_OVERLAP"]),
    (put([E, 3, "canonical_form"], " "), ["FINAL_EMPTY_ENTITY"]),
    (put([E, 3, "mentions"], []), ["FINAL_EMPTY_ENTITY"]),
    (put([E, 3, "mentions", 0, "end"], 99), ["FINAL_MENTION_SPAN"]),
    (put([E, 3, "mentions", 0], {"sent_idx": "d_1", "begin": 5, "end": 10, "form": "ME, s"}), ["FINAL_MENTION_OVERLAP"]),
    (drop([R, 1, "relation"]), ["FINAL_ISOLATED_ENTITY", "FINAL_ISOLATED_ENTITY", "FINAL_RELATION_SCHEMA"]),
    (put([R, 1, "privacy_label"], "X"), ["FINAL_ISOLATED_ENTITY", "FINAL_ISOLATED_ENTITY", "FINAL_RELATION_ENDPOINT"]),
    (add([R], relation("E1", "NAME", "E2", "TELEPHONE", "PII")), ["FINAL_DUPLICATE_RELATION"]),
    (drop([R, 1]), ["FINAL_ISOLATED_ENTITY", "FINAL_ISOLATED_ENTITY"]),
    (put([R, 1, "privacy_label"], "PII"), [MASK]),
]


def test_each_rule(spark):
    rows = [(i, json.dumps(broken(change), ensure_ascii=False)) for i, (change, _) in enumerate(CASES)]
    rows += [(1000, None), (1001, "{"), (1002, "[]"), (1003, "")]
    docs = spark.createDataFrame(rows, "doc_id int, json string")
    found = {}
    for r in final.final_issues(docs).collect():
        found.setdefault(r["doc_id"], []).append(r["code"])
    wrong = {i: (sorted(found.get(i, [])), sorted(codes)) for i, (_, codes) in enumerate(CASES) if sorted(found.get(i, [])) != sorted(codes)}
    assert not wrong
    assert all(found[i] == ["FINAL_SCHEMA"] for i in range(1000, 1004))


def test_counts_and_targets(spark):
    docs = spark.createDataFrame([(1, json.dumps(SOUND)), (2, json.dumps(broken(put([R, 1, "privacy_label"], "PII"))))], "doc_id int, json string")
    good, bad = final.final_check(docs).orderBy("doc_id").collect()
    assert (good["passed"], good["n_issues"], good["sentences"], good["entities"], good["relations"], good["pii_mentions"]) == (True, 0, 2, 4, 2, 2)
    assert not bad["passed"]
    assert [tuple(r) for r in final.final_issues(docs).collect()] == [(2, MASK, "d_1")]


def test_no_shuffle_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, json string")
    issues = final.final_issues(docs)
    assert "Exchange" not in issues._jdf.queryExecution().executedPlan().toString()
    assert issues.collect() == []


def test_customers_are_dealt_before_their_documents_are_made(spark):
    """A small table is one file and one task; documents made before the shuffle were all made in it."""
    from sievework.plans import documents as queries

    plan = queries.final_check(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("010-") < plan.index("RepartitionByExpression")
