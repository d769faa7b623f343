"""Patches of drafts, and known values in texts."""

import random
import re

from sievework.operators import drafts, revisions

_DRAFT = "doc_id string, draft_version int, segments array<struct<sentence_id:string,text:string>>, refs array<struct<ref_id:string,value:string>>, evidence array<struct<relation_id:string,ids:array<string>>>"
_PATCH = "doc_id string, base_version int, length_only boolean, " + ", ".join(f"{c} {t}" for c, t in revisions.PATCH.items())
_S = [("S1", "one <REF:C1>"), ("S2", "two"), ("S3", "three <REF:C2>")]


def _revise(spark, drafts_, patches):
    return {x["doc_id"]: x for x in revisions.revised(spark.createDataFrame(drafts_, _DRAFT), spark.createDataFrame(patches, _PATCH)).collect()}


def test_all_parts_change_or_none(spark):
    refs, evidence = [("C1", "a"), ("C2", "b")], [("R1", ["S1"]), ("R2", ["S2"])]
    d = [(x, 4, _S, refs, evidence) for x in ("good", "stale", "twice", "gap", "none", "loose")] + [("empty", 0, None, None, None)]
    ins = [("", [("S9", "start <REF:C3>")]), ("S1", [("S10", "x"), ("S11", "y")]), ("S1", [("S12", "z")])]
    p = [
        ("good", 4, False, [("S3", "THREE")], ins, [("C3", "new"), ("C1", "A")], [("R2", ["S2", "S10"]), ("R7", ["S9"])], [["S3", "S1"]]),
        ("stale", 3, False, [("S3", "THREE")], ins, [("C3", "new")], None, None),
        ("twice", 4, None, [("S1", "q"), ("S1", "r"), ("S8", "s")], [("S7", [("S2", "t")]), ("S2", [("S20", "u"), ("S20", "v")])], [("C1", "1"), ("C1", "2")], [("R1", []), ("R1", [])], None),
        ("gap", 4, False, None, ins, None, None, [["S2", "S1", "S99"]]),
        ("loose", 4, False, None, [("S1", [("S5", "w")])], None, None, [["S1", "S3"]]),
        ("empty", 0, False, None, [("", [("S1", "first")])], None, None, None),
    ]
    got = _revise(spark, d, p)
    x = got["good"]
    assert x["committed"] and x["draft_version"] == 5 and x["refusals"] == []
    assert [tuple(s) for s in x["segments"]] == [("S9", "start <REF:C3>"), ("S1", "one <REF:C1>"), ("S10", "x"), ("S11", "y"), ("S12", "z"), ("S2", "two"), ("S3", "THREE")]
    assert [tuple(r) for r in x["refs"]] == [("C1", "A"), ("C3", "new")]
    assert [tuple(r) for r in x["evidence"]] == [("R1", ["S1"]), ("R2", ["S2", "S10"]), ("R7", ["S9"])]
    codes = lambda k: sorted((r["code"], r["target"]) for r in got[k]["refusals"])
    assert codes("stale") == [("PATCH_BASE_VERSION", "3")] and codes("gap") == [("PATCH_PROTECTED_GAP", "S1")]
    assert codes("twice") == [("PATCH_ANCHOR", "S7"), ("PATCH_DUPLICATE_UPDATE", "C1"), ("PATCH_DUPLICATE_UPDATE", "R1"), ("PATCH_NEW_ID", "S2"), ("PATCH_NEW_ID", "S20"), ("PATCH_REPLACEMENT_ID", "S1"), ("PATCH_REPLACEMENT_ID", "S8")]
    for k in ("stale", "twice", "gap", "none"):
        y = got[k]
        assert (y["draft_version"], [tuple(s) for s in y["segments"]], [tuple(r) for r in y["refs"]], [tuple(r) for r in y["evidence"]]) == (4, _S, refs, evidence)
        assert y["committed"] is (None if k == "none" else False)
    assert got["loose"]["committed"] and got["empty"]["committed"] and [tuple(s) for s in got["empty"]["segments"]] == [("S1", "first")]


def test_patches_that_only_add_length(spark):
    d = [(x, 1, _S, [("C1", "a"), ("C9", "kept")], []) for x in "abcd"]
    new = lambda *texts: [("S3", [(f"S{20 + i}", t) for i, t in enumerate(texts)])]
    p = [("a", 1, True, [("S1", "q")], new("fresh"), None, None, None), ("b", 1, True, None, [("S3", [])], None, None, None), ("c", 1, True, None, new("t w o", "more", "mo re"), None, None, None), ("d", 1, True, None, new("fresh", "more"), None, None, None)]
    got = _revise(spark, d, p)
    assert {k: [r["code"] for r in got[k]["refusals"]] for k in "abcd"} == {"a": ["LENGTH_REWRITE_FORBIDDEN"], "b": ["LENGTH_ADDITION_EMPTY"], "c": ["LENGTH_ADDITION_REPEATED", "LENGTH_ADDITION_REPEATED"], "d": []}
    assert [r["ref_id"] for r in got["d"]["refs"]] == ["C1", "C9"]


def test_known_values_become_tokens(spark):
    r = random.Random(3)
    surfaces = [(p, "".join(r.choice("ab<>é ") for _ in range(r.randint(1, 4))), f"<NAME:E{k}>") for p in range(6) for k in range(40)] + [(0, "", "<X:E1>"), (7, "Kim", "<NAME:E1>")]
    texts = [(i, i % 8, "".join(r.choice("aab<>é ") for _ in range(r.randint(0, 60)))) for i in range(400)] + [(900, 7, None), (901, 7, "Kim met <Kim> and Kimberly")]
    got = {x["id"]: x["text"] for x in drafts.with_tokens(spark.createDataFrame(texts, "id long, plan_id long, text string").repartition(3), spark.createDataFrame(surfaces + surfaces[:9], "plan_id long, surface string, token string")).collect()}
    for i, p, t in texts:
        tags = {}
        for q, s, token in surfaces:
            if q == p and s:
                tags.setdefault(s, set()).add(token)
        sole = {s: next(iter(x)) for s, x in tags.items() if len(x) == 1}
        pattern = "<[^<>]+>|" + "|".join(re.escape(s) for s in sorted(sole, key=len, reverse=True))
        assert got[i] == (re.sub(pattern, lambda m, sole=sole: sole.get(m[0], m[0]), t) if t is not None and sole else t), (t, sole)


def test_ten_thousand_values_take_linear_time(spark):
    import time

    values = [(1, f"value {i} of many", f"<NAME:E{i}>") for i in range(10_000)]
    text = " and ".join(f"value {i} of many" for i in range(0, 10_000, 3)) * 3
    began = time.time()
    got = drafts.with_tokens(spark.createDataFrame([(i, 1, text) for i in range(20)], "id long, plan_id long, text string"), spark.createDataFrame(values, "plan_id long, surface string, token string")).collect()
    assert len(got) == 20 and "value" not in got[0]["text"].replace("many", "") and time.time() - began < 30
