"""Folds over plans against the same rules written as loops."""

import random

from sievework.operators import planning

ORGS, LINES = planning.ORGANISATIONS, planning.BRIDGE_TARGETS


def _chosen(wanted, held, pii, non_pii, n, most):
    out = []
    for r in wanted:
        h = held.get(r, set())
        if len(out) < most:
            if non_pii and any(p == "NON_PII" for p, _ in h):
                out.append((r, "NON_PII"))
                non_pii -= 1
            elif pii and any(p == "PII" and (n <= pii or t == "NAME") for p, t in h):
                out.append((r, "PII"))
                pii -= 1
    return out


def test_required_relations(spark):
    r = random.Random(1)
    options = [(s, f"r{k}", p, t) for s in ("x", "y") for k in range(8) for p in ("PII", "NON_PII") for t in ("NAME", "EMAIL") if r.random() < 0.4]
    rows = [(i, r.choice(["x", "y", "z", None]), r.sample([f"r{k}" for k in range(10)], r.randint(0, 8)), r.randint(0, 3), r.randint(0, 2), r.randint(1, 3)) for i in range(300)] + [(300, "x", None, 1, 1, 1)]
    c = spark.createDataFrame(rows, "plan_id long, subtype string, wanted array<string>, pii long, non_pii int, n_parties int")
    got = planning.required_selection(c, spark.createDataFrame(options * 2, "subtype string, relation string, privacy string, target string"), 3)
    assert got.columns == [*c.columns, "chosen"]
    for x in got.collect():
        held = {}
        for s, rel, p, t in options:
            if s == x["subtype"]:
                held.setdefault(rel, set()).add((p, t))
        assert [tuple(y) for y in x["chosen"]] == _chosen(x["wanted"] or [], held, x["pii"], x["non_pii"], x["n_parties"], 3)
    assert planning.coverage_order(spark.createDataFrame([("b", 2), ("a", 2), ("c", 0)], "relation string, n int")).first()["wanted"] == ["c", "a", "b"]


class Failed(Exception):
    pass


def _graph(people, slots, bridges, personal, public, owners, pairs):
    profile = owners is not None or pairs is not None
    order = [i for i, s in enumerate(slots) if s[1] == "PII"] + [i for i, s in enumerate(slots) if s[1] != "PII"] if bridges else list(range(len(slots)))
    edges, covered, orgs, bridged = {}, [], {}, 0
    if not personal or not public:
        raise Failed("SEED_GRAPH_CAPACITY")
    for pos, i in enumerate(order):
        _, privacy, required = slots[i]
        mine = [o for o in (personal if privacy == "PII" else public) if required is None or o[1] == required]
        left = [p for p, _ in people if f"NAME:{p}" not in covered]
        if profile and required is None:
            later, used = {slots[k][2] for k in order[pos + 1 :]}, {e[1] for e in edges.values()}
            mine.sort(key=lambda o: (o[1] in later, o[1] in used))
        if privacy == "PII" and len(left) > 1 and sum(slots[k][1] == "PII" for k in order[pos:]) <= len(left):
            mine = [o for o in mine if o[2] == "NAME"] or mine
        elif bridges and required is None:
            if privacy == "PII" and not orgs:
                mine.sort(key=lambda o: o[2] not in ORGS)
            elif privacy != "PII" and bridged < bridges:
                mine.sort(key=lambda o: not (o[0] in orgs.values() and o[2] in LINES))
        for source_type, relation, target_type in mine:
            first = left[0] if left else people[0][0] if profile else people[i % len(people)][0]
            if privacy == "PII" and target_type == "NAME":
                pair = (pairs or {}).get(relation)
                if pair:
                    roles = {role: p for p, role in people}
                    if not set(pair) <= set(roles):
                        continue
                    source, target = (f"NAME:{roles[x]}" for x in pair)
                else:
                    rest = [p for p in left if p != first] + [p for p, _ in people if p != first]
                    if not rest:
                        continue
                    source, target = f"NAME:{first}", f"NAME:{rest[0]}"
            elif privacy == "PII":
                own = next((p for p, role in people if profile and role == (owners or {}).get(relation)), first)
                source, target = f"NAME:{own}", f"{target_type}:{own}"
            else:
                org = next((o for o, t in orgs.items() if t == source_type), None) if bridged < bridges and target_type in LINES else None
                office = "office_main" if profile else f"office_{i % 2 + 1}"
                source = org or f"{source_type}:{office}"
                target = f"{target_type}:org_{org}" if org else f"{target_type}:" + (f"office_target_{i + 1}" if target_type == source_type else office)
            taken = set(edges.values())
            if source != target and (source, relation, target) not in taken and not (profile and (target, relation, source) in taken):
                break
        else:
            raise Failed("SEED_GRAPH_CAPACITY")
        edges[i] = (source, relation, target)
        if privacy == "PII" and target.split(":")[0] in ORGS:
            orgs.setdefault(target, target.split(":")[0])
        bridged += privacy != "PII" and source in orgs
        covered += [e for e in (source, target) if e in {f"NAME:{p}" for p, _ in people} and e not in covered]
    if len(covered) != len(people):
        raise Failed("SEED_PERSON_CAPACITY")
    return [(slots[i][0], slots[i][1], *edges[i]) for i in range(len(slots))]


_SHAPE = """plan_id long, subtype string, people array<struct<person_id:string,role:string>>, slots array<struct<slot_id:string,privacy:string,required:string>>, bridges int,
    owners map<string,string>, pairs map<string,struct<a:string,b:string>>"""


def test_seed_graphs(spark):
    r = random.Random(2)
    types = ["NAME", "EMAIL", "ADDRESS", "WORKPLACE", "AGE", "SCHOOL"]
    options = {("x", "PII", "NAME", f"r{r.randrange(5)}", r.choice(types)) for _ in range(14)} | {("y", "PII", "NAME", f"r{k % 3}", t) for k, t in enumerate(("NAME", "EMAIL", "WORKPLACE", "NAME"))}
    options |= {("x", "NON_PII", r.choice(ORGS), f"r{r.randrange(5)}", r.choice([*ORGS, *LINES])) for _ in range(14)} | {("y", "NON_PII", "WORKPLACE", "r1", "EMAIL"), ("y", "NON_PII", "WORKPLACE", "r0", "WORKPLACE")} | {("z", "PII", "NAME", "r0", "AGE")}
    options |= {("only", "PII", "NAME", "r0", "NAME"), ("only", "NON_PII", "SCHOOL", "r0", "SCHOOL"), ("lone", "PII", "NAME", "r0", "AGE"), ("lone", "NON_PII", "SCHOOL", "r0", "SCHOOL")}
    rows = []
    for i in range(400):
        people = [(f"P{k + 1}", r.choice(["applicant", "doctor", "seller"])) for k in range(r.randint(1, 3))]
        slots = [(f"R{k + 1}", r.choice(["PII", "PII", "NON_PII"]), r.choice([None, None, None, f"r{r.randrange(5)}"])) for k in range(r.randint(0, 6))]
        profile = r.random() < 0.5
        rows.append((i, r.choice(["x", "x", "x", "y", "z", "only"]), people, slots, r.randint(0, 2), {"r0": "doctor", "r2": "seller"} if profile else None, {"r1": ("doctor", "seller")} if profile else None))
    rows += [(900, "lone", [("P1", "a"), ("P2", "b")], [("R1", "PII", None), ("R2", "NON_PII", None)], 0, None, None), (901, None, [("P1", "a")], [], 1, None, None)]
    c = planning.with_options(spark.createDataFrame(rows, _SHAPE), spark.createDataFrame(sorted(options), "subtype string, privacy string, source string, relation string, target string"), "seed")
    c = c.cache()
    found = {x["plan_id"]: x for x in planning.seed_graph(c).collect()}
    assert {x["plan_id"]: x for x in planning.seed_graph(c.repartition(7)).collect()} == found  # where a plan is doesn't matter
    issues = {}
    for x in c.collect():
        pairs = {k: tuple(v) for k, v in x["pairs"].items()} if x["pairs"] is not None else None
        try:
            want, issue = _graph([tuple(p) for p in x["people"]], [tuple(s) for s in x["slots"]], x["bridges"], [tuple(o) for o in x["options_pii"]], [tuple(o) for o in x["options_non"]], x["owners"], pairs), None
        except Failed as e:
            want, issue = [], str(e)
        issues[issue] = issues.get(issue, 0) + 1
        got = found[x["plan_id"]]
        assert ([tuple(e) for e in got["edges"]], got["issue"]) == (want, issue), x
    assert found[900]["issue"] == "SEED_PERSON_CAPACITY" and found[901]["issue"] == "SEED_GRAPH_CAPACITY" and min(issues.values()) > 5, issues
    assert sum("org_" in e["target"] for x in found.values() for e in x["edges"]) > 5
    c.unpersist()


def test_plans_are_dealt_before_their_options_are_added(spark):
    """Options are many times a plan's size: dealt with them, a shuffle would hold the catalogue once a plan."""
    from sievework.plans import planning as queries

    plan = queries.seed_graphs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sha2(") < plan.index("RepartitionByExpression")


def test_only_options_that_a_slot_may_ask_for_are_hashed(spark):
    options = spark.createDataFrame([("x", p, "NAME", f"r{k}", t) for p in ("PII", "NON_PII") for k in range(3) for t in ("AGE", "EMAIL")], "subtype string, privacy string, source string, relation string, target string")
    slots = {1: [("R1", "PII", "r1")], 2: [("R1", "PII", "r1"), ("R2", "PII", None)], 3: [("R1", "NON_PII", "r2"), ("R2", "NON_PII", "r0"), ("R3", "PII", None)], 4: [("R1", "NON_PII", "r9")]}
    rows = [(p, "x", [("P1", "a")], s, 0, None, None) for p, s in slots.items()]
    conditions = spark.createDataFrame(rows, _SHAPE)
    got = {r["plan_id"]: r for r in planning.with_options(conditions, options, "s").collect()}
    whole = {r["plan_id"]: r for r in planning.with_options(conditions.drop("slots"), options, "s").collect()}
    of = lambda r, c, some: [o for o in r[c] if o["relation"] in some]
    assert got[1]["options_pii"] == of(whole[1], "options_pii", {"r1"}) and len(got[1]["options_non"]) == 6
    assert got[2]["options_pii"] == whole[2]["options_pii"] and got[3]["options_pii"] == whole[3]["options_pii"]
    assert got[3]["options_non"] == of(whole[3], "options_non", {"r2", "r0"}) and got[4]["options_non"] == []
