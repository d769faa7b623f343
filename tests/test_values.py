"""Choosing values in rounds against one row after the other."""

import hashlib
import random

import pytest

from pyspark.sql import functions as F

from sievework.operators import values
from sievework.operators.sampling import UNIQUE

TYPES = ["NAME", "EMAIL", "AGE", "WORKPLACE", "POSITION"]


def _brute(groups, pool, allowed, seed):
    ordered = sorted((hashlib.sha256(f"{seed}:{r['uuid']}".encode()).hexdigest(), r["uuid"], r) for r in pool)
    size = 1 << max(0, (len(pool) - 1).bit_length())
    plans, chosen, failed = {}, [], []
    for p, g, e, t in sorted(set(groups)):
        plans.setdefault(p, {}).setdefault(g, []).append((e, t))
    for p, own in plans.items():
        used = set()
        for g, ents in own.items():
            h = hashlib.sha256(f"{seed}:{p}:{g}".encode()).hexdigest()
            start, stride = int(h[:15], 16), int(h[16:21], 16) | 1
            for j in range(size if pool else 0):
                n = (start + j * stride) % size
                if n >= len(ordered):
                    continue
                r = ordered[n][2]
                v = [(t, (r[t] or "").strip()) for _, t in ents]
                form = [(t, x.lower() if t == "EMAIL" else x) for t, x in v]
                if all(x and x.lower() not in ("na", "none") and not (t == "AGE" and not x.isdigit()) and not (t == "EMAIL" and "@" not in x) for t, x in v) and all(str(r[f]) in ok for f, ok in allowed.get((p, g), [])) and not any(x in used for x in form if x[0] in UNIQUE):
                    chosen += [(p, g, e, t, x, y, r["uuid"]) for (e, t), (_, x), (_, y) in zip(ents, v, form, strict=True)]
                    used |= set(form)
                    break
            else:
                failed.append((p, "POOL_NO_FEASIBLE_ROW", str(g)))
                break
    return chosen, failed


@pytest.mark.parametrize("n_pool", [0, 1, 50, 20_000])
def test_values_in_rounds(spark, n_pool):
    r = random.Random(n_pool)
    pool = [
        {"uuid": f"u{i}", "NAME": r.choice([None, "na", f"Name {'abcdefgh'[i % 8]}{'xyz'[i % 3]}"]), "EMAIL": r.choice([f"A{i}@b.org", f"a{i // 2}@B.org", "bad"]), "AGE": r.choice(["7", "x", None]), "WORKPLACE": f"Firm {'abcd'[i % 4]}", "POSITION": r.choice(["  clerk ", None]) if i % 97 == 0 else None, "occupation": str(i % 3)}
        for i in range(n_pool)
    ]
    groups, allowed = [], {}
    for p in range(60):
        for g in range(r.randint(1, 7)):
            groups += [(p, g, f"E{g}{k}", t) for k, t in enumerate(r.sample(TYPES[:4] + (["POSITION"] if p % 5 == 0 else []), r.randint(1, 3)))]
            if r.random() < 0.2:
                allowed[p, g] = [("occupation", ["0", "2"])]
    df = spark.createDataFrame(groups + groups[:3], "plan_id long, value_group int, entity_id string, entity_type string").repartition(3)
    table = spark.createDataFrame([tuple(x.values()) for x in pool], ", ".join(f"{c} string" for c in ["uuid", *TYPES, "occupation"])).repartition(5)
    may = spark.createDataFrame([(p, g, f, ok) for (p, g), x in allowed.items() for f, ok in x], "plan_id long, value_group int, field string, allowed array<string>")
    want, failed = _brute(groups, pool, allowed, "s")
    got, issues = values.select_values(df, table, "s", types=TYPES, allowed=may)
    assert got.columns == ["plan_id", "value_group", "entity_id", "entity_type", "value", "canonical_form", "source"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sorted(map(tuple, issues.collect())) == sorted(failed)
    assert len(failed) > 2 and (n_pool < 50 or len(want) > 100)


def test_entities_that_must_differ(spark):
    groups = spark.createDataFrame([(1, 1, "E1", "AGE"), (1, 2, "E2", "AGE"), (2, 1, "E1", "NAME"), (2, 2, "E2", "NAME")], "plan_id long, value_group int, entity_id string, entity_type string")
    pool = spark.createDataFrame([("a", "7", "Ann"), ("b", "7", "Bob")], "uuid string, AGE string, NAME string")
    distinct = spark.createDataFrame([(1, "C1", ["E1", "E2"]), (2, "C2", ["E1", "E2", "E1"])], "plan_id long, constraint_id string, entity_ids array<string>")
    got, issues = values.select_values(groups, pool, "s", types=["AGE", "NAME"], distinct=distinct)
    assert got.count() == 4 and [tuple(x) for x in issues.collect()] == [(1, "POOL_DISTINCT_VALUE", "C1")]
    empty, none = values.select_values(groups.where("false"), pool, "s", types=["AGE"])
    assert empty.count() == none.count() == 0


def test_exploded_rows_are_not_broadcast(spark):
    groups = spark.createDataFrame([(p, g, f"E{g}", "NAME") for p in range(50) for g in range(3)], "plan_id long, value_group int, entity_id string, entity_type string")
    pool = values.usable(spark.createDataFrame([(str(i), "Ann") for i in range(40)], "uuid string, NAME string"), ["NAME"], [])
    state = values.written(values._asked(groups, None, "s").withColumn("got", F.lit(None).cast("array<string>")))
    plan = values._choose(state, values.written(values.numbered(pool, "s")), 40)._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and plan.count("BroadcastExchange") == 1 and "SortMergeJoin" in plan


def test_a_group_whose_values_are_all_taken_asks_for_no_second_batch(spark, monkeypatch):
    pool = spark.createDataFrame([(f"u{i}", f"Firm {'ab'[i % 2]}", "Name " + "".join("abcdefghij"[int(c)] for c in str(i)), None) for i in range(5000)], "uuid string, WORKPLACE string, NAME string, EMAIL string")
    rows = [(1, g, f"E{g}", "WORKPLACE") for g in range(4)] + [(2, 0, "E0", "EMAIL"), (2, 1, "E1", "NAME")] + [(3, g, f"E{g}{t}", t) for g in range(3) for t in ("NAME", "WORKPLACE")]
    groups = spark.createDataFrame(rows, "plan_id long, value_group int, entity_id string, entity_type string")
    rounds, choose = [], values._choose
    monkeypatch.setattr(values, "_choose", lambda *a: rounds.append(1) or choose(*a))
    got, issues = values.select_values(groups, pool, "s", types=["WORKPLACE", "NAME", "EMAIL"])
    assert sorted(map(tuple, issues.collect())) == [(p, "POOL_NO_FEASIBLE_ROW", g) for p, g in ((1, "2"), (2, "0"), (3, "2"))]
    assert {(r["plan_id"], r["value_group"]) for r in got.collect()} == {(1, 0), (1, 1), (3, 0), (3, 1)} and len(rounds) <= 2
