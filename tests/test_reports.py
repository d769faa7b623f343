"""Hand-computed cases of the reports."""

import math

from pyspark.sql import functions as F

from sievework.functions.stats import expected_more, expected_range, rate, wilson
from sievework.operators import audits, funnel, ledger


def test_forecast_golden(spark):
    candidates = spark.createDataFrame([("C1", "running"), ("C2", "accepted"), ("C3", "rejected"), ("C4", "error")], "candidate_id string, status string")
    slots = spark.createDataFrame([("accepted",), ("pending",), ("pending",), ("pending",)], "status string")
    r = funnel.forecast(candidates, slots).first()
    assert (r["accepted"], r["rejected"], r["remaining_slots"], r["acceptance_rate"], r["expected_additional"]) == (1, 1, 3, 0.5, 6)
    assert r["expected_range"] == [4, 32]


def test_stage_report_golden(spark):
    attempts = spark.createDataFrame([(1, "C1", 5, "repair_needed"), (2, "C1", 5, "passed"), (3, "C3", 5, "failed")], "id long, candidate_id string, stage int, status string")
    r = funnel.stage_funnel(attempts, "stage", "candidate_id", ("id",), F.col("status"), F.col("status").isin("passed", "cached"), ~F.col("status").isin("running", "interrupted")).first()
    assert (r["attempts"], r["unique_keys"], r["passed"], r["completed"], r["pass_rate"]) == (3, 2, 1, 2, 0.5)
    candidates = spark.createDataFrame([("C1", "accepted"), ("C3", "rejected")], "candidate_id string, status string")
    f = funnel.stage_forecast(attempts, candidates, F.lit(3)).first()
    assert (f["more_entries"], f["more_passes"], f["more_nonpasses"]) == (3.0, 1.5, 1.5)


def test_no_data(spark):
    none = spark.createDataFrame([], "status string")
    r = funnel.forecast(none, none).first()
    assert r["acceptance_rate"] is None and r["expected_additional"] is None and r["expected_range"] is None
    empty = spark.createDataFrame([], "candidate_id string, id long, s string")
    e = funnel.funnel(empty, "candidate_id", ("id",), F.col("s") == "p", F.col("s") != "r").first()
    assert (e["unique_keys"], e["rate"], e["lo"], e["expected_more"]) == (0, None, None, None)


def test_reason_rows_and_keys(spark):
    r = funnel.row_reasons(spark.createDataFrame([(["X", "X"],)], "codes array<string>"), "codes").first()
    assert (r["n_reasons"], r["n_rows"]) == (2, 1)


def test_wilson_against_formula(spark):
    rows = [(s, n) for n in range(5) for s in range(n + 1)]
    low, high = wilson(F.col("s"), F.col("n"))
    for r in spark.createDataFrame(rows, "s int, n int").select("s", "n", low.alias("lo"), high.alias("hi")).collect():
        if not r["n"]:
            assert r["lo"] is None and r["hi"] is None
            continue
        p, n, z = r["s"] / r["n"], r["n"], 1.96
        mid, half = (p + z * z / (2 * n)) / (1 + z * z / n), z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
        assert math.isclose(r["lo"], max(0, mid - half), abs_tol=1e-12) and math.isclose(r["hi"], min(1, mid + half), abs_tol=1e-12)


def test_rate_rules(spark):
    r = spark.range(1).select(rate(F.lit(1), F.lit(0)).alias("a"), expected_more(F.lit(3), F.lit(0.0)).alias("b"), expected_range(F.lit(3), F.lit(0.0), F.lit(0.5)).alias("c")).first()
    assert tuple(r) == (None, None, None)


def test_selection_audit_golden(spark):
    candidates = spark.createDataFrame([("C1", "accepted"), ("C2", "rejected"), ("C3", "rejected")], "candidate_id string, status string")
    reviews = spark.createDataFrame(
        [(1, "C1", 1, 1), (2, "C1", 2, 1), (3, "C2", 1, 1), (4, "C2", 2, 1), (5, "C3", 1, 1), (6, "C3", 2, 0)], "id long, candidate_id string, version int, response_valid int"
    )
    relations = spark.createDataFrame(
        [("C1", 1, 1, "AMBIGUOUS", "NON_PII", "nonadjacent", False), ("C1", 2, 1, "NON_PII", "NON_PII", "nonadjacent", True), ("C2", 1, 1, "AMBIGUOUS", "PII", "single", False), ("C2", 2, 1, "AMBIGUOUS", "PII", "single", False), ("C3", 1, 1, "PII", "PII", "single", True)],
        "candidate_id string, review_version int, response_valid int, observed_privacy string, planned_privacy string, mode string, confirmed boolean",
    )
    r = audits.selection_audit(candidates, reviews, relations).first()
    assert (r["reviewed"], r["valid_latest"], r["invalid_latest"], r["latest_ambiguous"], r["ambiguity_rate"], r["ever_ambiguous"]) == (3, 2, 1, 1, 0.5, 2)
    assert (r["ever_ambiguous_accepted"], r["ever_ambiguous_rejected"]) == (1, 1)
    counts = audits.latest_judgements(candidates, reviews, relations).collect()
    assert sorted(tuple(x) for x in counts) == [("accepted", "nonadjacent", "NON_PII", 1), ("rejected", "single", "AMBIGUOUS", 1)]
    now = relations.where("candidate_id = 'C1' and review_version = 2")
    assert [tuple(x) for x in audits.confirmed_modes(now, candidates).collect()] == [("nonadjacent", 1)]


def test_repair_audit(spark):
    payload = '{"structural_targets_satisfied":true,"all_code_checks_passed":false,"no_effective_progress":false,"length_only_progress":true,"remaining_missing_entities":["E1","E2"],"remaining_invalid_relation_ids":[]}'
    events = spark.createDataFrame([(1, "repair_evaluated", payload), (2, "other", "{}")], "id long, kind string, payload string")
    r = audits.repair_audit(events).first()
    assert tuple(r) == (1, 1, 0, 0, 1, 2, 0)
    assert audits.repair_audit(events.where("id = 2")).first()["remaining_missing_entities"] == 0


def test_ledger(spark):
    slots = spark.createDataFrame([("a", "D", "accepted"), ("b", "D", "pending"), ("c", "E", "accepted")], "slot_id string, domain string, status string")
    extra = spark.createDataFrame([("b",)], "slot_id string")
    candidates = spark.createDataFrame([("D", "accepted"), ("D", "rejected"), ("D", "error")], "domain string, status string")
    rows = {r["domain"]: r for r in ledger.domain_rollup(slots, candidates, extra).collect()}
    assert (rows["D"]["base_slots"], rows["D"]["supplemental_slots"], rows["D"]["remaining_slots"], rows["D"]["acceptance_rate"]) == (1, 1, 1, 0.5)
    assert rows["E"]["acceptance_rate"] is None and rows["E"]["accepted"] == 0
    done = {r["domain"]: r["complete"] for r in ledger.completion(slots, ["domain"], F.col("status") == "accepted").collect()}
    assert done == {"D": False, "E": True}
    assert [r["slot_id"] for r in ledger.base_slots(slots, extra, "slot_id").orderBy("slot_id").collect()] == ["a", "c"]


def test_with_offsets_and_thirds(spark):
    s = spark.createDataFrame([("d", 0, "abc"), ("d", 1, "defg"), ("d", 2, "hi")], "doc string, pos int, text string")
    assert [r["start"] for r in audits.with_offsets(s, "doc", "pos", "text").orderBy("pos").collect()] == [0, 3, 7]
    m = spark.createDataFrame([("d", 0), ("d", 3), ("d", 8)], "doc string, at int")
    assert {r["third"]: r["n_mentions"] for r in audits.thirds(m, "doc", F.col("at"), F.lit(9)).collect()} == {0: 1, 1: 1, 2: 1}
