import json
import zipfile

from pyspark.sql import functions as F

from sievework.sources import sinks, statistics, tables
from sievework.streaming import ledger as stream


def test_zip_json_and_hash(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("a.json", json.dumps({"x": "한"}, ensure_ascii=False))
        z.writestr("b.txt", "no")
    rows = tables.zip_corpus(spark, str(tmp_path / "c.zip")).collect()
    assert [(r["name"], json.loads(r["text"])) for r in rows] == [("a.json", {"x": "한"})]
    assert len(tables.file_hashes(spark, str(tmp_path / "c.zip")).first()["sha256"]) == 64
    (tmp_path / "p.json").write_text('[{"uuid":"1","ADDRESS":{"sido":"S"}}]')
    assert tables.json_table(spark, str(tmp_path / "p.json")).first()["ADDRESS"]["sido"] == "S"


def test_ledger_append(spark, tmp_path):
    tables.append(spark, str(tmp_path), "slots", spark.createDataFrame([("s1", "D")], "slot_id string, domain string"))
    tables.append(spark, str(tmp_path), "slots", spark.createDataFrame([("s2", "D")], "slot_id string, domain string"))
    got = tables.ledger(spark, str(tmp_path), "slots")
    assert got.count() == 2 and got.where("status is null").count() == 2


def test_reports(spark):
    df = spark.createDataFrame([("a", [1, 2]), ("b", None)], "k string, xs array<int>")
    body = sinks.report_csv(df.orderBy("k"))
    assert body.startswith(b"\xef\xbb\xbfk,xs\r\n") and b'"[1,2]"' in body
    assert sinks.text_table(df.select("k").orderBy("k")) == "k\na\nb"


def test_stream_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([(1, "C1", "running"), (2, "C1", "accepted"), (3, "C2", "running")], "id long, key string, status string")
    rows.write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream.start(events, str(tmp_path / "out"), str(tmp_path / "cp"), ["id"]).awaitTermination()
    stream.idempotent_append(str(tmp_path / "out"), ["id"])(rows, 0)  # a replay
    got = {r["key"]: r["status"] for r in stream.latest_by_key(spark, str(tmp_path / "out"), ["key"], "id").collect()}
    assert got == {"C1": "accepted", "C2": "running"}


def test_windowed_counts(spark):
    e = spark.createDataFrame([("2024-01-01 00:00:10", "a"), ("2024-01-01 00:00:50", "a"), ("2024-01-01 00:01:10", "b")], "s string, k string").select(F.to_timestamp("s").alias("ts"), "k")
    assert sorted(r["n"] for r in stream.windowed_counts(e, "ts", "1 minute", "1 minute", "k").collect()) == [1, 2]


def test_config_paths(tmp_path):
    (tmp_path / "c.json").write_text('{"pool_path":"../pool.zip","reference_dataset":"","seed":3}')
    assert tables.load_config(str(tmp_path / "c.json")) == {"pool_path": str((tmp_path.parent / "pool.zip").resolve()), "reference_dataset": "", "seed": 3}


def test_statistics_export(spark, tmp_path):
    rows = {
        "candidates": [{"candidate_id": "C1", "domain": "D", "status": "accepted", "reasons": "[]", "condition_json": '{"relation_count":3}'}, {"candidate_id": "C2", "domain": "D", "status": "rejected", "reasons": '[{"code":"X"},{"code":"X"}]'}],
        "slots": [{"slot_id": "s1", "domain": "D", "status": "accepted"}, {"slot_id": "s2", "domain": "D", "status": "open"}],
        "stage_attempts": [{"id": 1, "candidate_id": "C1", "stage": 1, "status": "failed", "reasons": '[{"code":"Y"}]'}, {"id": 2, "candidate_id": "C1", "stage": 1, "status": "passed", "reasons": "[]"}],
        "reviews": [{"id": 1, "candidate_id": "C1", "version": 1, "overall": "상"}],
        "api_calls": [{"id": 1, "candidate_id": "C1", "model": "m", "key_slot": "k", "input_tokens": 5, "cached_input_tokens": 1, "output_tokens": 2, "estimated_cost_usd": 0.5}],
        "accepted": [{"candidate_id": "C1", "document_id": "d", "document_sha256": "h", "metrics": '{"entities":{"E1":{"entity_type":"NAME","mentions":2}}}'}],
        "accepted_relations": [{"candidate_id": "C1", "relation_id": "R1", "relation": "r", "privacy_label": "PII", "document_sha256": "h"}],
        "events": [{"id": 1, "candidate_id": "C1", "kind": "other", "payload": "{}"}], "coverage_slots": [{"slot_id": "s2"}],
    }
    for name, values in rows.items():
        kinds = spark.createDataFrame([], tables.LEDGER[name]).schema
        tables.append(spark, str(tmp_path / "l"), name, spark.createDataFrame([tuple(v.get(f.name) for f in kinds) for v in values], kinds))
    statistics.export(spark, str(tmp_path / "l"), str(tmp_path / "o"))
    got = json.loads(spark.read.text(str(tmp_path / "o/summary.json"), wholetext=True).first()["value"])
    assert got["final_rejection_reasons"] == [{"reason": "X", "n_reasons": 2, "n_rows": 1}] and got["usage"][0]["requests"] == 1
    assert got["stages"][0]["attempts"] == 2 and got["stages"][0]["passed"] == 1 and got["accepted_mentions"] == [{"entity_type": "NAME", "mentions": 2, "n_entities": 1}]
    assert {(r["dimension"], r["grade"]): r["n"] for r in got["quality_latest_per_candidate"]}[("overall", statistics.UNGRADED)] == 1
    assert got["by_domain"][0]["supplemental_slots"] == 1 and got["forecast"][0]["remaining_slots"] == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "o/accepted_relations.csv")).first()["document_id"] == "d"
    assert len([p for p in (tmp_path / "o").iterdir() if p.name.endswith(".csv")]) == 13


def test_inspection_of_a_candidate(spark, tmp_path, capsys):
    import json

    from sievework import cli
    from sievework.sources import tables

    folder = str(tmp_path)
    tables.append(spark, folder, "candidates", spark.createDataFrame([("c1", "accepted"), ("c2", "rejected")], "candidate_id string, status string"))
    tables.append(spark, folder, "stage_attempts", spark.createDataFrame([(2, "c1", 4), (1, "c1", 2), (3, "c2", 1)], "id long, candidate_id string, stage int"))
    tables.append(spark, folder, "reviews", spark.createDataFrame([(1, "c1", "상")], "id long, candidate_id string, overall string"))
    tables.append(spark, folder, "events", spark.createDataFrame([(5, "c1", "b"), (4, "c1", "a")], "id long, candidate_id string, kind string"))
    assert cli.main(["inspect", folder, "c1"]) == 0
    found = json.loads(capsys.readouterr().out)
    assert found["candidate"]["status"] == "accepted" and [x["stage"] for x in found["stages"]] == [2, 4] and found["reviews"][0]["overall"] == "상"
    assert [x["kind"] for x in cli.inspected(spark, folder, "c1", "history")] == ["a", "b"]
    assert cli.main(["inspect", folder, "nobody"]) == 1
