"""Call limits over logs and streams, commits that crash, and recovery."""

import random

import pytest

from sievework.sources import commits
from sievework.streaming import calls

_LOG = "candidate string, seq long, task string, operation string, outcome string"


def _brute(log, most):
    """Limits as said in words, one call after the other."""
    out = []
    for c in sorted({r[0] for r in log}):
        sent, retried, attempts, state = 0, 0, {}, {}
        for _, seq, task, op, answer in sorted(r for r in log if r[0] == c):
            if op not in state:
                if sum(t == task for t, _ in attempts.values()) >= calls.LIMITS.get(task, 0):
                    out.append((c, seq, "STAGE_CALL_LIMIT"))
                    continue
                attempts[op], state[op] = [task, 0], "pending"
            if state[op] == "done":
                say = "cached"
            elif state[op] == "failed":
                say = "failed"
            elif sent >= most:
                say = "CANDIDATE_CALL_LIMIT"
            elif attempts[op][1] and retried:
                say = "SHARED_RETRY_LIMIT"
            else:
                retried += attempts[op][1] > 0
                attempts[op][1] += 1
                sent += 1
                say = "sent"
                over = retried or sent >= most
                state[op] = {"valid": "done", "bad": "failed", "lost": "pending", "retry": "failed" if over else "pending"}[answer]
            out.append((c, seq, say))
    return sorted(out)


def _log(seed):
    r = random.Random(seed)
    return [(f"c{r.randrange(12)}", i, r.choice([*calls.LIMITS, "other"]), f"op{r.randrange(9)}", r.choice(["valid", "retry", "bad", "lost"])) for i in range(400)]


def test_limits_and_one_shared_retry(spark):
    log = _log(1)
    got = calls.admitted(spark.createDataFrame(log, _LOG).repartition(3), 6)
    want = _brute(log, 6)
    assert sorted((r["candidate"], r["seq"], r["decision"]) for r in got.collect()) == want
    assert {x[2] for x in want} == {"sent", "cached", "failed", "STAGE_CALL_LIMIT", "CANDIDATE_CALL_LIMIT", "SHARED_RETRY_LIMIT"}
    assert calls.admitted(spark.createDataFrame([], _LOG), 6).count() == 0


def test_a_stream_that_stops_goes_on_with_its_counters(spark, tmp_path):
    log = _log(2)
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))

    def run():
        stream = calls.admit(spark.readStream.schema(_LOG).parquet(source), 6)
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()

    for a, z in ((0, 150), (100, 260), (260, 400)):  # the second part brings some calls again
        spark.createDataFrame(log[a:z], _LOG).coalesce(1).write.mode("append").parquet(source)
        run()
    got = sorted((r["candidate"], r["seq"], r["decision"]) for r in spark.read.parquet(target).collect())
    assert got == _brute(log, 6)


def _docs(spark, *rows):
    return spark.createDataFrame([(c, s, f"D{c}", t) for c, s, t in rows], "candidate_id string, slot_id string, document_id string, document string")


def test_commits_crash_and_recover(spark, tmp_path):
    folder = str(tmp_path)
    rows = lambda: sorted(r["candidate_id"] for r in commits.accepted(spark, folder).collect())
    assert commits.recover(spark, folder) == [] and rows() == []
    assert commits.commit(spark, folder, "one", _docs(spark, ("a", "s1", "x"), ("b", "s2", "y"))).count() == 0 and rows() == ["a", "b"]
    commits.commit(spark, folder, "two", _docs(spark, ("c", "s3", "z")), upto="documents")  # no marker: never happened
    assert commits.recover(spark, folder) == [] and rows() == ["a", "b"]
    commits.commit(spark, folder, "two", _docs(spark, ("c", "s3", "z")), upto="audits")
    assert rows() == ["a", "b"] and commits.recover(spark, folder) == ["two"] and rows() == ["a", "b", "c"] and commits.recover(spark, folder) == []
    no = commits.commit(spark, folder, "three", _docs(spark, ("a", "s9", "again"), ("d", "s3", "taken"), ("e", "s5", "v"), ("f", "s5", "w")))
    assert sorted((r["candidate_id"], r["code"], r["target"]) for r in no.collect()) == [("d", "SLOT_COMMIT_CONFLICT", "s3"), ("f", "SLOT_COMMIT_CONFLICT", "s5")]
    assert rows() == ["a", "b", "c", "e"]
    commits.commit(spark, folder, "three", _docs(spark, ("a", "s9", "again"), ("d", "s3", "taken"), ("e", "s5", "v"), ("f", "s5", "w")))  # run again: replaces itself
    assert rows() == ["a", "b", "c", "e"] and commits.recover(spark, folder) == []


@pytest.mark.parametrize(("part", "schema", "row", "code"), [
    ("documents/commit=one", commits.DOCUMENT, ("Da", "changed"), "ACCEPTED_DOCUMENT_HASH"),
    ("audits/commit=two", commits.RECORD, ("z", "s1", "Da", None), "ACCEPTED_DOCUMENT_HASH"),
    ("accepted/commit=two", commits.RECORD, ("z", "s7", "Dz", "0"), "ACCEPTED_AUDIT_MISSING"),
])
def test_ledgers_that_were_tampered_with(spark, tmp_path, part, schema, row, code):
    commits.commit(spark, str(tmp_path), "one", _docs(spark, ("a", "s1", "x")))
    spark.createDataFrame([row], schema).write.mode("overwrite").parquet(f"{tmp_path}/{part}")
    with pytest.raises(commits.LedgerError) as e:
        commits.recover(spark, str(tmp_path))
    assert e.value.code == code


def test_audits_for_a_slot_that_is_taken(spark, tmp_path):
    folder = str(tmp_path)
    commits.commit(spark, folder, "one", _docs(spark, ("b", "s1", "y")), upto="audits")
    commits.commit(spark, folder, "two", _docs(spark, ("a", "s1", "x")))
    with pytest.raises(commits.LedgerError, match="AUDIT_SLOT_CONFLICT: s1"):
        commits.recover(spark, folder)
