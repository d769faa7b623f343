"""Calls to providers under limits, as keyed state: counters per candidate and task that a stream keeps, and the same decisions over a whole log.

A candidate's operations are logical calls; each may be sent again if its answer was no use, but all operations of a candidate share one such retry. What was sent counts before the answer is known, so a call that a crash cut off
has been paid for. Completed operations answer again without a call, and failed ones fail again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Logical calls of a candidate by task.
LIMITS = {"plan": 1, "draft": 1, "repair": 2, "expand": 4, "review": 1}
RETRIES = 1
#: Of an answer: valid, retry (worth another try), bad (not), or lost (none came).
_OUT = "candidate string, seq long, task string, operation string, decision string, requests int, retries int"
_STATE = "requests int, retries int, last long, operations array<struct<operation:string,task:string,attempts:int,status:string>>"


class Calls:
    """What a candidate has used."""

    def __init__(self, requests: int = 0, retries: int = 0, last: int = -1, operations: list | None = None):
        self.requests, self.retries, self.last = requests, retries, last
        self.operations = {o[0]: [o[1], o[2], o[3]] for o in operations or []}

    def decide(self, task: str, operation: str, outcome: str, most: int) -> str:
        """sent, cached, failed, or the code of the limit that stopped it."""
        op = self.operations.get(operation)
        if op is None:
            if sum(t == task for t, _, _ in self.operations.values()) >= LIMITS.get(task, 0):
                return "STAGE_CALL_LIMIT"
            op = self.operations[operation] = [task, 0, "pending"]
        if op[2] != "pending":
            return "cached" if op[2] == "completed" else "failed"
        if self.requests >= most:
            return "CANDIDATE_CALL_LIMIT"
        if op[1]:
            if self.retries >= RETRIES:
                return "SHARED_RETRY_LIMIT"
            self.retries += 1
        op[1] += 1
        self.requests += 1
        if outcome == "valid":
            op[2] = "completed"
        elif outcome == "bad" or (outcome == "retry" and (self.retries >= RETRIES or self.requests >= most)):
            op[2] = "failed"
        return "sent"

    def row(self) -> tuple:
        return self.requests, self.retries, self.last, [(k, *v) for k, v in sorted(self.operations.items())]


def _decided(calls: Calls, rows: pd.DataFrame, most: int) -> pd.DataFrame:
    """Rows of one candidate in the order of seq; what was decided before (seq up to the last one) is not decided again."""
    out = []
    for r in rows.sort_values("seq", kind="stable").itertuples(index=False):
        if r.seq <= calls.last:
            continue
        calls.last = int(r.seq)
        out.append((r.candidate, r.seq, r.task, r.operation, calls.decide(r.task, r.operation, r.outcome, most), calls.requests, calls.retries))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")])


def _plain(log: DataFrame) -> DataFrame:
    return log.select(F.col("candidate").cast("string"), F.col("seq").cast("long"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("task", "operation", "outcome")))


def admitted(log: DataFrame, most: int) -> DataFrame:
    """A decision for each call of a log (candidate, seq, task, operation, outcome), `most` requests a candidate. seq is unique within a candidate; of equal ones the first counts. A task without a limit may not be called."""
    return _plain(log).groupBy("candidate").applyInPandas(lambda rows: _decided(Calls(), rows, most), _OUT)


def admit(stream: DataFrame, most: int) -> DataFrame:
    """The same for a stream: counters are state of the query, kept in its checkpoint, so a restart goes on where it was, and calls that come twice are decided once. Calls of a candidate come in the order of seq over batches."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        calls = Calls(*state.get) if state.exists else Calls()
        rows = pd.concat(list(batches))
        out = _decided(calls, rows, most)
        state.update(calls.row())
        yield out

    return _plain(stream).groupBy("candidate").applyInPandasWithState(step, _OUT, _STATE, "append", "NoTimeout")
