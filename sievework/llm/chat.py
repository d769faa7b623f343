"""Chat formatting: raw transcripts become turns with roles, by a hidden Markov model over the lines.

The states are the first and the further lines of a system, a user and an assistant turn. A line is seen as a speaker marker (which role its
word stands for, or which of the transcript's other names), whether a blank line stands before it, its length and its last character. The Viterbi path
gives the role of each line; a turn begins wherever the path enters a first line, and its marker is cut off. Turns are rendered in one canonical form.
Transition and emission probabilities are counted on a bounded sample of transcripts whose turns are known.

Defined cases: a null or empty transcript, or one of blank lines only, has no turns. The path is one over the whole transcript, however long. Blank lines within a turn stay as they are, those at the ends
of its text go. Ties go to the earlier state. Equal turns of one conversation and number count once in `as_transcripts`, which writes a conversation of more than `chunk_turns` turn numbers as several transcripts, each with turns of its own; turns without a number
come first, null texts are empty turns and leave no line. Input columns named like the outputs are replaced, as only the keys and the text are read.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import materialise, tidy, unit_hash

ROLES = ("system", "user", "assistant")
#: Words that name a role before a colon or in brackets.
SPEAKERS = {
    "system": 0, "context": 0, "instruction": 0, "instructions": 0, "note": 0,
    "user": 1, "human": 1, "q": 1, "question": 1, "me": 1, "customer": 1, "prompt": 1,
    "assistant": 2, "ai": 2, "bot": 2, "a": 2, "answer": 2, "model": 2, "agent": 2, "response": 2,
}
_MARKER = re.compile(r"\s*(?:#{1,6}\s*|\*\*|\[|<\|?)?([A-Za-z][A-Za-z_]{0,19})(?:\s*\d{1,3})?(?:(?:\s*:)?\*\*|\]|\|?>)?\s*(?::\s*|(?<=[>\]*])\s*$|$)")
_HEAD = re.compile(r"\s*(?:#{1,6}\s*\S|\*\*|\[|<)")
_KINDS = 7  # no marker; system, user, assistant; first and later other names; no marker, but other lines of the transcript have one
_LENGTHS = (20, 60, 120, 240)
_SIZES = (2 * _KINDS, len(_LENGTHS) + 1, 3)  # values of each feature: kind and whether a blank line stands before it, length, last character
#: Notations of as_transcripts: what stands before the text of a system, user and assistant turn.
NOTATIONS = (
    ("System: ", "User: ", "Assistant: "),
    ("Context: ", "Human: ", "AI: "),
    ("### System\n", "### User\n", "### Assistant\n"),
    ("Note: ", "Q: ", "A: "),
    ("<|system|>\n", "<|user|>\n", "<|assistant|>\n"),
    ("\n", "\n", "\n"),
)


@dataclass
class Model:
    """Log probabilities of the first state, of the next state, and of each feature's value by state; state 2 r begins a turn of role r, 2 r + 1 goes on."""

    start: np.ndarray
    move: np.ndarray
    emit: list[np.ndarray]


def marker(line: str) -> tuple[str, int] | None:
    """The lower-case word of a speaker marker and where the text after it begins."""
    m = _MARKER.match(line)
    if not m or (m.end() == len(line) and ":" not in m[0] and not _HEAD.match(line)):
        return None
    word = m[1].lower()
    return (word, m.end()) if word in SPEAKERS or (m[1][0].isupper() and ":" in m[0]) else None


def observe(text: str | None) -> tuple[list[str], np.ndarray, np.ndarray, list[int]]:
    """All lines, the numbers of those that aren't blank, their features, and where the text after each one's marker begins."""
    lines, at, rows, cuts, names = (text or "").split("\n"), [], [], [], {}
    blank = 0
    for i, line in enumerate(lines):
        if not line.strip():
            blank = 1
            continue
        kind, cut = 0, 0
        if found := marker(line):
            word, cut = found
            kind = SPEAKERS[word] + 1 if word in SPEAKERS else 4 + min(1, names.setdefault(word, len(names)))
        body = line[cut:].rstrip()
        last = 1 if body.endswith("?") else 2 if body.endswith((".", "!")) else 0
        at.append(i), cuts.append(cut)
        rows.append((2 * kind + blank, int(np.searchsorted(_LENGTHS, len(body))), last))
        blank = 0
    seen = np.array(rows, np.int64).reshape(-1, len(_SIZES))
    if len(seen) and seen[:, 0].max() > 1:
        seen[seen[:, 0] < 2, 0] += 12
    return lines, np.array(at, np.int64), seen, cuts


def count(samples: list[list[tuple[int, str]]]) -> Model:
    """Probabilities from transcripts given as their turns in order: role and raw text, marker included."""
    start, move = np.full(6, 0.1), np.full((6, 6), 0.05)
    move[:, 1::2] = 1e-6  # a further line follows a line of its own role
    for r in range(3):
        move[2 * r : 2 * r + 2, 2 * r + 1] = 0.5
    start[1::2] = 1e-3
    emit = [np.full((6, n), 0.05) for n in _SIZES]
    for turns in samples:
        lines: list[str] = []
        states: list[int] = []
        for role, raw in turns:
            first = True
            for x in raw.split("\n"):
                lines.append(x)
                if x.strip():
                    states.append(2 * role + (not first))
                    first = False
        _, _, rows, _ = observe("\n".join(lines))
        for i, (s, row) in enumerate(zip(states, rows, strict=True)):
            for f, v in enumerate(row):
                emit[f][s, v] += 1
            if i:
                move[states[i - 1], s] += 1
            else:
                start[s] += 1
    norm = lambda x: np.log(x / x.sum(-1, keepdims=True))
    # markers say who speaks; the other features differ between collections of chats, so half of their mass is spread evenly
    even = lambda e: np.log(0.5 * e / e.sum(-1, keepdims=True) + 0.5 / e.shape[1])
    return Model(norm(start), norm(move), [norm(emit[0]), *map(even, emit[1:])])


def viterbi(model: Model, rows: np.ndarray) -> np.ndarray:
    """The likeliest states of a transcript's lines: one path over all of them, with a byte per line and state to go back by."""
    if not len(rows):
        return np.zeros(0, np.int64)
    back = np.zeros((len(rows), 6), np.int8)
    emit = [e.T.copy() for e in model.emit]
    seen = lambda t: sum(e[v] for e, v in zip(emit, rows[t], strict=True))
    v = model.start + seen(0)
    for t in range(1, len(rows)):
        step = v[:, None] + model.move
        back[t] = step.argmax(0)
        v = step.max(0) + seen(t)
    path = np.zeros(len(rows), np.int64)
    path[-1] = v.argmax()
    for t in range(len(rows) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def turns(model: Model, text: str | None, context: int = 0) -> list[tuple[str, str]]:
    """(role, text) of each turn of a transcript: its lines as they are, blank ones between them too, without the marker and blank lines at the ends.

    The first `context` lines only say what came before: the path runs over them, but they give no turns.
    """
    lines, at, rows, cuts = observe(text)
    path = viterbi(model, rows)
    start = next((k for k in range(len(path)) if at[k] >= context), len(path))
    first = [k for k, s in enumerate(path.tolist()) if k >= start and (s % 2 == 0 or k == start)]
    out = []
    for k, end in zip(first, [*first, len(path)][1:], strict=True):
        own = [lines[at[k]][cuts[k] :], *lines[at[k] + 1 : at[end - 1] + 1]]
        while own and not own[0].strip():
            own.pop(0)
        out.append((ROLES[path[k] // 2], "\n".join(own)))
    return out


def render(role: str, text: str) -> str:
    """The canonical form of a turn."""
    return f"<|{role}|>\n{text}\n<|end|>\n"


def fit(conversations: DataFrame, *, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", sample_turns: int = 20000, seed: int = 9) -> Model:
    """Counts on about `sample_turns` turns of whole conversations, chosen by a hash of their id, twice as many at most (the first in the order of the hash, so reruns agree), each written in all notations in turn.

    `sample_turns` bounds what the driver gathers; roles that are none of ROLES are left out.
    """
    rows = conversations.select(F.col(id_col).alias("c"), F.col(turn).alias("n"), F.col(role).alias("r"), F.col(text).alias("t")).where(F.col("r").isin(*ROLES) & F.col("t").isNotNull())
    total = rows.count()
    got = rows.withColumn("h", unit_hash("c", seed=seed)).where(F.col("h") < min(1.0, sample_turns / max(1, total))).orderBy("h", "c", "n", "r", "t").limit(2 * sample_turns).toArrow().to_pylist()
    got.sort(key=lambda x: (str(x["c"]), x["n"] is not None, x["n"] or 0, x["t"]))
    by: dict = {}
    for x in got:
        by.setdefault(x["c"], []).append((ROLES.index(x["r"]), x["t"]))
    samples = []
    for i, mine in enumerate(by.values()):
        for notation in (NOTATIONS[i % len(NOTATIONS)], NOTATIONS[-1]):
            samples.append([(r, notation[r] + t) if (i + k) % 8 else (r, "\n" + t) for k, (r, t) in enumerate(mine)])
    return count(samples)


def as_transcripts(conversations: DataFrame, *, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk_turns: int = 512, context_turns: int = 8) -> DataFrame:
    """Writes tables of turns as raw transcripts: (id, chunk, context, transcript), a notation per conversation, every eighth marker missing.

    A chunk has `chunk_turns` turn numbers at most, so one conversation that holds a third of all rows is many rows. Each but the first begins with the last `context_turns` of the one before, `context` lines that
    `parse` reads and leaves out; `parse` numbers turns through.
    """
    rows = conversations.select(F.col(id_col).alias("id"), F.coalesce(F.col(turn), F.lit(0)).cast("long").alias("n"), F.lower(F.col(role)).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    own = F.floor(F.col("n") / chunk_turns).cast("long")
    again = F.when(F.pmod("n", F.lit(chunk_turns)) >= chunk_turns - context_turns, own + 1)
    rows = rows.distinct().withColumn("chunk", F.explode(F.filter(F.array(own, again), lambda x: x.isNotNull()))).withColumn("before", F.col("chunk") > own)
    style = F.pmod(F.xxhash64("id"), F.lit(len(NOTATIONS)))
    head = F.lit("\n")
    for i, notation in enumerate(NOTATIONS):
        for r, mark in zip(ROLES, notation, strict=True):
            head = F.when((style == i) & (F.col("r") == r), F.lit(mark)).otherwise(head)
    head = F.when(F.pmod(F.xxhash64("id", "n"), F.lit(8)) == 0, F.lit("\n")).otherwise(head)
    per = rows.groupBy("id", "chunk").agg(F.array_sort(F.collect_list(F.struct("n", F.concat(head, "t").alias("s"), "before"))).alias("p")).where("NOT forall(p, x -> x.before)")
    join = lambda kept: F.array_join(F.transform(kept, lambda x: x["s"]), "\n")
    lines = F.when(F.exists("p", lambda x: x["before"]), F.size(F.split(join(F.filter("p", lambda x: x["before"])), "\n"))).otherwise(0)
    return per.select("id", "chunk", lines.alias("context"), join(F.col("p")).alias("transcript"))


def parse(transcripts: DataFrame, model: Model, *, id_col: str = "id", text: str = "transcript") -> DataFrame:
    """A row per turn: id, turn (from 0 within the id), role, text and rendered. Where transcripts come in chunks (columns chunk and context), turns are numbered through all chunks of an id."""
    shared = transcripts.sparkSession.sparkContext.broadcast(model)
    chunked = "chunk" in transcripts.columns
    part = [F.col("chunk").cast("long"), F.col("context").cast("int")] if chunked else [F.lit(0).cast("long"), F.lit(0)]
    src = transcripts.select(F.col(id_col).alias("id"), part[0].alias("chunk"), part[1].alias("context"), F.col(text).cast("string").alias("__t"))
    names = ["id", "chunk", "turn", "role", "text", "rendered"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                part = whole.slice(at, 1024)
                found = [turns(m, t, c) for t, c in zip(part.column(3).to_pylist(), part.column(2).to_pylist(), strict=True)]
                row = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                flat = [x for f in found for x in f]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(row),
                        part.column(1).take(row),
                        pa.array([i for f in found for i in range(len(f))], pa.int64()),
                        pa.array([r for r, _ in flat], pa.string()),
                        pa.array([t for _, t in flat], pa.string()),
                        pa.array([render(r, t) for r, t in flat], pa.string()),
                    ],
                    names=names,
                )

    kinds = [src.schema["id"].dataType, T.LongType(), T.LongType(), T.StringType(), T.StringType(), T.StringType()]
    found = src.mapInArrow(tidy(run), T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))
    if not chunked:
        return found.drop("chunk")
    found, _ = materialise(found)
    # a row a chunk; only ids of several chunks need to know what came before
    sizes = found.groupBy("id", "chunk").agg(F.count("*").alias("n"))
    before = sizes.select("id", "chunk", F.sum("n").over(Window.partitionBy("id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("before")).where("before > 0")
    numbered = found.join(before.toDF("__id", "__chunk", "before"), F.col("id").eqNullSafe(F.col("__id")) & (F.col("chunk") == F.col("__chunk")), "left")
    return numbered.select("id", (F.col("turn") + F.coalesce("before", F.lit(0))).alias("turn"), "role", "text", "rendered")
