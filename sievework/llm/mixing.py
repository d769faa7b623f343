"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sizes are word counts. Each source gets a target; the targets are apportioned in blocks of `block` words, first among the
sources, then among the shards of each source, by the highest quotients t/(2k+1). A shard is the stream of its documents in
seeded order, cut into equal blocks; a quota of q of its n blocks takes the whole stream q div n times, and once more its
first q mod n blocks, which the seed has already shuffled. So at most one document of a shard is taken in part.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its own, last; an empty table gives no
rows. Repeated rows are separate rows: ties in the seeded order are between equal rows. Other columns pass through, input
columns with the names of the outputs are replaced.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import WORD, materialise


def size_of(text: str = "text"):
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Shares `share` times all sizes by weight; a target stops at `most` times its source's size, the excess goes to the others by weight."""
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    left, out, free = share * sum(n for _, n in sizes), {}, dict(order)
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s, n in free.items() if left * weight[s] / total >= most * n]
        if not full:
            return out | {s: left * weight[s] / total for s in free}
        for s in full:
            out[s] = most * free.pop(s)
        left -= sum(out[s] for s in full)
    return out


def sainte_lague(votes: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by the highest quotients v/(2k+1), none beyond `most`; ties to the earlier entry.

    It starts where rounding at a common divisor already stands, which is on the way of the method, and deals out the rest.
    """
    most = most or [seats] * len(votes)
    seats, total = min(seats, sum(most)), sum(votes)
    if total <= 0 or seats <= 0:
        return [0] * len(votes)
    d = total / seats
    got = [min(m, max(0, math.floor(v / d - 0.5))) for v, m in zip(votes, most, strict=True)]
    # entries at their limit stay there, so that the others move up by quotient from a lower bound
    heap = [(-v / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(votes, got, most, strict=True)) if g < m and v > 0]
    heapq.heapify(heap)
    rest = seats - sum(got)
    while rest > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        rest -= 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def mix(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = 32, least_blocks: int = 16, shard_docs: int = 1024, max_shards: int = 1024, seed: int = 11, keep: list[str] | None = None) -> DataFrame:
    """Adds size, source_size, target and taken to every row; `keep`: the columns that stay (all of them by default).

    The driver sees a row per source and shard: sources x max_shards at most, so a hot source is many even shards and the table of
    quotas has a bound that doesn't grow with the documents.
    """
    spark = docs.sparkSession
    own = ("size", "source_size", "target", "taken")
    out = [c for c in (docs.columns if keep is None else keep) if c not in own]
    rows = docs.withColumn("size", size_of(text)).withColumn("__src", F.col(source).cast("string"))
    rows = rows.withColumn("__key", F.xxhash64(F.lit(seed), F.col(id_col), F.col(text).cast("string"))).select(*out, "size", "__src", "__key")
    if text not in out:
        rows, _ = materialise(rows)  # words are counted once; without texts the table is small
    counts = rows.groupBy("__src").agg(F.count("*").alias("n")).collect()
    shards = {r["__src"]: max(1, min(max_shards, -(-r["n"] // shard_docs))) for r in counts}
    many = spark.createDataFrame(list(shards.items()), "__name string, __many long")
    rows = rows.join(many, F.col("__src").eqNullSafe(F.col("__name"))).withColumn("__shard", F.pmod(F.xxhash64("__key"), F.col("__many")).cast("int")).drop("__name", "__many")
    per = [(r["__src"], r["__shard"], r["w"]) for r in rows.groupBy("__src", "__shard").agg(F.sum("size").alias("w")).collect()]
    per.sort(key=lambda x: (x[0] is None, x[0] or "", x[1]))
    own_shards: dict[str | None, list[tuple[int, int]]] = {}
    for s, k, w in per:
        own_shards.setdefault(s, []).append((k, w))
    sizes = {s: sum(w for _, w in mine) for s, mine in own_shards.items()}
    goal = targets(list(sizes.items()), weights, share, most)
    names = list(goal)
    # a shard's blocks have `block` words each, or less, so that a shard with words has `least_blocks` or a block a word
    blocks = {(s, k): max(round(w / block), min(w, least_blocks)) for s, k, w in per}
    whole = {s: sum(blocks[s, k] for k, _ in mine) for s, mine in own_shards.items()}
    # votes are targets in blocks of the source's own size
    votes = [goal[s] * whole[s] / sizes[s] if sizes[s] else 0.0 for s in names]
    seats = sainte_lague(votes, round(sum(votes)), [math.floor(most) * whole[s] for s in names])
    quota: dict[tuple, int] = {}
    for s, q in zip(names, seats, strict=True):
        mine = own_shards[s]
        quota |= {(s, k): n for (k, _), n in zip(mine, sainte_lague([blocks[s, k] for k, _ in mine], q, [math.floor(most) * blocks[s, k] for k, _ in mine]), strict=True)}
    plan = spark.createDataFrame(
        [(s, k, w, blocks[s, k], quota[s, k], sizes[s], goal[s]) for s, k, w in per],
        "__s string, __k int, __w long, __b long, __q long, source_size long, target double",
    )
    # bounded by sources x max_shards (see above), whatever the number of documents
    joined = rows.join(F.broadcast(plan), F.col("__src").eqNullSafe(F.col("__s")) & (F.col("__shard") == F.col("__k")))
    w = Window.partitionBy("__src", "__shard").orderBy("__key").rowsBetween(Window.unboundedPreceding, -1)
    joined = joined.withColumn("__at", F.coalesce(F.sum("size").over(w), F.lit(0)))
    end = F.expr("(pmod(__q, greatest(__b, 1)) * __w) div greatest(__b, 1)")
    taken = F.expr("__q div greatest(__b, 1)") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("__at") + F.col("size"), end) - F.col("__at"))
    return joined.withColumn("taken", taken.cast("long")).select(*out, "size", "source_size", "target", "taken")


def apply_mix(docs: DataFrame, mixed: DataFrame, *, size: str = "size", taken: str = "taken") -> DataFrame:
    """The mixed corpus: each row round(taken / size) times, whole, with the columns of `docs`."""
    times = F.expr(f"CASE WHEN {size} > 0 THEN cast(round({taken} / {size}) AS int) ELSE 0 END")
    return mixed.withColumn("__n", F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)
