"""Approximate nearest neighbours by balanced posting lists.

Centroids come from balanced spherical k-means on a bounded sample; every row is indexed. A row goes to the list of its nearest centroid and, as a
boundary vector, to those of up to `replicas` centroids whose distance is at most (1 + boundary) times that of the nearest. Long lists are
stored as several blocks, so none is larger than `block_rows`. A query finds centroids by best-first search in an in-memory graph that joins
each centroid to its nearest ones, and scans the lists whose centroid is at most (1 + ratio) times as far as the second nearest, eight at least. Scores are inner
products of the original vectors in double precision. A task keeps a running k best of each block of queries over the blocks of a list, so k rows a query and list leave it at
most, and after the nearest lists only rows that beat the k-th score so far.

The largest inner product is made a nearest-neighbour search by one more component: rows get sqrt(M^2 - |x|^2), M the largest norm, queries
0 after scaling to M. All of that is in units of the largest component, so that squares of large components stay finite.

Defined cases: null or zero vectors, and those with null or non-finite components, take no part, nor do rows with a null id; vectors meet
those of their own length only; rows that share the query's id are its own, and an id is returned once, with its best score. A query with at most k
candidates gets all of them: lists are added by distance until their own (not replicated) rows suffice. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import materialise, tidy, unit_hash
from sievework.llm.vectors import best, matrix, pick, usable


#: Lists of a query that are scanned before the others.
_FIRST = 8


@dataclass
class Centroids:
    """Points in the raised space, the graph among them, and how many rows are nearest to each."""

    points: np.ndarray
    graph: list[np.ndarray]
    entry: int
    norm: float
    own: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def distances(self, x: np.ndarray) -> np.ndarray:
        square = (x**2).sum(1)[:, None] + (self.points**2).sum(1)[None] - 2 * x @ self.points.T
        return np.sqrt(np.maximum(square, 0))

    def search(self, x: np.ndarray, ratio: float, least: int, beam: int = 24, few: int = 8) -> list[int]:
        """Centroids within (1 + ratio) times the second least distance, at least `few`, and as many more as hold `least` rows, by best-first search."""
        dist = lambda ids: np.sqrt(((self.points[ids] - x) ** 2).sum(1))
        first = float(dist(np.array([self.entry]))[0])
        heap, seen, done = [(first, self.entry)], {self.entry}, []
        best = [first]
        while heap:
            d, c = heapq.heappop(heap)
            if d > (1 + ratio) * best[-1] and len(done) >= beam and self.own[[i for _, i in done]].sum() >= least:
                break
            done.append((d, c))
            new = np.array([i for i in self.graph[c].tolist() if i not in seen], np.int64)
            if len(new):
                seen.update(new.tolist())
                for e, i in zip(dist(new).tolist(), new.tolist(), strict=True):
                    best = sorted([*best, e])[:2]
                    heapq.heappush(heap, (e, i))
        done.sort()
        near = done[min(1, len(done) - 1)][0]  # of the second nearest: the nearest centroid may stand on the query itself
        out, rows = [], 0
        for d, c in done:
            if d > (1 + ratio) * near and rows >= least and len(out) >= few:
                break
            out.append(c)
            rows += self.own[c]
        return out


def raised(x: np.ndarray, norm: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(norm**2 - (x**2).sum(1), 0))])


def fit(sample: np.ndarray, lists: int, norm: float, *, rounds: int = 8, degree: int = 12, balance: float = 0.3, seed: int = 1) -> Centroids:
    """Balanced k-means: a cluster beyond its fair share is farther away by a penalty; then a graph of each centroid's nearest ones."""
    rng = np.random.default_rng(seed)
    x = raised(sample, norm)
    points = x[rng.choice(len(x), min(lists, len(x)), replace=False)].copy()
    weight = np.zeros(len(points))
    for _ in range(rounds):
        square = (x**2).sum(1)[:, None] + (points**2).sum(1)[None] - 2 * x @ points.T
        near = (square + weight[None]).argmin(1)
        size = np.bincount(near, minlength=len(points))
        weight = balance * np.maximum(square.min(1).mean(), 1e-12) * np.maximum(0, size / max(size.mean(), 1) - 1)
        sums = np.zeros_like(points)
        np.add.at(sums, near, x)
        some = size > 0
        length = np.linalg.norm(sums[some], axis=1, keepdims=True)  # raised rows are on a sphere, and so are centroids: none is near to all
        points[some] = np.where(length > 1e-9 * norm, sums[some] * (norm / np.maximum(length, 1e-300)), points[some])
        points[~some] = x[rng.choice(len(x), int((~some).sum()))]
    apart = ((points[:, None] - points[None]) ** 2).sum(-1) if len(points) <= 512 else None
    links: list[set[int]] = [set() for _ in points]
    for c in range(len(points)):
        d = apart[c] if apart is not None else ((points - points[c]) ** 2).sum(1)
        for i in np.argsort(d, kind="stable")[1 : degree + 1].tolist():
            links[c].add(i), links[i].add(c)
        if c:  # a link to the nearest earlier centroid keeps the graph in one piece
            i = int(d[:c].argmin())
            links[c].add(i), links[i].add(c)
    entry = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    return Centroids(points, [np.array(sorted(s), np.int64) for s in links], entry, norm)


def _packed(rows: DataFrame, dim: int, most: int) -> DataFrame:
    """Blocks of up to `most` rows of a (list, part), from rows sorted by those: (list, ids, vectors) as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            ids, x = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
            out = pa.RecordBatch.from_arrays([pa.array([held[0][0]], pa.int32()), pa.array([ids.astype("<i8").tobytes()]), pa.array([x.astype("<f8").tobytes()])], names=["list", "ids", "vecs"])
            held.clear()
            return out

        for b in batches:
            if not b.num_rows:
                continue
            lists, parts, ids, x = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), matrix(b.column(3), dim)
            cuts = np.flatnonzero((lists[1:] != lists[:-1]) | (parts[1:] != parts[:-1])) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                if held and (held[0][0], held[0][1]) != (lists[i], parts[i]):
                    yield flush()
                for k in range(i, j, most):
                    held.append((int(lists[i]), int(parts[i]), ids[k : min(j, k + most)], x[k : min(j, k + most)]))
                    if sum(len(h[2]) for h in held) >= most:
                        yield flush()
        if held:
            yield flush()

    sorted_rows = rows.select("list", "part", "id", "vec").repartition("list", "part").sortWithinPartitions("list", "part")
    return sorted_rows.mapInArrow(tidy(run), "list int, ids binary, vecs binary")


def _search(rows: DataFrame, asked: DataFrame, dim: int, k: int, *, sample_rows: int, max_lists: int, replicas: int, boundary: float, ratio: float, block_rows: int) -> DataFrame:
    """Searches among vectors of one length; `rows` and `asked` have id and vec."""
    spark = rows.sparkSession
    unit = rows.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0]
    n, norm = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / unit) * (x / unit))))).first()
    lists = int(max(4, min(max_lists, n**0.5 / 2)))
    # rows that repeat are one; the limit, hardly ever met, keeps the lowest hashes
    some = rows.where(unit_hash("id", "vec", seed=2) < min(1.0, sample_rows / n)).select("vec").distinct()
    got = some.orderBy(F.xxhash64("vec"), "vec").limit(sample_rows * 2).toArrow()["vec"].combine_chunks()
    sample = matrix(got, dim) if len(got) else matrix(rows.select("vec").limit(1).toArrow()["vec"].combine_chunks(), dim)
    sample = sample[np.lexsort(sample.T[::-1])] / unit  # reruns agree
    model = fit(sample, lists, norm)
    shared = spark.sparkContext.broadcast(model)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                if not b.num_rows:
                    continue
                d = m.distances(raised(matrix(b.column(1), dim) / unit, m.norm))
                few = min(replicas, d.shape[1])
                near = np.argpartition(d, few - 1, axis=1)[:, :few]
                far = np.take_along_axis(d, near, 1)
                first = far.min(1, keepdims=True)
                row, col = np.nonzero(far <= (1 + boundary) * first)
                which = near[row, col]
                own = which == d.argmin(1)[row]
                yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(own), *b.take(pa.array(row)).columns], names=["list", "own", "id", "vec"])

    placed, _ = materialise(rows.mapInArrow(tidy(assign), "list int, own boolean, id long, vec array<double>"))
    sizes = placed.groupBy("list").agg(F.count("*").alias("n")).collect()  # a row per centroid
    own = np.zeros(len(model.points))
    # an id counts once, in one of its lists, however many rows it has
    for r in placed.where("own").groupBy("id").agg(F.min("list").alias("list")).groupBy("list").agg(F.count("*").alias("own")).collect():
        own[r["list"]] = r["own"]
    model.own = own
    shared = spark.sparkContext.broadcast(model)
    many = F.create_map(*[F.lit(v) for r in sizes for v in (r["list"], -(-r["n"] // block_rows))])[F.col("list")]
    index, _ = materialise(_packed(placed.withColumn("part", F.pmod(F.xxhash64("id"), many).cast("int")), dim, block_rows))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(1), dim)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            scaled = np.column_stack([x * (m.norm / np.linalg.norm(x, axis=1))[:, None], np.zeros(len(x))])
            found = [m.search(q, ratio, k + 1) for q in scaled]
            row = np.repeat(np.arange(len(x)), [len(f) for f in found])
            turn = np.concatenate([np.arange(len(f)) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int32()), pa.array(turn, pa.int32()), *b.take(pa.array(row)).columns], names=["list", "turn", "id", "vec"])

    routed, _ = materialise(asked.mapInArrow(tidy(route), "list int, turn int, id long, vec array<double>"))
    parts = max(1, -(-asked.count() // 1024))

    def scanned(some: DataFrame) -> DataFrame:
        """`some`: list, id, vec and least, the score from which on a row can be among the query's k best."""
        with_least = some.select("list", "id", F.concat("vec", F.array("least")).alias("vec"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"))
        return _packed(with_least, dim + 1, 1024).toDF("list", "q_ids", "q_vecs").join(index, "list").mapInArrow(tidy(scan), "query_id long, vec_id long, score double")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[tuple[np.ndarray, np.ndarray]]] = {}  # of each block of queries: ids and scores of the best so far

        def flush() -> Iterator[pa.RecordBatch]:
            for q_ids, found in held.items():
                mine = np.repeat(np.frombuffer(q_ids, "<i8"), [len(i) for i, _ in found])
                yield pa.RecordBatch.from_arrays([pa.array(mine), *(pa.array(np.concatenate(c)) for c in zip(*found, strict=True))], names=["query_id", "vec_id", "score"])
            held.clear()

        for b in batches:
            for q_ids, q_vecs, ids, vecs in zip(*(b.column(c).to_pylist() for c in ("q_ids", "q_vecs", "ids", "vecs")), strict=True):
                if q_ids not in held and len(held) >= 64:
                    yield from flush()
                mine, q = np.frombuffer(q_ids, "<i8"), np.frombuffer(q_vecs, "<f8").reshape(-1, dim + 1)
                q, floor = q[:, :dim], q[:, dim]
                none = (np.zeros(0, np.int64), np.zeros(0))
                so_far = held.get(q_ids) or [none] * len(mine)
                floor = np.array([max(f, s[k - 1]) if len(s) >= k else f for f, (_, s) in zip(floor, so_far, strict=True)])
                held[q_ids] = within(mine, q, floor, so_far, np.frombuffer(ids, "<i8"), np.frombuffer(vecs, "<f8").reshape(-1, dim), k)
        yield from flush()

    # the nearest lists of each query first: the k-th score over them is the least that rows of other lists must reach
    once = lambda df: df.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest, _ = materialise(best(once(scanned(routed.where(F.col("turn") < _FIRST).withColumn("least", F.lit(float("-inf"))))), k))
    floor = nearest.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("__f"))
    rest = routed.where(F.col("turn") >= _FIRST).join(floor, "id", "left").withColumn("least", F.coalesce("__f", F.lit(float("-inf"))))
    return once(nearest.select("query_id", "vec_id", "score").unionByName(scanned(rest)))


def within(mine: np.ndarray, q: np.ndarray, floor: np.ndarray, so_far: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and scores of each query's k best among `so_far` and the rows of a block that reach its floor; an id counts once, with its best score."""
    rough = q @ x.T
    rough[mine[:, None] == ids[None]] = -np.inf
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] - 1))
    by_id = rough if len(starts) == len(ids) else np.maximum.reduceat(rough[:, order], starts, axis=1)
    few = min(k, by_id.shape[1])
    least = np.maximum(-np.partition(-by_id, few - 1, axis=1)[:, few - 1], floor)
    with np.errstate(invalid="ignore"):
        least = np.where(np.isfinite(least), least - 1e-9 * np.maximum(1, np.abs(least)), least)  # rounding of the product must not part equal rows
    out = []
    for i, (old_ids, old) in enumerate(so_far):
        at = np.flatnonzero((rough[i] >= least[i]) & (rough[i] > -np.inf))
        both, score = np.concatenate([old_ids, ids[at]]), np.concatenate([old, (x[at] * q[i]).sum(1)])
        p = pick(both, score, len(both))
        p = p[np.sort(np.unique(both[p], return_index=True)[1])][:k]
        out.append((both[p], score[p]))
    return out


def search(table: DataFrame, queries: DataFrame, k: int, *, id_col: str = "vec_id", vec: str = "embedding", sample_rows: int = 20000, max_lists: int = 4096, replicas: int = 3, boundary: float = 0.05, ratio: float = 0.18, block_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each query.

    `sample_rows` bounds what the centroids are fitted on, `max_lists` their number: the model that is sent to tasks has a fixed size.
    """
    nonzero = usable(vec) & F.exists(vec, lambda c: c != 0) & F.col(id_col).isNotNull()

    def good(df: DataFrame) -> DataFrame:
        return df.where(nonzero).select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"))

    rows, asked = good(table), good(queries)
    found = None
    for r in asked.select(F.size("vec").alias("d")).distinct().orderBy("d").collect():  # vectors of a table have one length, or a few
        same = F.size("vec") == r["d"]
        if rows.where(same).limit(1).count():
            part = _search(rows.where(same), asked.where(same), r["d"], k, sample_rows=sample_rows, max_lists=max_lists, replicas=replicas, boundary=boundary, ratio=ratio, block_rows=block_rows)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = table.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    return best(found, k)
