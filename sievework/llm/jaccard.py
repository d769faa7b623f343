"""Exact Jaccard join of documents' word shingles, and its connected components, in metric space.

The distance of two shingle sets is 1 - J. Pivots cut the space into regions, bounds that follow from the triangle inequality
keep pairs of a region apart, and regions are joined on their own, large ones recursively:

1. Sets that agree in some of a few minima of their hashed shingles are compared with one of them. That links most near copies, in as many rows as there are sets.
   All later steps leave out pairs that are in one component already, so a group of near copies costs in proportion to its size.
2. Pivots are shingles. A set lies in the region of each of its n - ceil(t*n) + 1 rarest shingles: a set within the distance must hold one of
   them and, ranking shingles alike, counts it among its own, so boundary documents are replicated exactly as far as the threshold asks and no link is lost.
   Rarity is read from a sketch of fixed size; a wrong estimate changes which regions are large, never the result.
   (Documents as pivots of the whole corpus don't work here: unrelated texts are all at distance 1, so every document is on every boundary.)
3. The shingle universe is cut into `cells` cells. The counts of a set's shingles by cell are a point, and the sum of differences of two points is a metric that bounds |x - y| + |y - x| from
   below; sets that link are close in it. Within a region documents are pivots: each row goes to the Voronoi cell of its nearest one and, by the triangle inequality,
   to those cells that a link could reach, and cells are joined recursively. Large regions are first dealt into blocks that meet in pairs.
4. What is left are candidate pairs, which aren't written: their connected groups are, a row per member. The same group found in many regions is one, and so are groups that share members, as far as
   a task can hold them. Each group meets its whole sets once, and a task verifies its pairs and gives the links of a spanning forest: fewer than the group has rows, whatever the number of pairs.

Equal sets are one node, named by a 128-bit hash. Sets, texts and links never reach the driver; each step is a written table.

Defined cases: a text with fewer words than a shingle is one shingle, the whole sequence; null and empty texts and those without words have no
shingles, link with nothing, and are their own component. Repeated rows are copies. Rows with a null id are linked like others; a component
without any id has none. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import discard, materialise, tidy

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_BANDS = 4  # of two minima each


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(w)
        if len(self) < 100_000 and len(w) <= 64:
            self[w] = h
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD[0]
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, words: _Words, size: int) -> np.ndarray:
    """The distinct shingles of a text, hashed and sorted; words are lower-cased in A-Z and parted by blanks and ASCII controls 9 to 13."""
    w = np.array(list(map(words.__getitem__, (text or "").encode().lower().split())), np.uint64)
    if not len(w):
        return w
    k = min(size, len(w))
    h = np.full(len(w) - k + 1, np.uint64(k))
    for i in range(k):
        h += w[i : len(w) - k + 1 + i] * _ODD[i]
    return np.unique(_mix(h))


def fingerprint(s: np.ndarray) -> bytes:
    """A 128-bit hash of a set."""
    return xxhash.xxh3_128_digest(s.tobytes(), seed=len(s))


def bands(s: np.ndarray) -> np.ndarray:
    """Two minima of a set in different orders, hashed together, `_BANDS` times over."""
    low = _mix(s[None, :] * _ODD[: 2 * _BANDS, None]).min(axis=1)
    return _mix(low[::2] * _ODD[:_BANDS] + low[1::2])


def _key(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


def _texts(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            part = whole.slice(at, 256)
            yield part, part.column(place).to_pylist()


def sketch(docs: DataFrame, text: str, size: int, bits: int) -> np.ndarray:
    """How many documents hold the shingles of each of 2**bits buckets. Tasks' counts are summed in slices by the executors; its size is fixed."""
    pieces = min(1024, 1 << bits)
    width = (1 << bits) // pieces

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total, used = _Words(), np.zeros(1 << bits, np.uint32), False
        for _, texts in _texts(batches, 0):
            used = True
            for t in texts:
                h = (shingles(t, words, size) >> np.uint64(64 - bits)).astype(np.int64)
                np.add.at(total, h, np.uint32(1))
        if used:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(pieces, dtype=np.int32)), pa.array([x.tobytes() for x in total.reshape(pieces, width)])], names=["piece", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(c, np.uint32)
                sums[p] = sums[p] + x if p in sums else x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()])], names=["piece", "counts"])

    schema = "piece int, counts binary"
    summed = docs.select(F.col(text).cast("string")).mapInArrow(tidy(count), schema).repartition("piece").mapInArrow(tidy(add), schema)
    out = np.zeros((pieces, width), np.uint32)
    for r in summed.collect():  # 4 * 2**bits bytes; an iterator would run a job for each partition
        out[r["piece"]] = np.frombuffer(r["counts"], np.uint32)
    return out.reshape(-1)


def signatures(docs: DataFrame, id_col: str, text: str, size: int, percent: int, rarity, bits: int, cells: int) -> DataFrame:
    """doc_id, key (a hash of the text), n, sid (the set's fingerprint; null if empty), bands, pivots (its rarest shingles, those excepted that no other document can hold) and cells."""
    shift = np.uint64(64 - cells.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, count = _Words(), rarity.value
        for part, texts in _texts(batches, 2):
            n, sid, low, pivots, cell = [], [], [], [], []
            for t in texts:
                s = shingles(t, words, size)
                n.append(len(s))
                if not len(s):
                    sid.append(None), low.append(None), pivots.append(None), cell.append(None)
                    continue
                most = len(s) - -(-percent * len(s) // 100) + 1
                c = count[(s >> np.uint64(64 - bits)).astype(np.int64)]
                first = np.lexsort((s, c))[:most]
                first = first[c[first] > 1]
                sid.append(fingerprint(s)), low.append(bands(s).view(np.int64)), pivots.append(s[first].view(np.int64))
                cell.append(np.minimum(np.bincount((s >> shift).astype(np.int64), minlength=cells), 255).astype(np.uint8).tobytes())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(sid, pa.binary()), pa.array(low, longs), pa.array(pivots, longs), pa.array(cell, pa.binary())],
                names=["doc_id", "key", "n", "sid", "bands", "pivots", "cells"],
            )

    schema = "doc_id long, key long, n long, sid binary, bands array<long>, pivots array<long>, cells binary"
    return docs.select(F.col(id_col).cast("long"), _key(text), F.col(text).cast("string")).mapInArrow(tidy(run), schema)


def unite(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Makes one class of each pair's classes; `up` holds the first member of each row's class."""
    while len(a):
        x, y = up[a], up[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while ((above := up[up]) != up).any():
            up[:] = above


class Window:
    """Rows of a group as points, and which pairs of them a link may join: sizes and points are close, components differ."""

    def __init__(self, n: np.ndarray, cells: np.ndarray, comp: np.ndarray, percent: int):
        self.n, self.cells, self.comp, self.percent = n, cells, comp, percent
        #: A link of a row is no longer than this: its partner has at most 100 / percent times its shingles.
        self.reach = (100 - percent) * n / percent

    def open(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs have sizes that fit and different components."""
        n = self.n
        return (100 * np.minimum(n[a], n[b]) >= self.percent * np.maximum(n[a], n[b])) & (self.comp[a] != self.comp[b]).any(axis=-1)

    def close(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs have points that are close enough."""
        out = np.zeros(len(a), bool)
        for at in range(0, len(a), 1 << 15):
            i, j = a[at : at + (1 << 15)], b[at : at + (1 << 15)]
            apart = np.abs(self.cells[i] - self.cells[j]).sum(axis=1, dtype=np.int64)
            out[at : at + (1 << 15)] = (100 + self.percent) * apart <= (100 - self.percent) * (self.n[i] + self.n[j])
        return out

    def among(self, own: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of own rows, and of own rows with others, that a link may join."""
        rows = np.concatenate([own, others])
        for at in range(0, len(own), 64):
            i, j = np.meshgrid(np.arange(at, min(at + 64, len(own))), np.arange(at + 1, len(rows)), indexing="ij")
            i, j = i[i < j], j[i < j]
            a, b = rows[i], rows[j]
            ok = self.open(a, b)
            a, b = a[ok], b[ok]
            ok = self.close(a, b)
            yield a[ok], b[ok]

    def pairs(self, rows: np.ndarray, small: int, pivots: int = 8) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of `rows` that a link may join: cells of the nearest pivots, with those rows of other cells that the triangle inequality lets in, recursively."""
        left = [(rows, rows[:0])]
        while left:
            own, others = left.pop()
            if len(own) <= small:
                yield from self.among(own, others)
                continue
            every = np.concatenate([own, others])
            pivot = own[np.linspace(0, len(own) - 1, pivots).astype(np.int64)]
            far = np.stack([np.abs(self.cells[every] - self.cells[p]).sum(axis=1, dtype=np.int64) for p in pivot], axis=1)
            home, near = far.argmin(axis=1), far.min(axis=1)
            mine = np.arange(len(every)) < len(own)
            for p in range(pivots):
                inside = mine & (home == p)
                if not inside.any():
                    continue
                # a pair of own rows of two cells is met in the cell of the lower number
                reached = ~inside & (~mine | (home > p)) & (far[:, p] - near <= 2 * self.reach[every])
                if inside.sum() + reached.sum() > 0.7 * len(every):
                    yield from self.among(every[inside], every[reached])
                else:
                    left.append((every[inside], every[reached]))


def _grouped(run, first: int = 2):
    """A function over whole groups, which the first columns name and by which rows are sorted, as one over batches."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # batches of which the last group may go on
        last: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [batch.column(i).to_numpy() for i in range(first)]
            change = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in names])) + 1
            if last is not None and last != tuple(x[0] for x in names):
                yield from run(pa.Table.from_batches(held))
                held = []
            if len(change):
                cut = int(change[-1])
                yield from run(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = [batch.slice(cut)]
            else:
                held.append(batch)
            last = tuple(x[-1] for x in names)
        if held:
            yield from run(pa.Table.from_batches(held))

    return tidy(over)


def _wide(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """Binary values of one width as rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def candidates(rows: DataFrame, percent: int, small: int) -> DataFrame:
    """Groups of sets, each connected by pairs that a link may join: a row (f1, f2, sid, comp, n) for each member of group (f1, f2).

    `rows`: region, block, sid, n, cells, comp. The name of a group is a hash of its members, so the same group of many regions is one.
    """

    def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
        region, block = t.column(0).to_numpy(), t.column(1).to_numpy()
        cuts = np.flatnonzero((region[1:] != region[:-1]) | (block[1:] != block[:-1])) + 1
        start = np.concatenate([[0], cuts, [len(region)]])
        sid, comp = _wide(t.column(2), np.uint64), _wide(t.column(5), np.uint64)
        window = Window(t.column(3).to_numpy(), _wide(t.column(4), np.uint8).astype(np.int16), comp, percent)
        up = np.arange(len(region))
        # small groups advance together
        size = np.diff(start)
        end = np.repeat(start[1:], size)
        live, k, found = np.flatnonzero(np.repeat(size, size) <= small), 0, []
        while len(live := live[live + k + 1 < end[live]]):
            k += 1
            a = live[window.open(live, live + k)]
            a = a[window.close(a, a + k)]
            found.append((a, a + k))
        if found:
            unite(up, *map(np.concatenate, zip(*found, strict=True)))
        for g in np.flatnonzero(size > small):
            local = np.zeros(0, np.int64)
            for a, b in window.pairs(np.arange(start[g], start[g + 1]), small):
                if len(a):
                    local = up[start[g] : start[g + 1]] - start[g]
                    unite(local, a - start[g], b - start[g])
                    up[start[g] : start[g + 1]] = local + start[g]
        many = np.bincount(up, minlength=len(up)) > 1
        at = np.flatnonzero(many[up])
        if not len(at):
            return
        at = at[np.argsort(up[at], kind="stable")]
        first = np.flatnonzero(np.diff(up[at], prepend=-1))
        lanes = [_mix(sid[at, 0] ^ _mix(sid[at, 1])), _mix(sid[at, 1] ^ _mix(sid[at, 0] + _ODD[2]))]
        names = [np.repeat(np.add.reduceat(x, first), np.diff([*first, len(at)])).view(np.int64) for x in lanes]
        taken = pa.array(at)
        yield pa.RecordBatch.from_arrays([pa.array(names[0]), pa.array(names[1]), *(t.column(c).take(taken).combine_chunks() for c in (2, 5, 3))], names=["f1", "f2", "sid", "comp", "n"])

    keyed = rows.select("region", "block", "sid", "n", "cells", "comp").repartition("region", "block").sortWithinPartitions("region", "block")
    return keyed.mapInArrow(_grouped(run), "f1 long, f2 long, sid binary, comp binary, n long").distinct()


def merged(groups: DataFrame, per_block: int, per_weight: int) -> tuple[DataFrame, list[str]]:
    """Groups that share members made one, so that each set is sent once; where that gives more than `per_block` rows or `per_weight` shingles they stay as they are. With the paths of written tables."""
    anchor = groups.groupBy("f1", "f2").agg(F.min("sid").alias("a"))
    heads, path = components(groups.join(anchor, ["f1", "f2"]).where("sid <> a").select("a", F.col("sid").alias("b")).distinct())
    members, members_path = materialise(groups.select("sid", "comp", "n").distinct().join(heads, "sid"))
    fits = members.groupBy("head").agg(F.count("*").alias("k"), F.sum("n").alias("w")).select("head", ((F.col("k") <= per_block) & (F.col("w") <= per_weight)).alias("fits"))
    members = members.join(fits, "head")
    small = members.where("fits").select(F.xxhash64("head").alias("f1"), F.xxhash64("head", F.lit(1)).alias("f2"), "sid", "comp")
    large = groups.join(members.where("not fits").select("sid"), "sid").select("f1", "f2", "sid", "comp")
    return small.unionByName(large), [path, members_path]


def forest(sets: list[np.ndarray], comp: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links of a group's sets that join different components, one for each two that they join."""
    n = np.array([len(s) for s in sets], np.int64)
    start = np.concatenate([[0], np.cumsum(n)[:-1]])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    comp, held, out = comp.copy(), np.zeros(int(flat.max()) + 1, np.int64), []
    for i in range(len(sets) - 1):
        js = np.flatnonzero((comp != comp[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])))
        js = js[js > i]
        if not len(js):
            continue
        mine = flat[start[i] : start[i] + n[i]]
        held[mine] = 1
        if n[js].sum() * 3 < len(flat):
            common = np.array([held[flat[start[j] : start[j] + n[j]]].sum() for j in js])
        else:
            common = np.add.reduceat(held[flat], start)[js]
        held[mine] = 0
        for j in js[100 * common >= percent * (n[i] + n[js] - common)]:
            if comp[j] != comp[i]:
                out.append((i, int(j)))
                comp[comp == comp[j]] = comp[i]
    return out


def joined(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): components that a link joins, a spanning forest of each group. `groups`: f1, f2, sid, comp; `sets`: sid, members."""

    def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
        f1, f2 = t.column(0).to_numpy(), t.column(1).to_numpy()
        cuts = np.flatnonzero((f1[1:] != f1[:-1]) | (f2[1:] != f2[:-1])) + 1
        lists = t.column(3).combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        names = t.column(2).to_pylist()
        a, b = [], []
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(f1)], strict=True):
            number = {c: k for k, c in enumerate(dict.fromkeys(names[i:j]))}
            comp = np.array([number[c] for c in names[i:j]])
            for x, y in forest([flat[ends[r] : ends[r + 1]] for r in range(i, j)], comp, percent):
                a.append(min(names[i + x], names[i + y])), b.append(max(names[i + x], names[i + y]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    rows = groups.join(sets, "sid").select("f1", "f2", "comp", "members").repartition("f1", "f2").sortWithinPartitions("f1", "f2")
    return rows.mapInArrow(_grouped(run), "a binary, b binary").distinct()


def _blocked(rows: DataFrame, per_block: int, per_weight: int) -> DataFrame:
    """Deals each region's rows into groups (region, block): those to be tried meet each other and all others of the region once or more, in groups of
    about 2 * per_block rows and 2 * per_weight shingles at most. `rows` has tried and, by region, how many are to be tried (n_tried), how many aren't (n_rest) and their shingles (w_tried, w_rest)."""
    need = lambda n, w: f"cast(greatest(ceil({n} / {per_block}), ceil({w} / {per_weight})) as int)"
    rows = rows.withColumns({"__t": F.expr(need("n_tried", "w_tried")), "__r": F.expr(f"greatest(1, {need('n_rest', 'w_rest')})")}).withColumn("__w", F.col("__t") + F.col("__r"))
    one = (F.col("n_tried") + F.col("n_rest") <= per_block) & (F.col("w_tried") + F.col("w_rest") <= per_weight)
    mine = F.when(F.col("tried"), F.pmod(F.xxhash64("sid", F.lit(1)), "__t")).otherwise(F.col("__t") + F.pmod(F.xxhash64("sid", F.lit(1)), "__r")).cast("int")
    rows = rows.withColumn("__i", mine)
    # group of blocks i <= j: number i * width + j; a tried block meets all blocks, another the tried ones
    others = F.when(F.col("tried"), F.sequence(F.lit(0), F.col("__w") - 1)).otherwise(F.sequence(F.lit(0), F.col("__t") - 1))
    number = lambda j: (F.least(F.col("__i"), j) * F.col("__w") + F.greatest(F.col("__i"), j)).cast("long")
    blocks = F.when(one, F.array(F.lit(0).cast("long"))).otherwise(F.transform(others, number))
    return rows.withColumn("block", F.explode(blocks))


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, size: int) -> DataFrame:
    """sid and whole shingle set, from the texts, of the nodes in `wanted` (sid, rep, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for part, texts in _texts(batches, 1):
            found = [shingles(t, words, size) for t in texts]
            keep = [i for i, (s, k) in enumerate(zip(found, part.column(0).to_pylist(), strict=True)) if len(s) and fingerprint(s) == k]
            if keep:
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep)), pa.array([found[i].view(np.int64) for i in keep], pa.list_(pa.int64()))], names=["sid", "members"])

    rows = docs.select(F.col(id_col).cast("long").alias("__id"), _key(text).alias("__key"), F.col(text).cast("string").alias("__text"))
    return rows.join(wanted, F.col("__id").eqNullSafe(F.col("rep")) & (F.col("__key") == F.col("key"))).select("sid", "__text").mapInArrow(tidy(run), "sid binary, members array<long>").dropDuplicates(["sid"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link; a few sets are `a` of many pairs, so theirs come second."""
    both = pairs.join(sets.toDF("b", "y"), "b").join(sets.toDF("a", "x"), "a")
    common = F.size(F.array_intersect("x", "y"))
    return both.withColumn("__i", common).where(100 * F.col("__i") >= percent * (F.size("x") + F.size("y") - F.col("__i"))).select("a", "b")


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """(sid, head) for the ends of `edges`, a written table and its path, by contraction.

    A round points each node to the least of itself and its neighbours, carries the links over to what their ends point to and drops those within. Node numbers are hashes, so
    a round removes a fixed share of the nodes that still have links, and the links of a group of near copies go with the first one. Each round is a written table.
    """
    spark = edges.sparkSession
    levels: list[tuple[DataFrame, str]] = []
    links, path = materialise(edges.select("a", "b"))
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        levels.append(materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p"))))
        level = levels[-1][0]
        moved = links.join(level.toDF("a", "x"), "a").join(level.toDF("b", "y"), "b").where("x <> y")
        links, new_path = materialise(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        discard(spark, path)
        path = new_path
        if not links.limit(1).count():
            break
    out = levels[0][0].toDF("sid", "head")
    for level, _ in levels[1:]:
        out = out.join(level.toDF("head", "__up"), "head", "left").select("sid", F.coalesce("__up", "head").alias("head"))
    found = materialise(out)
    discard(spark, path, *(p for _, p in levels))
    return found


def _placed(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85, bits: int = 22, cells: int = 128, small: int = 64, per_block: int = 1024, per_weight: int = 1 << 20, max_broadcast: int = 200_000
) -> tuple[DataFrame, list[str]]:
    """doc_id, key, n, sid, head (a node of the component) and component_id of every row; links are at 100 * J >= percent. The written tables that they are read from come with them."""
    spark = docs.sparkSession
    rarity = spark.sparkContext.broadcast(sketch(docs, text, size, bits))
    rows, rows_path = materialise(signatures(docs, id_col, text, size, percent, rarity, bits, cells))
    rarity.destroy()
    full = rows.where("sid is not null")
    nodes, nodes_path = materialise(
        full.groupBy("sid").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("m"), *(F.first(c).alias(c) for c in ("n", "bands", "pivots", "cells")))
        .select("sid", F.col("m.doc_id").alias("rep"), F.col("m.key").alias("key"), "n", "bands", "pivots", "cells")
    )
    origin = nodes.select("sid", "rep", "key")

    def sets_of(sids: DataFrame) -> tuple[DataFrame, str]:
        wanted, wanted_path = materialise(sids.distinct().join(origin, "sid"))
        few = wanted.count() <= max_broadcast  # rows of 50 bytes; more of them, and the texts are shuffled to them
        out = materialise(_sets(docs, F.broadcast(wanted) if few else wanted, id_col, text, size))
        discard(spark, wanted_path)
        return out

    # near copies first: sets that share a band with another are compared with the least such set
    banded = nodes.select("sid", "n", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min(F.struct("sid", "n")).alias("m"), F.count("*").alias("k")).where("k > 1").select("band", F.col("m.sid").alias("a"), F.col("m.n").alias("__n"))
    alike = banded.join(least, "band").where((F.col("sid") != F.col("a")) & (100 * F.least("n", "__n") >= percent * F.greatest("n", "__n")))
    pairs, pairs_path = materialise(alike.select("a", F.col("sid").alias("b")).distinct())
    sets, sets_path = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("sid")))
    first, first_path = materialise(_verified(pairs, sets, percent))
    known, known_path = components(first)
    discard(spark, pairs_path, sets_path, first_path)
    # then all that is not in the largest component of its region
    held = nodes.select("sid", F.explode("pivots").alias("region"))
    shared = held.groupBy("region").agg(F.count("*").alias("k")).where("k > 1").select("region")
    points = nodes.select("sid", "n", "cells").join(known, "sid", "left").select("sid", "n", "cells", F.coalesce("head", "sid").alias("comp"))
    held, held_path = materialise(held.join(shared, "region").join(points, "sid"))
    by_comp = held.groupBy("region", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("w"))
    several = by_comp.groupBy("region").agg(F.max(F.struct("k", "comp", "w")).alias("top"), F.sum("k").alias("k"), F.sum("w").alias("w"), F.count("*").alias("c")).where("c > 1")
    sizes = several.select("region", F.col("top.comp").alias("__top"), F.col("top.k").alias("n_rest"), F.col("top.w").alias("w_rest"), F.expr("k - top.k").alias("n_tried"), F.expr("w - top.w").alias("w_tried"))
    regions = held.join(sizes, "region").withColumn("tried", F.col("comp") != F.col("__top"))
    groups, groups_path = materialise(candidates(_blocked(regions, per_block, per_weight), percent, small))
    sets, sets_path = sets_of(groups.select("sid"))
    whole, whole_paths = merged(groups, per_block, per_weight)
    second, second_path = materialise(joined(whole, sets, percent))
    last, last_path = components(second)
    last = last.toDF("__h", "__t")
    discard(spark, held_path, groups_path, sets_path, second_path, *whole_paths)
    placed = nodes.select("sid", "rep").join(known, "sid", "left").withColumn("__h", F.coalesce("head", "sid")).join(last, "__h", "left").select("sid", "rep", F.coalesce("__t", "__h").alias("head"))
    placed, placed_path = materialise(placed)
    low = placed.groupBy("head").agg(F.min("rep").alias("__c"))
    final, final_path = materialise(placed.join(low, "head").select("sid", "head", "__c"))
    discard(spark, nodes_path, placed_path, known_path, last_path)
    out = rows.join(final, "sid", "left")
    return out.select("doc_id", "key", "n", "sid", "head", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("__c")).alias("component_id")), [rows_path, final_path]


def link(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; links are at 100 * J >= percent. Options are those of `_placed`."""
    return _placed(docs, **options)[0].select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` without all but one of each component: the one with the smallest id, of its rows the first by hash. Each row is judged by its own text, whatever other rows share its id.

    Rows without shingles link with nothing and stay, repeated ones too. Of the rows of a component that have a null id one stays as well.
    """
    found, paths = _placed(docs, id_col=id_col, text=text, **options)
    found = found.where("n > 0").select("doc_id", "key", "head")
    found, _ = materialise(found.groupBy("doc_id", "key", "head").agg(F.count("*").alias("k")))  # an id and a text have one component
    discard(docs.sparkSession, *paths)
    first = found.groupBy("head", F.col("doc_id").isNull().alias("__null")).agg(F.min(F.struct("doc_id", "key")).alias("m")).select(F.col("m.doc_id").alias("__id"), F.col("m.key").alias("__key"))
    is_first = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key"))
    drop = found.join(first, is_first, "left_anti").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    twice = found.where("k > 1").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.lit(True).alias("__twice"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (_key(text) == F.col("__key"))
    flagged = docs.join(drop, same, "left_anti").join(twice, same, "left")
    once = flagged.where("__twice is null").select(*docs.columns)
    # what is left of repeated rows: one each, by the least hash of the row
    repeated = flagged.where("__twice").withColumn("__h", F.xxhash64(*docs.columns))
    least = repeated.groupBy(F.col("__id").alias("__i"), F.col("__key").alias("__k")).agg(F.min("__h").alias("__first"))
    chosen = repeated.join(least, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__key") == F.col("__k")) & (F.col("__h") == F.col("__first")))
    return once.unionByName(chosen.dropDuplicates(["__id", "__key"]).select(*docs.columns))
