"""Exact top-k by inner product of quantised vectors over a bit-sliced index.

Each component x becomes floor(scale * x). A block of rows is stored as bitmaps: slice j of component d holds bit j of every row's
value less the block's least value there. A query adds, for each set bit i of |q_d| and each slice j, the bitmap (its complement
where q_d is negative) at weight i + j; carry-save adders on whole bitmaps reduce each weight to one slice. The top rows are
selected from the most significant slice of the sums downward. The `dropped` lowest slices are not added: they bound the error of a sum,
so all rows that the bound leaves open are resolved from the stored integers. The result is exact.

Queries and index are both in blocks; every block of queries meets every block of rows. Index blocks are built where the rows
are, without a shuffle, and written with their bitmaps. Rows whose integers are so large that an inner product of two such could leave 64 bits (length times the square of the largest is 2^62 or more)
are in blocks of their own, with their components instead of bitmaps. Where a block of queries or of rows is of that kind, products in doubles and the bound of their error leave a few rows open, and those are resolved in
integers of any size. A score beyond 64 bits is given as the nearest of 64 bits; ranks go by the exact one.

Defined cases: null vectors, empty ones, and vectors with null or non-finite components take no part, nor do rows
with a null id; vectors meet those of their own length only; rows that share the query's id are its own. Repeated ids each count. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import materialise, tidy
from sievework.llm.vectors import pick, usable

_ONE = np.uint64(1)
_MOST = (1 << 63) - 1


def slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps [component, bit, word] of a matrix of integers less its columns' least values; those values."""
    low = values.min(axis=0)
    u = (values - low).astype(np.uint64)
    bits = max(1, int(u.max()).bit_length())
    words = -(-len(u) // 64)
    out = np.zeros((u.shape[1], bits, words), np.uint64)
    for j in range(bits):
        packed = np.packbits(((u >> np.uint64(j)) & _ONE).astype(np.uint8).T, axis=1, bitorder="little")
        full = np.zeros((u.shape[1], words * 8), np.uint8)
        full[:, : packed.shape[1]] = packed
        out[:, j] = full.view("<u8")
    return out, low


def add(stacks: dict[int, list[np.ndarray]]) -> list[np.ndarray | None]:
    """Sums bitmaps given by weight: one slice per weight, by full and half adders on all bitmaps of a weight at once."""
    out: list[np.ndarray | None] = []
    w = 0
    while stacks:
        stack = stacks.pop(w, None)
        s = np.concatenate(stack) if stack else None
        carry: list[np.ndarray] = []
        while s is not None and len(s) > 1:
            if len(s) == 2:
                carry.append((s[0] & s[1])[None])
                s = (s[0] ^ s[1])[None]
            else:
                m = len(s) // 3
                a, b, c = s[:m], s[m : 2 * m], s[2 * m : 3 * m]
                x = a ^ b
                carry.append((a & b) | (c & x))
                s = np.concatenate([x ^ c, s[3 * m :]])
        out.append(s[0] if s is not None else None)
        if carry:
            stacks.setdefault(w + 1, []).extend(carry)
        w += 1
    return out


def _ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def candidates(sums: list[np.ndarray | None], valid: np.ndarray, k: int, slack: int) -> np.ndarray:
    """A bitmap of the rows whose sum is at least the k-th highest less `slack`."""
    none = np.zeros_like(valid)
    top, tied, kth = none.copy(), valid.copy(), 0
    for w in range(len(sums) - 1, -1, -1):  # from the most significant slice down
        s = sums[w] if sums[w] is not None else none
        both = tied & s
        if _ones(top | both) >= k:
            tied, kth = both, kth | (1 << w)
        else:
            top |= both
            tied &= ~s
    least = kth - slack
    if _ones(valid) <= k or least <= 0:
        return valid
    above, equal = none.copy(), valid.copy()
    for w in range(max(len(sums), least.bit_length()) - 1, -1, -1):
        s = sums[w] if w < len(sums) and sums[w] is not None else none
        if least >> w & 1:
            equal &= s
        else:
            above |= equal & s
            equal &= ~s
    return above | equal


class Block:
    """A block of the index as it is searched."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, dropped: int, all_slices: np.ndarray | None = None):
        self.ids, self.values = ids, values
        if all_slices is None:
            all_slices, _ = slices(values)
        self.dropped = min(dropped, all_slices.shape[1] - 1)
        kept = all_slices[:, self.dropped :]
        self.signed = np.stack([kept, ~kept])
        n = len(ids)
        self.valid = np.full(-(-n // 64), np.uint64(0xFFFFFFFFFFFFFFFF))
        if n % 64:
            self.valid[-1] = (_ONE << np.uint64(n % 64)) - _ONE

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with the query's id."""
        size, sign = np.abs(q), (q < 0).astype(np.int64)
        stacks: dict[int, list[np.ndarray]] = {}
        for i in range(int(size.max()).bit_length()):
            d = np.flatnonzero(size >> i & 1)
            for j in range(self.signed.shape[2]):
                if len(d):
                    stacks.setdefault(i + j, []).append(self.signed[sign[d], d, j])
        valid = self.valid
        mine = np.flatnonzero(self.ids == own)
        if len(mine):
            valid = valid.copy()
            for m in mine:
                valid[m // 64] &= ~(_ONE << np.uint64(m % 64))
        # sums are in units of 2**dropped; a complement's lowest bits are off by as much as a slice's
        slack = -(-int(size.sum()) * ((1 << self.dropped) - 1) // (1 << self.dropped)) + 1 if self.dropped else 0
        rows = candidates(add(stacks), valid, k, slack)
        at = np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))
        scores = self.values[at] @ q
        p = pick(self.ids[at], scores, k)
        return self.ids[at][p], scores[p]


def whole(x: float, scale: int) -> int:
    """floor(scale * x), for any finite x."""
    return math.floor(x * scale) if abs(x) < 2.0**60 else int(x) * scale


def wide_search(ids: np.ndarray, rows: np.ndarray, own: int, q: np.ndarray, k: int, scale: int) -> tuple[np.ndarray, list[int]]:
    """Ids and exact scores of the k best rows but those with the query's id, of vectors whose integers may be of any size."""
    others = np.flatnonzero(ids != own)
    with np.errstate(over="ignore", invalid="ignore"):
        a, b = np.floor(rows[others] * scale), np.floor(q * scale)
        near = a @ b
        off = np.abs(a) @ np.abs(b) * ((len(q) + 2) * 2.0**-52)
        low = near - off
        known = np.isfinite(low)
        at_least = np.partition(low[known], -k)[-k] if known.sum() >= k else -np.inf
        open_ = others[~known | (near + off >= at_least)]
    exact = [whole(x, scale) for x in q.tolist()]
    scores = [sum(whole(x, scale) * y for x, y in zip(r, exact, strict=True)) for r in rows[open_].tolist()]
    top = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[open_[i]]))[:k]
    return ids[open_[top]], [scores[i] for i in top]


def _order(score: int) -> str:
    """Empty within 64 bits; else a text whose order is that of the scores beyond, on either side."""
    if -_MOST <= score <= _MOST:
        return ""
    digits = str(abs(score))
    up = f"{len(digits):04d}{digits}"
    return up if score > 0 else "".join(str(9 - int(c)) for c in up)


def _packed(values: np.ndarray) -> bytes:
    """Integers in the fewest bytes that hold them all."""
    for kind in ("<i2", "<i4"):
        if len(values) and np.iinfo(kind).min <= values.min() and values.max() <= np.iinfo(kind).max:
            return values.astype(kind).tobytes()
    return values.astype("<i8").tobytes()


def _integers(packed: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(packed, f"<i{len(packed) // (rows * dim)}").reshape(rows, dim).astype(np.int64)


def _blocks(rows: DataFrame, id_col: str, vec: str, scale: int, most: int, sliced: bool) -> DataFrame:
    """Blocks of up to `most` rows of one vector length, as bytes, from the rows of each task; with `sliced` their bitmaps as well, `bits` slices a component. Wide blocks hold the components themselves as doubles."""

    schema = "dim int, wide boolean, ids binary, vals binary" + (", bits int, slices binary" if sliced else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list] = {}

        def flush(dim: int, wide: bool, parts: list) -> pa.RecordBatch:
            ids, values = (np.concatenate(x) for x in zip(*parts, strict=True))
            cols = [pa.array([dim], pa.int32()), pa.array([wide]), pa.array([ids.astype("<i8").tobytes()]), pa.array([values.astype("<f8").tobytes() if wide else _packed(values)])]
            if sliced:
                maps = np.zeros((dim, 0, 0), np.uint64) if wide else slices(values)[0]
                cols += [pa.array([maps.shape[1]], pa.int32()), pa.array([maps.astype("<u8").tobytes()])]
            return pa.RecordBatch.from_arrays(cols, names=names)

        for b in batches:
            ids = b.column(0).to_numpy()
            lists = b.column(1)
            length = np.diff(lists.offsets.to_numpy())
            flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
            ends = np.cumsum(length)
            large = b.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(length):
                for wide in (False, True):
                    at = np.flatnonzero((length == dim) & (large == wide))
                    values = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                    values = values if wide else np.floor(values * scale).astype(np.int64)
                    parts = held.setdefault((int(dim), wide), [])
                    for k in range(0, len(at), most):
                        parts.append((ids[at[k : k + most]], values[k : k + most]))
                        if sum(len(x) for x, _ in parts) >= most:
                            yield flush(int(dim), wide, parts)
                            parts.clear()
        for (dim, wide), parts in held.items():
            if parts:
                yield flush(dim, wide, parts)

    largest = F.array_max(F.transform(vec, lambda x: F.greatest(F.abs(x.cast("double")) * scale + 1, F.lit(1.0))))
    return rows.select(F.col(id_col).cast("long"), F.col(vec), (largest * largest * F.size(vec) >= float(1 << 62)).alias("wide")).mapInArrow(tidy(run), schema)


def top_k(table: DataFrame, queries: DataFrame, k: int, *, id_col: str = "vec_id", vec: str = "embedding", scale: int = 256, dropped: int = 2, block_rows: int = 16384, block_queries: int = 128) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows of `table`."""
    good = usable(vec) & F.col(id_col).isNotNull()
    index, _ = materialise(_blocks(table.where(good), id_col, vec, scale, block_rows, True), large_rows=True)
    asked, _ = materialise(_blocks(queries.where(good), id_col, vec, scale, block_queries, False))
    # blocks of rows with blocks of the stated queries; these, the smaller ones, are the side that a task may buffer
    pairs = index.crossJoin(asked.toDF("q_dim", "q_wide", "q_ids", "q_vals")).select("q_dim", "q_wide", "q_ids", "q_vals", *index.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for b in batches:
            for q_dim, q_wide, q_ids, q_vals, dim, wide, ids, vals, bits, maps in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if q_dim != dim:
                    continue
                own, size = np.frombuffer(q_ids, "<i8"), len(ids) // 8
                if wide or q_wide:
                    rows = np.frombuffer(vals, "<f8").reshape(-1, dim) if wide else _integers(vals, size, dim) / scale
                    asked_ = np.frombuffer(q_vals, "<f8").reshape(-1, dim) if q_wide else _integers(q_vals, len(own), dim) / scale
                    got = [wide_search(np.frombuffer(ids, "<i8"), rows, int(i), v, k, scale) for i, v in zip(own, asked_, strict=True)]
                    exact = [s for _, x in got for s in x]
                    scores, order = [max(-_MOST, min(_MOST, s)) for s in exact], [_order(s) for s in exact]
                else:
                    q = _integers(q_vals, len(own), dim)
                    if last != ids:
                        last, block = ids, Block(np.frombuffer(ids, "<i8"), _integers(vals, size, dim), dropped, np.frombuffer(maps, "<u8").reshape(dim, bits, -1))
                    got = [block.search(int(i), v, k) for i, v in zip(own, q, strict=True)]
                    scores = np.concatenate([s for _, s in got])
                    order = [""] * len(scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, [len(x) for x, _ in got])), pa.array(np.concatenate([x for x, _ in got])), pa.array(scores, pa.int64()), pa.array(order, pa.string())],
                    names=["query_id", "vec_id", "score", "beyond"],
                )

    found = pairs.mapInArrow(tidy(run), "query_id long, vec_id long, score long, beyond string")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("beyond").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
