"""Ranked lexical search by Fagin's threshold algorithm over an impact-sorted, document-partitioned index.

`build` cuts the documents into blocks where they are. A block holds its vocabulary and, for each term, its documents and how often they
hold it; with it come the counts of the corpus (documents with a term, terms, documents of each term). `search` turns a block into impact-sorted lists of the terms
in question and a forward index, and answers each item there: all its lists are read from the top in turn, a document that is met for the first time is
scored whole by the forward index, and reading ends when the threshold (the sum of what the lists could still give) falls strictly
below the k-th score so far. A task keeps the best of all its blocks, so later blocks end early; Spark merges what the tasks kept.

Impacts depend on the mean length of all documents, so lists are sorted when they are searched, not when blocks are written.

Whole blocks pass between the JVM and Python, so their integers take as few bytes as the largest of a block needs: mostly three or four for a document of a term and how often it holds it.
Blocks of items meet all blocks of the index; a block of the index passes once for each block of items, so these are large. A block is bounded by `block_docs` and `block_postings` (one document may be more by itself), a block of items by
`block_items` and `block_terms` (one item likewise).

Defined cases: a null or empty text, or one without terms, counts for nothing and is never found; an item without terms gives no rows; so does an
empty table. Repeated rows are documents, or items, of their own. A null doc_id can be found and comes last among equal scores. Fewer than k documents with a score over 0: all of them.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import materialise, tidy

#: Bytes of a term stay, A-Z in lower case; all others part terms. Bytes of 128 and more are parts of other characters.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LAST = np.iinfo(np.int64).max  # stands for a null id
_BLOCK = "ids binary, nulls binary, sizes binary, vocabulary binary, dfs binary, docs binary, counts binary"
_ITEMS = "item_block long, rows binary, ends binary, vocabulary binary, terms binary, weights binary"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order, as UTF-8."""
    return (text or "").encode().translate(_TABLE).split()


@dataclass
class Index:
    """blocks: written; documents: those with a term; total: all terms of all documents."""

    blocks: DataFrame
    documents: int
    total: int


def _ints(b: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(b, kind)


def _packed(x: np.ndarray) -> bytes:
    """Integers of 0 and more, each in as many bytes as the largest needs."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))).newbyteorder("<")).tobytes()


def _unpacked(b: bytes, n: int) -> np.ndarray:
    """The n integers that `_packed` wrote."""
    return _ints(b, f"<u{len(b) // n if n else 1}")


def build(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", block_docs: int = 4096, block_postings: int = 1 << 19) -> Index:
    """The index of all terms of all documents. It doesn't move documents: blocks are made of what a task reads."""
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        ids, null, sizes, held, many, ends = [], [], [], [], [], [0]

        def flush() -> pa.RecordBatch:
            words = list(number)
            place = sorted(range(len(words)), key=words.__getitem__)
            at = np.empty(len(words), np.int64)
            at[place] = np.arange(len(words))
            term, count = at[np.concatenate(held)], np.concatenate(many)
            doc = np.repeat(np.arange(len(ids), dtype=np.int64), np.diff(ends))
            order = np.lexsort((doc, term))
            dfs = np.bincount(term, minlength=len(words))
            cols = [np.array(ids, "<i8"), np.array(null, np.uint8), np.array(sizes, "<i8"), b"\n".join(words[i] for i in place), _packed(dfs), _packed(doc[order]), _packed(count[order])]
            for x in (number, ids, null, sizes, held, many):
                x.clear()
            ends[:] = [0]
            return pa.RecordBatch.from_arrays([pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary()) for x in cols], names=names)

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = Counter(terms(t))
                if not own:
                    continue
                ids.append(0 if i is None else i), null.append(i is None), sizes.append(own.total())
                held.append(np.array([number.setdefault(w, len(number)) for w in own], np.int64))
                many.append(np.array(list(own.values()), np.int64))
                ends.append(ends[-1] + len(own))
                if len(ids) >= block_docs or ends[-1] >= block_postings:
                    yield flush()
        if ids:
            yield flush()

    blocks, _ = materialise(docs.select(F.col(id_col).cast("long"), F.col(text).cast("string")).mapInArrow(tidy(run), _BLOCK), large_rows=True)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [_ints(x) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in sizes], pa.int64()), pa.array([int(x.sum()) for x in sizes], pa.int64())], names=["n", "total"])

    all_ = blocks.select("sizes").mapInArrow(tidy(count), "n long, total long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    return Index(blocks, *all_)


def frequencies(index: Index) -> DataFrame:
    """(term, df): how many documents of each block hold a term, a row per block and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, dfs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = words.split(b"\n")
                df = _unpacked(dfs, len(found)).astype(np.int64)
                for k in range(0, len(found), 8192):
                    yield pa.RecordBatch.from_arrays([pa.array(found[k : k + 8192], pa.binary()), pa.array(df[k : k + 8192])], names=["term", "df"])

    return index.blocks.select("vocabulary", "dfs").mapInArrow(tidy(run), "term binary, df long")


def _asked(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """(row, item_id, term, times): the terms of each item; `row` tells rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, item, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = Counter(terms(t))
                n = len(own)
                yield pa.RecordBatch.from_arrays([pa.array([row] * n, pa.int64()), pa.array([item] * n, pa.int64()), pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.int64())], names=["row", "item_id", "term", "times"])

    numbered = items.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long"), F.col(text).cast("string"))
    return numbered.mapInArrow(tidy(run), "row long, item_id long, term binary, times long")


def _item_blocks(weighed: DataFrame, block_items: int, block_terms: int) -> DataFrame:
    """Items (row, and its terms with their weights) in blocks, as bytes, from the rows of each task."""
    names = [c.split()[0] for c in _ITEMS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list]] = []

        def flush() -> pa.RecordBatch:
            words = sorted({x["term"] for _, own in held for x in own})
            at = {w: i for i, w in enumerate(words)}
            flat = [x for _, own in held for x in own]
            cols = [np.array([r for r, _ in held], "<i8"), np.cumsum([len(own) for _, own in held], dtype="<i8"), b"\n".join(words), np.array([at[x["term"]] for x in flat], "<i8"), np.array([x["w"] for x in flat], "<i8")]
            out = [pa.array([held[0][0]], pa.int64()), *(pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary()) for x in cols)]
            held.clear()
            return pa.RecordBatch.from_arrays(out, names=names)

        for b in batches:
            for row, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append((row, own))
                if len(held) >= block_items or sum(len(x) for _, x in held) >= block_terms:
                    yield flush()
        if held:
            yield flush()

    return weighed.mapInArrow(tidy(run), _ITEMS)


class Lists:
    """A block as it is searched for the terms of a block of items: lists by falling impact, and what each document holds."""

    def __init__(self, block: dict, words: list[bytes], documents: int, total: int):
        ids, null = _ints(block["ids"]), np.frombuffer(block["nulls"], np.uint8).astype(bool)
        self.ids = np.where(null, _LAST, ids)
        own = {w: i for i, w in enumerate(block["vocabulary"].split(b"\n"))}
        at = np.array([own.get(w, -1) for w in words], np.int64)
        starts = np.concatenate([[0], np.cumsum(_unpacked(block["dfs"], len(own)), dtype=np.int64)])
        low = np.where(at >= 0, starts[at], 0)
        size = np.where(at >= 0, starts[at + 1] - low, 0)
        self.ends = np.concatenate([[0], np.cumsum(size)])
        pick = np.repeat(low - self.ends[:-1], size) + np.arange(self.ends[-1])
        doc, tf = (_unpacked(block[c], starts[-1])[pick].astype(np.int64) for c in ("docs", "counts"))
        term = np.repeat(np.arange(len(words)), size)
        m = 75 + (25 * _ints(block["sizes"]) * documents) // total
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
        order = np.lexsort((doc, -impact, term))
        self.docs, self.impacts = doc[order], impact[order]
        order = np.argsort(doc, kind="stable")
        self.row_terms, self.row_impacts = term[order], impact[order]
        self.rows = np.searchsorted(doc[order], np.arange(len(ids) + 1))
        self.weight = np.zeros(len(words), np.int64)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """By the forward index, for the weights at hand."""
        low, size = self.rows[docs], self.rows[docs + 1] - self.rows[docs]
        ends = np.cumsum(size)
        at = np.repeat(low - (ends - size), size) + np.arange(ends[-1])
        return np.add.reduceat(self.weight[self.row_terms[at]] * self.row_impacts[at], ends - size)

    def search(self, which: np.ndarray, weight: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray], step: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """The k best of `best` and of the block: ids and scores, highest first, ties by id. Each round reads the next `step` entries of every list, then twice as many."""
        ids, scores = best
        self.weight[which] = weight
        low, high = self.ends[which], self.ends[which + 1]
        seen = np.zeros(len(self.ids), bool)
        depth = 0
        while True:
            a, b = np.minimum(low + depth, high), np.minimum(low + depth + step, high)
            met = np.unique(np.concatenate([self.docs[x:y] for x, y in zip(a, b, strict=True)]))
            new = met[~seen[met]]
            if len(new):
                seen[new] = True
                s = self.scores(new)
                some = s > 0
                ids, scores = np.concatenate([ids, self.ids[new[some]]]), np.concatenate([scores, s[some]])
                top = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[top], scores[top]
            left = b < high
            threshold = int((weight[left] * self.impacts[b[left] - 1]).sum())
            if not left.any() or len(scores) == k and threshold < scores[-1]:
                break
            depth, step = depth + step, step * 2
        self.weight[which] = 0
        return ids, scores


def search(index: Index, items: DataFrame, k: int = 20, *, id_col: str = "item_id", text: str = "text", block_items: int = 512, block_terms: int = 1 << 15) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents."""
    spark = items.sparkSession
    out = "item_id long, rank int, doc_id long, score long"
    if not index.total:
        return spark.createDataFrame([], out)
    asked, _ = materialise(_asked(items, id_col, text))
    df = frequencies(index).join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * index.documents + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    weighed = asked.join(df, "term").groupBy("row").agg(F.collect_list(F.struct("term", (F.col("times") * weight).alias("w"))).alias("own"))
    blocks, _ = materialise(_item_blocks(weighed, block_items, block_terms))
    pairs = index.blocks.crossJoin(blocks)  # blocks of the index with blocks of the stated items; these, the smaller rows, are the side that a task may buffer
    documents, total = index.documents, index.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[int, tuple[np.ndarray, list]] = {}  # of the blocks of items met last

        def give(rows: np.ndarray, top: list) -> pa.RecordBatch:
            size = [len(i) for i, _ in top]
            ids = np.concatenate([i for i, _ in top])
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(rows, size)), pa.array(ids, mask=ids == _LAST), pa.array(np.concatenate([s for _, s in top]))], names=["row", "doc_id", "score"])

        for b in batches:
            for r in b.to_pylist():
                rows, ends = _ints(r["rows"]), _ints(r["ends"])
                if r["item_block"] not in tops:
                    if len(tops) >= 16:
                        yield give(*tops.pop(next(iter(tops))))
                    tops[r["item_block"]] = rows, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(rows)
                top = tops[r["item_block"]][1]
                which, weight = _ints(r["terms"]), _ints(r["weights"])
                lists = Lists({c: r[c] for c in ("ids", "nulls", "sizes", "dfs", "docs", "counts")} | {"vocabulary": r["index_words"]}, r["vocabulary"].split(b"\n"), documents, total)
                for i, (x, y) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
                    top[i] = lists.search(which[x:y], weight[x:y], k, top[i])
        for x in tops.values():
            yield give(*x)

    pairs = pairs.select("item_block", "rows", "ends", blocks["vocabulary"], "terms", "weights", "ids", "nulls", "sizes", index.blocks["vocabulary"].alias("index_words"), "dfs", "docs", "counts")
    found, _ = materialise(pairs.mapInArrow(tidy(run), "row long, doc_id long, score long"))
    w = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.join(asked.select("row", "item_id").distinct(), "row").select("item_id", "rank", "doc_id", "score")
