"""Spelling variants: words at edit distance one, found by a self-join of a vocabulary trie with active-node sets.

The vocabulary is parted by prefix. Of two words at distance one, the shorter of m characters, either the first m div 2 characters are equal or the last m - m div 2 are, so each word
goes to the parts of these keys for m its own length and one less, and no pair is lost. A part with more than `part_words` words is parted again by the same rule within what is still open of its words; a pair belongs to
one part only, the one that follows the prefix where both rules hold.

Within a part a trie is walked in depth-first order. Each node carries the set of nodes whose distance from it is one: its parent, its children, its siblings, and those that are reached by the node's own
character from the parent's set. Where two words end at such nodes they are a pair.

Then each word takes its most frequent near word as its form, if that is `times` times as frequent, and follows forms to the last one by doubling.

Defined cases: null and empty texts have no words, an empty table gives no rows. Rows that share an id, and repeated rows, count each. A null id stands as the empty text where variants are made. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import discard, materialise, tidy

#: One byte a character: letters stay, A-Z in lower case; all others, and those outside of Latin-1, part words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, as Latin-1, A-Z in lower case."""
    return (text or "").encode("latin-1", "replace").translate(_TABLE).split()


def damaged(prefix: int, run: bytes, one_in: int) -> bytes:
    """The run, less one character if the crc32 that goes on from `prefix` is divisible by `one_in`."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", one_in: int = 199, least_chars: int = 6, least: int = 5, held: int = 400_000) -> DataFrame:
    """(word, n): the words of all texts; each task counts first, `held` words at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(w.decode("latin-1"), n) for w, n in counts.items() if len(w) >= least_chars]
            counts.clear()
            for k in range(0, len(rows), 16384):
                words, n = zip(*rows[k : k + 16384], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                prefix = zlib.crc32(f"{'' if i is None else i}:".encode())
                for w, n in Counter(runs(t)).items():
                    counts[damaged(prefix, w, one_in)] += n
                if len(counts) >= held:
                    yield from flush()
        yield from flush()

    each = docs.select(F.col(id_col).cast("string"), F.col(text).cast("string")).mapInArrow(tidy(run), "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _open(m: Column, a: Column, b: Column) -> Column:
    return F.floor((m - a - b) / 2).cast("int")


def _parts(rows: DataFrame) -> DataFrame:
    """Rows (word, m, path, a, b), each once by prefix and once by suffix: the first a and the last b characters are equal in a part, `path` says by which steps."""
    f = _open(F.col("m"), F.col("a"), F.col("b"))
    ways = F.array(
        F.struct(F.concat("path", F.lit("p")).alias("path"), (F.col("a") + f).alias("a"), F.col("b").alias("b")),
        F.struct(F.concat("path", F.lit("s")).alias("path"), F.col("a").alias("a"), (F.col("m") - F.col("a") - f).alias("b")),
    )
    split = rows.select("word", "m", F.explode(ways).alias("x")).select("word", "m", "x.*")
    key = F.concat_ws("|", "m", "path", F.substring(F.col("word"), F.lit(1), F.col("a")), F.substring(F.col("word"), F.length("word") - F.col("b") + 1, F.col("b")))
    return split.withColumn("key", key)


def belongs(u: str, v: str, m: int, path: str) -> bool:
    """Whether the pair is the part's: at each step by prefix where that holds, else by suffix."""
    a = b = 0
    for way in path:
        f = (m - a - b) // 2
        if (u[a : a + f] == v[a : a + f]) != (way == "p"):
            return False
        a, b = (a + f, b) if way == "p" else (a, m - a - f)
    return True


def near_in(words: list[str], a: int, b: int) -> Iterator[tuple[str, str]]:
    """Pairs at distance one of distinct words that share their first a and last b characters: a trie of what is between, its nodes numbered as they come."""
    children: list[dict[str, int]] = [{}]
    ends: list[str | None] = [None]
    for w in words:
        node = 0
        for c in w[a : len(w) - b]:
            child = children[node].get(c)
            if child is None:
                child = children[node][c] = len(children)
                children.append({})
                ends.append(None)
            node = child
        ends[node] = w
    stack: list[tuple[int, list[int]]] = [(0, list(children[0].values()))]
    while stack:
        node, active = stack.pop()
        if ends[node] is not None:
            for other in active:
                if other > node and ends[other] is not None:
                    yield ends[node], ends[other]
        own = children[node]
        for c, child in own.items():
            reached = {node, *children[child].values(), *(x for x in own.values() if x != child)}
            reached.update(x for x in (children[y].get(c) for y in active) if x is not None and x != child)
            stack.append((child, list(reached)))


def near_pairs(words: DataFrame, *, part_words: int = 50_000) -> DataFrame:
    """(u, v) for all pairs of the column `word`, whose values are distinct, at edit distance one; each pair once."""
    spark = words.sparkSession
    lengths = F.filter(F.array(F.length("word"), F.length("word") - 1), lambda m: m >= 1)
    rows = words.select("word", F.explode(lengths).alias("m"), F.lit("").alias("path"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    left, done, paths = _parts(rows), [], []
    while True:
        parts, path = materialise(left)
        paths.append(path)
        sizes = parts.groupBy("key").agg(F.count("*").alias("size"), F.first(_open(F.col("m"), F.col("a"), F.col("b"))).alias("open"))
        # one open character or none can't be parted; such a part has the words of a few characters' choices at most
        large = sizes.where((F.col("size") > part_words) & (F.col("open") > 0)).select("key")
        if large.limit(1).count() == 0:
            done.append(parts)
            break
        done.append(parts.join(large, "key", "left_anti"))
        left = _parts(parts.join(large, "key", "left_semi").select("word", "m", "path", "a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("key", "word", "m", "path", "a", "b")), strict=True))
        found: list[tuple[str, str]] = []
        for _, group in groupby(rows, key=lambda r: r[0]):
            own = list(group)
            if len(own) < 2:
                continue
            _, _, m, path, a, b = own[0]
            found += [(u, v) for u, v in near_in([r[1] for r in own], a, b) if min(len(u), len(v)) == m and belongs(u, v, m, path)]
            if len(found) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*found, strict=True)], names=["u", "v"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*found, strict=True)], names=["u", "v"])

    out = [d.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(run), "u string, v string") for d in done]
    pairs, _ = materialise(reduce(DataFrame.unionByName, out))
    discard(spark, *paths)
    return pairs


def roots(links: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of (word, form), forms followed to the last by `rounds` doublings: paths of up to 2 ** rounds links."""
    state = links.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        further = state.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        joined = state.join(further, F.col("root") == F.col("__w"), "left").select("word", F.coalesce("__r", "root").alias("root"))
        state, _ = materialise(joined)
    return state


def variants(words: DataFrame, *, times: int = 5, part_words: int = 50_000) -> DataFrame:
    """word, n, n_near, form, form_n and root of every row of (word, n)."""
    words, _ = materialise(words.select("word", "n"))
    pairs = near_pairs(words, part_words=part_words)
    both = pairs.union(pairs.select("v", "u")).toDF("word", "other")
    with_n = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
    best = with_n.groupBy("word").agg(F.count("*").alias("n_near"), F.max("m").alias("m"), F.min_by("other", F.struct(-F.col("m"), "other")).alias("other"))
    near = words.join(best, "word", "left")
    goes = F.col("m") >= times * F.col("n")
    near, _ = materialise(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(goes, F.col("other")).alias("form"), F.when(goes, F.col("m")).alias("form_n")))
    most = near.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    links = 1 + int(math.log(max(most, times)) / math.log(times))  # each link multiplies n by `times`
    root = roots(near.where("form is not null").select("word", "form"), math.ceil(math.log2(links + 1)))
    return near.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))
