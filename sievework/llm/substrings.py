"""Substring dedup by compaction of a De Bruijn graph of token k-mers.

A window of k words is an edge between the nodes that its first and last k - 1 words are. Edges that documents share are kept, paths of them that no document enters, leaves or branches
from are compacted to one row each, and documents are covered by whole paths:

1. Documents of one word sequence are one text; of a text the smallest id counts. All windows of a copy with a larger id repeat, so it is done without a look at its windows.
2. Each window has a seed, the least hashed of its runs of `seed_words` words, at one place for equal windows. Seeds that two texts hold are found first, by batches: a batch sends a seed
   once, whatever the number of its texts that hold it, so a frequent seed meets others once a batch. Windows whose seed no other text holds are in one text only.
3. The windows left are edges, named by 128-bit hashes. Per edge: its source (the smallest doc_id, and place) and whether all its occurrences have one window before and one after them. Of consecutive edges
   of a source that have, all occurrences are consecutive too, so they are one path; its first edge stands for it.
4. Occurrences join the first edges of paths: a row per document and path, with the coordinates of the source. Words under paths whose source has a smaller id are removed.
5. The words of each path are hashed (sha256) in all documents that hold it, its source too. Should they differ anywhere, hashes of edges met by chance, and the graph is made anew with another salt.

Texts never reach the driver, and each step is a written table.

Defined cases: null texts, and those without words, have none and keep none; texts of fewer words than a window keep all. A null doc_id comes after all others. Rows that share an id are compared as texts but never remove
words from each other. Repeated rows get equal results. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import discard, materialise, release, tidy

_LAST = np.iinfo(np.int64).max  # stands for a null id
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)
_ATTEMPTS = 4


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, w: bytes) -> int:
        n = self[w] = len(self)
        return n


class _Words:
    """64-bit hashes of words; words are numbered as they come, up to a bound, and each is hashed once."""

    def __init__(self, salt: int, most: int = 400_000):
        self.salt, self.most, self.number, self.hashes = salt, most, _Numbers(), np.zeros(0, np.uint64)

    def __call__(self, texts: list[list[bytes]]) -> np.ndarray:
        """Of all words of all texts, in one array."""
        if len(self.number) > self.most:
            self.number, self.hashes = _Numbers(), np.zeros(0, np.uint64)
        number = self.number
        at = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        if len(number) > len(self.hashes):
            new = [xxhash.xxh3_64_intdigest(w, self.salt) for w in islice(number, len(self.hashes), None)]
            self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        return self.hashes[at]


def _mix(h: np.ndarray, odd: np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * odd
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def _runs(words: np.ndarray, size: int, odd: np.uint64) -> np.ndarray:
    """A hash of each run of `size` words, by place of its first."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = (h ^ words[j : j + n]) * odd
        h ^= h >> np.uint64(32)
    return _mix(h, odd)


def _windows(words: np.ndarray, window: int, size: int, odd: np.uint64) -> np.ndarray:
    """A hash of each window, of two runs that cover it where `size` allows."""
    n = len(words) - window + 1
    if n <= 0 or 2 * size < window:
        return _runs(words, window, odd)
    runs = _runs(words, size, odd)
    return _mix(runs[:n] * odd ^ _mix(runs[window - size :], odd), odd)


def _seeds(words: np.ndarray, lengths: list[int], size: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in one array: hashes of the runs of `size` words, the places of all windows, the text of each, and the place of its seed, the least run within it, the first on ties."""
    runs = _runs(words, size, _ODD[0])
    n = max(0, len(words) - window + 1)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    least, seed = runs[:n].copy(), np.arange(n)
    for j in range(1, window - size + 1):
        x = runs[j : j + n]
        low = x < least
        least = np.where(low, x, least)
        seed = np.where(low, np.arange(j, n + j), seed)
    place = np.flatnonzero(owner[:n] == owner[window - 1 :]) if n else np.zeros(0, np.int64)
    return runs, place, owner[place], seed[place]


def _chunks(rows: Iterator[tuple], most: int = 100_000) -> Iterator[list[tuple]]:
    """Rows, whose last entry is a list of words, in lists of about `most` words."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[-1])
        if n >= most:
            yield held
            held, n = [], 0
    if held:
        yield held


def _alike(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each run of equal values begins and ends."""
    if len(values):
        cut = np.flatnonzero(values[1:] != values[:-1]) + 1
        yield from zip([0, *cut.tolist()], [*cut.tolist(), len(values)], strict=True)


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _name(words: list[bytes]) -> bytes:
    """sha256 of the words joined by one blank; no word holds a blank."""
    return hashlib.sha256(b" ".join(words)).digest()


def _texts(docs: DataFrame, sizes: bool) -> DataFrame:
    """(at, name, text) of every row, or with `sizes` (at, name, n_words): at is the id to order by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            words = [_split(t) for t in texts]
            last = pa.array([len(w) for w in words], pa.int64()) if sizes else b.column(1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_name(w) for w in words], pa.binary()), last], names=["at", "name", "n_words" if sizes else "text"])

    return docs.select("__at", "__text").mapInArrow(tidy(run), "at long, name binary, " + ("n_words long" if sizes else "text string"))


def _shared_seeds(docs: DataFrame, buckets: int, window: int, size: int, salt: int, batch_words: int) -> DataFrame:
    """(text_id, seed): of each text the seeds that another one holds too. Seeds go to `buckets` groups by their hash, about as many to each."""
    schema = "bucket int, hashes binary, owner binary, names binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, names = _Words(salt), {}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            h, key = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((key, h))
            h, key = h[order], key[order]
            once = np.r_[True, (h[1:] != h[:-1]) | (key[1:] != key[:-1])]
            h, key = h[once], key[once]
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            many = np.diff(np.r_[start, len(h)])
            all_names = list(names)
            bucket = ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            several = np.repeat(many > 1, many)
            order = np.argsort(bucket, kind="stable")
            cols: dict[str, list] = {"bucket": [], "hashes": [], "owner": [], "names": []}
            first = np.zeros(len(h), bool)
            first[start] = True
            for a, z in _alike(bucket[order]):
                at = order[a:z]
                # what several texts of the batch hold is settled here: it goes to its owners as it is, and once, without one, to the other batches
                for kind in (0, 1):
                    mine = at[several[at]] if kind else at[first[at]]
                    if len(mine):
                        used, local = np.unique(key[mine], return_inverse=True)
                        cols["bucket"].append(int(bucket[at[0]])), cols["hashes"].append(h[mine].astype("<u8").tobytes())
                        cols["owner"].append((np.where(several[mine], -1 - local, local) if not kind else local).astype("<i4").tobytes() + bytes([kind]))
                        cols["names"].append(b"".join(all_names[x] for x in used))
                if len(cols["bucket"]) >= 256:
                    yield pa.RecordBatch.from_pydict(cols, kinds)
                    cols = {c: [] for c in cols}
            if cols["bucket"]:
                yield pa.RecordBatch.from_pydict(cols, kinds)
            names.clear(), held.clear()

        def fresh() -> Iterator[tuple[int, list[bytes]]]:
            for b in batches:
                for t in b.column(0).to_pylist():
                    w = _split(t)
                    if len(w) >= window and (name := _name(w)[:16]) not in names:
                        names[name] = len(names)
                        yield names[name], w

        kinds = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("owner", pa.binary()), ("names", pa.binary())])
        n = 0
        for part in _chunks(fresh()):
            texts = [w for _, w in part]
            runs, _, owner, seed = _seeds(words(texts), list(map(len, texts)), size, window)
            seed, first = np.unique(seed, return_index=True)
            held.append((runs[seed], np.array([k for k, _ in part])[owner[first]]))
            n += sum(map(len, texts))
            if n >= batch_words:
                yield from flush()
                n = 0
        if held:
            yield from flush()

    def settle(table: pa.Table) -> pa.Table:
        """Of one bucket: seeds that come from two batches with two texts, or from a batch where several held it."""
        hashes, owners, texts, seeds = [], [], [], []
        number: dict[bytes, int] = {}
        for h, o, n in zip(*(table.column(c).to_pylist() for c in ("hashes", "owner", "names")), strict=True):
            local = np.array([number.setdefault(n[i : i + 16], len(number)) for i in range(0, len(n), 16)], np.int64)
            own, h = np.frombuffer(o[:-1], "<i4"), np.frombuffer(h, "<u8")
            if o[-1]:
                texts.append(local[own]), seeds.append(h)
            else:
                hashes.append(h), owners.append(np.where(own >= 0, local[own], -1))
        if hashes:
            h, o = np.concatenate(hashes), np.concatenate(owners)
            order = np.lexsort((o, h))
            h, o = h[order], o[order]
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            end = np.r_[start[1:], len(h)]
            shared = np.repeat((o[start] < 0) | (o[start] != o[end - 1]), end - start) & (o >= 0)
            texts.append(o[shared]), seeds.append(h[shared])
        ids = np.array([int.from_bytes(n[:8], "big", signed=True) for n in number], np.int64)
        at, seed = np.concatenate(texts), np.concatenate(seeds)
        return pa.table({"text_id": pa.array(ids[at]), "seed": pa.array(seed.astype("<u8").view(np.int64))})

    sent = docs.select("__text").mapInArrow(tidy(send), schema)
    return sent.groupBy("bucket").applyInArrow(settle, "text_id long, seed long")


def _edges(held: DataFrame, window: int, size: int, salt: int) -> DataFrame:
    """(e, f, at, text_id, place, context) of the windows of (at, text_id, text, seeds) whose seed is among `seeds`. e, f: 128 bits; context: a hash of the windows before and after."""
    names = ["e", "f", "at", "text_id", "place", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(salt)
        apart = lambda owner: (owner.astype(np.uint64) + np.uint64(1)) * _ODD[0]  # noqa: E731  tells the texts of a chunk apart; that hashes meet can only add a window
        rows = ((at, text, np.array(seeds, np.int64), _split(t)) for b in batches for at, text, t, seeds in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for part in _chunks(rows):
            ats, texts, seeds, split = zip(*part, strict=True)
            lengths = list(map(len, split))
            w = words(split)
            runs, place, owner, seed = _seeds(w, lengths, size, window)
            mine = np.concatenate(seeds).view(np.uint64) ^ apart(np.repeat(np.arange(len(seeds)), list(map(len, seeds))))
            used, back = np.unique(seed, return_inverse=True)  # a seed has one owner: it lies within its window
            of = np.zeros(len(used), np.int64)
            of[back] = owner
            kept = np.isin(runs[used] ^ apart(of), mine)[back]
            e, f = _windows(w, window, size, _ODD[0]), _windows(w, window, size, _ODD[2])
            padded = np.concatenate([[np.uint64(0)], e, [np.uint64(0)]])
            starts = np.cumsum([0, *lengths[:-1]])
            place, owner = place[kept], owner[kept]
            first, last = place == starts[owner], place == starts[owner] + np.array(lengths)[owner] - window
            before, after = np.where(first, np.uint64(7), padded[place]), np.where(last, np.uint64(11), padded[place + 2])
            context = _mix(before * _ODD[0] ^ after * _ODD[1], _ODD[2])
            cols = [e[place].view(np.int64), f[place].view(np.int64), np.array(ats)[owner], np.array(texts)[owner], place - starts[owner], context.view(np.int64)]
            for a in range(0, len(place), 16384):
                yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 16384], pa.int64()) for c in cols], names=names)

    return held.select("at", "text_id", "text", "seeds").mapInArrow(tidy(run), "e long, f long, at long, text_id long, place long, context long")


def paths(edges: DataFrame) -> DataFrame:
    """(e, f, n, src_at, src_text, src_place): the paths of the shared edges, each by its first edge, its number of edges and its source."""
    shared = (
        edges.groupBy("e", "f").agg(F.min(F.struct("at", "text_id", "place")).alias("src"), F.max("at").alias("last"), F.min("context").alias("c"), F.max("context").alias("d"))
        .where("src.at < last")
        .select("e", "f", F.col("src.at").alias("src_at"), F.col("src.text_id").alias("src_text"), F.col("src.place").alias("src_place"), (F.col("c") == F.col("d")).alias("plain"))
    )
    w = Window.partitionBy("src_at", "src_text").orderBy("src_place")
    on = F.col("plain") & F.lag("plain").over(w) & (F.lag("src_place").over(w) == F.col("src_place") - 1)
    numbered = shared.withColumn("first", F.when(F.coalesce(on, F.lit(False)), None).otherwise(F.col("src_place")))
    grouped = numbered.withColumn("first", F.last("first", ignorenulls=True).over(w))
    return grouped.groupBy("src_at", "src_text", "first").agg(F.min_by(F.struct("e", "f"), "src_place").alias("x"), F.count("*").alias("n")).select("x.e", "x.f", "n", "src_at", "src_text", F.col("first").alias("src_place"))


def _cut(held: DataFrame, window: int) -> DataFrame:
    """(name, at, n_removed, kept, checks) of (name, at, text, spans): spans of paths by place, number of windows, path, and whether its words go; checks: a hash of each path's words."""
    kind = pa.list_(pa.struct([("e", pa.int64()), ("f", pa.int64()), ("words", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, kept, checks = [], [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                w = _split(text)
                gone = np.zeros(len(w) + 1, np.int64)
                own = []
                for s in spans:
                    a, z = s["place"], s["place"] + s["n"] + window - 1
                    own.append({"e": s["e"], "f": s["f"], "words": _name(w[a:z])[:16]})
                    if s["goes"]:
                        gone[a] += 1
                        gone[z] -= 1
                left = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                removed.append(len(w) - len(left)), kept.append(_name([w[i] for i in left.tolist()]).hex()), checks.append(own)
            yield pa.RecordBatch.from_arrays([b.column("name"), b.column("at"), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(checks, kind)], names=["name", "at", "n_removed", "kept", "checks"])

    return held.select("name", "at", "text", "spans").mapInArrow(tidy(run), "name binary, at long, n_removed long, kept string, checks array<struct<e:long,f:long,words:binary>>")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", window: int = 13, seed_words: int = 7, batch_words: int = 1 << 20, bucket_seeds: int = 1 << 18) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by one blank) of every row."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("__at"), F.col(text).cast("string").alias("__text"))
    rows, rows_path = materialise(_texts(plain, True))
    firsts = rows.groupBy("name").agg(F.min("at").alias("at"), F.first("n_words").alias("n_words")).withColumn("text_id", F.expr("conv(hex(substring(name, 1, 8)), 16, -10)").cast("long"))
    n_words = firsts.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    buckets = max(1, -(-int(n_words * 2 / (window - seed_words + 2)) // bucket_seeds))
    for attempt in range(_ATTEMPTS):
        salt = 0x5EED + attempt
        seeds, seeds_path = materialise(_shared_seeds(plain, buckets, window, seed_words, salt, batch_words))
        release(spark)
        asked = firsts.join(seeds.groupBy("text_id").agg(F.collect_list("seed").alias("seeds")), "text_id").select("name", "at", "text_id", "seeds")
        texts = _texts(plain, False)
        edges, edges_path = materialise(_edges(texts.join(asked.hint("shuffle_hash"), ["name", "at"]), window, seed_words, salt))
        release(spark)
        found, found_path = materialise(paths(edges))
        release(spark)
        met = edges.join(found, ["e", "f"]).select("at", "text_id", F.struct("place", "n", "e", "f", (F.col("src_at") < F.col("at")).alias("goes")).alias("span"))
        spans, spans_path = materialise(met.groupBy("at", "text_id").agg(F.collect_set("span").alias("spans")))
        discard(spark, seeds_path, edges_path, found_path)
        release(spark)
        wanted = spans.join(firsts.select("name", "at", "text_id"), ["at", "text_id"]).select("name", "at", "spans")
        cut, cut_path = materialise(_cut(texts.join(wanted.hint("shuffle_hash"), ["name", "at"]), window))
        discard(spark, spans_path)
        words = cut.select(F.explode("checks").alias("x")).select("x.*").groupBy("e", "f").agg((F.min("words") != F.max("words")).alias("differ"))
        if words.where("differ").limit(1).count() == 0:
            break
        discard(spark, cut_path)
    else:
        raise RuntimeError(f"hashes of windows met in {_ATTEMPTS} attempts")
    done = cut.groupBy("name").agg(F.first("n_removed").alias("removed"), F.first("kept").alias("kept"))
    out = rows.join(firsts.select("name", F.col("at").alias("first")), "name").join(done, "name", "left")
    copy = F.col("at") > F.col("first")
    whole = copy & (F.col("n_words") >= window)
    none = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.when(F.col("at") != _LAST, F.col("at")).alias("doc_id"),
        "n_words",
        F.when(whole, F.col("n_words")).when(copy, 0).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, none).otherwise(F.coalesce(F.when(~copy, F.col("kept")), F.lower(F.hex("name")))).alias("kept_sha256"),
    )
