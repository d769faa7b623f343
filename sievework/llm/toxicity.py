"""Toxicity scores: subword-bag embeddings, averaged, into a linear softmax; both trained jointly in numpy.

A word's vector is the mean of the vectors of its hashed character 3- to 5-grams and of the word itself, a text's vector the
mean of its words' vectors, so a misspelling that was never seen shares most of its vectors with the word it hides. The two-class
softmax over the text's vector is trained with the embeddings by Adagrad; a group penalty on each bucket's vector keeps
those at zero that carry no signal, which is what lets a few words in a thousand decide. A trained text score is linear in
its words, so scoring caches one number per word.

Defined cases: a null text is empty; a text without letters scores the model's bias. With no labelled rows, or labels of
one class only, every score is the share of toxic labels (0 where there are none). Repeated rows get equal scores. Other columns pass through; input columns
with the names of the outputs are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import tidy, unit_hash

_LETTERS = re.compile(r"[^\W\d_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """weight[bucket]: what the bucket's vector adds along the softmax's axis; bias: the score of a text without letters."""

    weight: np.ndarray
    bias: float


def subwords(words: list[str], buckets: int, low: int = 3, high: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words in a row, and where each word's begin (one more entry than words)."""
    points = np.frombuffer(("\x02" + "\x02\x02".join(words) + "\x02").encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = (np.cumsum(points == 2) - 1) // 2
    out, owner, h = [], [], np.zeros(len(points), np.uint64)
    for n in range(1, high + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        h = (h[:m] + points[n - 1 :] + np.uint64(n)) * _MULT
        h ^= h >> np.uint64(29)
        if n >= low:
            whole = word[:m] == word[n - 1 :]
            out.append(((h[whole] >> np.uint64(17)) % np.uint64(buckets)).astype(np.int64))
            owner.append(word[:m][whole])
    out.append(np.array([zlib.crc32(w.encode()) % buckets for w in words], np.int64))
    owner.append(np.arange(len(words)))
    grams, owner = np.concatenate(out), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return grams[order], np.searchsorted(owner[order], np.arange(len(words) + 1))


def _spread(starts: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the n-grams of the picked words, one word after another, and where each begins."""
    n = (starts[1:] - starts[:-1])[picked]
    off = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(starts[picked] - off[:-1], n) + np.arange(off[-1]), off


def train(texts: list[str], labels: np.ndarray, *, buckets: int = 1 << 19, dims: int = 4, epochs: int = 14, rate: float = 0.5, penalty: float = 3e-5, batch: int = 64, min_docs: int = 10, seed: int = 5) -> Model:
    """Embeddings and softmax by minibatch Adagrad with a proximal group penalty; buckets in fewer than `min_docs` texts stay zero."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():
        p = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(buckets, np.float32), float(np.log(max(p, 1e-12) / max(1 - p, 1e-12))))
    vocab: dict[str, int] = {}
    docs = [np.array([vocab.setdefault(w, len(vocab)) for w in _LETTERS.findall(t.lower())], np.int64) for t in texts]
    grams, starts = subwords(list(vocab) or ["a"], buckets)
    df = np.zeros(buckets, np.int32)
    bags = []
    for d in docs:
        u, c = np.unique(d, return_counts=True)
        bags.append((u, c / max(1, len(d))))
        df[np.unique(grams[_spread(starts, u)[0]])] += 1
    used = df >= max(2, min(min_docs, len(docs) // 200))
    emb = (rng.standard_normal((buckets, dims)) * 0.1).astype(np.float32)
    emb[~used] = 0
    axis, bias = rng.standard_normal(dims), 0.0
    seen_e, seen_a, seen_b = np.zeros(buckets), np.zeros(dims), 0.0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // batch)):
            word = np.concatenate([bags[i][0] for i in at])
            share = np.concatenate([bags[i][1] for i in at])
            doc = np.repeat(np.arange(len(at)), [len(bags[i][0]) for i in at])
            u, back = np.unique(word, return_inverse=True)
            pos, off = _spread(starts, u)
            idx, n = grams[pos], np.diff(off)
            vec = np.add.reduceat(emb[idx], off[:-1], axis=0) / n[:, None] if len(u) else np.zeros((0, dims))
            mean = np.column_stack([np.bincount(doc, share * vec[back, k], len(at)) for k in range(dims)])
            p = 1 / (1 + np.exp(-(mean @ axis + bias)))
            err = (p - y[at]) / len(at)
            per_word = np.bincount(back, err[doc] * share, len(u)) / np.maximum(n, 1)  # times the axis: the gradient of each n-gram of a word
            hit, where = np.unique(idx, return_inverse=True)
            g = np.bincount(where, np.repeat(per_word, n), len(hit))[:, None] * axis[None]
            g_axis, g_bias = mean.T @ err, err.sum()
            seen_e[hit] += (g**2).sum(1)
            step = (rate / (np.sqrt(seen_e[hit]) + 1e-10))[:, None]
            x = emb[hit] - step * g
            x *= np.maximum(0, 1 - step * penalty / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12))
            x[~used[hit]] = 0
            emb[hit] = x
            seen_a += g_axis**2
            seen_b += g_bias**2
            axis -= rate * g_axis / (np.sqrt(seen_a) + 1e-10)
            bias -= rate * g_bias / (np.sqrt(seen_b) + 1e-10)
    return Model((emb @ axis).astype(np.float32), float(bias))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = 6400, toxic_share: float = 0.25, seed: int = 3, **options) -> Model:
    """Trains on at most about `sample_rows` labelled rows, chosen by a hash of their id: `toxic_share` of them toxic where there are as many.

    `sample_rows` bounds what is broadcast to find their texts and what the driver gathers. Rows with a null id, text or label are left out.
    """
    rows = labels.select(F.col(id_col).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y is not null")
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    most = {1: sample_rows * toxic_share, 0: sample_rows * (1 - toxic_share)}
    rate = [min(1.0, most[k] / n[k]) if n.get(k) else 0.0 for k in (0, 1)]
    chosen = rows.where(unit_hash("k", seed=seed) < F.when(F.col("y") == 1, rate[1]).otherwise(rate[0]))
    texts = docs.select(F.col(id_col).alias("k"), F.col(text).alias("t")).where("t is not null")
    got = texts.join(F.broadcast(chosen), "k").select("t", "y").toArrow()  # `sample_rows` small rows
    pairs = sorted(zip(got["t"].to_pylist(), got["y"].to_pylist(), strict=True))  # so that reruns agree
    return train([t for t, _ in pairs], np.array([int(v == 1) for _, v in pairs]), **options)


class _Words(dict):
    def __missing__(self, w):
        n = self[w] = len(self)
        return n


def score(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.7, batch_rows: int = 2048, cache_words: int = 250_000) -> DataFrame:
    """Adds score and predicted (1 from `threshold` on) to every row; map-only. The model's size is fixed by `buckets`."""
    src = docs.drop("score", "predicted")
    schema = T.StructType([*src.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = src.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words, known = _Words(), np.zeros(0, np.float64)
        for whole in batches:
            for at in range(0, whole.num_rows, batch_rows):
                part = whole.slice(at, batch_rows)
                if len(words) > cache_words:
                    words, known = _Words(), known[:0]
                number = words.__getitem__
                found = [np.array(list(map(number, _LETTERS.findall((t or "").lower()))), np.int64) for t in part.column(text).to_pylist()]
                if len(words) > len(known):
                    grams, starts = subwords(list(words)[len(known) :], len(m.weight))
                    known = np.concatenate([known, np.add.reduceat(m.weight[grams], starts[:-1], dtype=np.float64) / np.diff(starts)])
                z = np.array([known[f].mean() if len(f) else 0.0 for f in found]) + m.bias
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))], names=[f.name for f in schema.fields])

    return src.mapInArrow(tidy(run), schema)
