"""Language identification by script ranges, per-word scores and Viterbi with a switching penalty.

`fit` learns, from a bounded sample of labelled rows, log probabilities of character n-grams per language and the
scripts that each language uses. `identify` splits a text into words (runs of letters), lets the script of a word narrow
the candidate languages, scores the word for each candidate, and labels the words by the path of highest score that
pays a penalty for each change of language. Spans of one language are runs of words with one label.

Defined cases: a null or empty text, or one without letters, is `und` with score 0 and no spans. A word in a script
that no learned language uses has no candidates: it scores the same for all. With no labelled rows every text is `und`.
Ties go to the language that comes first by code point. Repeated rows get equal results; other columns pass through, and
input columns with the names of the outputs are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import tidy, unit_hash

#: First code points of ranges and the script of each; a range ends where the next begins.
SCRIPTS = (
    (0x0000, "common"), (0x0041, "latin"), (0x0250, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"),
)
_STARTS = np.array([a for a, _ in SCRIPTS])
_NAMES = sorted({s for _, s in SCRIPTS})
_SCRIPT_OF = np.array([_NAMES.index(s) for _, s in SCRIPTS])
_LETTERS = re.compile(r"[^\W\d_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)
SPANS = "array<struct<start:int,end:int,lang:string>>"


@dataclass
class Model:
    """langs by code point; logp[language, bucket]; allowed[language, script]."""

    langs: list[str]
    logp: np.ndarray
    allowed: np.ndarray
    max_n: int
    clip: float


def _grams(words: list[str], buckets: int, max_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of all words, the word of each, and the script of each word."""
    points = np.frombuffer(("\x02" + "\x02\x02".join(words) + "\x02").encode("utf-32-le"), np.uint32).astype(np.uint64)
    edge = points == 2
    word = (np.cumsum(edge) - 1) // 2  # each word has an edge before it and one after it
    first = np.flatnonzero(edge)[::2] + 1
    script = _SCRIPT_OF[np.searchsorted(_STARTS, points[first].astype(np.int64), "right") - 1]
    out, owner, h = [], [], np.zeros(len(points), np.uint64)
    for n in range(1, max_n + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        h = (h[:m] + points[n - 1 :] + np.uint64(n)) * _MULT
        h ^= h >> np.uint64(29)
        whole = word[:m] == word[n - 1 :]
        if n == 1:
            whole &= ~edge
        out.append((h[whole] >> np.uint64(17)) % np.uint64(buckets))
        owner.append(word[:m][whole])
    return np.concatenate(out).astype(np.int64), np.concatenate(owner), script


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", sample_docs: int = 3000, sample_chars: int = 1 << 26, buckets: int = 1 << 15, max_n: int = 4, clip: float = 6.0, seed: int = 7) -> Model:
    """Learns from `sample_docs` distinct labelled texts at most, shared evenly among the languages.

    Rows are chosen by a hash of their text, at a rate set by the count of their language; of these the texts of the lowest hashes are taken, each once however often it is repeated, up to the
    language's share of `sample_docs` and, but for the first, of `sample_chars`. Those two bound what the driver gathers. Null texts and null languages are left out.
    """
    rows = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).where("t is not null and l is not null")
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((0, buckets), np.float32), np.zeros((0, len(_NAMES)), bool), max_n, clip)
    share = max(1, sample_docs // len(langs))
    rate = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, share / counts[k]))])
    chosen = rows.where(unit_hash("t", seed=seed) < rate[F.col("l")]).withColumn("h", F.xxhash64("t", F.lit(seed)))
    first = Window.partitionBy("l").orderBy("h")
    sizes = chosen.groupBy("l", "h").agg(F.max(F.length("t")).alias("n")).withColumn("r", F.row_number().over(first)).where(F.col("r") <= share).collect()
    left, kept = dict.fromkeys(langs, sample_chars // len(langs)), set()
    for x in sorted(sizes, key=lambda x: (x["l"], x["r"])):
        if x["r"] == 1 or x["n"] <= left[x["l"]]:
            kept.add(x["h"])
            left[x["l"]] -= x["n"]
    got = chosen.where(F.col("h").isin(*kept)).groupBy("l", "h").agg(F.min("t").alias("t")).select("t", "l").toArrow()
    logp = np.zeros((len(langs), buckets), np.float32)
    allowed = np.zeros((len(langs), len(_NAMES)), bool)
    texts: dict[str, list[str]] = {k: [] for k in langs}
    for t, k in zip(got["t"].to_pylist(), got["l"].to_pylist(), strict=True):
        texts[k].append(t)
    for i, k in enumerate(langs):
        count = np.full(buckets, 0.05)
        scripts = np.zeros(len(_NAMES))
        for t in texts[k]:
            if words := _LETTERS.findall(t.lower()):
                grams, _, script = _grams(words, buckets, max_n)
                count += np.bincount(grams, minlength=buckets)
                scripts += np.bincount(script, minlength=len(_NAMES))
        logp[i] = np.log(count / count.sum())
        allowed[i] = scripts >= 0.005 * max(1.0, scripts.sum())
    return Model(langs, logp, allowed, max_n, clip)


def word_scores(model: Model, words: list[str]) -> np.ndarray:
    """For each word its score per language: at most 0, at least -clip; 0 for all if its script has no candidates."""
    grams, owner, script = _grams(words, model.logp.shape[1], model.max_n)
    order = np.argsort(owner, kind="stable")
    starts = np.searchsorted(owner[order], np.arange(len(words)))
    s = np.add.reduceat(model.logp[:, grams[order]], starts, axis=1).T
    fits = model.allowed[:, script].T
    s = np.where(fits, s, -np.inf)
    best = s.max(axis=1, keepdims=True)
    return np.where(np.isfinite(best), np.maximum(s - np.where(np.isfinite(best), best, 0), -model.clip), 0).astype(np.float32)


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best label path of each score matrix (words x languages); all paths advance together, longest first."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    live = lengths > 0
    order, lengths = [i for i, x in zip(order, live, strict=True) if x], lengths[live]
    paths = [np.zeros(0, np.int16) for _ in scores]
    if not order:
        return paths
    n_langs = scores[order[0]].shape[1]
    flat = np.concatenate([scores[i] for i in order])
    base = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # how many have more than t words
    stay, top = np.empty((len(flat), n_langs), bool), np.empty(len(flat), np.int16)
    v = flat[base].astype(np.float64)
    final = np.empty(len(order), np.int64)
    for t in range(1, lengths[0]):
        n = active[t]
        if n < len(v):
            final[n : len(v)] = v[n:].argmax(1)
            v = v[:n]
        at = base[:n] + t
        best = v.argmax(1)
        change = v[np.arange(n), best] - penalty
        keep = v >= change[:, None]
        stay[at], top[at] = keep, best
        v = np.where(keep, v, change[:, None]) + flat[at]
    final[: len(v)] = v.argmax(1)
    label = np.empty(len(flat), np.int16)
    state = final.copy()
    for t in range(lengths[0] - 1, -1, -1):
        n = active[t]
        at = base[:n] + t
        label[at] = state[:n]
        if t:
            state[:n] = np.where(stay[at, state[:n]], state[:n], top[at])
    for i, b, n in zip(order, base, lengths, strict=True):
        paths[i] = label[b : b + n]
    return paths


class _Words(dict):
    """Numbers words as they come; `held` counts their characters."""

    held = 0

    def __missing__(self, w):
        n = self[w] = len(self)
        self.held += len(w)
        return n


def _label(model: Model, texts: list[str | None], words: _Words, known: np.ndarray, penalty: float, spans: bool) -> tuple[np.ndarray, list, list, list, list]:
    number = words.__getitem__
    lower = [(x or "").lower() for x in texts]
    found = [list(map(number, _LETTERS.findall(x))) for x in lower]
    if len(words) > len(known):
        new = list(islice(words, len(known), None))
        size = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in new], np.float32)
        scores = [word_scores(model, new[i : i + 4096]) for i in range(0, len(new), 4096)]
        known = np.concatenate([known, np.column_stack([np.concatenate(scores), size])])
    tables = [known[np.array(f, np.int64)] for f in found]
    paths = viterbi([x[:, :-1] for x in tables], penalty)
    langs, scores, shares, runs = [], [], [], []
    for raw, low, x, path in zip(texts, lower, tables, paths, strict=True):
        if not len(path) or not x[:, -1].any():  # no words, or such as are fractions and superscripts only
            langs.append("und"), scores.append(0.0), shares.append(0.0), runs.append([])
            continue
        letters = np.bincount(path, weights=x[:, -1], minlength=len(model.langs))
        k = int(letters.argmax())
        total = x[:, :-1].sum(0, dtype=np.float64)
        post = np.exp(total - total.max())
        langs.append(model.langs[k])
        first = np.argmax(total) == k
        shares.append(float(letters[k] / letters.sum() * (post[k] / post.sum() if first else 1)))
        scores.append(shares[-1] if first else shares[-1] / 2)
        if spans:
            cut = np.flatnonzero(np.diff(path)) + 1
            at = [(m.start(), m.end()) for m in _LETTERS.finditer(raw if len(raw) == len(low) else low)] if len(cut) else None
            if at is None:
                m = _LETTERS.search(raw)
                end = next(i for i in range(len(raw), 0, -1) if _LETTERS.match(raw[i - 1]))
                runs.append([{"start": m.start(), "end": end, "lang": model.langs[path[0]]}])
            else:
                edges = [0, *cut.tolist(), len(path)]
                runs.append([{"start": at[a][0], "end": at[b - 1][1], "lang": model.langs[path[a]]} for a, b in zip(edges, edges[1:], strict=False)])
    return known, langs, scores, shares, runs


def identify(docs: DataFrame, model: Model, *, text: str = "text", penalty: float = 12.0, spans: bool = True, share: str | None = None, batch_rows: int = 512, cache_words: int = 100_000, cache_chars: int = 4_000_000) -> DataFrame:
    """Adds lang_pred, score and, with `spans`, lang_spans (code points of the text; half-open) to every row.

    `share` names one more column: the score, but not halved where the words in sum speak for another language than the one with most letters, as in texts of several languages.

    Map-only: the model, whose size the parameters of `fit` fix, goes with the tasks; scores of words are kept between batches up to `cache_words` and `cache_chars`. Offsets of a text whose lower case has another
    length than itself count in the lower case.
    """
    added = ["lang_pred", "score", *(["lang_spans"] if spans else []), *([share] if share else [])]
    src = docs.drop(*added)
    schema = T.StructType([*src.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if spans:
        schema = schema.add("lang_spans", T._parse_datatype_string(SPANS))
    if share:
        schema = schema.add(share, T.DoubleType())
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
    shared = src.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words, known = _Words(), np.zeros((0, len(m.langs) + 1), np.float32)
        for whole in batches:
            for k in range(0, whole.num_rows, batch_rows):
                part = whole.slice(k, batch_rows)
                texts = part.column(text).to_pylist()
                if m.langs:
                    if len(words) > cache_words or words.held > cache_chars:
                        words, known = _Words(), known[:0]
                    known, langs, scores, shares, runs = _label(m, texts, words, known, penalty, spans)
                else:
                    langs, scores, shares, runs = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts), [[] for _ in texts]
                cols = [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), *([pa.array(runs, kind)] if spans else []), *([pa.array(shares, pa.float64())] if share else [])]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])

    return src.mapInArrow(tidy(run), schema)
