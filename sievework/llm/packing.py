"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A document's ids, with an end id, are cut into whole sequences and a rest. The rest loses at most `max_cuts` pieces of exactly
capacity/j ids, the largest that fits each time, and what stays goes to the class of the largest j with length <= capacity/j.
A sequence of class j holds exactly j pieces: the k-th piece of a class lies in bin k div j. Pieces are numbered within each
task and class as they are cut; the counts of tasks and classes, summed up in task order, make the numbers global, so
tasks fill bins independently and only the last bin of a class stays short.

Defined cases: a null or empty text is the end id alone; an empty table has no pieces; repeated rows are packed one by one;
a text of any length is tokenised whole. Extra columns are dropped.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import materialise, tidy

#: Splits text before merges as the byte-level tokenizer does, for texts of the characters that _PLAIN lists only.
_L = "A-Za-zªµºÀ-ÖØ-öø-ʯ"
_S = "\\t\\n\\v\\f\\r "
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^{_S}{_L}0-9]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_PLAIN = re.compile("[\\t\\n\\v\\f\\r -~¡-©«-±´¶-¸»¿-ʯ‐-‧‰-⁞€™]*")


def cut(n: int, capacity: int, max_cuts: int, smallest: int) -> list[tuple[int, int]]:
    """(length, j) of the pieces of a document of n ids, in order; j pieces of that class fill a sequence."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    last = capacity // smallest
    for _ in range(max_cuts):
        if not rest:
            break
        j = -(-capacity // rest)
        if j > last:
            break
        if capacity // j < rest:  # can't be, but for rounding
            j += 1
        size = capacity // j
        if size * j < 0.97 * capacity or size == rest:
            break
        out.append((size, j))
        rest -= size
    if rest:
        j = min(last, capacity // rest)
        out.append((rest, j))
    return out


class _Words(dict):
    """The ids of a word, as little-endian 32-bit bytes, from the tokenizer's own merges."""

    def __init__(self, merges, most: int):
        self.merges, self.most = merges, most

    def __missing__(self, word: str) -> bytes:
        ids = np.array([t.id for t in self.merges(word.encode().decode("latin-1").translate(_BYTES))], "<u4").tobytes()
        if len(self) < self.most and len(word) <= 64:
            self[word] = ids
        return ids


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers write bytes with: printable Latin-1 stands for itself, the rest for what follows 255, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTES = _byte_letters()


def byte_level(tok) -> bool:
    """Whether a tokenizer splits texts and writes bytes as _SPLIT and _BYTES do."""
    made = json.loads(tok.to_str())
    split = made.get("pre_tokenizer") or {}
    return split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not made.get("normalizer") and not made["model"].get("ignore_merges")


def tokens(path: str, usual: bool | None = None, cache_words: int = 100_000):
    """A function from a text to its ids as bytes.

    With a byte-level tokenizer of the usual kind, texts of common characters are split into words here and each word's ids are kept; all other texts, those that hold
    one of the tokenizer's added tokens, and those for any other tokenizer go through the tokenizer whole. Both ways give the same ids.
    """
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    usual = byte_level(tok) if usual is None else usual
    words = _Words(tok.model.tokenize, cache_words)

    def ids(text: str) -> bytes:
        if usual and not any(t in text for t in added) and _PLAIN.fullmatch(text):
            return b"".join(map(words.__getitem__, _SPLIT.findall(text)))
        return np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    return ids


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, j int, task int, k long"


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 0, max_cuts: int = 2, smallest: int = 32) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Two passes: pieces are written once (ids and texts are not), then numbered. What is shuffled is a row per piece shorter than
    a sequence. The table of counts has a row per task and class.
    """
    from tokenizers import Tokenizer

    usual = byte_level(Tokenizer.from_file(tokenizer))  # told to the tasks, which needn't hold the vocabulary twice
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, task, number = tokens(tokenizer, usual), TaskContext.get().partitionId(), {}
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                part = whole.slice(at, 256)
                rows: list[tuple] = []
                for doc, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = memoryview(encode(t or "") + end)
                    total, start = len(ids) // 4, 0
                    for size, j in cut(total, capacity, max_cuts, smallest):
                        k = number.get(j, 0)
                        number[j] = k + 1
                        rows.append((doc, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), total, j, task, k))
                        start += size
                cols = list(zip(*rows, strict=True)) or [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    schema = T._parse_datatype_string(_PIECES)
    schema[0].dataType = docs.schema[id_col].dataType
    names = [f.name for f in schema.fields]
    kinds = [_arrow(f.dataType) for f in schema.fields]
    pieces, _ = materialise(docs.select(F.col(id_col), F.col(text).cast("string")).mapInArrow(tidy(run), schema))
    per = pieces.groupBy("j", "task").agg(F.count("*").alias("n"))
    w = Window.partitionBy("j").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).drop("n")
    n_classes = capacity // smallest + 1
    placed = pieces.join(per, ["j", "task"]).withColumn("__n", F.col("before") + F.col("k"))
    placed = placed.withColumn("sequence_id", F.expr(f"(__n div j) * {n_classes} + j"))
    full = placed.where("j = 1").withColumn("offset", F.lit(0).cast("long"))
    inside = Window.partitionBy("sequence_id").orderBy("__n").rowsBetween(Window.unboundedPreceding, -1)
    shared = placed.where("j > 1").withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long"))
    out = [F.col(names[0]).alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return full.select(*out).unionByName(shared.select(*out))


def _arrow(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)
