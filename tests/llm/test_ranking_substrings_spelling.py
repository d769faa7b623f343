"""Ranked search, substring dedup and spelling variants against brute force, on small vocabularies and odd rows."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sievework.llm import ranking, spelling, substrings

LAST = 2**63 - 1


def _texts(seed, n=70):
    """Few words, so that terms, windows and ties are many; nulls, empty texts, repeated ids and rows."""
    r = random.Random(seed)
    words = [f"{'Wé'[k % 2]}{k}" for k in range(3 + 4 * seed)]
    rows = [(r.choice([None, 1, 2, 3, *range(40)]), " ".join(r.choice(words) for _ in range(r.randint(0, 45)))) for _ in range(n)]
    long = [f"u{i}" for i in range(70)]
    rows += [(200 + j, " ".join([*long[j : 60 - j], f"x{j}", *long[: j * 2]])) for j in range(8)]
    return rows + [(5, None), (100, rows[3][1]), (101, rows[3][1]), (102, "a b c " * 20), (103, "a b c\t" * 30), (104, " \n\t "), *rows[:6]]


def _frame(spark, rows, key="doc_id"):
    """With columns whose names clash with those that the operators make."""
    clash = ["word", "n", "row", "rank", "score", "term", "at", "name", "e", "f", "key", "path", "__text"]
    return spark.createDataFrame([(*r, *range(len(clash))) for r in rows], f"{key} long, text string, " + ", ".join(f"{c} int" for c in clash)).repartition(4)


def _terms(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c if c.isalnum() or ord(c) > 127 else " " for c in text or "").split(" ")


def _ranked(docs, items, k):
    held = [(i, Counter(t for t in _terms(x) if t)) for i, x in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(t for t in _terms(text) if t), []
        for i, c in held:
            m = 75 + (25 * c.total() * n_docs) // total
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, n in asked.items() if c[t])
            if s > 0:
                scores.append((-s, LAST if i is None else i, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2])[:k])]
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_ranks_of_the_threshold_algorithm(spark, seed):
    docs = _texts(seed)
    items = [(i, t) for i, (_, t) in enumerate(docs[::5])] + [(1, "u1 U2 u1, x3."), (7, None), (8, "unseen"), (1, "u1 U2 u1, x3.")]
    want = sorted(_ranked(docs, items, 6), key=str)
    for block in (8192, 7):
        index = ranking.build(_frame(spark, docs), block_docs=block)
        got = ranking.search(index, _frame(spark, items, "item_id"), 6, block_items=5)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_lists_are_left_when_the_threshold_falls_below_the_kth_score(spark):
    docs = [(i, "rare " * 30 if i < 5 else "rare " + f"other{i} " * 40) for i in range(4000)]
    block = ranking.build(_frame(spark, docs).coalesce(1)).blocks.first().asDict()
    lists = ranking.Lists(block, [b"rare"], 4000, 400_000)
    calls = []
    scores = lists.scores
    lists.scores = lambda d: calls.append(len(d)) or scores(d)
    ids, _ = lists.search(np.array([0]), np.array([10]), 3, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    assert ids.tolist() == [0, 1, 2] and sum(calls) <= 200


def test_integers_of_a_block_take_as_many_bytes_as_its_largest_needs(spark):
    docs = [(i, f"a b{i % 9} c{i} a") for i in range(300)]
    block = ranking.build(_frame(spark, docs).coalesce(1)).blocks.first().asDict()
    assert len(block["docs"]) == 900 * 2 and len(block["counts"]) == 900 and len(block["dfs"]) == 2 * (300 + 9 + 1)
    for x in ([], [0], [255, 0], [256, 1], [65_535, 2], [65_536], [2**32 - 1], [2**32], [2**40, 7]):
        assert ranking._unpacked(ranking._packed(np.array(x, np.int64)), len(x)).tolist() == x
    long = [*((i, "a " * n + f"b z{n}") for i, n in enumerate((1, 255, 256, 65_535, 65_536, 70_000))), (9, "b b")]
    items = [(1, "a b"), (2, "a z256"), (3, "b b z1")]
    got = ranking.search(ranking.build(_frame(spark, long).coalesce(1)), _frame(spark, items, "item_id"), 6).collect()
    assert sorted(map(tuple, got), key=str) == sorted(_ranked(long, items, 6), key=str)


def test_a_block_of_the_index_passes_once_for_many_items(spark, monkeypatch):
    made, blocks = [], ranking._item_blocks
    monkeypatch.setattr(ranking, "_item_blocks", lambda *a: made.append(blocks(*a)) or made[-1])
    docs = _texts(1)
    items = [(i, t) for i, (_, t) in enumerate(docs * 3) if t and t.strip()]
    got = ranking.search(ranking.build(_frame(spark, docs)), _frame(spark, items, "item_id"), 6).collect()
    assert len(items) > 128 and made[0].count() == 1
    assert sorted(map(tuple, got), key=str) == sorted(_ranked(docs, items, 6), key=str)


def test_search_of_nothing(spark):
    empty = _frame(spark, [(1, "a")]).where("false")
    assert ranking.search(ranking.build(empty), _frame(spark, [(1, "a")], "item_id")).count() == 0
    assert ranking.search(ranking.build(_frame(spark, [(1, "a"), (2, "b")])), _frame(spark, [(1, "")], "item_id")).count() == 0


def _removed(rows, k=13):
    first = {}
    words = [(i, LAST if i is None else i, (t or "").encode().split()) for i, t in rows]
    for _, o, w in words:
        for p in range(len(w) - k + 1):
            first[tuple(w[p : p + k])] = min(first.get(tuple(w[p : p + k]), LAST), o)
    out = []
    for i, o, w in words:
        gone = {q for p in range(len(w) - k + 1) if first[tuple(w[p : p + k])] < o for q in range(p, p + k)}
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for q, x in enumerate(w) if q not in gone)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_removed_words(spark, seed):
    rows = _texts(seed)
    want = _removed(rows)
    assert sum(r[2] for r in want) > 100
    got = substrings.remove_repeats(_frame(spark, rows), batch_words=300, bucket_seeds=60)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_a_third_of_all_rows_are_copies(spark):
    text = " ".join(f"p{i}" for i in range(90))
    rows = [(i, text) for i in range(300)] + [(300 + i, f"new{i} " + text[: 40 + i]) for i in range(300)] + [(600 + i, " ".join(f"{i}q{j}" for j in range(30))) for i in range(300)]
    assert sorted(map(tuple, substrings.remove_repeats(_frame(spark, rows), batch_words=2000).collect()), key=str) == _removed(rows)


def test_hashes_that_meet_are_seen_and_made_anew(spark, monkeypatch):
    rows = [(1, " ".join(f"a{i}" for i in range(20))), (2, " ".join(f"b{i}" for i in range(20))), (3, " ".join(f"a{i}" for i in range(15)))]
    blunt = 0x5EED
    edges = substrings._edges
    monkeypatch.setattr(substrings, "_ATTEMPTS", 2)
    seen = []

    def spoiled(held, window, size, salt):
        seen.append(salt)
        df = edges(held, window, size, salt)
        return df if salt != blunt else df.selectExpr("1L AS e", "1L AS f", "at", "text_id", "place", "place AS context")

    monkeypatch.setattr(substrings, "_edges", spoiled)
    assert sorted(map(tuple, substrings.remove_repeats(_frame(spark, rows)).collect()), key=str) == _removed(rows)
    assert seen == [blunt, blunt + 1]


def _near(words):
    less, masked, out = defaultdict(set), defaultdict(set), set()
    for w in words:
        for i in range(len(w)):
            less[w[:i] + w[i + 1 :]].add(w)
            masked[i, w[:i] + "\0" + w[i + 1 :]].add(w)
    out |= {(min(v, w), max(v, w)) for w in words for v in less[w] if v != w}
    return out | {(a, b) for g in masked.values() for a in g for b in g if a < b}


@pytest.mark.parametrize("seed", [0, 1])
def test_near_pairs_of_a_trie(spark, seed):
    r = random.Random(seed)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randint(1, 9))) for _ in range(900)} | {"x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for most in (50_000, 3):
        got = [tuple(sorted(x)) for x in spelling.near_pairs(df, part_words=most).collect()]
        assert len(got) == len(set(got)) and set(got) == _near(words)


def test_forms_and_roots(spark):
    n = {"letters": 1000, "lettres": 5, "letterz": 200, "leterz": 40, "leterzz": 8, "lette": 3, "étalon": 30, "etalon": 6, "stalon": 30}
    out = {r["word"]: r for r in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert [(w, out[w]["n_near"], out[w]["form"], out[w]["form_n"], out[w]["root"]) for w in ("letters", "letterz", "leterz", "leterzz", "lettres", "etalon")] == [
        ("letters", 1, None, None, "letters"), ("letterz", 2, "letters", 1000, "letters"), ("leterz", 2, "letterz", 200, "letters"), ("leterzz", 1, "leterz", 40, "letters"),
        ("lettres", 0, None, None, "lettres"), ("etalon", 2, "stalon", 30, "stalon"),
    ]


def test_words_of_a_vocabulary(spark):
    import zlib

    rows = [(i, "Übergröße ×÷ naïveté—naïveté ABCDEF_ghijkl 漢字abcdef") for i in range(400)] + [(None, "Letters letters"), (7, None), (7, "")]
    want = Counter()
    for i, t in rows:
        for run in ("Übergröße", "naïveté", "naïveté", "abcdef", "ghijkl", "abcdef") if i is not None and t else ("letters", "letters") if t else ():
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    want = {w: n for w, n in want.items() if n >= 5 and len(w) >= 6}
    got = {r["word"]: r["n"] for r in spelling.vocabulary(_frame(spark, rows), held=3).collect()}
    assert got == want and got["abcdef"] > 700
    assert spelling.variants(spelling.vocabulary(_frame(spark, rows).where("false"))).count() == 0
