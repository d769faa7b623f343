"""Language ID, mixing, chat, toxicity and packing."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import chat, langid, mixing, packing, toxicity
from sievework.llm.queries import QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.01"


def best_path(scores, penalty):
    n = scores.shape[1]
    value = lambda p: sum(scores[i, s] for i, s in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:], strict=False))
    return max(value(p) for p in itertools.product(range(n), repeat=len(scores))), value


def test_language_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    many = [rng.normal(size=(k, 3)) * 4 for k in (5, 1, 0, 6, 3)]
    for penalty in (0.5, 3.0, 20.0):
        for s, p in zip(many, langid.viterbi(many, penalty), strict=True):
            if len(s):
                top, value = best_path(s, penalty)
                assert math.isclose(value(tuple(p)), top)
            else:
                assert len(p) == 0


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(5)
    rows = [(words(rng, "abcdef", 60), "aa") for _ in range(40)] + [(words(rng, "mnopqr", 60), "bb") for _ in range(40)] + [(words(rng, "абвгд", 60), "cc") for _ in range(40)]
    return langid.fit(spark.createDataFrame([*rows, (None, "aa"), ("x", None)], "text string, lang string"))


def test_language_spans(spark, model):
    a, b, c = "abc def fed cab bad dab face deaf", "mop pro porn norm romp mono moor noon", "баг дав гад вба"
    rows = [(1, f"{a}. {b}! {c}"), (2, None), (3, ""), (4, "123 -- ½²"), (5, "日本語"), (6, a), (7, a), (8, (a + " ") * 5000)]
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [s["lang"] for s in got[1]["lang_spans"]] == ["aa", "bb", "cc"]
    text = rows[0][1]
    assert [text[s["start"] : s["end"]] for s in got[1]["lang_spans"]] == [a, b, c]
    for k in (2, 3, 4):
        assert (got[k]["lang_pred"], got[k]["score"], got[k]["lang_spans"]) == ("und", 0.0, [])
    assert got[5]["lang_pred"] in model.langs and 0 <= got[5]["score"] <= 0.5
    assert got[6]["lang_pred"] == got[7]["lang_pred"] == got[8]["lang_pred"] == "aa" and got[6]["score"] == got[7]["score"]


def test_language_edge_cases(spark):
    none = langid.fit(spark.createDataFrame([], "text string, lang string"))
    out = langid.identify(spark.createDataFrame([("x", 1, "old")], "text string, score int, lang_pred string"), none).collect()
    assert [(r["text"], r["lang_pred"], r["score"]) for r in out] == [("x", "und", 0.0)]
    assert langid.identify(spark.createDataFrame([], "text string"), none).count() == 0


def test_language_held_out(spark):
    out = QUERIES["op3_language_id"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = out.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 200 and right >= 0.98 * n


def by_hand(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        i = max(range(len(votes)), key=lambda k: (votes[k] / (2 * got[k] + 1), -k))
        got[i] += 1
    return got


def test_sainte_lague_against_quotients():
    rng = random.Random(2)
    for _ in range(200):
        votes = [rng.randrange(1, 1000) for _ in range(rng.randrange(1, 8))]
        seats = rng.randrange(0, 60)
        assert mixing.sainte_lague(votes, seats) == by_hand(votes, seats)
    assert mixing.sainte_lague([5, 5], 10, [2, 3]) == [2, 3] and mixing.sainte_lague([0, 0], 5) == [0, 0]


def test_targets():
    t = mixing.targets([("a", 100), (None, 10), ("b", 100), ("c", 100)])
    assert t["a"] == 200 and t[None] == 20 and math.isclose(sum(t.values()), 465) and math.isclose(t["c"] / t["b"], 2)


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(400), rng.choice(["hot"] * 6 + ["b", "c", None])) for i in range(3000)] + [(1, None, "b"), (2, "x y", "tiny"), (2, "x y", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    assert len(out) == len(rows) and sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()), key=str)
    total, goal, size = {}, {}, {}
    for r in out:
        assert r["size"] == len((r["text"] or "").split()) and 0 <= r["taken"] <= 2 * r["size"]
        total[r["source"]] = total.get(r["source"], 0) + r["taken"]
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        goal[r["source"]] = r["target"]
    for s, g in goal.items():
        assert abs(total[s] - g) <= max(32, 0.01 * g) and all(r["source_size"] == size[s] for r in out if r["source"] == s)
    for s, g in mixing.targets(list(size.items())).items():
        assert math.isclose(goal[s], g)
    mixed = mixing.apply_mix(df, mixing.mix(df))
    assert mixed.columns == df.columns
    whole = {tuple(r) for r in df.collect()}
    assert all(tuple(r) in whole for r in mixed.collect())


def test_mix_edge_cases(spark):
    cols = "doc_id long, text string, source string, size string, s int, k int"
    assert mixing.mix(spark.createDataFrame([], cols)).count() == 0
    r = mixing.mix(spark.createDataFrame([(None, None, None, "x", 1, 2)], cols)).first()
    assert (r["size"], r["taken"], r["target"], r["s"], r["k"]) == (0, 0, 0.0, 1, 2)


def test_chat_viterbi_against_all_paths(spark):
    m = chat.count([[(1, "User: hi?"), (2, "Assistant: yes.\nmore")], [(0, "System: be good"), (1, "\nwhat?"), (2, "\nthis.")]])
    for text in ("User: a\nAssistant: b\nUser: c", "x?\n\ny.\nz", "Alice: hi\nBob: ho", "System: s\nQ: why?\nA: so."):
        _, _, rows, _ = chat.observe(text)
        value = lambda p: m.start[p[0]] + sum(m.move[a, b] for a, b in zip(p, p[1:], strict=False)) + sum(e[s, v[f]] for s, v in zip(p, rows, strict=True) for f, e in enumerate(m.emit))  # noqa: B023, E731
        assert math.isclose(value(chat.viterbi(m, rows).tolist()), max(map(value, itertools.product(range(6), repeat=len(rows)))))


def test_chat_turns_and_rendering(spark):
    conversations = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    m = chat.fit(conversations)
    assert chat.turns(m, "### User\nHow?\nTell me\n\n### Assistant\nLike this:\nstep 1: do") == [("user", "How?\nTell me"), ("assistant", "Like this:\nstep 1: do")]
    assert chat.turns(m, None) == chat.turns(m, "") == chat.turns(m, " \n\n") == []
    assert chat.render("user", "x") == "<|user|>\nx\n<|end|>\n"
    assert len(chat.turns(m, "User: a\nAssistant: b\n" * 20000)) == 40000
    got = QUERIES["op5_chat_turns"](spark, FOLDER)
    true = {}
    for r in conversations.collect():
        true.setdefault(r["conv_id"], []).append((r["turn"], r["role"]))
    want = {(c, i): role for c, v in true.items() for i, (_, role) in enumerate(sorted(v))}
    hits = sum(want.get((r["conv_id"], r["turn"])) == r["role"] for r in got.collect())
    assert hits >= 0.97 * len(want)


def test_chat_texts_come_back_whole(spark):
    """Texts of several paragraphs, fitted on other conversations than those that are read."""
    rng = random.Random(12)
    say = lambda: words(rng, "abcdefgh", rng.randrange(3, 30)).capitalize()
    rows = [(c, t, ("user", "assistant")[t % 2], f"{say()}?\n\n{say()}." if t % 2 == 0 else f"{say()}.\n\n    code {t}\n\n{say()}.") for c in range(200) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    m = chat.fit(df.where("conv_id < 100"))
    right = total = 0
    for r in (r for r in rows if r[0] >= 100 and r[1] == 0):
        mine = [x for x in rows if x[0] == r[0]]
        for notation in chat.NOTATIONS[:5]:
            got = chat.turns(m, "\n".join(notation[chat.ROLES.index(x[2])] + x[3] for x in mine))
            right, total = right + (got == [(x[2], x[3]) for x in mine]), total + 1
    assert right >= 0.97 * total


def test_chat_edge_cases(spark):
    cols = "conv_id long, turn long, role string, text string"
    m = chat.fit(spark.createDataFrame([], cols))
    assert chat.parse(chat.as_transcripts(spark.createDataFrame([], cols)), m).count() == 0
    rows = [(1, 0, "user", "hi?")] * 3 + [(1, None, None, None), (None, 1, "bot", "x")]
    t = chat.as_transcripts(spark.createDataFrame(rows, cols))
    assert t.count() == 2 and chat.parse(t, m).count() >= 1


def test_toxicity_generalises_to_misspellings(spark):
    rng = random.Random(8)
    rows = []
    for i in range(700):
        t = words(rng, "abcdefgh", 80).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                w = rng.choice(["scumbag", "idiotic", "moronic"])
                t[rng.randrange(80)] = w[:2] + w[2:].replace(w[3], rng.choice("xyz"), 1) if rng.random() < 0.5 else w
        rows.append((i, " ".join(t), int(bad)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3], "doc_id long, toxic int")
    m = toxicity.fit(docs, labels, min_docs=3)
    got = {r["doc_id"]: r for r in toxicity.score(docs, m).collect()}
    held = [(got[i]["score"], y) for i, _, y in rows if i % 3 == 0]
    assert all(0 <= s <= 1 for s, _ in held) and np.mean([(s >= 0.5) == y for s, y in held]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got.values())


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "d"), (2, "", "d"), (3, "x " * 100000, None)], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert [r["predicted"] for r in out] == [0] * 4 and all(r["score"] < 1e-6 for r in out)
    ones = spark.createDataFrame([(3, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    assert all(r["score"] > 0.99 for r in toxicity.score(docs, toxicity.fit(docs, ones)).collect())
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def ids_of(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


TEXTS = ["a  b\n\n c's don't it'll\t\tx  ", " 12ab34  ,,;; ünï ¿qué? “x” – y…z ", "中文 text ½²", "tab\x0b\x0c x\r\n  \n y", "<|endoftext|>", "a <|endoftext|> b", "<|endoftext", "x'S 'LL   \x85 \xa0 z", "", None, "word " * 3000, "é" * 5000, "ǅ ʰ ª º ٣ x1２", "\x00\x1c\x1d a\x7f"]


def test_tokens_equal_the_tokenizer():
    encode = packing.tokens(tokenizer_path())
    for t, want in zip(TEXTS, ids_of(TEXTS), strict=True):
        assert np.frombuffer(encode(t or ""), "<u4").tolist() == want[:-1], repr(t)


def test_cut_is_whole():
    for n in [*range(1, 2100), 4096, 40001]:
        pieces = packing.cut(n, 1024, 2, 32)
        assert sum(s for s, _ in pieces) == n and all(0 < s * j <= 1024 or (s <= 32 and j == 32) for s, j in pieces)


def test_packing_round_trip(spark):
    rng = random.Random(6)
    texts = TEXTS + [words(rng, "abcdefghij", rng.randrange(900)) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, task string").repartition(6)
    ids = ids_of(texts)
    by_seq, by_doc = {}, {}
    for r in packing.pack(df, tokenizer_path()).collect():
        by_seq.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] and zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
    for i, want in enumerate(ids):
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
        assert at == len(want)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert packing.pack(df.limit(0), tokenizer_path()).count() == 0
    twice = packing.pack(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string"), tokenizer_path())
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in twice.collect()) == [(0, 1), (1, 3), (1, 3)]
