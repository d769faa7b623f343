"""What used to be cut off: large vectors, long conversations, deep pages, long tokens; samples where one row repeats; columns whose names clash."""

import math
import random

import numpy as np
import pytest

import corpus_pipeline
from sievework.llm import ann, bitslice, chat, html_extract, langid, mixing, secrets


def test_large_finite_vectors_are_ranked_exactly(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(40)]
    rows += [(40, [1e8, 1.0, -2.0, 0.5]), (41, [1e30, -1e30, 3.0, 0.0]), (42, [-1e200, 1e200, 1.0, 2.0]), (43, [1e300, 2.0, 2.0, 2.0]), (44, [1e30, -1e30, 3.5, 0.0]), (45, [1e8, 1.0, -2.0, 0.5])]
    rows += [(50, [float("inf"), 0.0, 0.0, 0.0]), (51, None), (52, [1.0, None, 1.0, 1.0]), (53, []), (54, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in bitslice.top_k(df, df, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    exact = {i: [bitslice.whole(x, 256) for x in v] for i, v in rows if v and None not in v and all(map(math.isfinite, v))}
    assert exact[40][0] == 256 * 10**8 and exact[42][0] == -256 * int(1e200)
    most = (1 << 63) - 1
    for q, v in exact.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in exact.items() if i != q and len(w) == len(v))[:5]
        assert sorted(got.get(q, [])) == [(k + 1, i, max(-most, min(most, -s))) for k, (s, i) in enumerate(scores)]
    assert set(got) == set(exact) - {54}


def test_a_long_conversation_is_numbered_through(spark):
    cols = "conv_id long, turn int, role string, text string"
    rows = [(1, i, ("user", "assistant")[i % 2], f"{('please tell me about', 'here is what I know of')[i % 2]} topic {i}") for i in range(700)]
    rows += [(k, i, ("user", "assistant")[i % 2], f"{('please tell me about', 'here is what I know of')[i % 2]} thing {i}") for k in range(2, 40) for i in range(6)]
    df = spark.createDataFrame(rows, cols).repartition(3)
    model = chat.fit(df)
    t = chat.as_transcripts(df, chunk_turns=64)
    assert t.where("id = 1").count() == 11 and t.where("id = 1 and context > 0").count() == 10
    found = chat.parse(t, model)
    assert found.columns == ["id", "turn", "role", "text", "rendered"]
    mine = sorted((r["turn"], r["role"], r["text"]) for r in found.where("id = 1").collect())
    assert [m[0] for m in mine] == list(range(len(mine))) and 690 <= len(mine) <= 700
    text = "\n".join(m[2] for m in mine)
    assert all(f"topic {i}\n" in text + "\n" for i in range(700))
    whole = chat.parse(chat.as_transcripts(df, chunk_turns=1000), model).where("id = 1")
    assert [(r["turn"], r["role"], r["text"]) for r in whole.orderBy("turn").collect()] == mine


def test_deep_pages_lose_their_menus():
    deep = "<div>" * 9000 + "<nav>menu</nav><p>body</p>" + "</div>" * 9000
    assert html_extract.text_of(deep) == "body"
    open_ended = "<div><section>" * 30_000 + "</p></article>" * 30_000 + "<nav>menu</nav><p>body</p>"
    assert html_extract.text_of(open_ended) == "body"


def test_long_header_of_a_token(spark):
    text = "x eyJ" + "a" * 5000 + ".eyJ" + "b" * 20 + "." + "c" * 20 + " y"
    found = secrets.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["secret_spans"]
    assert [(s["kind"], s["start"], s["end"]) for s in found if s["kind"] == "jwt"] == [("jwt", 2, len(text) - 2)]


def test_samples_stay_bounded_where_one_row_repeats(spark, monkeypatch):
    r = random.Random(5)
    words = {"en": ["the", "house", "of", "green"], "de": ["das", "haus", "der", "grün"]}
    text = lambda k: " ".join(r.choice(words[k]) for _ in range(8))
    rows = [(i, text("en"), "en") for i in range(3000)] + [(i, text("de"), "de") for i in range(3000)] + [(i, "the one text of the house", "en") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    grams = langid._grams
    monkeypatch.setattr(langid, "_grams", lambda w, *a: seen.append(len(w)) or grams(w, *a))
    for chars in (1 << 26, 2000):
        seen.clear()
        model = langid.fit(df, sample_docs=200, sample_chars=chars)
        assert model.langs == ["de", "en"] and 2 <= len(seen) <= 200
    assert len(seen) <= 120
    vectors = [(7, [1.0, 0.0, 0.5])] * 4000 + [(i, [float(x) for x in np.random.default_rng(i).normal(size=3)]) for i in range(500)]
    v = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4)
    sizes = []
    fit = ann.fit
    monkeypatch.setattr(ann, "fit", lambda s, *a, **k: sizes.append(len(s)) or fit(s, *a, **k))
    assert ann.search(v, v.where("vec_id = 11"), 3, sample_rows=100).count() == 3
    assert sizes and max(sizes) <= 200


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_of_small_and_large_sources(spark, seed):
    r = random.Random(seed)
    rows = [(i, " ".join(["w"] * r.randint(0, 60)), s) for i, s in enumerate(r.choices(["a", "b", "c", "d", None, "tiny"], [400, 200, 100, 50, 20, 2], k=2500))] + [(9001, "one two three", "three"), (9002, None, "none")]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep=["doc_id", "source"]).collect()
    taken, size, target = {}, {}, {}
    for x in out:
        taken[x["source"]] = taken.get(x["source"], 0) + x["taken"]
        size[x["source"]], target[x["source"]] = x["source_size"], x["target"]
        assert 0 <= x["taken"] <= 2 * x["size"]
    assert all(abs(taken[s] - target[s]) <= max(2, size[s] / 16 + 40) for s in taken), (taken, target)


def test_stages_keep_columns_with_names_of_outputs(spark):
    r = random.Random(3)
    words = {"en": ["the", "house", "of", "green", "river"], "de": ["das", "haus", "der", "grün", "fluß"]}
    rows = [(i, " ".join(r.choice(words[k]) for _ in range(40)) + (f" password=abcdefgh{i:08d}" if i % 5 == 0 else ""), k, f"s{i % 3}", None) for i, k in enumerate(["en", "de"] * 60)]
    rows += [(200, None, "en", "s0", 3), (201, "", None, None, 3), (None, rows[4][1], "en", "s1", 4), (3, rows[4][1], None, "s1", 4), rows[0], rows[0]]
    clash = ["secret_spans", "size", "target", "source_size", "taken", "score", "lang_pred", "lang_spans", "__share", "key", "head", "n"]
    df = spark.createDataFrame([(*x, *range(len(clash))) for x in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in clash)).repartition(3)
    plain = df.drop(*clash)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df, plain = stage(spark, df, ""), stage(spark, plain, "")
        got = df.collect()
        assert df.columns == [*plain.columns, *clash] and all(x[c] == i for x in got for i, c in enumerate(clash)), name
        key = lambda x: str(tuple(x[c] for c in plain.columns))
        assert sorted(map(key, got)) == sorted(map(key, plain.collect())) and got, name
        df, plain = (spark.createDataFrame(x.collect(), x.schema) for x in (df, plain))
    pieces = corpus_pipeline.STAGES[-1][1](spark, df, "")
    assert sorted(map(str, pieces.select("doc_id", "start", "length").collect())) == sorted(map(str, corpus_pipeline.STAGES[-1][1](spark, plain, "").select("doc_id", "start", "length").collect()))
