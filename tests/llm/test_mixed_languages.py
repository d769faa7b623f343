"""Texts of two known languages in the pipeline's first stage."""

import random

from sievework.llm import langid


def test_mixed_texts_of_known_languages_stay(spark, monkeypatch):
    import corpus_pipeline as p

    rng = random.Random(6)
    word = lambda letters, low, high: "".join(rng.choice(letters) for _ in range(rng.randrange(low, high)))
    kinds = {"aa": "abcdef", "bb": "mnopqr"}
    docs = [(i, " ".join(word(kinds[lang], 2, 7) for _ in range(60)), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    # more letters in long words of one language, more words in short ones of the other
    docs += [(1000 + i, " ".join([word(kinds[a], 11, 12) for _ in range(20)] + [word(kinds[b], 4, 5) for _ in range(45)]), a) for i, (a, b) in enumerate([("aa", "bb"), ("bb", "aa")] * 10)]
    docs += [(2000, "123 -- ½²", "aa"), (2001, None, "aa")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(df.where("doc_id < 1000"))
    halved = [r for r in langid.identify(df.where("doc_id between 1000 and 1999"), model).collect() if r["score"] < 0.3]
    assert halved
    monkeypatch.setattr(p.langid, "fit", lambda d: model)
    kept = p.language(spark, df, "")
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in docs if r[0] < 2000}
