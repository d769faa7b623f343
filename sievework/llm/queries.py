"""The queries op1 to op13 over the tables of a folder, and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import ann, bitslice, chat, html_extract, jaccard, langid, mixing, packing, ranking, secrets, spelling, substrings, toxicity
from sievework.llm.common import fold, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda x: x["rank"] < secrets.BASE)
    count = lambda kind: F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("secret_spans")).alias("spans"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(fold("doc_id") != 1))
    out = langid.identify(docs.select("doc_id", "text"), model, spans=False)
    return out.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "lang_pred", "score")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op5_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table holds turns, so they are written as raw transcripts first; the turns are what the parser recovers."""
    conversations = table(spark, sf_dir, "conversations")
    model = chat.fit(conversations)
    found = chat.parse(chat.as_transcripts(conversations), model)
    return found.withColumnRenamed("id", "conv_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold("doc_id") != 1)
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model)
    return out.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "score", "predicted")


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_posting_list_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, rows.where("vec_id % 20 = 0"), 20)


def op9_bitsliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return bitslice.top_k(rows, rows.where("vec_id % 50 = 0"), 5)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranking.build(table(spark, sf_dir, "documents"))
    return ranking.search(index, table(spark, sf_dir, "benchmark"), 20)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_secret_scan, op3_language_id, op4_mix_sources, op5_chat_turns, op6_toxicity, op7_harmonic_packing, op8_posting_list_search, op9_bitsliced_top_k, op10_jaccard_join,
        op11_ranked_search, op12_substring_dedup, op13_spelling_variants,
    )
}


def _spans_sql() -> str:
    """The secret scan as SQL: every rule over every text, offsets from what the expression leaves and takes."""
    parts = []
    for i, r in enumerate(secrets.RULES):
        # a look-behind becomes a group for what is before, and the match one for what is meant
        behind = re.match(r"\(\?<!\[(.*?)\]\)", r.pattern)
        pattern = f"(?:^|[^{behind[1]}])({r.pattern[behind.end() :]})" if behind else r.pattern
        e = "'" + pattern.replace("'", "''") + "'"
        begin = "s + length(f) - length(h)" if behind else "s"
        parts.append(
            f"""SELECT doc_id, {i} AS rank, '{r.kind}' AS kind, {begin} AS s, s + length(f) AS e FROM (
            SELECT doc_id, m[i] AS f, v[i] AS h, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s
            FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, {e}) AS m, regexp_extract_all(t, {e}, {1 if behind else r.group}) AS v, string_split_regex(t, {e}) AS g
              FROM d WHERE regexp_matches(t, {e})))) WHERE length(h) >= {r.least}"""
        )
    union = " UNION ALL ".join(parts)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.RULES[: secrets.BASE])
    text = "kind || ':' || s || ':' || e, ',' ORDER BY s, rank"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS ({union}),
        a AS (SELECT doc_id, {counts}, string_agg({text}) FILTER (rank < {secrets.BASE}) AS base, string_agg({text}) AS spans FROM s GROUP BY doc_id)
        SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.RULES[: secrets.BASE])}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""


#: The article of the tables' pages, which all have one of paragraphs and headings, by plain patterns.
_ARTICLE_SQL = """
        WITH b AS (SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?(?:p|h1)>') AS l FROM pages),
        c AS (SELECT page_id, url, list_transform(l, lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(x, '<br>', ' '), '</?b>', '', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))) AS l FROM b),
        t AS (SELECT page_id, url, array_to_string(list_filter(l, lambda x: x <> ''), chr(10)) AS text FROM c)
        SELECT page_id, url, text, length(text) AS n_chars FROM t"""
ORACLES: dict[str, str] = {
    "op1_html_extraction": _ARTICLE_SQL,
    "op2_secret_scan": _spans_sql(),
    "op9_bitsliced_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
              FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 5""",
    "op11_ranked_search": r"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
        i AS (SELECT row_number() OVER () AS r, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
        q AS (SELECT r, item_id, t, count(*) AS times FROM i GROUP BY ALL),
        p AS (SELECT k, doc_id, len(w) AS n, unnest(w) AS t FROM d),
        tf AS (SELECT k, doc_id, n, t, count(*) AS tf FROM p WHERE t IN (SELECT t FROM q) GROUP BY ALL),
        df AS (SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY t, n_docs),
        s AS (SELECT r, item_id, k, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total)))) AS BIGINT) AS score FROM tf JOIN q USING (t) JOIN df USING (t), c GROUP BY ALL),
        o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
        SELECT * FROM o WHERE rank <= 20""",
    "op12_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        p AS (SELECT k, doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) > 12),
        x AS (SELECT k, doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS h FROM p),
        f AS (SELECT h, min(doc_id) AS first FROM x GROUP BY 1),
        g AS (SELECT DISTINCT k, unnest(range(i, i + 13)) AS i FROM x JOIN f USING (h) WHERE first < doc_id OR (doc_id IS NULL AND first IS NOT NULL)),
        u AS (SELECT k, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
        o AS (SELECT k, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM u ANTI JOIN g USING (k, i) GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN o USING (k)""",
    "op13_spelling_variants": r"""
        WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS w FROM documents),
        e AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM r GROUP BY 1, 2),
        b AS (SELECT w, n, list_transform(range(0, len(x)), lambda i: CAST(strpos('0123456789ABCDEF', x[(i + 1 - 2 * (i % 2)) + 1]) - 1 AS BIGINT)) AS nibbles FROM e),
        h AS (SELECT w, n, xor(4294967295, list_reduce(nibbles, lambda c, v: xor(c >> 4,
            [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][xor(c & 15, v) + 1]), 4294967295::BIGINT)) AS h FROM b),
        y AS (SELECT CASE WHEN h % 199 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM h),
        v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM y WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
        k AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
        l AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS short FROM k),
        a AS (SELECT DISTINCT x.word AS u, y.word AS v FROM l x JOIN l y ON x.i = y.i AND x.short = y.short AND length(x.word) = length(y.word) AND x.word <> y.word
              UNION SELECT l.word, v.word FROM l JOIN v ON l.short = v.word UNION SELECT v.word, l.word FROM l JOIN v ON l.short = v.word),
        m AS (SELECT u AS word, count(*) AS n_near, arg_min(v.word, (-v.n, v.word)) AS other, max(v.n) AS m FROM a JOIN v ON a.v = v.word GROUP BY 1),
        t AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM v LEFT JOIN m USING (word)),
        z AS (SELECT word, word AS root FROM t UNION ALL SELECT z.word, t.form FROM z JOIN t ON z.root = t.word WHERE t.form IS NOT NULL)
        SELECT t.*, z.root FROM t JOIN z USING (word) JOIN t AS last ON last.word = z.root WHERE last.form IS NULL""",
}
