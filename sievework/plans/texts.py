"""Text queries over documents, parties and conversations, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import text as t
from sievework.operators import audits, dedup, document
from sievework.sources.tables import table

EMAIL = t.LITERALS["EMAIL"]


def text_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(t.collapse(F.col("text"))).alias("hash"), F.length(t.collapse(F.col("text"))).cast("long").alias("n_chars"))


def canonical_digits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.length(t.digits(F.col("text"))).cast("long").alias("n_digits"), F.md5(t.digits(F.col("text"))).alias("hash"))


def canonical_form(spark: SparkSession, d: str) -> DataFrame:
    kind = F.expr("CASE c_custkey % 3 WHEN 0 THEN 'MOBILE_PHONE' WHEN 1 THEN 'EMAIL' ELSE 'NAME' END")
    return table(spark, d, "customer").select("c_custkey", t.canonical(F.concat(F.lit("\t "), "c_name", F.lit(" \n")), kind).alias("canonical"))


def redact_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys are planted in a text per event, since the tables hold none."""
    e = table(spark, d, "events")
    return e.select("event_id", t.redact_keys(F.concat(F.lit("call sk-"), F.col("user_id").cast("string"), F.lit("_x failed; "), F.col("event_type"))).alias("text"))


def literal_email(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.contains("text", F.lit("@"))).select("doc_id", F.size(t.literal(F.col("text"), "EMAIL")).alias("n_emails"))
    return docs.where("n_emails > 0")


def value_predicate(spark: SparkSession, d: str) -> DataFrame:
    kind = F.expr("CASE s_suppkey % 4 WHEN 0 THEN 'NAME' WHEN 1 THEN 'AGE' WHEN 2 THEN 'CARD_NUMBER' ELSE 'WORKPLACE' END")
    value = F.expr("CASE s_suppkey % 5 WHEN 0 THEN 'na' WHEN 1 THEN cast(s_suppkey as string) WHEN 2 THEN concat('1234-5678-9012-', s_suppkey) WHEN 3 THEN 'Some Name' ELSE s_name END")
    return table(spark, d, "supplier").select("s_suppkey", t.valid_value(value, kind).alias("valid"))


def missing_values(spark: SparkSession, d: str) -> DataFrame:
    value = F.expr("CASE n_nationkey % 6 WHEN 0 THEN ' N/A ' WHEN 1 THEN 'None' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN 'nano' ELSE n_name END")
    return table(spark, d, "nation").select("n_nationkey", t.missing(value).alias("missing"))


def char_sequence(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "benchmark")
    return b.select("item_id", F.posexplode(document.char_sequence(F.col("text"))).alias("i", "ch"))


def bio_labels(spark: SparkSession, d: str) -> DataFrame:
    """Characters of e-mail addresses by label; a text without an address costs no labels."""
    docs = table(spark, d, "documents").where(F.contains("text", F.lit("@"))).select("doc_id", "text", t.spans(F.col("text"), EMAIL).alias("s"))
    hit = docs.where("size(s) > 0").select("doc_id", F.explode("s").alias("x"))
    one = hit.select("doc_id", document.bio(F.col("x.form"), F.array(F.struct(F.lit(0).alias("begin"), F.length("x.form").alias("end"), F.lit("EMAIL").alias("label")))).alias("l"))
    return one.select("doc_id", F.explode("l").alias("label")).groupBy("doc_id", "label").agg(F.count("*").alias("n"))


def document_labels(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents through char_sequence and bio with all their addresses as spans: characters, a hash of their order, and labels by kind."""
    spans = F.transform(t.spans(F.col("text"), EMAIL), lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"), F.lit("EMAIL").alias("label")))
    docs = table(spark, d, "documents").select("doc_id", "text", spans.alias("s"))
    each = docs.select("doc_id", document.char_sequence(F.col("text")).alias("c"), document.bio(F.col("text"), F.col("s")).alias("l"))
    count = lambda label, name: F.size(F.filter("l", lambda x: x == label)).alias(name)
    return each.select("doc_id", F.size("c").alias("n_chars"), F.md5(F.array_join("c", "|")).alias("hash"), count("B-EMAIL", "n_begin"), count("I-EMAIL", "n_inside"), count("O", "n_outside"))


def email_spans(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.contains("text", F.lit("@")))
    return docs.select("doc_id", F.explode(t.spans(F.col("text"), EMAIL)).alias("x")).select("doc_id", F.col("x.begin").alias("begin"), F.col("x.end").alias("end"), F.col("x.form").alias("form"))


def mention_thirds(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.contains("text", F.lit("@"))).select("doc_id", F.length("text").alias("n"), F.explode(t.spans(F.col("text"), EMAIL)).alias("x"))
    return audits.thirds(docs, "doc_id", F.col("x.begin"), F.col("n"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    per = _lines(spark, d).select("doc_id", t.sentences(F.col("line")).alias("s"))
    return per.groupBy("doc_id").agg(F.sum(F.size("s")).alias("n_sentences"), F.max(F.array_max(F.transform("s", lambda x: F.length(x)))).alias("longest"))


def boilerplate_first(spark: SparkSession, d: str) -> DataFrame:
    out = dedup.first_copies(_lines(spark, d), ["doc_id"], "pos", F.lit("prose"), t.strip(F.col("line")))
    return out.where("dropped").select("doc_id", "pos", "keeper")


def section_shortage(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).withColumn("section", F.expr("pos div 3"))
    return audits.section_shortage(rows, ["doc_id", "section"], F.length("line"), F.lit(600)).withColumn("n_chars", F.col("n_chars").cast("long"))


def line_offsets(spark: SparkSession, d: str) -> DataFrame:
    return audits.with_offsets(_lines(spark, d).where("length(line) > 0"), "doc_id", "pos", "line").select("doc_id", "pos", F.col("start").cast("long").alias("start"))


def exact_dup_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_groups(table(spark, d, "documents"), "doc_id", t.collapse(F.col("text"))).where("n > 1")


def structure_islands(spark: SparkSession, d: str) -> DataFrame:
    kind = table(spark, d, "conversations").withColumn("kind", F.expr("CASE WHEN length(text) > 200 THEN 'long' ELSE 'short' END"))
    return dedup.islands(kind, ["conv_id"], "turn", "kind")


def structure_hash(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").withColumn("kind", F.expr("CASE WHEN length(text) > 200 THEN 'long' ELSE 'short' END"))
    return dedup.structure(rows, "conv_id", "turn", F.expr("turn div 2"), "kind", "text")


def structure_cap(spark: SparkSession, d: str) -> DataFrame:
    shape = structure_hash(spark, d)
    out = dedup.within_cap(shape, ["fingerprint"], "conv_id", 3)
    return out.groupBy("fingerprint").agg(F.count("*").alias("n"), F.count_if("passed").alias("n_passed"))


def adjacency(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of neighbouring turns by roles and gap."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, d, "conversations").withColumns({"before": F.lag("role").over(w), "gap": F.col("turn") - F.lag("turn").over(w)})
    return c.where("before is not null").groupBy("before", "role", "gap").agg(F.count("*").alias("n"))


def last_turns(spark: SparkSession, d: str) -> DataFrame:
    """The last two turns of each conversation, and whether a turn is beyond the sixth of its role there."""
    from pyspark.sql import Window

    c = table(spark, d, "conversations")
    w, r = Window.partitionBy("conv_id").orderBy(F.col("turn").desc()), Window.partitionBy("conv_id", "role").orderBy("turn")
    return c.withColumns({"from_end": F.row_number().over(w), "rank": F.row_number().over(r)}).where("from_end <= 2").select("conv_id", "turn", "from_end", (F.col("rank") > 6).alias("excess"))


QUERIES = {f.__name__: f for f in (
    text_normalise, canonical_digits, canonical_form, redact_keys, literal_email, value_predicate, missing_values, char_sequence, bio_labels, document_labels, email_spans, mention_thirds,
    sentence_split, boilerplate_first, section_shortage, line_offsets, exact_dup_groups, structure_islands, structure_hash, structure_cap, adjacency, last_turns,
)}

_C = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_E = "'[A-Za-z0-9_.+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'"
_LINES = "SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"
_S = """hits AS (SELECT doc_id, text, regexp_extract_all(text, {e}) AS m FROM documents WHERE contains(text, '@')),
        g AS (SELECT doc_id, m, string_split_regex(text, {e}) AS gaps, length(text) AS n FROM hits WHERE len(m) > 0),
        x AS (SELECT doc_id, n, m, gaps, unnest(range(1, len(m) + 1)) AS i FROM g),
        sp AS (SELECT doc_id, n, m[i] AS form, CAST(list_sum(list_transform(gaps[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(m[1:i-1], lambda v: length(v))), 0) AS INTEGER) AS b FROM x)""".format(e=_E)
_K = "CASE WHEN length(text) > 200 THEN 'long' ELSE 'short' END"
_SHAPE = f"""
        r AS (SELECT conv_id, turn, {_K} AS kind, turn // 2 AS sec, length(text) AS n FROM conversations),
        b AS (SELECT *, sum(CASE WHEN sec IS NOT DISTINCT FROM psec THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS block FROM (SELECT *, lag(sec) OVER (PARTITION BY conv_id ORDER BY turn) AS psec, lag(kind) OVER (PARTITION BY conv_id ORDER BY turn) AS pkind FROM r)),
        q AS (SELECT *, sum(CASE WHEN kind IS NOT DISTINCT FROM pkind AND block = pblock THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM (SELECT *, lag(block) OVER (PARTITION BY conv_id ORDER BY turn) AS pblock FROM b)),
        runs AS (SELECT conv_id, block, run, min(kind) AS k, count(*) AS c, sum(n) AS ch, min(turn) AS p0 FROM q GROUP BY ALL),
        bl AS (SELECT conv_id, block, string_agg(k || ':' || c, ',' ORDER BY p0) AS runs, sum(c) AS c, sum(ch) AS ch, min(p0) AS p0 FROM runs GROUP BY ALL),
        bd AS (SELECT conv_id, string_agg(CAST(c AS BIGINT) || '|' || runs || '|' || CAST((ch // c) // 40 AS BIGINT), ';' ORDER BY p0) AS body FROM bl GROUP BY 1),
        en AS (SELECT conv_id, arg_min(kind, turn) AS f, arg_max(kind, turn) AS l FROM r GROUP BY 1),
        fp AS (SELECT conv_id, sha256(body || '#' || f || '#' || l) AS fingerprint FROM bd JOIN en USING (conv_id))"""
ORACLES = {
    "text_normalise": f"SELECT doc_id, md5({_C}) AS hash, length({_C}) AS n_chars FROM documents",
    "canonical_digits": "SELECT doc_id, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits, md5(regexp_replace(text, '[^0-9]', '', 'g')) AS hash FROM documents",
    "canonical_form": "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN regexp_replace(c_name, '[^0-9]', '', 'g') WHEN 1 THEN lower(c_name) ELSE c_name END AS canonical FROM customer",
    "redact_keys": "SELECT event_id, 'call [REDACTED] failed; ' || event_type AS text FROM events",
    "literal_email": f"SELECT doc_id, CAST(len(regexp_extract_all(text, {_E})) AS INTEGER) AS n_emails FROM documents WHERE len(regexp_extract_all(text, {_E})) > 0",
    "value_predicate": """
        WITH v AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'NAME' WHEN 1 THEN 'AGE' WHEN 2 THEN 'CARD_NUMBER' ELSE 'WORKPLACE' END AS kind,
          CASE s_suppkey % 5 WHEN 0 THEN 'na' WHEN 1 THEN CAST(s_suppkey AS VARCHAR) WHEN 2 THEN '1234-5678-9012-' || s_suppkey WHEN 3 THEN 'Some Name' ELSE s_name END AS v FROM supplier)
        SELECT s_suppkey, lower(trim(v)) NOT IN ('', 'na', 'n/a', 'null', 'none', 'nan') AND length(v) <= 120 AND CASE kind WHEN 'NAME' THEN regexp_full_match(v, '[가-힣A-Za-z· .''-]{2,60}')
          WHEN 'AGE' THEN regexp_full_match(v, '[0-9]{1,3}(세)?') WHEN 'CARD_NUMBER' THEN regexp_full_match(v, '[0-9 -]{13,25}') ELSE true END AS valid FROM v""",
    "missing_values": "SELECT n_nationkey, n_nationkey % 6 < 4 AS missing FROM nation",
    "char_sequence": "SELECT item_id, CAST(i AS INTEGER) AS i, substring(text, i + 1, 1) AS ch FROM (SELECT item_id, text, unnest(range(length(text))) AS i FROM benchmark)",
    "bio_labels": f"""WITH {_S}
        SELECT doc_id, 'B-EMAIL' AS label, count(*) AS n FROM sp GROUP BY 1 UNION ALL SELECT doc_id, 'I-EMAIL', CAST(sum(length(form) - 1) AS BIGINT) FROM sp GROUP BY 1""",
    "email_spans": f"WITH {_S} SELECT doc_id, b AS begin, CAST(b + length(form) AS INTEGER) AS \"end\", form FROM sp",
    "mention_thirds": f"WITH {_S} SELECT CAST(least(2, b * 3 // n) AS INTEGER) AS third, count(*) AS n_mentions, count(DISTINCT doc_id) AS n_documents FROM sp GROUP BY 1",
    "sentence_split": f"""
        WITH l AS ({_LINES}), s AS (SELECT doc_id, unnest(string_split(regexp_replace(line, '(^|[^0-9.!?。！？]|[0-9][.!?。！？])([.!?。！？]+["''”’)]*)(\\s+|$)', '\\1\\2' || chr(1), 'g'), chr(1))) AS s FROM l)
        SELECT doc_id, count(*) FILTER (regexp_replace(s, '^\\s+|\\s+$', '', 'g') <> '') AS n_sentences, CAST(max(CASE WHEN regexp_replace(s, '^\\s+|\\s+$', '', 'g') <> '' THEN length(regexp_replace(s, '^\\s+|\\s+$', '', 'g')) END) AS INTEGER) AS longest FROM s GROUP BY 1""",
    "boilerplate_first": f"""
        WITH l AS (SELECT doc_id, pos, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS t FROM ({_LINES})), k AS (SELECT *, min(pos) OVER (PARTITION BY doc_id, t) AS keeper FROM l)
        SELECT doc_id, pos, keeper FROM k WHERE pos <> keeper AND (length(t) >= 50 OR t IN ('감사합니다', '감사합니다.'))""",
    "section_shortage": f"""
        SELECT doc_id, CAST(pos // 3 AS BIGINT) AS section, CAST(sum(length(line)) AS BIGINT) AS n_chars, 600 AS target, CAST(greatest(0, 600 - sum(length(line))) AS BIGINT) AS shortage FROM ({_LINES}) GROUP BY ALL""",
    "line_offsets": f"SELECT doc_id, pos, CAST(coalesce(sum(length(line)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM ({_LINES}) WHERE length(line) > 0",
    "exact_dup_groups": f"SELECT sha256({_C}) AS hash, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "structure_islands": f"""
        WITH k AS (SELECT conv_id, turn, {_K} AS kind FROM conversations), s AS (SELECT *, CASE WHEN lag(kind) OVER w = kind THEN 0 ELSE 1 END AS f FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
        r AS (SELECT *, CAST(sum(f) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS run FROM s)
        SELECT conv_id, run, kind, count(*) AS n_rows, min(turn) AS first_row FROM r GROUP BY ALL""",
    "structure_hash": f"WITH {_SHAPE} SELECT conv_id, fingerprint FROM fp",
    "structure_cap": f"WITH {_SHAPE} SELECT fingerprint, count(*) AS n, CAST(least(3, count(*)) AS BIGINT) AS n_passed FROM fp GROUP BY 1",
    "adjacency": """
        SELECT before, role, gap, count(*) AS n FROM (SELECT role, lag(role) OVER w AS before, turn - lag(turn) OVER w AS gap FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE before IS NOT NULL GROUP BY ALL""",
    "last_turns": """
        SELECT conv_id, turn, CAST(e AS INTEGER) AS from_end, r > 6 AS excess FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS e, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS r FROM conversations) WHERE e <= 2""",
}
