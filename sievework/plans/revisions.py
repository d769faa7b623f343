"""Queries over orders as drafts, with their SQL: patches and what refuses them, digests and schemas of nested JSON; and known values in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.functions import nested
from sievework.operators import drafts, revisions
from sievework.plans.steps import dealt
from sievework.sources.tables import table


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, n, flag, part): lines of orders, numbered from 1."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return dealt(table(spark, d, "lineitem"), "l_orderkey").select(F.col("l_orderkey").alias("doc_id"), F.row_number().over(w).alias("n"), F.col("l_returnflag").alias("flag"), F.col("l_partkey").alias("part"))


def _drafts_and_patches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A sentence, a reference and a relation for each line; of eight orders six have a patch with a fault."""
    row = F.struct("n", "flag")
    per = _lines(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("l"))
    d_ = per.selectExpr(
        "doc_id", "cast(doc_id % 3 AS int) AS draft_version", "transform(l, x -> struct(concat('S', x.n) AS sentence_id, concat('Line ', x.n, ' ships <REF:C', x.n, '>') AS text)) AS segments",
        "transform(l, x -> struct(concat('C', x.n) AS ref_id, x.flag AS value)) AS refs", "transform(l, x -> struct(concat('R', x.n) AS relation_id, array(concat('S', x.n)) AS ids)) AS evidence")
    k = "doc_id % 8"
    p = per.selectExpr(
        "doc_id", f"cast(doc_id % 3 + IF({k} = 1, 1, 0) AS int) AS base_version", "false AS length_only", f"array(struct(IF({k} = 2, 'S99', 'S1') AS sentence_id, 'changed' AS text)) AS replacements",
        f"array(struct(CASE {k} WHEN 3 THEN 'S98' WHEN 6 THEN 'S1' ELSE concat('S', size(l)) END AS after, array(struct(IF({k} = 4, 'S1', 'S50') AS sentence_id, 'added' AS text)) AS segments)) AS insertions",
        f"CASE {k} WHEN 5 THEN array(struct('C1' AS ref_id, 'x' AS value), struct('C1' AS ref_id, 'y' AS value)) WHEN 7 THEN array(struct('C2' AS ref_id, 'new' AS value)) END AS ref_updates",
        f"IF({k} = 7, array(struct('R1' AS relation_id, array('S1', 'S50') AS ids)), NULL) AS evidence_updates", f"IF({k} = 6, array(array('S2', 'S1')), NULL) AS protected")
    return d_, p


def patch_refusals(spark: SparkSession, d: str) -> DataFrame:
    return revisions.revised(*_drafts_and_patches(spark, d)).select("doc_id", F.explode_outer("refusals").alias("x")).select("doc_id", "x.code", "x.target").where("code IS NOT NULL")


def patched_drafts(spark: SparkSession, d: str) -> DataFrame:
    """All parts of each draft after its patch, as texts."""
    return revisions.revised(*_drafts_and_patches(spark, d)).selectExpr(
        "doc_id", "draft_version", "committed", "array_join(transform(segments, s -> concat(s.sentence_id, ':', s.text)), '|') AS body",
        "array_join(transform(refs, r -> concat(r.ref_id, '=', r.value)), ',') AS refs", "array_join(transform(evidence, e -> concat(e.relation_id, '=', array_join(e.ids, '+'))), ',') AS evidence")


def nested_digest(spark: SparkSession, d: str) -> DataFrame:
    """Orders and their lines as nested JSON, with keys in another order than the canonical one."""
    per = _lines(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("n", "part", "flag"))).alias("l"))
    o = table(spark, d, "orders").join(per, F.col("o_orderkey") == F.col("doc_id"))
    json = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.transform("l", lambda x: F.struct(x["part"].alias("part"), x["flag"].alias("flag"))).alias("lines"), F.col("o_totalprice").alias("price"), F.concat(F.lit('é"'), "o_orderpriority").alias("kind")))
    return o.select("doc_id", nested.digest(F.parse_json(json), depth=3).alias("digest"))


#: What order_schema_issues holds its documents against.
ORDER_SCHEMA = {
    "type": "object",
    "properties": {
        "id": {"type": "string", "pattern": "O[0-9]+"},
        "status": {"type": "string", "enum": ["F", "O", "P"]},
        "customer": {"type": ["integer", "null"]},
        "lines": {"type": "array", "items": {"anyOf": [{"type": "integer"}, {"type": "object", "properties": {"part": {"type": "integer"}}}]}, "minItems": 1, "maxItems": 2},
    },
}


def order_schema_issues(spark: SparkSession, d: str) -> DataFrame:
    k = "o_orderkey % 8"
    json = f"""concat('{{"id":', IF({k} = 1, cast(o_orderkey AS string), concat('"', IF({k} = 2, 'X', 'O'), o_orderkey, '"')), ',"status":"', IF({k} = 3, 'Z', o_orderstatus), '","customer":', IF({k} = 4, '1.5', IF({k} = 0, 'null', cast(o_custkey AS string))),
        IF({k} = 5, '', concat(',"lines":', IF({k} = 6, '[]', IF({k} = 7, '[1,{{"part":"x"}},3]', '[1,{{"part":2}}]')))), '}}')"""
    docs = table(spark, d, "orders").selectExpr("o_orderkey AS doc_id", f"{json} AS json")
    return docs.select("doc_id", F.explode_outer(nested.violations(F.try_parse_json("json"), ORDER_SCHEMA)).alias("issue")).where("issue IS NOT NULL")


def surfaces_to_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Words of a benchmark item are the known values of every fortieth document; what becomes a token is counted, and the text is hashed with a mark for each."""
    items = table(spark, d, "benchmark").where("item_id < 40").select(F.col("item_id").alias("plan_id"), F.posexplode(F.split("text", "[^A-Za-z]+")).alias("i", "surface"))
    surfaces = items.where("length(surface) >= 3").select("plan_id", "surface", F.concat(F.lit("<W:E"), "i", F.lit(">")).alias("token"))
    docs = table(spark, d, "documents").select("doc_id", F.expr("doc_id % 40").alias("plan_id"), F.translate("text", "<>§", "()s").alias("text"))
    out = drafts.with_tokens(docs, surfaces)
    marked = F.regexp_replace("text", "<W:E[0-9]+>", "§")
    return out.select("doc_id", F.md5(marked).alias("hash"), F.regexp_count("text", F.lit("<W:E[0-9]+>")).cast("long").alias("n_tokens"))


QUERIES = {f.__name__: f for f in (patch_refusals, patched_drafts, nested_digest, order_schema_issues, surfaces_to_tokens)}

_L = "l AS (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n, l_returnflag AS flag, l_partkey AS part FROM lineitem)"
_O = f"WITH {_L}, o AS (SELECT doc_id, doc_id % 8 AS k, max(n) AS m, doc_id % 8 IN (0, 7) OR (doc_id % 8 = 6 AND max(n) = 1) AS ok FROM l GROUP BY 1)"
ORACLES = {
    "patch_refusals": f"""{_O} SELECT doc_id, CASE k WHEN 1 THEN 'PATCH_BASE_VERSION' WHEN 2 THEN 'PATCH_REPLACEMENT_ID' WHEN 3 THEN 'PATCH_ANCHOR' WHEN 4 THEN 'PATCH_NEW_ID' WHEN 5 THEN 'PATCH_DUPLICATE_UPDATE' ELSE 'PATCH_PROTECTED_GAP' END AS code,
        CASE k WHEN 1 THEN CAST(doc_id % 3 + 1 AS VARCHAR) WHEN 2 THEN 'S99' WHEN 3 THEN 'S98' WHEN 4 THEN 'S1' WHEN 5 THEN 'C1' ELSE 'S1' END AS target FROM o WHERE NOT ok""",
    "patched_drafts": f"""{_O} SELECT doc_id, CAST(doc_id % 3 + CASE WHEN ok THEN 1 ELSE 0 END AS INTEGER) AS draft_version, ok AS committed,
        string_agg(CASE WHEN ok AND n = 1 THEN 'S1:changed' ELSE 'S' || n || ':Line ' || n || ' ships <REF:C' || n || '>' END, '|' ORDER BY n) || CASE WHEN ok THEN '|S50:added' ELSE '' END AS body,
        coalesce(string_agg(CASE WHEN ok AND n = 1 THEN NULL WHEN k = 7 AND n = 2 THEN 'C2=new' ELSE 'C' || n || '=' || flag END, ',' ORDER BY n), '') AS refs,
        string_agg(CASE WHEN k = 7 AND n = 1 THEN 'R1=S1+S50' ELSE 'R' || n || '=S' || n END, ',' ORDER BY n) AS evidence FROM l JOIN o USING (doc_id) GROUP BY doc_id, ok""",
    "nested_digest": f"""WITH {_L}, p AS (SELECT doc_id, string_agg('{{"flag":"' || flag || '","part":' || part || '}}', ',' ORDER BY n) AS s FROM l GROUP BY 1)
        SELECT doc_id, sha256('{{"kind":"é\\"' || o_orderpriority || '","lines":[' || s || '],"price":' || CAST(o_totalprice AS VARCHAR) || ',"status":"' || o_orderstatus || '"}}') AS digest FROM orders JOIN p ON o_orderkey = doc_id""",
    "order_schema_issues": """
        WITH f AS (SELECT * FROM (VALUES (1, 'SCHEMA_TYPE $.id'), (2, 'SCHEMA_PATTERN $.id'), (3, 'SCHEMA_TYPE $.status'), (4, 'SCHEMA_TYPE $.customer'), (5, 'SCHEMA_KEYS $'), (6, 'SCHEMA_ARRAY_LENGTH $.lines'),
          (7, 'SCHEMA_ARRAY_LENGTH $.lines'), (7, 'SCHEMA_ANY_OF $.lines[1]')) t(k, issue)) SELECT o_orderkey AS doc_id, issue FROM orders JOIN f ON o_orderkey % 8 = k""",
    "surfaces_to_tokens": """
        WITH w AS (SELECT item_id, unnest(string_split_regex(text, '[^A-Za-z]+')) AS w FROM benchmark WHERE item_id < 40),
        u AS (SELECT item_id, w FROM w WHERE length(w) >= 3 GROUP BY ALL HAVING count(*) = 1), p AS (SELECT item_id, string_agg(w, '|' ORDER BY length(w) DESC, w) AS e FROM u GROUP BY 1),
        d AS (SELECT doc_id, translate(text, '<>§', '()s') AS t, e FROM documents LEFT JOIN p ON item_id = doc_id % 40), r AS (SELECT doc_id, CASE WHEN e IS NULL THEN t ELSE regexp_replace(t, e, '§', 'g') END AS t FROM d)
        SELECT doc_id, md5(t) AS hash, length(t) - length(replace(t, '§', '')) AS n_tokens FROM r""",
}
