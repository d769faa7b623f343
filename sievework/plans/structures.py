"""Queries on similarity, graphs, rules and choice, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import text as t
from sievework.operators import dedup, document, graph, sampling
from sievework.plans.steps import dealt
from sievework.sources.tables import table

THRESHOLD = 0.55


def _grams(spark: SparkSession, d: str) -> DataFrame:
    return dedup.gram_table(table(spark, d, "documents"), "doc_id", F.col("text"))


def gram_counts(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce(dedup.collapse(F.col("text")), F.lit(""))
    return table(spark, d, "documents").select("doc_id", F.size(dedup.grams(text)).cast("long").alias("n_grams"))


def gram_jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Between the first documents of classes of equal gram sets, and between each other document of a class and its first: what a document is similar to follows from its first."""
    firsts, members = dedup.classes(_grams(spark, d), "doc_id")
    pairs = dedup.similar_pairs(firsts, "doc_id", THRESHOLD).withColumn("jaccard", F.round("jaccard", 9))
    return pairs.unionByName(members.where("doc_id > first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"), F.lit(1.0).alias("jaccard")))


def gram_classes(spark: SparkSession, d: str) -> DataFrame:
    return dedup.classes(_grams(spark, d), "doc_id")[1]


def benchmark_nearest(spark: SparkSession, d: str) -> DataFrame:
    corpus = dedup.gram_table(table(spark, d, "benchmark"), "item_id", F.col("text"))
    return dedup.nearest(_grams(spark, d), "doc_id", corpus, "item_id").withColumn("jaccard", F.round("jaccard", 9))


def greedy_accept(spark: SparkSession, d: str) -> DataFrame:
    firsts, members = dedup.classes(_grams(spark, d), "doc_id")
    return dedup.greedy_accept(table(spark, d, "documents").select("doc_id"), "doc_id", dedup.similar_pairs(firsts, "doc_id", THRESHOLD), members)


def addition_copies(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of turns of a conversation by the same role that are near copies."""
    c = table(spark, d, "conversations").where("conv_id is not null and role is not null")
    per = c.groupBy("conv_id", "role").agg(F.collect_list(F.struct("turn", "text")).alias("c"))
    pairs = per.select("role", *dedup.copies_in_order(F.col("c"), "turn", "text")).where("n_pairs > 0")
    return pairs.groupBy("role").agg(F.sum("n_pairs").alias("n_pairs"), F.sum("n_copies").alias("n_copies"))


def ratcliff_near_dup(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of lines of a document, each with all earlier ones, that are near duplicates; lines are numbered from 0."""
    docs = table(spark, d, "documents").select("doc_id", F.explode(document.near_duplicates(F.split("text", "\n"))).alias("x"))
    return docs.select("doc_id", F.col("x.earlier").alias("a"), F.col("x.later").alias("b"), F.round("x.ratio", 9).alias("ratio"))


def masked_text(spark: SparkSession, d: str) -> DataFrame:
    """Documents with e-mail addresses, each address replaced by its type."""
    docs = table(spark, d, "documents").where(F.contains("text", F.lit("@"))).select("doc_id", F.lit(0).alias("position"), "text")
    m = docs.select("doc_id", "position", F.explode(t.spans(F.col("text"), t.LITERALS["EMAIL"])).alias("x")).select("doc_id", "position", "x.begin", "x.end", F.lit("EMAIL").alias("kind"))
    out = dedup.masked(docs, m, "doc_id", "position", "text")
    return out.select("doc_id", F.md5("normalized_text").alias("hash"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("plan_id"), F.concat(F.lit("P"), F.expr("l_partkey % 97")).alias("source"), F.concat(F.lit("S"), F.expr("l_suppkey % 13")).alias("target"), F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("n"))


def privacy_groups(spark: SparkSession, d: str) -> DataFrame:
    return graph.node_labels(_edges(spark, d), ["plan_id"], "source", "target", F.col("flag") == "R")


def bridges(spark: SparkSession, d: str) -> DataFrame:
    out = graph.bridges(_edges(spark, d), ["plan_id"], "source", "target", F.col("flag") == "R", F.col("source").rlike("[02468]$"))
    return out.select("plan_id", "source", "target", "flag", "n")


def components(spark: SparkSession, d: str) -> DataFrame:
    """Parts that meet in an order, by the least part."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    first = li.groupBy("l_orderkey").agg(F.min("l_partkey").alias("a"))
    return graph.components(li.join(first, "l_orderkey").select("a", F.col("l_partkey").alias("b")), "a", "b")


def spec_semi_anti(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    allowed = table(spark, d, "part").where("p_retailprice > 1500").select("p_brand", F.expr("p_size % 10").alias("k")).distinct()
    keyed = part.withColumn("k", F.expr("p_size % 10"))
    yes, no = graph.legal(keyed, allowed, ["p_brand", "k"]), graph.illegal(keyed, allowed, ["p_brand", "k"])
    return yes.withColumn("legal", F.lit(True)).unionByName(no.withColumn("legal", F.lit(False))).select("p_partkey", "legal")


def allowed_triples(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = n.groupBy("r_name").agg(F.collect_list("n_name").alias("sources")).select(F.col("r_name").alias("domain"), F.lit("borders").alias("relation"), "sources", F.col("sources").alias("targets"))
    return graph.allowed_triples(rows)


def evidence_modes(spark: SparkSession, d: str) -> DataFrame:
    """How an order's lines of one return flag lie: groups are its line numbers by flag."""
    g = table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.collect_set(F.col("l_linenumber").cast("string")).alias("g"))
    per = g.where("size(g) > 1").groupBy("l_orderkey").agg(F.collect_list("g").alias("groups"))
    positions = F.map_from_arrays(F.array(*[F.lit(str(i)) for i in range(1, 8)]), F.array(*[F.lit(i) for i in range(1, 8)]))
    return per.select("l_orderkey", graph.evidence_mode(F.col("groups"), positions).alias("mode"), graph.smallest_evidence(F.col("groups"), positions).alias("smallest"))


def plan_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose parts, suppliers and flags make the same graph have the same fingerprint."""
    e = dealt(_edges(spark, d).select("plan_id", "source", "target", F.col("flag").alias("label")), "plan_id")
    nodes = e.select("plan_id", F.explode(F.array("source", "target")).alias("node")).distinct().withColumn("label", F.substring("node", 1, 1))
    return graph.plan_fingerprints(nodes, e)


def doc_validation_issues(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    rules = {
        "EMPTY": F.length(t.strip(F.col("text"))) == 0,
        "LENGTH": F.col("n_chars") != F.length("text"),
        "LANGUAGE": ~F.col("lang").isin("en", "de", "fr"),
        "SHORT": F.length("text") < 100,
        "EMAIL": F.contains("text", F.lit("@")) & F.col("text").rlike(t.LITERALS["EMAIL"]),  # the cheap test first
        "PLACEHOLDER": F.col("text").rlike(document.PLACEHOLDER),
    }
    return document.issues(docs, "doc_id", rules, F.col("source"))


def mention_overlaps(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_suppkey").alias("position"), F.concat_ws("-", "l_partkey", "l_linenumber").alias("entity_id"), F.expr("cast(l_quantity as int)").alias("begin"), F.expr("cast(l_quantity as int) + 9").alias("end"))
    spread = m.withColumn("position", F.expr("position % 3"))
    return document.overlaps(spread)


def slot_round_robin(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("domain"), F.col("n_name").alias("subtype"))
    return sampling.round_robin(n.select("domain").distinct(), n, 12, "seed")


def hash_pick(spark: SparkSession, d: str) -> DataFrame:
    return sampling.pick(table(spark, d, "part").select("p_brand", "p_partkey"), ["p_brand"], F.col("p_partkey"), "pick", 3)


def hash_chance(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where(sampling.chance(F.col("c_custkey"), "bernoulli", 0.25)).select("c_custkey")


def least_used(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_nationkey", F.col("c_mktsegment").alias("option"))
    options = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey")).crossJoin(c.select("option").distinct())  # 25 nations, 5 segments
    return sampling.least_used(options, c, ["c_nationkey"], "option")


def next_slot(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    eligible = e.select(F.col("c_mktsegment").alias("relation"), F.col("n_name").alias("domain"), F.expr("concat('t', c_custkey % 7)").alias("subtype")).distinct()
    totals = e.groupBy(F.col("n_name").alias("domain")).agg(F.count("*").alias("n"))
    missing = e.select(F.col("c_mktsegment").alias("relation")).distinct()
    return sampling.next_slot(missing, eligible, totals, 1000000).select("relation", "domain", "subtype")


def apportioned(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.expr("cast(o_totalprice as bigint)").alias("total"))
    return o.select("o_orderkey", F.posexplode(sampling.apportion(F.col("total"), F.array(F.lit(0.5), F.lit(0.25), F.lit(0.25)))).alias("i", "share"))


def json_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey", t.canonical_json_hash({"name": F.col("n_name"), "key": F.col("n_nationkey"), "region": F.col("n_regionkey")}).alias("hash"), t.seed_of(F.col("n_name")).cast("string").alias("seed"))


QUERIES = {f.__name__: f for f in (
    gram_counts, gram_jaccard_pairs, gram_classes, benchmark_nearest, greedy_accept, addition_copies, ratcliff_near_dup, masked_text, privacy_groups, bridges, components, spec_semi_anti, allowed_triples,
    evidence_modes, plan_fingerprint, doc_validation_issues, mention_overlaps, slot_round_robin, hash_pick, hash_chance, least_used, next_slot, apportioned, json_hash,
)}

_N = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"
_G = """{a} AS (SELECT {k}, {n} AS t FROM {f}), {a}g AS (SELECT DISTINCT {k}, substring(t, i, 4) AS g FROM (SELECT {k}, t, unnest(range(1, length(t) - 2)) AS i FROM {a} WHERE length(t) >= 4)),
        {a}n AS (SELECT {k}, count(*) AS n FROM {a}g GROUP BY 1)"""
_D = _G.format(a="d", k="doc_id", f="documents", n=_N)
_B = _G.format(a="b", k="item_id", f="benchmark", n=_N)
_PAIRS = f"""{_D}, dl AS (SELECT doc_id, list_sort(list(g)) AS l FROM dg GROUP BY 1),
        m AS MATERIALIZED (SELECT doc_id, min(doc_id) OVER (PARTITION BY l) AS first FROM d LEFT JOIN dl USING (doc_id)),
        f AS (SELECT doc_id, g FROM dg JOIN m USING (doc_id) WHERE doc_id = first),
        c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM f x JOIN f y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
        p AS MATERIALIZED (SELECT a, b, CAST(c AS DOUBLE) / (p.n + q.n - c) AS j FROM c JOIN dn p ON a = p.doc_id JOIN dn q ON b = q.doc_id WHERE CAST(c AS DOUBLE) / (p.n + q.n - c) >= 0.55)"""
_ED = "SELECT l_orderkey AS plan_id, 'P' || (l_partkey % 97) AS source, 'S' || (l_suppkey % 13) AS target, l_returnflag AS flag, l_linenumber AS n FROM lineitem"
_V = """SELECT doc_id, code, source AS target FROM (
          SELECT doc_id, source, 'EMPTY' AS code FROM documents WHERE length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) = 0
          UNION ALL SELECT doc_id, source, 'LENGTH' FROM documents WHERE n_chars <> length(text) UNION ALL SELECT doc_id, source, 'LANGUAGE' FROM documents WHERE lang NOT IN ('en', 'de', 'fr')
          UNION ALL SELECT doc_id, source, 'SHORT' FROM documents WHERE length(text) < 100
          UNION ALL SELECT doc_id, source, 'EMAIL' FROM documents WHERE regexp_matches(text, '[A-Za-z0-9_.+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')
          UNION ALL SELECT doc_id, source, 'PLACEHOLDER' FROM documents WHERE regexp_matches(text, '<(?:[A-Z][A-Z0-9_]*:E[0-9]+|REF:C[0-9]+)>|[〈＜][A-Z][A-Z0-9_]*:E[0-9]+[〉＞]|\\{josa:'))"""
ORACLES = {
    "gram_counts": f"WITH {_D} SELECT doc_id, coalesce(n, 0) AS n_grams FROM d LEFT JOIN dn USING (doc_id)",
    "gram_jaccard_pairs": f"WITH {_PAIRS} SELECT a, b, round(j, 9) AS jaccard FROM p UNION ALL SELECT first, doc_id, 1.0 FROM m WHERE doc_id > first",
    "gram_classes": f"WITH {_PAIRS} SELECT doc_id, first FROM m",
    "greedy_accept": f"""WITH RECURSIVE {_PAIRS}, i AS MATERIALIZED (SELECT doc_id, coalesce(e, []) AS e, row_number() OVER (ORDER BY doc_id) AS k FROM m LEFT JOIN (SELECT b AS doc_id, list(a) AS e FROM p GROUP BY 1) USING (doc_id) WHERE doc_id = first),
        r AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS taken UNION ALL SELECT i.k, CASE WHEN list_has_any(e, taken) THEN taken ELSE list_append(taken, doc_id) END FROM r JOIN i ON i.k = r.k + 1),
        t AS (SELECT unnest(taken) AS doc_id FROM (SELECT taken FROM r ORDER BY k DESC LIMIT 1))
        SELECT m.doc_id, CASE WHEN t.doc_id IS NULL THEN 'refused' ELSE 'accepted' END AS status FROM m LEFT JOIN t USING (doc_id)""",
    "benchmark_nearest": f"""WITH {_D}, {_B}, c AS (SELECT doc_id, item_id, count(*) AS c FROM dg JOIN bg USING (g) GROUP BY ALL),
        s AS (SELECT doc_id, item_id, CAST(c AS DOUBLE) / (dn.n + bn.n - c) AS j FROM c JOIN dn USING (doc_id) JOIN bn USING (item_id)),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY j DESC, item_id) AS rn FROM s)
        SELECT d.doc_id, coalesce(item_id, f) AS nearest, coalesce(round(j, 9), CASE WHEN f IS NULL THEN 0 ELSE 1 END) AS jaccard FROM d LEFT JOIN r ON r.doc_id = d.doc_id AND rn = 1
        LEFT JOIN (SELECT min(item_id) AS f FROM b WHERE length(t) < 4) ON length(d.t) < 4""",
    "masked_text": "SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[A-Za-z0-9_.+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '<EMAIL>', 'g'), '\\s+', ' ', 'g'))) AS hash FROM documents WHERE contains(text, '@')",
    "privacy_groups": f"""WITH e AS ({_ED}) SELECT plan_id, node, CASE WHEN bool_or(flag = 'R') THEN 'PII' ELSE 'NON_PII' END AS privacy
        FROM (SELECT plan_id, source AS node, flag FROM e UNION ALL SELECT plan_id, target, flag FROM e) GROUP BY 1, 2""",
    "bridges": f"""WITH e AS ({_ED}), l AS (SELECT plan_id, node, bool_or(flag = 'R') AS p FROM (SELECT plan_id, source AS node, flag FROM e UNION ALL SELECT plan_id, target, flag FROM e) GROUP BY 1, 2)
        SELECT e.* FROM e JOIN l s ON s.plan_id = e.plan_id AND s.node = source JOIN l t ON t.plan_id = e.plan_id AND t.node = target WHERE flag <> 'R' AND regexp_matches(source, '[02468]$') AND s.p AND NOT t.p""",
    "components": """WITH RECURSIVE li AS (SELECT l_orderkey AS o, l_partkey AS p FROM lineitem), f AS (SELECT o, min(p) AS a FROM li GROUP BY 1), e AS (SELECT DISTINCT a AS x, p AS y FROM li JOIN f USING (o)),
        u AS (SELECT x, y FROM e UNION SELECT y, x FROM e), r(x, c) USING KEY (x) AS (SELECT DISTINCT x, x FROM u
            UNION SELECT u.y, min(r.c) FROM r JOIN u ON u.x = r.x JOIN recurring.r AS o ON o.x = u.y WHERE r.c < o.c GROUP BY u.y)
        SELECT x AS node, c AS component FROM r""",
    "spec_semi_anti": "SELECT p_partkey, EXISTS (SELECT 1 FROM part q WHERE q.p_retailprice > 1500 AND q.p_brand = p.p_brand AND q.p_size % 10 = p.p_size % 10) AS legal FROM part p",
    "allowed_triples": "SELECT r_name AS domain, a.n_name AS source_type, 'borders' AS relation, b.n_name AS target_type FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey JOIN region ON a.n_regionkey = r_regionkey",
    "evidence_modes": """WITH g AS (SELECT l_orderkey, l_returnflag, count(DISTINCT l_linenumber) AS n, max(l_linenumber) - min(l_linenumber) + 1 AS w FROM lineitem GROUP BY 1, 2)
        SELECT l_orderkey, CASE WHEN bool_or(n = w) THEN 'adjacent' ELSE 'nonadjacent' END AS mode, CAST(min(n) AS INTEGER) AS smallest FROM g WHERE n > 1 GROUP BY 1""",
    "doc_validation_issues": _V,
    "mention_overlaps": """WITH m AS (SELECT l_orderkey AS doc_id, l_suppkey % 3 AS p, l_partkey || '-' || l_linenumber AS e, CAST(l_quantity AS INTEGER) AS b FROM lineitem),
        o AS (SELECT *, max(b + 9) OVER (PARTITION BY doc_id, p ORDER BY b, b + 9, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS x FROM m)
        SELECT doc_id, 'FINAL_MENTION_OVERLAP' AS code, e AS target FROM o WHERE b < x""",
    "slot_round_robin": """WITH s AS (SELECT r_name AS domain, n_name AS subtype, row_number() OVER (PARTITION BY r_name ORDER BY sha256('seed:' || n_name), n_name) - 1 AS r, count(*) OVER (PARTITION BY r_name) AS n FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT domain || '_' || lpad(CAST(i + 1 AS VARCHAR), 3, '0') AS slot_id, domain, subtype FROM s, range(12) t(i) WHERE i % n = r""",
    "hash_pick": "SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY sha256('pick:' || p_partkey), p_partkey) AS r FROM part) WHERE r <= 3",
    "hash_chance": "SELECT c_custkey FROM customer WHERE CAST('0x' || substring(sha256('bernoulli:' || c_custkey), 1, 8) AS BIGINT) < 0.25 * 4294967296",
    "least_used": """WITH o AS (SELECT n_nationkey, s FROM nation, (SELECT DISTINCT c_mktsegment AS s FROM customer)), u AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL),
        j AS (SELECT n_nationkey, s, coalesce(n, 0) AS n FROM o LEFT JOIN u ON c_nationkey = n_nationkey AND c_mktsegment = s), r AS (SELECT *, row_number() OVER (PARTITION BY n_nationkey ORDER BY n, s) AS rn FROM j)
        SELECT n_nationkey AS c_nationkey, s AS option, n AS n_used FROM r WHERE rn = 1""",
    "next_slot": """WITH e AS (SELECT c_custkey, c_mktsegment, c_acctbal, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey), t AS (SELECT n_name, count(*) AS n FROM e GROUP BY 1)
        SELECT c_mktsegment AS relation, n_name AS domain, 't' || (c_custkey % 7) AS subtype FROM e JOIN t USING (n_name) ORDER BY c_mktsegment, n, n_name, subtype LIMIT 1""",
    "apportioned": """WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders), s AS (SELECT o_orderkey, v, CAST(floor(v * 0.5::DOUBLE) AS BIGINT) AS x, CAST(floor(v * 0.25::DOUBLE) AS BIGINT) AS y FROM o)
        SELECT o_orderkey, 0 AS i, x AS share FROM s UNION ALL SELECT o_orderkey, 1, y FROM s UNION ALL SELECT o_orderkey, 2, v - x - y FROM s""",
    "json_hash": """SELECT n_nationkey, sha256('{"key":' || n_nationkey || ',"name":"' || n_name || '","region":' || n_regionkey || '}') AS hash, CAST(CAST('0x' || substring(sha256(n_name), 1, 16) AS UBIGINT) AS VARCHAR) AS seed FROM nation""",
}
