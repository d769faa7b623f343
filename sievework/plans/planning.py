"""Queries over orders as conditions of plans: required relations, seed graphs and values, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import planning, values
from sievework.sources.tables import table
from sievework.streaming import calls

_PERSONAL = ("NAME", "EMAIL", "ADDRESS", "WORKPLACE", "AGE", "DEPARTMENT", "MOBILE_PHONE", "NAME")
_PUBLIC = ("TELEPHONE", "EMAIL", "ADDRESS", "WORKPLACE", "DEPARTMENT", "BANK_ACCOUNT_NUMBER")
_ROLES = ("applicant", "doctor", "seller")


def _one_of(names: tuple[str, ...], number: str) -> str:
    return f"element_at(array({', '.join(repr(n) for n in names)}), cast({number} % {len(names)} AS int) + 1)"


def required_selection(spark: SparkSession, d: str) -> DataFrame:
    """Brands as relations, the least sold first; dear parts say which a subtype may hold, and as what."""
    sold = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("relation")).agg(F.count("*").alias("n"))
    options = table(spark, d, "part").where("p_retailprice % 100 > 80").selectExpr(
        "cast(p_size % 5 AS string) AS subtype", "p_brand AS relation", "IF(p_partkey % 2 = 0, 'PII', 'NON_PII') AS privacy", "IF(p_partkey % 4 = 0, 'NAME', 'EMAIL') AS target")
    orders = table(spark, d, "orders").selectExpr("o_orderkey AS plan_id", "cast(o_custkey % 6 AS string) AS subtype", "o_orderkey % 3 AS pii", "o_custkey % 3 AS non_pii", "1 + o_orderkey % 4 AS n_parties")
    chosen = planning.required_selection(orders.crossJoin(F.broadcast(planning.coverage_order(sold))), options, 3)  # one row
    return chosen.select("plan_id", F.posexplode("chosen").alias("i", "x")).select("plan_id", "i", "x.relation", "x.privacy")


def _conditions(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    slot = F.expr("struct(l_linenumber AS n, l_partkey AS k, concat('R', l_linenumber) AS slot_id, IF(l_returnflag = 'R', 'NON_PII', 'PII') AS privacy, IF(l_tax >= 0.07, p_type, NULL) AS required)")
    per = lines.groupBy(F.col("l_orderkey").alias("plan_id")).agg(F.array_sort(F.collect_list(slot)).alias("s"))
    slots = F.transform("s", lambda x: F.struct(x["slot_id"], x["privacy"], x["required"]))
    people = F.expr(f"transform(sequence(1, cast(1 + o_custkey % 3 AS int)), i -> struct(concat('P', i) AS person_id, {_one_of(_ROLES, '(o_custkey + i)')} AS role))")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("plan_id"), F.expr("cast(o_orderkey % 5 AS string)").alias("subtype"), people.alias("people"), F.expr("cast(o_orderkey % 3 AS int)").alias("bridges"), (F.col("o_custkey") % 4 == 0).alias("strict"))
    profile = {"owners": "map('ECONOMY', 'doctor', 'PROMO', 'seller')", "pairs": "map('STANDARD', named_struct('a', 'doctor', 'b', 'seller'))"}
    return orders.join(per, "plan_id").select("plan_id", "subtype", "people", slots.alias("slots"), "bridges", *(F.when(F.col("strict"), F.expr(e)).alias(c) for c, e in profile.items()))


def _options(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    subtype = "cast(p_size % 5 AS string) AS subtype"
    personal = part.selectExpr(subtype, "'PII' AS privacy", "'NAME' AS source", "p_type AS relation", f"{_one_of(_PERSONAL, 'p_partkey')} AS target")
    public = part.selectExpr(subtype, "'NON_PII' AS privacy", f"{_one_of(planning.ORGANISATIONS, 'p_partkey')} AS source", "p_type AS relation", f"{_one_of(_PUBLIC, '(p_partkey div 3)')} AS target")
    return personal.unionByName(public).distinct()


def seed_graphs(spark: SparkSession, d: str) -> DataFrame:
    """Orders as conditions and their lines as slots; parts say what a subtype may use. A row per relation, or one without a relation that says why the plan has none."""
    found = planning.seed_graph(planning.with_options(_conditions(spark, d), _options(spark, d), "graph_seed"))
    return found.select("plan_id", "issue", F.explode_outer("edges").alias("e")).select("plan_id", F.col("e.slot_id").alias("slot_id"), F.col("e.privacy").alias("privacy"), F.col("e.source").alias("source"), F.col("e.relation").alias("relation"), F.col("e.target").alias("target"), "issue")


def value_groups_of_orders(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Lines of orders as groups of entities, customers as the pool."""
    kinds = F.expr("CASE l_partkey % 4 WHEN 0 THEN array('NAME', 'TELEPHONE') WHEN 1 THEN array('WORKPLACE') WHEN 2 THEN array('NAME', 'WORKPLACE', 'AGE') ELSE array('AGE', 'NAME') END")
    each = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("plan_id"), F.col("l_linenumber").alias("value_group"), F.posexplode(kinds).alias("i", "entity_type"))
    groups = each.select("plan_id", "value_group", F.concat(F.lit("E"), "value_group", F.lit("_"), "i").alias("entity_id"), "entity_type")
    pool = table(spark, d, "customer").selectExpr(
        "cast(c_custkey AS string) AS uuid", "translate(c_name, '#0123456789', ' abcdefghij') AS NAME", "concat('02-', lpad(c_custkey, 7, '0')) AS TELEPHONE", "c_mktsegment AS WORKPLACE", "IF(c_nationkey % 5 = 0, 'na', cast(c_nationkey AS string)) AS AGE")
    return groups, pool


def value_selection(spark: SparkSession, d: str) -> DataFrame:
    """What each group takes; a plan that stops has one more row, with the code."""
    groups, pool = value_groups_of_orders(spark, d)
    chosen, issues = values.select_values(groups, pool, "values", types=["NAME", "TELEPHONE", "WORKPLACE", "AGE"])
    none = F.lit(None).cast("string")
    stopped = issues.select("plan_id", F.col("target").cast("int").alias("value_group"), none.alias("entity_id"), none.alias("value"), none.alias("source"), F.col("code").alias("issue"))
    return chosen.select("plan_id", "value_group", "entity_id", "value", "source", none.alias("issue")).unionByName(stopped)


def call_admission(spark: SparkSession, d: str) -> DataFrame:
    """Events as calls: users are candidates, event types tasks; values say which operation is meant and how it was answered."""
    kinds = "CASE event_type WHEN 'view' THEN 'expand' WHEN 'click' THEN 'repair' WHEN 'purchase' THEN 'draft' WHEN 'signup' THEN 'plan' ELSE 'review' END"
    answer = "CASE cast(value AS int) % 5 WHEN 0 THEN 'retry' WHEN 1 THEN 'bad' WHEN 2 THEN 'lost' ELSE 'valid' END"
    log = table(spark, d, "events").selectExpr("user_id AS candidate", "event_id AS seq", f"{kinds} AS task", "concat(event_type, cast(value AS int) % 3) AS operation", f"{answer} AS outcome")
    return calls.admitted(log, 6)


QUERIES = {f.__name__: f for f in (required_selection, seed_graphs, value_selection, call_admission)}
ORACLES = {
    "required_selection": """
        WITH RECURSIVE w AS (SELECT relation, CAST(row_number() OVER (ORDER BY n, relation) AS BIGINT) AS k FROM (SELECT p_brand AS relation, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)),
        h AS (SELECT p_size % 5 AS subtype, p_brand AS relation, bool_or(p_partkey % 2 = 0) AS p, bool_or(p_partkey % 2 <> 0) AS q, bool_or(p_partkey % 4 = 0) AS named FROM part WHERE p_retailprice % 100 > 80 GROUP BY 1, 2),
        s AS (
          SELECT o_orderkey AS plan_id, o_custkey % 6 AS subtype, 1 + o_orderkey % 4 AS parties, CAST(0 AS BIGINT) AS k, o_orderkey % 3 AS pii, o_custkey % 3 AS non_pii, CAST(0 AS INTEGER) AS n, CAST(NULL AS VARCHAR) AS relation, CAST(NULL AS VARCHAR) AS privacy FROM orders
          UNION ALL
          SELECT plan_id, subtype, parties, k, pii - CASE WHEN privacy = 'PII' THEN 1 ELSE 0 END, non_pii - CASE WHEN privacy = 'NON_PII' THEN 1 ELSE 0 END, n + CASE WHEN privacy IS NULL THEN 0 ELSE 1 END, relation, privacy FROM (
            SELECT s.plan_id, s.subtype, s.parties, w.k, s.pii, s.non_pii, s.n, w.relation,
              CASE WHEN s.n >= 3 THEN NULL WHEN h.q AND s.non_pii > 0 THEN 'NON_PII' WHEN h.p AND s.pii > 0 AND (s.parties <= s.pii OR h.named) THEN 'PII' END AS privacy
            FROM s JOIN w ON w.k = s.k + 1 LEFT JOIN h ON h.subtype = s.subtype AND h.relation = w.relation))
        SELECT plan_id, CAST(n - 1 AS INTEGER) AS i, relation, privacy FROM s WHERE privacy IS NOT NULL""",
}
