"""Reports over the tables of a folder, with the SQL each is held against.

The tables stand in for the ledger: events for attempts (a user's latest event is the latest attempt of a key), orders for candidates, lineitem for calls and relations,
customer and nation for slots and domains, labels for grades.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.stats import rate, wilson
from sievework.operators import audits, funnel, ledger
from sievework.sources.tables import table

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'rejected' ELSE 'running' END"


def _passed():
    return F.col("event_type").isin("purchase", "signup")


def _completed():
    return F.col("event_type") != "view"


def funnel_wilson(spark: SparkSession, d: str) -> DataFrame:
    return funnel.funnel(table(spark, d, "events"), "user_id", ("ts", "event_id"), _passed(), _completed())


def stage_funnel(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("stage", F.expr("event_id % 5"))
    return funnel.stage_funnel(events, "stage", "user_id", ("ts", "event_id"), F.col("event_type"), _passed(), _completed())


def status_by_composite(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    keyed = j.select(F.col("c_mktsegment").alias("domain"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("subtype"), F.expr("cast(year(o_orderdate) as string)").alias("format"), "o_orderstatus")
    return funnel.status_counts(keyed, ["domain", "subtype", "format"], "o_orderstatus", ["F", "O", "P"])


def reason_distinct(spark: SparkSession, d: str) -> DataFrame:
    return funnel.reasons(table(spark, d, "events"), F.col("event_type"), "user_id")


def reason_rows(spark: SparkSession, d: str) -> DataFrame:
    codes = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("codes"))
    return funnel.row_reasons(codes, "codes")


def usage_by_key(spark: SparkSession, d: str) -> DataFrame:
    cost = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    out = ledger.usage(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], {"quantity": F.col("l_quantity"), "cost": cost})
    return out.withColumns({"quantity": F.round("quantity", 2), "cost": F.round("cost", 2)})


def call_cost(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    price = ledger.call_cost(F.col("l_quantity") * 1000, F.col("l_quantity") * 250, F.col("l_linenumber") * 100, F.lit(0.4), F.lit(0.1), F.lit(1.6))
    return li.groupBy("l_returnflag").agg(F.round(F.sum(price), 6).alias("cost"))


def budget_admission(spark: SparkSession, d: str) -> DataFrame:
    out = ledger.admitted(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_totalprice"), 400000.0, 10)
    return out.select("o_custkey", "o_orderkey", F.round("running_cost", 2).alias("running_cost"), "running_calls", "admitted")


def next_attempt(spark: SparkSession, d: str) -> DataFrame:
    attempts = ledger.numbered(table(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], ["ts", "event_id"])
    return ledger.next_attempt(attempts, ["user_id", "event_type"])


def coverage_zero_fill(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").select("n_nationkey", "n_name")
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    return ledger.zero_filled(nations, rows, "n_nationkey", 3, "c_mktsegment")


def label_counts(spark: SparkSession, d: str) -> DataFrame:
    return ledger.label_counts(table(spark, d, "lineitem"), "l_linestatus", "l_returnflag", ("A", "N", "R"))


def completion_quorum(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return ledger.completion(j, ["c_mktsegment", "c_nationkey"], F.col("o_orderstatus") == "F")


def accepted_join3(spark: SparkSession, d: str) -> DataFrame:
    relations = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("candidate_id"), F.col("l_linenumber").alias("relation_id"), F.expr("cast(l_orderkey % 7 as string)").alias("document_sha256"), F.col("l_returnflag").alias("relation"))
    accepted = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("candidate_id"), F.expr("cast(o_orderkey % 7 as string)").alias("document_sha256"), F.col("o_custkey").alias("document_id"))
    candidates = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("candidate_id"), F.col("c_mktsegment").alias("domain"), F.col("o_orderpriority").alias("subtype"))
    out = ledger.accepted_relations(relations, accepted, candidates, "BUILDING")
    return out.select("candidate_id", "relation_id", "relation", "document_id", "domain", "subtype")


def base_slots_anti(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").where("o_orderstatus = 'P' and o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return ledger.base_slots(table(spark, d, "customer"), orders, "c_custkey").select("c_custkey", "c_mktsegment")


def fallback_union(spark: SparkSession, d: str) -> DataFrame:
    indexed = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("item"), F.lit("indexed").alias("origin"))
    fallback = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit(0).cast("long").alias("item"), F.lit("fallback").alias("origin"))
    return ledger.with_fallback(indexed, fallback, "id")


def latest_grade(spark: SparkSession, d: str) -> DataFrame:
    return audits.latest_grade(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id", "quality", "ungraded")


def ever_vs_latest(spark: SparkSession, d: str) -> DataFrame:
    return audits.ever_vs_latest(table(spark, d, "events"), "user_id", ("ts", "event_id"), F.col("event_type") == "purchase")


def rate_null_rule(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    per = j.groupBy("source", "lang").agg(F.count_if(F.col("toxic") == 1).alias("n_toxic"), F.count_if(F.col("quality") == 1).alias("n_good"))
    return per.withColumn("ratio", F.round(rate(F.col("n_toxic"), F.col("n_good")), 9))


def histogram_repeat(spark: SparkSession, d: str) -> DataFrame:
    return funnel.histogram(table(spark, d, "events"), "user_id")


def map_sum(spark: SparkSession, d: str) -> DataFrame:
    maps = table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n")).groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "n"))).alias("counts"))
    return funnel.summed_maps(maps, "counts")


def domain_rollup(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("domain"))
    customers = table(spark, d, "customer").join(nation, "c_nationkey")
    slots = customers.select(F.col("c_custkey").alias("slot_id"), "domain", F.expr("CASE WHEN c_acctbal > 5000 THEN 'accepted' ELSE 'pending' END").alias("status"))
    candidates = table(spark, d, "orders").join(customers.select(F.col("c_custkey").alias("o_custkey"), "domain"), "o_custkey").select("domain", F.expr(_STATUS).alias("status"))
    extra = customers.where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("slot_id"))
    return ledger.domain_rollup(slots, candidates, extra)


def forecast(spark: SparkSession, d: str) -> DataFrame:
    candidates = table(spark, d, "orders").select(F.expr(_STATUS).alias("status"))
    slots = table(spark, d, "customer").select(F.expr("CASE WHEN c_acctbal > 0 THEN 'accepted' ELSE 'pending' END").alias("status"))
    r = funnel.forecast(candidates, slots)
    flat = r.select("accepted", "rejected", "remaining_slots", *[F.round(c, 6).alias(c) for c in ("acceptance_rate", "lo", "hi")], "expected_additional", F.col("expected_range")[0].alias("fewest"), F.col("expected_range")[1].alias("most"))
    return flat


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """A row per order and line number, which the table repeats."""
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"))


def stage_forecast(spark: SparkSession, d: str) -> DataFrame:
    candidates = table(spark, d, "orders").select(F.col("o_orderkey").alias("candidate_id"), F.expr(_STATUS).alias("status"))
    attempts = _lines(spark, d).select(F.expr("l_orderkey * 10 + l_linenumber").alias("id"), F.col("l_orderkey").alias("candidate_id"), F.expr("l_linenumber % 3").alias("stage"), F.expr("CASE l_returnflag WHEN 'A' THEN 'passed' WHEN 'R' THEN 'failed' ELSE 'cached' END").alias("status"))
    return funnel.stage_forecast(attempts, candidates, F.lit(100))


def issue_delta(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("half", F.expr("event_id % 2"))
    return audits.delta(e.where("half = 0"), e.where("half = 1"), ["user_id", "event_type"])


def issue_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("code"), F.col("l_linestatus").alias("message"), F.expr("cast(l_linenumber as string)").alias("action"), F.expr("cast(l_suppkey as string)").alias("target"))
    return audits.grouped_issues(rows).select("code", "message", "action", F.size("targets").alias("n_targets"), F.array_join("targets", ",").alias("targets"), "n")


def _judged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    candidates = table(spark, d, "orders").select(F.col("o_orderkey").alias("candidate_id"), F.expr(_STATUS).alias("status"))
    li = _lines(spark, d).withColumn("valid", F.expr("CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE 1 END"))
    reviews = li.select(F.expr("l_orderkey * 10 + l_linenumber").alias("id"), F.col("l_orderkey").alias("candidate_id"), F.col("l_linenumber").alias("version"), F.col("valid").alias("response_valid"))
    relations = li.select(F.col("l_orderkey").alias("candidate_id"), F.col("l_linenumber").alias("review_version"), F.col("valid").alias("response_valid"), F.expr("CASE l_returnflag WHEN 'A' THEN 'AMBIGUOUS' WHEN 'R' THEN 'PII' ELSE 'NON_PII' END").alias("observed_privacy"), F.expr("CASE WHEN l_linenumber % 2 = 0 THEN 'single' ELSE 'adjacent' END").alias("mode"))
    return candidates, reviews, relations


def selection_audit(spark: SparkSession, d: str) -> DataFrame:
    return audits.selection_audit(*_judged(spark, d)).withColumn("ambiguity_rate", F.round("ambiguity_rate", 9))


def latest_judgements(spark: SparkSession, d: str) -> DataFrame:
    return audits.latest_judgements(*_judged(spark, d))


def props_design(spark: SparkSession, d: str) -> DataFrame:
    return audits.design_counts(table(spark, d, "events").select(F.col("props").alias("condition_json")), "k")


def interval_by_segment(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "F").alias("passed"), F.count("*").alias("n"))
    low, high = wilson(F.col("passed"), F.col("n"))
    return c.select("o_orderpriority", "passed", "n", F.round(low, 9).alias("lo"), F.round(high, 9).alias("hi"))


QUERIES = {f.__name__: f for f in (
    funnel_wilson, stage_funnel, status_by_composite, reason_distinct, reason_rows, usage_by_key, call_cost, budget_admission, next_attempt, coverage_zero_fill, label_counts,
    completion_quorum, accepted_join3, base_slots_anti, fallback_union, latest_grade, ever_vs_latest, rate_null_rule, histogram_repeat, map_sum, domain_rollup, forecast,
    stage_forecast, issue_delta, issue_groups, selection_audit, latest_judgements, props_design, interval_by_segment,
)}

_WILSON = """
  round(CASE WHEN {n} > 0 THEN greatest(0.0, ({p} + 3.8416/(2.0*{n})) / (1 + 3.8416/{n}) - 1.96*sqrt({p}*(1-{p})/{n} + 3.8416/(4.0*{n}*{n})) / (1 + 3.8416/{n})) END, {r}) AS lo,
  round(CASE WHEN {n} > 0 THEN least(1.0, ({p} + 3.8416/(2.0*{n})) / (1 + 3.8416/{n}) + 1.96*sqrt({p}*(1-{p})/{n} + 3.8416/(4.0*{n}*{n})) / (1 + 3.8416/{n})) END, {r}) AS hi"""


def _interval(p: str, n: str, digits: int) -> str:
    return _WILSON.format(p=f"(CAST({p} AS DOUBLE) / nullif({n}, 0))", n=n, r=digits)


_ST = "CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'rejected' ELSE 'running' END"
ORACLES = {
    "funnel_wilson": f"""
        WITH l AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events),
        c AS (SELECT count(*) unique_keys, count(*) FILTER (event_type IN ('purchase','signup')) passed, count(*) FILTER (event_type <> 'view') completed FROM l WHERE rn = 1)
        SELECT unique_keys, passed, completed, round(CAST(passed AS DOUBLE) / nullif(completed, 0), 6) AS rate, {_interval('passed', 'completed', 6)},
          CASE WHEN passed > 0 THEN CAST(ceil((unique_keys - passed) / (CAST(passed AS DOUBLE) / completed)) AS BIGINT) END AS expected_more FROM c""",
    "stage_funnel": f"""
        WITH e AS (SELECT *, event_id % 5 AS stage FROM events),
        a AS (SELECT stage, count(*) attempts FROM e GROUP BY stage),
        l AS (SELECT *, row_number() OVER (PARTITION BY stage, user_id ORDER BY ts DESC, event_id DESC) rn FROM e),
        c AS (SELECT stage, count(*) unique_keys, count(*) FILTER (event_type IN ('purchase','signup')) passed, count(*) FILTER (event_type <> 'view') completed FROM l WHERE rn = 1 GROUP BY stage)
        SELECT stage, attempts, unique_keys, passed, completed, round(CAST(passed AS DOUBLE) / nullif(completed, 0), 6) AS pass_rate, {_interval('passed', 'completed', 6)} FROM a JOIN c USING (stage)""",
    "status_by_composite": """
        SELECT coalesce(c_mktsegment, '') AS domain, coalesce(nullif(o_orderpriority, '5-LOW'), '') AS subtype, coalesce(CAST(year(o_orderdate) AS VARCHAR), '') AS format,
          count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p, count(*) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "reason_distinct": "SELECT event_type AS reason, count(*) AS n_rows, count(DISTINCT user_id) AS n_keys FROM events GROUP BY 1",
    "reason_rows": "SELECT l_returnflag AS reason, count(*) AS n_reasons, count(DISTINCT l_orderkey) AS n_rows FROM lineitem GROUP BY 1",
    "usage_by_key": "SELECT l_returnflag, l_linestatus, count(*) AS requests, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS cost FROM lineitem GROUP BY ALL",
    "call_cost": "SELECT l_returnflag, round(sum(((l_quantity * 1000 - l_quantity * 250) * 0.4::DOUBLE + l_quantity * 250 * 0.1::DOUBLE + l_linenumber * 100 * 1.6::DOUBLE) / 1000000), 6) AS cost FROM lineitem GROUP BY 1",
    "budget_admission": """
        SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER w, 2) AS running_cost, count(*) OVER w AS running_calls, (sum(o_totalprice) OVER w <= 400000.0) AND (count(*) OVER w <= 10) AS admitted
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""",
    "next_attempt": "SELECT user_id, event_type, CAST(count(*) + 1 AS INTEGER) AS next_attempt FROM events GROUP BY ALL",
    "coverage_zero_fill": """
        SELECT n_nationkey, n_name, count(c_custkey) AS n_rows, count(DISTINCT c_mktsegment) AS n_documents, count(c_custkey) >= 3 AS met
        FROM nation LEFT JOIN customer c ON c_nationkey = n_nationkey GROUP BY ALL""",
    "label_counts": "SELECT l_linestatus, count(*) FILTER (l_returnflag = 'A') AS \"A\", count(*) FILTER (l_returnflag = 'N') AS \"N\", count(*) FILTER (l_returnflag = 'R') AS \"R\" FROM lineitem GROUP BY 1",
    "completion_quorum": "SELECT c_mktsegment, c_nationkey, count(*) AS slots, count(*) FILTER (o_orderstatus = 'F') AS done, bool_and(o_orderstatus = 'F') AS complete FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
    "accepted_join3": """
        SELECT l_orderkey AS candidate_id, l_linenumber AS relation_id, l_returnflag AS relation, o_custkey AS document_id, c_mktsegment AS domain, o_orderpriority AS subtype
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND c_mktsegment = 'BUILDING'""",
    "base_slots_anti": "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_totalprice > 100000)",
    "fallback_union": """
        SELECT o_custkey AS id, o_orderkey AS item, 'indexed' AS origin FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT c_custkey, 0, 'fallback' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
    "latest_grade": "SELECT coalesce(CAST(quality AS VARCHAR), 'ungraded') AS grade, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
    "ever_vs_latest": """
        WITH p AS (SELECT user_id, bool_or(event_type = 'purchase') AS ever, arg_max(event_type = 'purchase', (ts, event_id)) AS latest FROM events GROUP BY 1)
        SELECT ever, latest, count(*) AS n_keys FROM p GROUP BY ALL""",
    "rate_null_rule": """
        SELECT source, lang, count(*) FILTER (toxic = 1) AS n_toxic, count(*) FILTER (quality = 1) AS n_good, round(CAST(count(*) FILTER (toxic = 1) AS DOUBLE) / nullif(count(*) FILTER (quality = 1), 0), 9) AS ratio
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL""",
    "histogram_repeat": "SELECT repeats, count(*) AS n_keys FROM (SELECT count(*) AS repeats FROM events GROUP BY user_id) GROUP BY 1",
    "map_sum": "SELECT l_returnflag AS key, CAST(count(*) AS BIGINT) AS total FROM lineitem GROUP BY 1",
    "domain_rollup": f"""
        WITH cu AS (SELECT c_custkey, n_name AS domain, c_acctbal, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey),
        s AS (SELECT domain, count(*) slots, count(*) FILTER (c_mktsegment <> 'MACHINERY') base_slots, count(*) FILTER (c_mktsegment = 'MACHINERY') supplemental_slots, count(*) FILTER (c_acctbal <= 5000) remaining_slots FROM cu GROUP BY 1),
        k AS (SELECT domain, count(*) FILTER (({_ST}) = 'accepted') accepted, count(*) FILTER (({_ST}) = 'rejected') rejected FROM orders JOIN cu ON o_custkey = c_custkey GROUP BY 1)
        SELECT s.*, coalesce(accepted, 0) AS accepted, coalesce(rejected, 0) AS rejected, round(CAST(accepted AS DOUBLE) / nullif(accepted + rejected, 0), 6) AS acceptance_rate FROM s LEFT JOIN k USING (domain)""",
    "forecast": f"""
        WITH c AS (SELECT count(*) FILTER (o_orderstatus = 'F') accepted, count(*) FILTER (o_orderstatus = 'O') rejected FROM orders),
        s AS (SELECT count(*) FILTER (c_acctbal <= 0) remaining_slots FROM customer),
        w AS (SELECT *, CAST(accepted AS DOUBLE) / (accepted + rejected) AS p, {_interval('accepted', '(accepted + rejected)', 15)} FROM c, s)
        SELECT accepted, rejected, remaining_slots, round(p, 6) AS acceptance_rate, round(lo, 6) AS lo, round(hi, 6) AS hi, CAST(ceil(remaining_slots / p) AS BIGINT) AS expected_additional,
          CAST(ceil(remaining_slots / hi) AS BIGINT) AS fewest, CAST(ceil(remaining_slots / lo) AS BIGINT) AS most FROM w""",
    "stage_forecast": """
        WITH t AS (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O')), n AS (SELECT count(*) AS n FROM t),
        l AS (SELECT l_linenumber % 3 AS stage, l_returnflag, row_number() OVER (PARTITION BY l_linenumber % 3, l_orderkey ORDER BY l_linenumber DESC) rn FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL) WHERE l_orderkey IN (SELECT o_orderkey FROM t)),
        c AS (SELECT stage, count(*) AS e, count(*) FILTER (l_returnflag <> 'R') AS p FROM l WHERE rn = 1 GROUP BY 1)
        SELECT stage, round_even(100.0::DOUBLE * e / n, 2) AS more_entries, round_even(100.0::DOUBLE * p / n, 2) AS more_passes, round_even(100.0::DOUBLE * (e - p) / n, 2) AS more_nonpasses FROM c, n""",
    "issue_delta": """
        WITH a AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 2 = 0), b AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 2 = 1)
        SELECT *, 'resolved' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'new' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "issue_groups": """
        SELECT l_returnflag AS code, l_linestatus AS message, CAST(l_linenumber AS VARCHAR) AS action, CAST(count(DISTINCT l_suppkey) AS INTEGER) AS n_targets,
          array_to_string(list_sort(list_distinct(list(CAST(l_suppkey AS VARCHAR)))), ',') AS targets, count(*) AS n FROM lineitem GROUP BY ALL""",
    "selection_audit": """
        WITH li AS (SELECT l_orderkey AS id, l_linenumber AS v, l_linenumber % 3 <> 0 AS valid, min(l_returnflag) = 'A' AS amb FROM lineitem GROUP BY l_orderkey, l_linenumber),
        l AS (SELECT id, arg_max(valid, v) AS valid, arg_max(amb, v) AS amb FROM li GROUP BY id),
        e AS (SELECT id, bool_or(amb) AS ever FROM li WHERE valid GROUP BY id),
        j AS (SELECT l.*, coalesce(ever, false) AS ever, o_orderstatus AS s FROM l LEFT JOIN e USING (id) LEFT JOIN orders ON o_orderkey = id)
        SELECT count(*) AS reviewed, count(*) FILTER (valid) AS valid_latest, count(*) FILTER (NOT valid) AS invalid_latest, count(*) FILTER (valid) AS observed, count(*) FILTER (valid AND amb) AS latest_ambiguous,
          count(*) FILTER (ever) AS ever_ambiguous, count(*) FILTER (ever AND s = 'F') AS ever_ambiguous_accepted, count(*) FILTER (ever AND s = 'O') AS ever_ambiguous_rejected,
          round(CAST(count(*) FILTER (valid AND amb) AS DOUBLE) / nullif(count(*) FILTER (valid), 0), 9) AS ambiguity_rate FROM j""",
    "latest_judgements": """
        WITH li AS (SELECT l_orderkey AS id, l_linenumber AS v, min(l_returnflag) AS f FROM lineitem GROUP BY 1, 2), l AS (SELECT id, max(v) AS v, arg_max(f, v) AS f FROM li GROUP BY 1)
        SELECT CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'rejected' ELSE 'running' END AS status, CASE WHEN v % 2 = 0 THEN 'single' ELSE 'adjacent' END AS mode,
          CASE f WHEN 'A' THEN 'AMBIGUOUS' WHEN 'R' THEN 'PII' ELSE 'NON_PII' END AS observed_privacy, count(*) AS n FROM l JOIN orders ON o_orderkey = id WHERE v % 3 <> 0 GROUP BY 1, 2, 3""",
    "props_design": "SELECT json_extract_string(props, '$.k') AS value, count(*) AS n FROM events WHERE props IS NOT NULL AND props <> '' GROUP BY 1",
    "interval_by_segment": f"WITH c AS (SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS passed, count(*) AS n FROM orders GROUP BY 1) SELECT o_orderpriority, passed, n, {_interval('passed', 'n', 9)} FROM c",
}
