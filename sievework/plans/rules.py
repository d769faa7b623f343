"""Queries over the single rules and text functions, with their SQL. Orders are plans or documents, their lines entities, sentences or relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import text as t
from sievework.operators import audits, dedup, document, drafts, graph, ledger, policies, review
from sievework.plans.revisions import _lines
from sievework.plans.steps import dealt, written
from sievework.sources.tables import table


def final_consonants(spark: SparkSession, d: str) -> DataFrame:
    """Names of customers end with a digit, which decides."""
    name = F.col("c_name")
    return table(spark, d, "customer").select("c_custkey", t.final_consonant(name).alias("heard"), *(t.particle(name, F.lit(p)).alias(n) for n, p in (("topic", "은/는"), ("way", "으로/로"), ("copula", "이다/다"))))


def particle_markers(spark: SparkSession, d: str) -> DataFrame:
    raw = F.expr("""concat(CASE c_custkey % 6 WHEN 0 THEN '〈NAME:E1〉은 왔다' WHEN 1 THEN '<NAME:E1> {josa:는/은} 왔다' WHEN 2 THEN '<NAME:E1>{josa:에/에} 왔다' WHEN 3 THEN '<NAME:E1>{josa:가} 왔다' WHEN 4 THEN '<NAME:E1>{josa:x/y} 왔다' ELSE '은 왔다' END, c_custkey)""")
    return table(spark, d, "customer").select("c_custkey", t.normalise_particles(raw).alias("text"))


def numeric_field_values(spark: SparkSession, d: str) -> DataFrame:
    raw = F.expr("concat('금액: 1,', lpad(o_custkey % 1000, 3, '0'), ' 원, 기간 : ', o_orderkey % 30, '일. 금액:', o_orderkey, '원 메모: 없음')")
    return table(spark, d, "orders").select("o_orderkey", F.explode(t.numeric_fields(raw)).alias("label", "amount"))


def typed_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Bare ids of lines that weren't returned become tokens."""
    lines = _lines(spark, d).withColumnRenamed("doc_id", "plan_id")
    segments = lines.select("plan_id", "n", F.expr("concat('E', n, ' ships; E9x, E99 and <X:E', n, '> stay, E', n, '은')").alias("text"))
    entities = lines.where("flag <> 'R'").select("plan_id", F.concat(F.lit("E"), "n").alias("entity_id"), F.expr("IF(part % 2 = 0, 'NAME', 'EMAIL')").alias("entity_type"))
    return drafts.typed_ids(segments, entities)


def rendered_orders(spark: SparkSession, d: str) -> DataFrame:
    """A sentence per order with a name, its particle and a reference; every seventh order asks for a particle that isn't one, every eleventh lacks the reference."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("doc_id"), "c_name", "o_orderpriority")
    segments = o.select("doc_id", F.lit(0).alias("position"), F.expr("concat('Order <NAME:E1>{josa:', IF(doc_id % 7 = 0, 'x/y', '은/는'), '} of <REF:C1>.')").alias("text"))
    values = o.select("doc_id", F.lit("E1").alias("slot"), F.lit("NAME").alias("kind"), F.col("c_name").alias("value")).unionByName(
        o.where("doc_id % 11 <> 0").select("doc_id", F.lit("C1").alias("slot"), F.lit("REF").alias("kind"), F.col("o_orderpriority").alias("value")))
    out = document.render(segments, values)
    return out.select("doc_id", "sentence", F.col("mentions")[0]["begin"].alias("begin"), F.col("mentions")[0]["end"].alias("end"), F.col("refs")[0]["begin"].alias("ref_begin"))


def _people(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities, constraints and relations: line 1 is a name, the others by part; slot groups by part too; even plans say that E1 and E2 are one persona."""
    lines = _lines(spark, d).withColumnRenamed("doc_id", "plan_id").withColumn("entity_id", F.concat(F.lit("E"), "n"))
    kind = F.expr("CASE WHEN n = 1 OR part % 5 = 0 THEN 'NAME' WHEN part % 5 < 3 THEN 'EMAIL' ELSE 'WORKPLACE' END")
    entities = lines.select("plan_id", "entity_id", kind.alias("entity_type"), F.expr("concat('G', part % 3)").alias("slot_group"), "n", "flag", "part")
    two = lines.where("n = 2").select("plan_id", "part")
    same = two.where("plan_id % 2 = 0").selectExpr("plan_id", "'C1' AS constraint_id", "'same_persona' AS kind", "'' AS field", "array('E1', 'E2') AS entity_ids", "cast(array() AS array<string>) AS allowed_values")
    jobs = two.selectExpr("plan_id", "explode(array(struct('C2' AS c, array('E1') AS e, array('a', 'b') AS v), struct('C3' AS c, array('E2') AS e, IF(plan_id % 3 = 0, array('c'), array('b', 'c')) AS v))) AS x")
    constraints = same.unionByName(jobs.selectExpr("plan_id", "x.c AS constraint_id", "'occupation' AS kind", "'' AS field", "x.e AS entity_ids", "x.v AS allowed_values"))
    relations = lines.where("n > 1").selectExpr("plan_id", "concat('R', n) AS relation_id", "'E1' AS source", "entity_id AS target", "IF(part % 2 = 0, 'GUIDANCE_SUPPORT', 'other') AS relation", "IF(flag = 'R', 'PII', 'NON_PII') AS target_privacy")
    return entities, constraints, relations


def _groups(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    entities, constraints, relations = _people(spark, d)
    links = entities.limit(0).select("plan_id", F.lit("").alias("name_entity_id"), "entity_id", F.lit("").alias("link_kind"))
    pairs = graph.value_group_edges(entities, constraints, relations.where("false"), links)
    return graph.value_groups(entities, pairs, ("entity_type",)), entities, constraints


def value_groups(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d)[0].drop("entity_type")


def value_conflicts(spark: SparkSession, d: str) -> DataFrame:
    groups, entities, constraints = _groups(spark, d)
    return graph.group_conflicts(entities, dealt(written(groups), "plan_id"), constraints)


def person_links(spark: SparkSession, d: str) -> DataFrame:
    entities, _, relations = _people(spark, d)
    return graph.person_links(relations, entities)


def party_links(spark: SparkSession, d: str) -> DataFrame:
    """Relations by which an actual party cites an example person, where the policy allows it."""
    entities, _, relations = _people(spark, d)
    persons = entities.where("entity_type = 'NAME'").selectExpr("plan_id", "entity_id AS name_entity_id", "IF(n = 1, 'actual_party', 'example_person') AS context_kind")
    wanted = entities.select("plan_id").distinct().selectExpr("plan_id", "IF(plan_id % 3 > 0, 'party_link_v1', 'none') AS reference_link_policy")
    return policies.with_people(relations, persons, wanted).select("plan_id", "relation_id", "party_link")


def direct_evidence(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(spark, d)
    sentences = lines.select("doc_id", F.expr("concat('S', n)").alias("sentence_id"), F.expr("array(concat('A', part % 3), concat('B', part % 2))").alias("entity_ids"))
    ends = lines.select("doc_id").distinct().select("doc_id", F.lit("R1").alias("relation_id"), F.lit("A0").alias("source"), F.lit("B0").alias("target"))
    return document.direct_evidence(sentences, ends).select("doc_id", "relation_id", F.array_join("ids", ",").alias("ids"))


def segment_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids that repeat, or aren't S1, S2, ..., get the next numbers."""
    segments = _lines(spark, d).select("doc_id", F.col("n").alias("position"), F.expr("concat('S', part % 5)").alias("sentence_id"))
    return document.unique_ids(segments).select("doc_id", "position", "new_id")


def spec_findings(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(spark, d)
    sentences = lines.selectExpr("doc_id", "concat('S', n) AS sentence_id", "IF(n % 2 = 1, 'A', 'B') AS section_id", "IF(flag = 'N', 'heading', 'prose') AS kind", "IF(part % 4 = 0, ' short ', 'a sentence of some length') AS sentence")
    findings = lines.selectExpr("doc_id", "concat('k', n) AS check_id", "IF(part % 3 = 0, '', 'A') AS section_id", "part % 5 > 0 AS passed", "IF(part % 7 = 0, ' ', 'why') AS reason", "array(concat('S', n), IF(part % 11 = 0, concat('S', n), 'S1')) AS evidence")
    return document.spec_issues(findings, sentences)


def concrete_facts(spark: SparkSession, d: str) -> DataFrame:
    ending = F.expr("CASE p_partkey % 4 WHEN 0 THEN ' 기재한다. ' WHEN 1 THEN ' 작성한다 x' WHEN 2 THEN ' 설명한다!' ELSE '' END")
    return table(spark, d, "part").select("p_partkey", document.concrete(F.concat(F.substring("p_name", 1, 7), ending)).alias("concrete"))


def repair_audit(spark: SparkSession, d: str) -> DataFrame:
    payload = F.to_json(F.expr("""struct(value > 50 AS structural_targets_satisfied, user_id % 2 = 0 AS all_code_checks_passed, value < 10 AS no_effective_progress, user_id % 3 = 0 AS length_only_progress,
        array_repeat('E1', cast(user_id % 4 AS int)) AS remaining_missing_entities, array_repeat('R1', cast(user_id % 2 AS int)) AS remaining_invalid_relation_ids)"""))
    events = table(spark, d, "events").select(F.expr("IF(event_type = 'error', 'repair_evaluated', event_type)").alias("kind"), payload.alias("payload"))
    return audits.repair_audit(events)


def same_multisets(spark: SparkSession, d: str) -> DataFrame:
    """Whether the flags of an order's odd lines are those of its even lines."""
    per = _lines(spark, d).groupBy("doc_id").agg(*(F.collect_list(F.when(F.col("n") % 2 == k, F.col("flag"))).alias(c) for k, c in ((1, "a"), (0, "b"))))
    return per.select("doc_id", policies.same_multiset(F.col("a"), F.col("b")).alias("same"))


def neighbours(spark: SparkSession, d: str) -> DataFrame:
    rows = drafts.with_neighbours(table(spark, d, "conversations"), ["conv_id", "role"], "turn")
    return rows.select("conv_id", "turn", F.md5(F.coalesce("before", F.lit("-"))).alias("before"), F.md5(F.coalesce("after", F.lit("-"))).alias("after"))


def reviewer_views(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose lines, an array of structs, lose what a reviewer mustn't see."""
    per = _lines(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("n", F.col("flag").alias("target_privacy"), F.struct(F.col("part").alias("id"), F.col("flag").alias("context_reason")).alias("end")))).alias("relations"))
    return review.reviewer_view(per.withColumn("scene_id", F.lit("SC1"))).select("doc_id", F.to_json("relations").alias("relations"))


def consumer_views(spark: SparkSession, d: str) -> DataFrame:
    per = _lines(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("n", "flag", F.struct(F.col("part").alias("id"), "flag").alias("end")))).alias("lines"))
    return review.consumer_view(per, {"doc_id": None, "lines": {"end": {"id": None}}}).select("doc_id", F.to_json("lines").alias("lines"))


def unplanned_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Entities named in one sentence whose pair is no relation."""
    _, _, relations = _people(spark, d)
    segments = _lines(spark, d).selectExpr("doc_id AS plan_id", "concat('S', n) AS sentence_id", "concat('<NAME:E1> and <EMAIL:E', n, '> met <X:E', 1 + n % 3, '>') AS text")
    return drafts.suspected_pairs(segments, relations)


def full_review(spark: SparkSession, d: str) -> DataFrame:
    """Orders as documents of three sentences with a full review each; all but every sixteenth review has a fault."""
    o = table(spark, d, "orders").selectExpr("o_orderkey AS doc_id", "o_orderkey % 16 AS k")
    quote = lambda *q: "array(" + ", ".join(f"struct('{s}' AS sentence_id, '{t}' AS quote)" for s, t in q) + ")"
    some = lambda rows: o.selectExpr("doc_id", f"inline({rows})")
    none, no_quotes = "cast(array() AS array<array<string>>)", "cast(array() AS array<struct<sentence_id:string,quote:string>>)"
    sentences = some("array(struct('S1' AS sentence_id, 'Kim works at Acme.' AS sentence), struct('S2' AS sentence_id, 'He likes it.' AS sentence), struct('S3' AS sentence_id, 'other text' AS sentence))")
    mentions = some("array(struct('S1' AS sentence_id, 'E1' AS entity_id), struct('S1' AS sentence_id, 'E2' AS entity_id))")
    referred = mentions.unionByName(o.selectExpr("doc_id", "'S2' AS sentence_id", "'E1' AS entity_id"))
    relations = o.selectExpr(
        "doc_id", "IF(k = 6, 'R9', 'R1') AS relation_id", "true AS extractable", "true AS direction_supported", "true AS coreference_unambiguous", "CASE k WHEN 2 THEN 'NON_PII' WHEN 3 THEN 'AMBIGUOUS' ELSE 'PII' END AS observed_privacy",
        f"CASE k WHEN 1 THEN {quote(('S1', 'nope'))} WHEN 4 THEN {no_quotes} WHEN 5 THEN {quote(('S3', 'other'))} ELSE {quote(('S1', 'works at'))} END AS quotes", f"CASE k WHEN 4 THEN {none} WHEN 5 THEN array(array('S3')) ELSE array(array('S1')) END AS groups")
    references = o.where("k <> 7").selectExpr("doc_id", "'C1' AS ref_id", "IF(k = 8, 'E9', 'E1') AS observed_entity_id", "true AS unambiguous", f"{quote(('S1', 'Kim'), ('S2', 'He'))} AS quotes", "IF(k = 9, array(array('S2')), array(array('S1', 'S2'))) AS groups")
    extra = o.where("k IN (10, 11)").selectExpr("doc_id", "'E1/E3' AS item_id", f"IF(k = 10, {no_quotes}, {quote(('S3', 'text'))}) AS quotes", f"IF(k = 10, {none}, array(array('S3'))) AS groups")
    persons = o.selectExpr("doc_id", "'E1' AS name_entity_id", "IF(k = 12, 'doctor', 'applicant') AS role", "'actual_party' AS context_kind", f"{quote(('S1', 'Kim'))} AS quotes", "array(array('S1')) AS groups")
    ids = "cast(array() AS array<string>)"
    reviewed = review.Reviewed(
        relations=relations, references=references, extra=extra, persons=persons,
        counts=o.selectExpr("doc_id", "IF(k = 15, 2, 1) AS actual_person_count", "1 AS n_parties", "0 AS unregistered_names"),
        unregistered=o.where("k = 13").selectExpr("doc_id", "'S3' AS sentence_id"),
        contradictions=o.where("k = 13").selectExpr("doc_id", f"explode(array(array('S9'), {ids})) AS sentence_ids"),
        findings=o.where("k IN (14, 15)").selectExpr("doc_id", "IF(k = 14, 'fluency', 'format') AS kind", f"IF(k = 14, {ids}, array('S2', 'S3')) AS sentence_ids", "array('R1') AS relation_ids"),
        grades=o.selectExpr("doc_id", "k <> 15 AS format_ok", f"IF(k = 14, '{review.MIDDLE}', '{review.TOP}') AS overall", f"'{review.TOP}' AS consistency", f"IF(k = 15, '{review.LOW}', '{review.TOP}') AS suitability", f"'{review.MIDDLE}' AS fluency"),
        planned=o.selectExpr("doc_id", "'R1' AS relation_id", "'E1' AS source", "'E2' AS target", "'PII' AS target_privacy"), refs=o.selectExpr("doc_id", "'C1' AS ref_id", "'E1' AS entity_id", "array('S2') AS sentence_ids"),
        people=o.selectExpr("doc_id", "'E1' AS name_entity_id", "'applicant' AS role", "'actual_party' AS context_kind"), names=o.selectExpr("doc_id", "'E1' AS name_entity_id", "array('S1') AS sentence_ids"),
        mentions=mentions, documents=review.by_document(sentences, referred),
    )
    return review.full_gate(reviewed)


def mention_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Orders as documents, their lines as sentences of two scenes with a mention each; of three entities one is personal."""
    lines = _lines(spark, d)
    sentences = lines.selectExpr("doc_id", "n AS position", "concat('Line ', part, '.') AS sentence", "concat('SC', n % 2) AS scene_id")
    mentions = lines.selectExpr("doc_id", "concat('E', part % 3) AS entity_id", "n AS position", "cast(part % 4 AS int) AS begin")
    labels = lines.select("doc_id").distinct().selectExpr("doc_id", "explode(array('E0', 'E1', 'E2')) AS entity_id").selectExpr("doc_id", "entity_id", "IF(entity_id = 'E0', 'PII', 'NON_PII') AS privacy")
    out = audits.mention_distribution(sentences, mentions, labels)
    text = lambda c: F.coalesce(F.array_join(c, ","), F.lit("")).alias(c)
    return out.select("doc_id", "pii_mentions", "non_pii_mentions", "pii_repeated", "non_pii_repeated", F.round("pii_share", 9).alias("pii_share"), text("pii_scenes"), text("non_pii_scenes"), text("pii_thirds"), text("non_pii_thirds"))


def evidence_remap(spark: SparkSession, d: str) -> DataFrame:
    """Relations whose sentences were renumbered: evidence that two sentences could be meant by goes."""
    segments = _lines(spark, d).select("doc_id", F.col("n").alias("position"), F.expr("concat('S', part % 5)").alias("sentence_id"))
    renamed = document.unique_ids(segments)
    evidence = segments.select("doc_id", F.expr("concat('R', position)").alias("relation_id"), F.array(F.array("sentence_id", F.lit("S77")), F.array("sentence_id", "sentence_id")).alias("groups"))
    out = document.remapped_evidence(evidence, renamed.select("doc_id", F.col("sentence_id").alias("old_id"), "new_id"))
    return out.select("doc_id", "relation_id", F.array_join(F.transform("groups", lambda g: F.array_join(g, "+")), ",").alias("groups"))


def design_table(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 9 > 0, F.to_json(F.expr("struct(o_orderpriority AS format, o_orderstatus AS variant, o_custkey % 4 AS n_parties)"))).alias("condition_json"))
    return audits.design(o, ["format", "variant", "n_parties"])


def completion_state(spark: SparkSession, d: str) -> DataFrame:
    """By nation: whether all orders are delivered or open, and whether all priorities were ordered three times."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("domain"), "o_orderstatus", "o_orderpriority", "o_orderkey")
    quota = ledger.completion(o.where("o_orderkey % 50 = 0"), ["domain"], F.col("o_orderstatus") != "P")
    required = o.select("domain").distinct().crossJoin(F.broadcast(o.select("o_orderpriority").distinct()))  # five priorities
    counts = o.groupBy("domain", "o_orderpriority").agg(F.count("*").alias("n"))
    met = required.join(counts, ["domain", "o_orderpriority"], "left").select("domain", (F.coalesce("n", F.lit(0)) >= 3).alias("met"))
    return ledger.complete_with_coverage(quota, met, ["domain"])


def compatible_triples(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    relation = "IF(p_type = 'PROMO', 'INFORMATION_GOVERNANCE', p_type)"
    triples = part.selectExpr("p_partkey", "p_brand AS subtype", "IF(p_partkey % 2 = 0, 'NAME', 'SCHOOL') AS source_type", f"{relation} AS relation", "IF(p_partkey % 3 = 0, 'EMAIL', 'AGE') AS target_type")
    allowed = part.where("p_retailprice % 100 > 50").selectExpr("p_brand AS subtype", f"{relation} AS relation")
    return graph.compatible(triples, allowed).select("p_partkey", "subtype", "relation")


def duplicate_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Orders as candidates: their lines' flags are the plan, the number of lines the structure; every seventh format is fixed."""
    per = _lines(spark, d).groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("flag")), "").alias("plan"), F.count("*").alias("k"))
    rows = per.join(table(spark, d, "orders"), F.col("doc_id") == F.col("o_orderkey")).selectExpr(
        "doc_id", "plan", "concat('T', k) AS structure", "concat(o_orderpriority, o_custkey % 40) AS format", "o_custkey % 40 % 7 = 0 AS fixed_format", "o_totalprice % 100 / 100 AS jaccard", "o_custkey AS nearest")
    return dedup.duplicate_issues(rows, "doc_id")


QUERIES = {f.__name__: f for f in (
    mention_distribution, evidence_remap, design_table, completion_state, compatible_triples, duplicate_verdicts, full_review, final_consonants, particle_markers, numeric_field_values, typed_tokens, rendered_orders, value_groups, value_conflicts, person_links, party_links, direct_evidence, segment_ids, spec_findings, concrete_facts,
    repair_audit, same_multisets, neighbours, reviewer_views, consumer_views, unplanned_pairs,
)}

_L = "l AS (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n, l_returnflag AS flag, l_partkey AS part FROM lineitem)"
_E = f"{_L}, e AS (SELECT doc_id AS plan_id, n, 'E' || n AS entity_id, CASE WHEN n = 1 OR part % 5 = 0 THEN 'NAME' WHEN part % 5 < 3 THEN 'EMAIL' ELSE 'WORKPLACE' END AS entity_type, part % 3 AS s, flag, part FROM l)"
_G = f"""{_E}, h AS (SELECT plan_id, max(CASE WHEN n = 1 THEN s END) AS s1, max(CASE WHEN n = 2 THEN s END) AS s2 FROM e GROUP BY 1),
        m AS (SELECT e.*, CASE WHEN plan_id % 2 = 0 AND s = s2 THEN s1 ELSE s END AS g FROM e JOIN h USING (plan_id)), v AS (SELECT *, min(entity_id) OVER (PARTITION BY plan_id, g) AS value_group FROM m)"""
_HEARD = "CASE right(c_name, 1) WHEN '0' THEN 21 WHEN '1' THEN 8 WHEN '3' THEN 16 WHEN '6' THEN 1 WHEN '7' THEN 8 WHEN '8' THEN 8 ELSE 0 END"
ORACLES = {
    "mention_distribution": f"""WITH {_L}, t AS (SELECT *, length('Line ' || part || '.') AS len FROM l), p AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
          sum(len) OVER (PARTITION BY doc_id) AS total FROM t), m AS (SELECT doc_id, part % 3 AS e, 'SC' || (n % 2) AS scene, least(2, (start + part % 4) * 3 // total) AS third FROM p),
        k AS (SELECT doc_id, e, count(*) AS c FROM m GROUP BY 1, 2), r AS (SELECT doc_id, count(*) FILTER (e = 0 AND c > 1) AS pr, count(*) FILTER (e > 0 AND c > 1) AS nr FROM k GROUP BY 1)
        SELECT doc_id, count(*) FILTER (e = 0) AS pii_mentions, count(*) FILTER (e > 0) AS non_pii_mentions, any_value(pr) AS pii_repeated, any_value(nr) AS non_pii_repeated, round(CAST(count(*) FILTER (e = 0) AS DOUBLE) / count(*), 9) AS pii_share,
          coalesce(string_agg(DISTINCT scene, ',' ORDER BY scene) FILTER (e = 0), '') AS pii_scenes, coalesce(string_agg(DISTINCT scene, ',' ORDER BY scene) FILTER (e > 0), '') AS non_pii_scenes,
          coalesce(array_to_string(list_sort(list(DISTINCT CAST(third AS INTEGER)) FILTER (e = 0)), ','), '') AS pii_thirds, coalesce(array_to_string(list_sort(list(DISTINCT CAST(third AS INTEGER)) FILTER (e > 0)), ','), '') AS non_pii_thirds FROM m JOIN r USING (doc_id) GROUP BY 1""",
    "evidence_remap": f"""WITH {_L}, b AS (SELECT doc_id, n, part % 5 AS s, count(*) OVER (PARTITION BY doc_id, part % 5) AS k, part % 5 = 0 OR row_number() OVER (PARTITION BY doc_id, part % 5 ORDER BY n) > 1 AS bad FROM l),
        i AS (SELECT *, 'S' || CASE WHEN bad THEN max(s) OVER (PARTITION BY doc_id) + count(*) FILTER (bad) OVER (PARTITION BY doc_id ORDER BY n) ELSE s END AS id FROM b)
        SELECT doc_id, 'R' || n AS relation_id, CASE WHEN k > 1 THEN '' ELSE id || '+S77,' || id END AS groups FROM i""",
    "design_table": """WITH o AS (SELECT * FROM orders WHERE o_orderkey % 9 > 0) SELECT 'format' AS field, o_orderpriority AS value, count(*) AS n FROM o GROUP BY 2 UNION ALL SELECT 'variant', o_orderstatus, count(*) FROM o GROUP BY 2
        UNION ALL SELECT 'n_parties', CAST(o_custkey % 4 AS VARCHAR), count(*) FROM o GROUP BY 2""",
    "completion_state": """WITH o AS (SELECT c_nationkey AS domain, o_orderstatus, o_orderpriority, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey), q AS (SELECT domain, bool_and(o_orderstatus <> 'P') AS q FROM o WHERE o_orderkey % 50 = 0 GROUP BY 1),
        c AS (SELECT domain, bool_and(n >= 3) AS c FROM (SELECT d.domain, p.o_orderpriority, count(o_orderkey) AS n FROM (SELECT DISTINCT domain FROM o) d CROSS JOIN (SELECT DISTINCT o_orderpriority FROM o) p LEFT JOIN o ON o.domain = d.domain AND o.o_orderpriority = p.o_orderpriority GROUP BY 1, 2) GROUP BY 1)
        SELECT domain, q AS quota_complete, c AS coverage_complete, q AND c AS complete FROM q JOIN c USING (domain)""",
    "compatible_triples": """WITH p AS (SELECT *, CASE WHEN p_type = 'PROMO' THEN 'INFORMATION_GOVERNANCE' ELSE p_type END AS relation FROM part)
        SELECT p_partkey, p_brand AS subtype, relation FROM p WHERE (p_brand, relation) IN (SELECT (p_brand, relation) FROM p WHERE p_retailprice % 100 > 50) AND NOT (relation = 'INFORMATION_GOVERNANCE' AND p_partkey % 6 = 0)""",
    "duplicate_verdicts": f"""WITH {_L}, g AS (SELECT doc_id, string_agg(flag, '' ORDER BY flag) AS plan, 'T' || count(*) AS structure FROM l GROUP BY 1),
        r AS (SELECT *, o_orderpriority || (o_custkey % 40) AS f FROM g JOIN orders ON doc_id = o_orderkey), n AS (SELECT *, row_number() OVER (PARTITION BY structure, f ORDER BY doc_id) AS s, row_number() OVER (PARTITION BY plan ORDER BY doc_id) AS p FROM r)
        SELECT doc_id, 'CONTENT_DUPLICATE' AS code, CAST(o_custkey AS VARCHAR) AS target FROM n WHERE o_totalprice % 100 / 100 >= 0.55 UNION ALL SELECT doc_id, 'STRUCTURE_DUPLICATE', structure FROM n WHERE s > 5 AND o_custkey % 40 % 7 <> 0 UNION ALL SELECT doc_id, 'PLAN_DUPLICATE', plan FROM n WHERE p > 3""",
    "full_review": """SELECT o_orderkey AS doc_id, code, target FROM orders JOIN (VALUES (1, 'REVIEW_QUOTE', 'S1'), (1, 'REVIEW_EVIDENCE_QUOTE_MISSING', 'S1'), (2, 'RELATION_MEANING', 'R1'), (3, 'PRIVACY_AMBIGUOUS', 'R1'),
        (4, 'REVIEW_MISSING_EVIDENCE', 'R1'), (5, 'REVIEW_ENDPOINT_EVIDENCE', 'R1'), (6, 'REVIEW_RELATION_COVERAGE', 'R1'), (6, 'REVIEW_RELATION_COVERAGE', 'R9'), (7, 'REVIEW_REFERENCE_COVERAGE', 'C1'),
        (8, 'REVIEW_REFERENCE_ENTITY', 'C1'), (8, 'REFERENCE_MEANING', 'C1'), (9, 'REVIEW_REFERENCE_CONNECTION', 'C1'), (10, 'REVIEW_EXTRA_EVIDENCE', 'E1/E3'), (10, 'UNPLANNED_RELATIONS', ''), (11, 'UNPLANNED_RELATIONS', 'S3'),
        (12, 'PERSON_ROLE_MEANING', 'E1'), (13, 'UNREGISTERED_ENTITIES', 'S3'), (13, 'REVIEW_TEXT_TARGET', 'S9'), (13, 'CONTRADICTIONS', ''), (14, 'REVIEW_TEXT_TARGET', ''), (14, 'QUALITY_GRADE', ''), (14, 'REVIEW_QUALITY_TARGET', ''),
        (15, 'TEXT_FORMAT', 'S2'), (15, 'TEXT_FORMAT', 'S3'), (15, 'FORMAT_MEANING', ''), (15, 'QUALITY_GRADE', ''), (15, 'REVIEW_PERSON_COUNT', ''), (15, 'PERSON_COUNT_MEANING', '')) f(k, code, target) ON o_orderkey % 16 = k""",
    "final_consonants": f"SELECT c_custkey, {_HEARD} AS heard, CASE {_HEARD} WHEN 0 THEN '는' ELSE '은' END AS topic, CASE WHEN {_HEARD} IN (0, 8) THEN '로' ELSE '으로' END AS way, '이다' AS copula FROM customer",
    "particle_markers": """SELECT c_custkey, CASE c_custkey % 6 WHEN 2 THEN '<NAME:E1>에 왔다' WHEN 3 THEN '<NAME:E1>{josa:이/가} 왔다' WHEN 4 THEN '<NAME:E1>{josa:x/y} 왔다' WHEN 5 THEN '은 왔다' ELSE '<NAME:E1>{josa:은/는} 왔다' END || c_custkey AS text FROM customer""",
    "numeric_field_values": "SELECT o_orderkey, '금액' AS label, o_orderkey || '원' AS amount FROM orders UNION ALL SELECT o_orderkey, '기간', (o_orderkey % 30) || '일' FROM orders",
    "typed_tokens": f"""WITH {_L}, k AS (SELECT *, CASE WHEN flag = 'R' THEN 'E' || n ELSE '<' || CASE WHEN part % 2 = 0 THEN 'NAME' ELSE 'EMAIL' END || ':E' || n || '>' END AS k FROM l)
        SELECT doc_id AS plan_id, CAST(n AS INTEGER) AS n, k || ' ships; E9x, E99 and <X:E' || n || '> stay, ' || k || '은' AS text FROM k""",
    "rendered_orders": f"""SELECT o_orderkey AS doc_id, CASE WHEN ok THEN 'Order ' || c_name || p || ' of ' || o_orderpriority || '.' END AS sentence, CASE WHEN ok THEN 6 END AS begin, CASE WHEN ok THEN CAST(6 + length(c_name) AS INTEGER) END AS "end",
        CASE WHEN ok THEN CAST(6 + length(c_name) + 5 AS INTEGER) END AS ref_begin FROM (SELECT *, o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AS ok, CASE {_HEARD} WHEN 0 THEN '는' ELSE '은' END AS p FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "value_groups": f"WITH {_G} SELECT plan_id, entity_id, value_group FROM v",
    "value_conflicts": f"""WITH {_G} SELECT plan_id, value_group, 'VALUE_GROUP_TYPE_CONFLICT' AS code, entity_type AS detail FROM v GROUP BY plan_id, value_group, entity_type HAVING count(*) > 1
        UNION ALL SELECT a.plan_id, a.value_group, 'VALUE_ALLOWED_CONFLICT', 'occupation' FROM v a JOIN v b ON a.plan_id = b.plan_id AND a.n = 1 AND b.n = 2 AND a.value_group = b.value_group WHERE a.plan_id % 3 = 0""",
    "person_links": f"""WITH {_E} SELECT plan_id, entity_id AS name, entity_id, 'identity' AS link_kind FROM e WHERE entity_type = 'NAME'
        UNION ALL SELECT plan_id, 'E1', entity_id, CASE WHEN flag = 'R' AND entity_type = 'EMAIL' THEN 'personal_attribute' ELSE 'related_context' END FROM e WHERE n > 1""",
    "party_links": f"WITH {_E} SELECT plan_id, 'R' || n AS relation_id, plan_id % 3 > 0 AND flag <> 'R' AND entity_type = 'NAME' AND part % 2 = 0 AS party_link FROM e WHERE n > 1",
    "direct_evidence": f"WITH {_L} SELECT doc_id, 'R1' AS relation_id, string_agg('S' || n, ',' ORDER BY 'S' || n) AS ids FROM l WHERE part % 6 = 0 GROUP BY 1",
    "segment_ids": f"""WITH {_L}, b AS (SELECT doc_id, n, part % 5 AS s, part % 5 = 0 OR row_number() OVER (PARTITION BY doc_id, part % 5 ORDER BY n) > 1 AS bad FROM l)
        SELECT doc_id, CAST(n AS INTEGER) AS position, 'S' || CASE WHEN bad THEN max(s) OVER (PARTITION BY doc_id) + count(*) FILTER (bad) OVER (PARTITION BY doc_id ORDER BY n) ELSE s END AS new_id FROM b""",
    "spec_findings": f"""WITH {_L}, s AS (SELECT doc_id, n, CASE WHEN n % 2 = 1 THEN 'A' ELSE 'B' END AS sec, flag <> 'N' AND part % 4 <> 0 AS good FROM l),
        f AS (SELECT l.doc_id, l.n, CASE WHEN part % 3 = 0 THEN '' ELSE 'A' END AS sec, part % 5 > 0 AS passed, part % 7 = 0 OR part % 11 = 0 OR l.n = 1 AS invalid, part % 11 = 0 AS own FROM l),
        b AS (SELECT f.doc_id, f.n, bool_or(good AND (f.sec = '' OR f.sec = s.sec)) AS body FROM f JOIN s ON s.doc_id = f.doc_id AND (s.n = f.n OR (s.n = 1 AND NOT own)) GROUP BY 1, 2)
        SELECT doc_id, 'SPEC_REVIEW_EVIDENCE' AS code, 'k' || n AS target FROM f JOIN b USING (doc_id, n) WHERE invalid OR (passed AND NOT body) UNION ALL SELECT doc_id, 'DOCUMENT_SPEC_INCOMPLETE', 'k' || n FROM f WHERE NOT passed""",
    "concrete_facts": "SELECT p_partkey, length(trim(left(p_name, 7) || CASE p_partkey % 4 WHEN 0 THEN ' 기재한다.' WHEN 1 THEN ' 작성한다 x' WHEN 2 THEN ' 설명한다!' ELSE '' END)) >= 8 AND p_partkey % 4 IN (1, 3) AS concrete FROM part",
    "repair_audit": """SELECT count(*) AS evaluated_attempts, count(*) FILTER (value > 50) AS structural_targets_satisfied, count(*) FILTER (user_id % 2 = 0) AS all_code_checks_passed, count(*) FILTER (value < 10) AS no_effective_progress,
        count(*) FILTER (user_id % 3 = 0) AS length_only_progress, CAST(coalesce(sum(user_id % 4), 0) AS BIGINT) AS remaining_missing_entities, CAST(coalesce(sum(user_id % 2), 0) AS BIGINT) AS remaining_invalid_relations FROM events WHERE event_type = 'error'""",
    "same_multisets": f"WITH {_L} SELECT doc_id, coalesce(string_agg(flag, '' ORDER BY flag) FILTER (n % 2 = 1), '') = coalesce(string_agg(flag, '' ORDER BY flag) FILTER (n % 2 = 0), '') AS same FROM l GROUP BY 1",
    "neighbours": "SELECT conv_id, turn, md5(coalesce(lag(text) OVER w, '-')) AS before, md5(coalesce(lead(text) OVER w, '-')) AS after FROM conversations WINDOW w AS (PARTITION BY conv_id, role ORDER BY turn)",
    "reviewer_views": f"""WITH {_L} SELECT doc_id, '[' || string_agg('{{"n":' || n || ',"end":{{"id":' || part || '}}}}', ',' ORDER BY n) || ']' AS relations FROM l GROUP BY 1""",
    "consumer_views": f"""WITH {_L} SELECT doc_id, '[' || string_agg('{{"end":{{"id":' || part || '}}}}', ',' ORDER BY n) || ']' AS lines FROM l GROUP BY 1""",
    "unplanned_pairs": f"""WITH {_L}, t AS (SELECT doc_id AS plan_id, 'S' || n AS sentence_id, unnest(['E1', 'E' || n, 'E' || (1 + n % 3)]) AS e FROM l), u AS (SELECT DISTINCT * FROM t),
        r AS (SELECT doc_id AS plan_id, 'E1' AS a, 'E' || n AS b FROM l WHERE n > 1)
        SELECT x.plan_id, x.sentence_id, x.e AS a, y.e AS b FROM u x JOIN u y ON x.plan_id = y.plan_id AND x.sentence_id = y.sentence_id AND x.e < y.e ANTI JOIN r ON r.plan_id = x.plan_id AND r.a = x.e AND r.b = y.e""",
}
