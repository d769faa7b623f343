"""Plans as folds: required relations under capacity, and seed graphs, for all conditions of a table at once.

Both are sequential within a plan: each choice depends on those before. They are folds over the plan's own arrays with a typed state, inside the row, so plans are independent rows: no
shuffle besides the one that deals plans to tasks, no Python, and nothing on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.nested import let

# Organisations, and what a bridge may lead to.
ORGANISATIONS = ("WORKPLACE", "DEPARTMENT", "SCHOOL")
BRIDGE_TARGETS = ("TELEPHONE", "EMAIL", "ADDRESS", "BANK_ACCOUNT_NUMBER")


def coverage_order(missing: DataFrame) -> DataFrame:
    """(wanted): one row, the relations of (relation, n) as an array, the least covered first, then by name. A catalogue of relations is small by nature."""
    return missing.agg(F.array_sort(F.collect_set(F.struct("n", "relation"))).alias("w")).select(F.transform("w", lambda x: x["relation"]).alias("wanted"))


def required_selection(candidates: DataFrame, options: DataFrame, most: int) -> DataFrame:
    """Adds chosen, array<struct<relation, privacy>>, to candidates: of the wanted relations, in order, those that a label with room left can hold; `most` at most.

    candidates: subtype, wanted (array of relations), pii, non_pii (room by label), n_parties. options: subtype, relation, privacy, target: what a subtype may hold. NON_PII goes before PII. While there are more parties
    than room for PII, PII takes a relation that leads to a NAME. A subtype without options, and a null array, choose nothing.
    """
    held = options.groupBy("subtype", "relation").agg(
        F.bool_or(F.col("privacy") == "PII").alias("p"), F.bool_or(F.col("privacy") == "NON_PII").alias("q"), F.bool_or((F.col("privacy") == "PII") & (F.col("target") == "NAME")).alias("named")
    )
    by = held.groupBy(F.col("subtype").alias("__subtype")).agg(F.map_from_entries(F.collect_list(F.struct("relation", F.struct("p", "q", "named")))).alias("__held"))
    joined = candidates.join(by, F.col("subtype").eqNullSafe(F.col("__subtype")), "left")
    fold = f"""
        aggregate(
          coalesce(wanted, array()),
          named_struct('p', cast(pii AS int), 'q', cast(non_pii AS int), 'out', cast(array() AS array<struct<relation: string, privacy: string>>)),
          (a, r) -> transform(array(try_element_at(__held, r)), h -> CASE
            WHEN size(a.out) >= {most} THEN a
            WHEN h.q AND a.q > 0 THEN named_struct('p', a.p, 'q', a.q - 1, 'out', concat(a.out, array(named_struct('relation', r, 'privacy', 'NON_PII'))))
            WHEN h.p AND a.p > 0 AND (n_parties <= a.p OR h.named) THEN named_struct('p', a.p - 1, 'q', a.q, 'out', concat(a.out, array(named_struct('relation', r, 'privacy', 'PII'))))
            ELSE a END)[0],
          a -> a.out)"""
    return joined.withColumn("chosen", F.when(F.col("__held").isNotNull(), F.expr(fold)).otherwise(F.expr("cast(array() AS array<struct<relation: string, privacy: string>>)"))).drop("__subtype", "__held")


def with_options(conditions: DataFrame, options: DataFrame, seed: str) -> DataFrame:
    """Adds options_pii and options_non, array<struct<source, relation, target>>, in the order that the plan's seed gives; options: subtype, privacy, source, relation, target, rows of a subtype's catalogue, which is small by nature.

    Hashes are most of the work. Where conditions have slots, only what a slot may ask for is hashed: a list that no slot reads is in no order, and one of which all slots require relations has only these.
    """
    row = F.struct("source", "relation", "target")
    per = options.groupBy(F.col("subtype").alias("__s")).agg(*(F.array_sort(F.collect_set(F.when(F.col("privacy") == p, row))).alias(c) for p, c in (("PII", "__p"), ("NON_PII", "__q"))))
    # what the hash reads of an option is written once a subtype, what it reads of a plan once a plan
    named = lambda o: F.when(F.coalesce(o["source"], o["relation"], o["target"]).isNotNull(), F.concat_ws(":", o["source"], o["relation"], o["target"]))
    per = per.select("__s", *(F.transform(c, lambda o: F.struct(named(o).alias("n"), o.alias("o"))).alias(c) for c in ("__p", "__q")))
    none = F.array().cast("array<struct<n:string,o:struct<source:string,relation:string,target:string>>>")
    plan = F.concat_ws(":", F.lit(seed), F.col("plan_id").cast("string"))
    keyed = lambda c: let(plan, lambda p: F.transform(F.coalesce(c, none), lambda o: F.struct(F.sha2(F.concat_ws(":", p, o["n"]), 256).alias("k"), o["o"].alias("o"))))
    def shuffled(c: str) -> Column:
        if "slots" not in conditions.columns:
            return F.transform(F.sort_array(keyed(F.col(c))), lambda x: x["o"])
        own = F.filter("slots", lambda s: s["privacy"].eqNullSafe("PII") if c == "__p" else ~s["privacy"].eqNullSafe("PII"))
        asked = F.transform(own, lambda s: s["required"])
        free = F.exists(asked, lambda r: r.isNull())
        some = F.when(free, F.col(c)).otherwise(F.filter(c, lambda o: F.array_contains(asked, o["o"]["relation"])))
        return F.when(F.size(asked) == 0, F.transform(F.coalesce(c, none), lambda o: o["o"])).otherwise(F.transform(F.sort_array(keyed(some)), lambda x: x["o"]))

    # a plan is much work and few bytes, by which adaptive execution would put many into one task; it is dealt before its options are added, which are many times its size
    spread = conditions.repartition(int(conditions.sparkSession.conf.get("spark.sql.shuffle.partitions")), "plan_id")
    joined = spread.join(F.broadcast(per), F.col("subtype").eqNullSafe(F.col("__s")), "left")
    return joined.withColumns({"options_pii": shuffled("__p"), "options_non": shuffled("__q")}).drop("__s", "__p", "__q")


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_EDGES = "array<struct<slot_id: string, index: int, privacy: string, source: string, relation: string, target: string>>"


def seed_graph(conditions: DataFrame) -> DataFrame:
    """plan_id, edges (array of slot_id, privacy, source, relation, target, in the order of the slots) and issue (null, SEED_GRAPH_CAPACITY or SEED_PERSON_CAPACITY).

    conditions: plan_id; people, array<struct<person_id, role>>; slots, array<struct<slot_id, privacy, required>>, where `required` is a relation or null; bridges, how many are wanted; options_pii and options_non, in order
    of preference (`with_options`); and, for subtypes with a profile, owners, map<relation, role>, and pairs, map<relation, struct<a, b>> of roles; both null without. Ends are named TYPE:group; a group is a person, an
    office, or an organisation's own line.

    Slots are filled in order, personal ones first where bridges are wanted. A personal relation starts from a person that none has touched yet; when only as many personal slots are left as such people, relations between people
    go first. With a profile, relations that later slots require or that are used already go last, attributes belong to the person in the owner's role, and pairs of roles are fixed. A bridge starts from an organisation that a personal
    relation leads to. No edge is used twice, with a profile in neither direction. Without a feasible option for a slot the graph fails, and likewise if a person is left without a relation; then it has no edges.
    """
    orgs, targets = _listed(ORGANISATIONS), _listed(BRIDGE_TARGETS)
    todo = "transform(slots, (s, i) -> named_struct('slot_id', s.slot_id, 'privacy', s.privacy, 'required', s.required, 'index', i))"
    todo = f"transform(array({todo}), t -> IF(bridges > 0, concat(filter(t, x -> x.privacy = 'PII'), filter(t, x -> x.privacy <> 'PII')), t))[0]"
    todo = f"""transform(array({todo}), t -> transform(t, (s, i) -> named_struct('slot', s, 'rest_pii', size(filter(slice(t, i + 1, size(t)), x -> x.privacy = 'PII')),
        'reserved', transform(filter(slice(t, i + 2, size(t)), x -> x.required IS NOT NULL), x -> x.required))))[0]"""
    # what a step knows: b.un, people without a relation; b.pairs, whether relations between people go first
    known = """named_struct('un', filter(people, p -> NOT array_contains(a.covered, concat('NAME:', p.person_id))),
        'choices', transform(array(IF(s.slot.privacy = 'PII', options_pii, options_non)), l -> IF(s.slot.required IS NULL, l, filter(l, o -> o.relation = s.slot.required)))[0])"""
    narrowed = """named_struct('un', b.un, 'first', s.slot.privacy = 'PII' AND size(b.un) > 1 AND s.rest_pii <= size(b.un),
        'choices', IF(s.slot.privacy = 'PII' AND size(b.un) > 1 AND s.rest_pii <= size(b.un) AND exists(b.choices, o -> o.target = 'NAME'), filter(b.choices, o -> o.target = 'NAME'), b.choices))"""
    # 0 for null, 1 for false, 2 for true, as a sort would have them
    place = lambda c: f"coalesce(cast({c} AS int) + 1, 0)"
    bridge = f"""CASE WHEN c.first OR bridges = 0 OR s.slot.required IS NOT NULL THEN false
                       WHEN s.slot.privacy = 'PII' THEN size(a.orgs) = 0 AND o.target NOT IN ({orgs})
                       ELSE a.bridged < bridges AND NOT (exists(a.orgs, g -> g.type = o.source) AND o.target IN ({targets})) END"""
    reserved = "(profile AND s.slot.required IS NULL AND array_contains(s.reserved, o.relation))"
    again = "(profile AND s.slot.required IS NULL AND exists(a.edges, e -> e.relation = o.relation))"
    rank = f"9 * {place(bridge)} + 3 * {place(reserved)} + {place(again)}"
    first = lambda array: f"try_element_at({array}, 1)"
    person = f"coalesce({first('c.un')}, IF(profile, {first('people')}, try_element_at(people, s.slot.index % greatest(size(people), 1) + 1))).person_id"
    owner = f"coalesce(IF(profile, {first('filter(people, p -> p.role = try_element_at(owners, o.relation))')}.person_id, NULL), {person})"
    pair = "IF(profile, try_element_at(pairs, o.relation), NULL)"
    role = lambda end: f"try_element_at(filter(people, p -> p.role = {pair}.{end}), -1).person_id"
    other = f"coalesce({first(f'filter(c.un, p -> p.person_id <> {person})')}, {first(f'filter(people, p -> p.person_id <> {person})')}).person_id"
    line = f"IF(a.bridged < bridges AND o.target IN ({targets}), {first('filter(a.orgs, g -> g.type = o.source)')}.id, NULL)"
    office = "IF(profile, 'office_main', concat('office_', s.slot.index % 2 + 1))"
    ends = f"""CASE
        WHEN s.slot.privacy = 'PII' AND o.target = 'NAME' AND {pair} IS NOT NULL THEN named_struct('source', concat('NAME:', {role('a')}), 'target', concat('NAME:', {role('b')}))
        WHEN s.slot.privacy = 'PII' AND o.target = 'NAME' THEN named_struct('source', concat('NAME:', {person}), 'target', concat('NAME:', {other}))
        WHEN s.slot.privacy = 'PII' THEN named_struct('source', concat('NAME:', {owner}), 'target', concat(o.target, ':', {owner}))
        WHEN {line} IS NOT NULL THEN named_struct('source', {line}, 'target', concat(o.target, ':org_', {line}))
        ELSE named_struct('source', concat(o.source, ':', {office}), 'target', concat(o.target, ':', IF(o.target = o.source, concat('office_target_', s.slot.index + 1), {office}))) END"""
    feasible = """x.source IS NOT NULL AND x.target IS NOT NULL AND x.source <> x.target AND NOT exists(a.edges, e -> e.relation = x.relation
        AND (e.source = x.source AND e.target = x.target OR profile AND e.source = x.target AND e.target = x.source))"""
    # the first feasible option of the least rank; ends are only looked for where an option ranks before the one found, and 13, all false, is the least rank that a feasible option with a relation has
    edge = f"""aggregate(c.choices, named_struct('rank', 27, 'x', cast(NULL AS {_EDGES[6:-1]})), (f, o) -> IF(f.rank <= 13 AND bridges IS NOT NULL AND o.relation IS NOT NULL, f, transform(array({rank}), r ->
        IF(r >= f.rank, f, transform(array({ends}), n -> transform(array(named_struct('slot_id', s.slot.slot_id, 'index', s.slot.index, 'privacy', s.slot.privacy, 'source', n.source, 'relation', o.relation, 'target', n.target)),
            x -> IF({feasible}, named_struct('rank', r, 'x', x), f))[0])[0]))[0]), f -> f.x)"""
    empty = f"named_struct('edges', cast(array() AS {_EDGES}), 'covered', cast(array() AS array<string>), 'orgs', cast(array() AS array<struct<id: string, type: string>>), 'bridged', 0, 'failed', size(options_pii) = 0 OR size(options_non) = 0)"
    taken = f"""transform(array(transform(array(x), e -> named_struct('e', e, 'orgs', IF(e.privacy = 'PII' AND split(e.target, ':')[0] IN ({orgs}) AND NOT exists(a.orgs, g -> g.id = e.target),
            concat(a.orgs, array(named_struct('id', e.target, 'type', split(e.target, ':')[0]))), a.orgs)))[0]), y -> named_struct('edges', concat(a.edges, array(y.e)),
        'covered', array_union(a.covered, filter(array(y.e.source, y.e.target), z -> startswith(z, 'NAME:') AND exists(people, p -> z = concat('NAME:', p.person_id)))),
        'orgs', y.orgs, 'bridged', a.bridged + IF(y.e.privacy = 'NON_PII' AND exists(y.orgs, g -> g.id = y.e.source), 1, 0), 'failed', false))[0]"""
    step = f"""IF(a.failed, a, transform(array(transform(array(transform(array({known}), b -> {narrowed})[0]), c -> {edge})[0]), x ->
        IF(x IS NULL, named_struct('edges', a.edges, 'covered', a.covered, 'orgs', a.orgs, 'bridged', a.bridged, 'failed', true), {taken}))[0])"""
    done = """a -> named_struct('issue', CASE WHEN a.failed THEN 'SEED_GRAPH_CAPACITY' WHEN size(a.covered) <> size(people) THEN 'SEED_PERSON_CAPACITY' END,
        'edges', transform(array_sort(transform(a.edges, e -> named_struct('index', e.index, 'e', e))), x -> named_struct('slot_id', x.e.slot_id, 'privacy', x.e.privacy, 'source', x.e.source, 'relation', x.e.relation, 'target', x.e.target)))"""
    kind = {"owners": "map<string,string>", "pairs": "map<string,struct<a:string,b:string>>"}
    full = conditions.select("*", *(F.lit(None).cast(t).alias(c) for c, t in kind.items() if c not in conditions.columns)).withColumn("profile", F.col("owners").isNotNull() | F.col("pairs").isNotNull())
    out = full.select("plan_id", F.expr(f"aggregate({todo}, {empty}, (a, s) -> {step}, {done})").alias("g"))
    edges = F.col("g.edges")
    return out.select("plan_id", F.when(F.col("g.issue").isNull(), edges).otherwise(F.slice(edges, 1, 0)).alias("edges"), F.col("g.issue").alias("issue"))
