"""Values for the groups of plans, from a pool of any size, in rounds.

Each group has a seeded order over all rows of the pool: row numbers (start + j * stride) mod 2^k, where 2^k is the least power of two that isn't under the pool's size and the stride is odd, so that each
number comes once. A round lets every open group ask for its next rows by number, which is an equi-join; the batch of a group grows as long as it finds none. Within a plan, groups choose in their order, by a fold over the rows
they got: a value of a unique type that an earlier group took is not taken again. A group that finds nothing among its rows holds up those after it until the next round. Nothing is collected, and no pool is refused.

A group whose types no row has, or for which earlier groups took all values that such rows have of one type, would ask for the whole pool in vain; it is told so before its second batch (`_exhausted`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import canonical, strip, valid_value
from sievework.operators.sampling import UNIQUE
from sievework.plans.steps import dealt, written

_FIRST, _GROWTH, _LIST = 4, 8, 32  # rows of a first batch, how batches grow, and how many usable rows of a batch a group brings to the fold
_SMALL = 1 << 15  # rows of a pool that is broadcast
_PLANS = 1 << 17  # plans of a task, about
_CANDIDATE = "array<struct<j:bigint,uuid:string,v:array<struct<entity_id:string,entity_type:string,value:string,canonical_form:string>>,k:array<string>>>"


def numbered(pool: DataFrame, seed: str) -> DataFrame:
    """Adds __n, the row's place in the order of a seeded hash of uuid, from 0: ranges of the hash are sorted in parallel and their sizes summed."""
    keyed = pool.withColumn("__h", F.sha2(F.concat_ws(":", F.lit(seed), F.col("uuid").cast("string")), 256))
    ranged = keyed.repartitionByRange("__h", "uuid").sortWithinPartitions("__h", "uuid")
    # the lower 33 bits number a partition's rows, the upper ones the partitions
    placed = written(ranged.withColumn("__m", F.monotonically_increasing_id()).drop("__h"))
    part = F.shiftrightunsigned("__m", 33)
    sizes = placed.groupBy(part.alias("__p")).agg(F.count("*").alias("__c"))
    before = sizes.select("__p", (F.sum("__c").over(Window.orderBy("__p")) - F.col("__c")).alias("__before"))  # a row a partition
    return placed.withColumn("__p", part).join(before, "__p").withColumn("__n", F.col("__before") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__p", "__m", "__before")


def usable(pool: DataFrame, types: list[str], fields: list[str]) -> DataFrame:
    """(uuid, vals, fields): per row the valid values by type, stripped, with their canonical forms and, of unique types, the key by which they are the same; and the fields that constraints ask for."""
    value = lambda t: strip(F.col(t).cast("string"))
    form = lambda t: canonical(value(t), F.lit(t))
    held = lambda t: F.struct(value(t).alias("v"), form(t).alias("c"), (F.concat(F.lit(f"{t}|"), form(t)) if t in UNIQUE else F.lit(None).cast("string")).alias("k"))
    entries = F.filter(F.array(*[F.when(F.coalesce(valid_value(value(t), F.lit(t)), F.lit(False)), F.struct(F.lit(t).alias("k"), held(t).alias("v"))) for t in types]), lambda x: x.isNotNull())
    held = F.filter(F.array(*[F.struct(F.lit(f).alias("k"), F.col(f).cast("string").alias("v")) for f in fields]), lambda x: x["v"].isNotNull()) if fields else F.array().cast("array<struct<k:string,v:string>>")
    return pool.select(F.col("uuid").cast("string").alias("uuid"), F.map_from_entries(entries).alias("vals"), F.map_from_entries(held).alias("fields"))


def _asked(groups: DataFrame, allowed: DataFrame | None, seed: str) -> DataFrame:
    """A row per plan: its groups in order, each with its entities, what its row's fields may hold, and its order over the pool."""
    g = groups.groupBy("plan_id", "value_group").agg(F.array_sort(F.collect_set(F.struct(F.col("entity_id").cast("string").alias("entity_id"), F.col("entity_type").cast("string").alias("entity_type")))).alias("ents"))
    if allowed is not None:
        per = allowed.groupBy("plan_id", "value_group").agg(F.collect_list(F.struct("field", "allowed")).alias("may"))
        g = g.join(per, ["plan_id", "value_group"], "left")
    else:
        g = g.withColumn("may", F.lit(None).cast("array<struct<field:string,allowed:array<string>>>"))
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.col("plan_id").cast("string"), F.col("value_group").cast("string")), 256)
    number = lambda at, n: F.conv(F.substring(digest, at, n), 16, 10).cast("long")
    row = F.struct(
        F.col("value_group").alias("g"), "ents", F.coalesce("may", F.array().cast("array<struct<field:string,allowed:array<string>>>")).alias("may"),
        number(1, 15).alias("start"), number(17, 5).bitwiseOR(F.lit(1)).alias("stride"), F.lit(0).cast("long").alias("asked"), F.lit(_FIRST).cast("long").alias("batch"),
    )
    return g.groupBy("plan_id").agg(F.array_sort(F.collect_list(row), lambda a, b: F.when(a["g"] < b["g"], -1).otherwise(1)).alias("open"), F.array().cast("array<string>").alias("used"), F.lit(None).cast("string").alias("failed"))


def _choose(state: DataFrame, pool: DataFrame, size: int) -> DataFrame:
    """One round: adds got, the groups that chose and their rows, and takes them from open; a plan whose group has asked for every row fails."""
    modulus = 1 << max(0, (size - 1).bit_length())
    # a plan is few bytes and much work; tasks of plans stay as they are where the pool is broadcast
    each = dealt(state, "plan_id", rows=_PLANS).select("plan_id", "used", F.explode("open").alias("x")).select(
        "plan_id", "used", "x.g", "x.ents", "x.may", F.explode(F.expr(f"transform(sequence(x.asked, least(x.asked + x.batch, {modulus}L) - 1), j -> struct(j, (x.start + j * x.stride) & {modulus - 1}L AS n))")).alias("y"))
    # exploded rows look small to the planner, and would be broadcast
    near = F.broadcast(pool) if size <= _SMALL else pool.hint("merge")
    rows = each.select("plan_id", "used", "g", "ents", "may", "y.j", F.col("y.n").alias("__n")).join(near, "__n")
    fits = F.forall("ents", lambda e: F.map_contains_key("vals", e["entity_type"])) & ((F.size("may") == 0) | F.forall("may", lambda m: F.coalesce(F.array_contains(m["allowed"], F.try_element_at("fields", m["field"])), F.lit(False))))
    rows = rows.where(fits)
    value = lambda e: F.element_at("vals", e["entity_type"])
    mine = F.transform("ents", lambda e: F.struct(e["entity_id"], e["entity_type"], value(e)["v"].alias("value"), value(e)["c"].alias("canonical_form")))
    keys = F.filter(F.transform("ents", lambda e: value(e)["k"]), lambda k: k.isNotNull())
    rows = rows.select("plan_id", "g", "j", "uuid", "used", mine.alias("v"), keys.alias("k")).where((F.size("used") == 0) | ~F.arrays_overlap("k", "used")).drop("used")
    if size > _SMALL:
        rows = rows.repartition("plan_id")
    first = rows.withColumn("__r", F.row_number().over(Window.partitionBy("plan_id", "g").orderBy("j"))).where(F.col("__r") <= _LIST)
    lists = first.groupBy("plan_id", "g").agg(F.array_sort(F.collect_list(F.struct("j", "uuid", "v", "k"))).alias("c"))
    per = lists.groupBy("plan_id").agg(F.map_from_entries(F.collect_list(F.struct("g", "c"))).alias("lists"))
    pick = f"try_element_at(filter(coalesce(try_element_at(lists, o.g), cast(array() AS {_CANDIDATE})), c -> NOT arrays_overlap(c.k, a.used)), 1)"
    kind = state.schema["open"].dataType.elementType.simpleString()
    plan = state.schema["open"].dataType.elementType["g"].dataType.simpleString()
    got = f"array<struct<g:{plan},uuid:string,v:array<struct<entity_id:string,entity_type:string,value:string,canonical_form:string>>>>"
    start = f"named_struct('used', used, 'got', cast(array() AS {got}), 'rest', cast(array() AS array<{kind}>), 'failed', cast(null AS string))"
    # a full list may have left out usable rows behind its last one
    further = f"""transform(array(coalesce(try_element_at(lists, o.g), cast(array() AS {_CANDIDATE}))), l -> IF(size(l) >= {_LIST}, l[{_LIST - 1}].j + 1, least(o.asked + o.batch, {modulus}L)))[0]"""
    waits = f"""named_struct('used', a.used, 'got', a.got, 'rest', concat(a.rest, array(named_struct('g', o.g, 'ents', o.ents, 'may', o.may, 'start', o.start, 'stride', o.stride,
        'asked', {further}, 'batch', o.batch * {_GROWTH}))), 'failed', IF({further} >= {modulus}L, cast(o.g AS string), null))"""
    takes = "named_struct('used', concat(a.used, p.k), 'got', concat(a.got, array(named_struct('g', o.g, 'uuid', p.uuid, 'v', p.v))), 'rest', a.rest, 'failed', null)"
    step = f"IF(size(a.rest) > 0, named_struct('used', a.used, 'got', a.got, 'rest', concat(a.rest, array(o)), 'failed', a.failed), transform(array({pick}), p -> IF(p IS NULL, {waits}, {takes}))[0])"
    folded = state.drop("got").join(per.hint("merge"), "plan_id", "left").select("plan_id", F.expr(f"aggregate(open, {start}, (a, o) -> {step})").alias("z"))
    return folded.select("plan_id", F.when(F.col("z.failed").isNull(), F.col("z.rest")).otherwise(F.slice("z.rest", 1, 0)).alias("open"), F.col("z.used").alias("used"), F.col("z.failed").alias("failed"), F.col("z.got").alias("got"))


def _kinds(ents: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(ents, lambda e: e["entity_type"])))


def _ends(state: DataFrame, pool: DataFrame, most: int) -> DataFrame:
    """(kinds, ends): for each set of types that an open group has and a row suits, the types of which such rows have `most` values or fewer: all their keys, an array a type."""
    asked = state.select(F.explode("open").alias("x")).select(_kinds(F.col("x.ents")).alias("kinds")).distinct()
    suits = pool.crossJoin(F.broadcast(asked)).where(F.forall("kinds", lambda t: F.map_contains_key("vals", t)))  # sets of types are few by nature
    keys = F.filter(F.transform("kinds", lambda t: F.element_at("vals", t)["k"]), lambda k: k.isNotNull())
    each = written(suits.select("kinds", F.explode_outer(keys).alias("k")).distinct()).withColumn("t", F.substring_index("k", "|", 1))
    few = each.where("k IS NOT NULL").groupBy("kinds", "t").agg(F.count("*").alias("n")).where(F.col("n") <= most)
    ends = each.join(few, ["kinds", "t"]).groupBy("kinds", "t").agg(F.collect_list("k").alias("e")).groupBy("kinds").agg(F.collect_list("e").alias("ends"))
    return written(each.select("kinds").distinct().join(ends, "kinds", "left").withColumn("ends", F.coalesce("ends", F.array().cast("array<array<string>>"))))


def _exhausted(state: DataFrame, ends: DataFrame) -> DataFrame:
    """The state, where plans fail whose first open group has types that no row has, or a type of which all values are taken."""
    j = state.where("size(open) > 0").withColumn("kinds", _kinds(F.col("open")[0]["ents"])).join(F.broadcast(ends), "kinds", "left")
    failed = F.coalesce(F.exists("ends", lambda e: F.size(F.array_except(e, "used")) == 0), F.lit(True))
    j = j.withColumn("failed", F.when(failed, F.col("open")[0]["g"].cast("string")))
    return j.select("plan_id", F.when(failed, F.slice("open", 1, 0)).otherwise(F.col("open")).alias("open"), "used", "failed")


def select_values(groups: DataFrame, pool: DataFrame, seed: str, *, types: list[str], allowed: DataFrame | None = None, distinct: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(plan_id, value_group, entity_id, entity_type, value, canonical_form, source) of the groups that chose, and issues (plan_id, code, target).

    groups: plan_id, value_group, entity_id, entity_type; groups of a plan choose in the order of value_group. pool: uuid, a column for each of `types`, and the fields of constraints. allowed: plan_id, value_group,
    field, allowed (array): what the chosen row's field may hold. distinct: plan_id, constraint_id, entity_ids (array): entities that must differ.

    A plan stops at the first group that no row suits (POOL_NO_FEASIBLE_ROW, its group); entities that must differ and don't give POOL_DISTINCT_VALUE. Null and badly formed values suit no one; an empty pool suits no group.
    """
    fields = [r[0] for r in allowed.select("field").distinct().collect()] if allowed is not None else []  # names of columns
    ready = usable(pool, types, fields)
    ready = written(numbered(ready, seed))
    size = ready.count()
    state = written(_asked(groups, allowed, seed).withColumn("got", F.lit(None).cast("array<string>")))
    entities = state.select(F.expr("aggregate(open, 0, (n, g) -> n + size(g.ents))").alias("n"))
    rounds, failed, ends = [], [], None
    issue = lambda df: df.where("failed IS NOT NULL").select("plan_id", F.lit("POOL_NO_FEASIBLE_ROW").alias("code"), F.col("failed").alias("target"))
    while state.where("size(open) > 0").limit(1).count():
        if size:
            new = written(_choose(state.where("size(open) > 0"), ready, size))
        else:
            new = written(state.select("plan_id", F.slice("open", 1, 0).alias("open"), "used", F.col("open")[0]["g"].cast("string").alias("failed"), F.expr("cast(array() AS array<struct<g:string,uuid:string,v:array<struct<entity_id:string,entity_type:string,value:string,canonical_form:string>>>>)").alias("got")))
        rounds.append(new.select("plan_id", F.explode("got").alias("x")).select("plan_id", F.col("x.g").alias("value_group"), F.col("x.uuid").alias("source"), F.explode("x.v").alias("e")))
        failed.append(issue(new))
        state = new.where("size(open) > 0")
        if size and state.limit(1).count():
            if ends is None:
                # a plan has taken no more values than it has entities
                ends = _ends(state, ready, entities.agg(F.max("n")).first()[0])
            state = written(_exhausted(state, ends))
            failed.append(issue(state))
    none = groups.limit(0).select("plan_id", "value_group", F.lit("").alias("source"), F.expr("named_struct('entity_id', '', 'entity_type', '', 'value', '', 'canonical_form', '')").alias("e"))
    values = none
    issues = groups.limit(0).select("plan_id", F.lit("").alias("code"), F.lit("").alias("target"))
    values, issues = reduce(DataFrame.union, rounds, values), reduce(DataFrame.unionByName, failed, issues)
    values = written(values.select("plan_id", "value_group", "e.*", "source"))
    if distinct is not None:
        each = distinct.select("plan_id", "constraint_id", F.explode(F.array_distinct("entity_ids")).alias("entity_id")).join(values.select("plan_id", "entity_id", "canonical_form"), ["plan_id", "entity_id"])
        twice = each.groupBy("plan_id", "constraint_id").agg(F.count("*").alias("n"), F.count_distinct("canonical_form").alias("d")).where("d < n")
        issues = issues.unionByName(twice.select("plan_id", F.lit("POOL_DISTINCT_VALUE").alias("code"), F.col("constraint_id").cast("string").alias("target")))
    return values, issues
