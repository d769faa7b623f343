"""Seeded choice and quotas. Order by a hash of key and seed stands where a random generator would: any engine can repeat it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled(key: Column, seed: str) -> Column:
    """What to order by for a seeded shuffle."""
    return F.sha2(F.concat_ws(":", F.lit(seed), key.cast("string")), 256)


def round_robin(domains: DataFrame, subtypes: DataFrame, per_domain: int, seed: str) -> DataFrame:
    """(slot_id, domain, subtype): `per_domain` slots each, over the domain's subtypes in shuffled order, again and again. domains: domain; subtypes: domain, subtype."""
    w = Window.partitionBy("domain").orderBy(shuffled(F.col("subtype"), seed), "subtype")
    ordered = subtypes.withColumns({"__r": F.row_number().over(w) - 1, "__n": F.count("*").over(Window.partitionBy("domain"))})
    slots = domains.select("domain", F.explode(F.sequence(F.lit(0), F.lit(per_domain - 1))).alias("__i"))
    joined = slots.join(ordered, "domain").where("__i % __n = __r")
    return joined.select(F.concat("domain", F.lit("_"), F.lpad((F.col("__i") + 1).cast("string"), 3, "0")).alias("slot_id"), "domain", "subtype")


def pick(rows: DataFrame, keys: list[str], by: Column, seed: str, n: int = 1) -> DataFrame:
    """n rows of each key by seeded hash order."""
    w = Window.partitionBy(*keys).orderBy(shuffled(by, seed), by)
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def chance(key: Column, seed: str, p: float) -> Column:
    """True with probability p, by hash."""
    return F.conv(F.substring(shuffled(key, seed), 1, 8), 16, 10).cast("double") < p * 4294967296.0


def least_used(options: DataFrame, used: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Of each key's options the one used least, then the least by value."""
    counts = used.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    joined = options.join(counts, [*keys, value], "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    return joined.groupBy(*keys).agg(F.min_by(value, F.struct("__n", value)).alias(value), F.min("__n").alias("n_used"))


def apportion(total: Column, weights: Column) -> Column:
    """Shares of a total by weights, rounded down, the rest to the last."""
    whole = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    parts = F.transform(weights, lambda w: F.floor(total * w / whole).cast("long"))
    but_last = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.concat(but_last, F.array((total - F.aggregate(but_last, F.lit(0).cast("long"), lambda a, x: a + x)).cast("long")))


def next_slot(missing: DataFrame, eligible: DataFrame, totals: DataFrame, cap: int) -> DataFrame:
    """The slot to add: the first missing relation that has an eligible (domain, subtype) under the cap, in the domain with the fewest candidates."""
    j = missing.join(eligible, "relation").join(totals, "domain", "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < cap)
    best = j.groupBy("relation").agg(F.min(F.struct("n", "domain", "subtype")).alias("x"))
    return best.agg(F.min_by(F.struct("relation", "x.domain", "x.subtype"), "relation").alias("y")).select("y.*").where("relation is not null")


# Types whose values no two entities of a document may share.
UNIQUE = (
    "NAME", "EMAIL", "MOBILE_PHONE", "TELEPHONE", "RRN", "PASSPORT_NUMBER", "DRIVER_LICENSE_NUMBER", "BANK_ACCOUNT_NUMBER", "CARD_NUMBER", "VEHICLE_NUMBER",
    "WORKPLACE", "DEPARTMENT", "SCHOOL",
)
