"""Reports over attempts: the latest row of a key, pass rates with intervals, forecasts, counts by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.stats import expected_more, expected_range, rate, wilson


def latest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key. Spark keeps one row a key in each task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def funnel(rows: DataFrame, key: str, order: tuple[str, ...], passed: Column, completed: Column) -> DataFrame:
    """One row over the latest row of each key: how many passed of those completed, the rate's interval, and how many more keys the rest takes."""
    last = latest(rows, [key], *order)
    c = last.agg(F.count("*").alias("unique_keys"), F.count_if(passed).alias("passed"), F.count_if(completed).alias("completed"))
    p = rate(F.col("passed"), F.col("completed"))
    low, high = wilson(F.col("passed"), F.col("completed"))
    return c.select(
        "unique_keys", "passed", "completed", F.round(p, 6).alias("rate"), F.round(low, 6).alias("lo"), F.round(high, 6).alias("hi"),
        expected_more(F.col("unique_keys") - F.col("passed"), p).alias("expected_more"),
    )


def stage_funnel(rows: DataFrame, stage: str, key: str, order: tuple[str, ...], status: Column, passed: Column, completed: Column) -> DataFrame:
    """By stage: attempts, keys, passes and completions of each key's latest attempt, pass rate and interval."""
    attempts = rows.groupBy(stage).agg(F.count("*").alias("attempts"))
    last = latest(rows.withColumn("__status", status), [stage, key], *order)
    per = last.groupBy(stage).agg(F.count("*").alias("unique_keys"), F.count_if(passed).alias("passed"), F.count_if(completed).alias("completed"))
    low, high = wilson(F.col("passed"), F.col("completed"))
    return attempts.join(per, stage).select(
        stage, "attempts", "unique_keys", "passed", "completed",
        F.round(rate(F.col("passed"), F.col("completed")), 6).alias("pass_rate"), F.round(low, 6).alias("lo"), F.round(high, 6).alias("hi"),
    )


def forecast(candidates: DataFrame, slots: DataFrame) -> DataFrame:
    """Accepted, rejected, slots left, the acceptance rate, its interval, and how many candidates the slots left take. `candidates` and `slots` have status."""
    c = candidates.agg(F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "rejected").alias("rejected"))
    s = slots.agg(F.count_if(F.col("status") != "accepted").alias("remaining_slots"))
    n = F.col("accepted") + F.col("rejected")
    p, (low, high) = rate(F.col("accepted"), n), wilson(F.col("accepted"), n)
    left = F.col("remaining_slots")
    return c.crossJoin(s).select(  # one row each
        "accepted", "rejected", "remaining_slots", p.alias("acceptance_rate"), low.alias("lo"), high.alias("hi"),
        expected_more(left, p).alias("expected_additional"), expected_range(left, low, high).alias("expected_range"),
    )


def stage_forecast(attempts: DataFrame, candidates: DataFrame, expected: Column) -> DataFrame:
    """By stage, for terminal candidates: entries, passes and other results that `expected` more candidates would bring, to two digits, half to even."""
    terminal = candidates.where(F.col("status").isin("accepted", "rejected"))
    total = terminal.agg(F.count("*").alias("__n"))
    last = latest(attempts.join(terminal.select("candidate_id"), "candidate_id", "left_semi"), ["stage", "candidate_id"], "id")
    per = last.groupBy("stage").agg(F.count("*").alias("entries"), F.count_if(F.col("status").isin("passed", "cached")).alias("passes"))
    share = lambda c: F.bround(expected * c / F.col("__n"), 2)
    return per.crossJoin(total).select(
        "stage", share(F.col("entries")).alias("more_entries"), share(F.col("passes")).alias("more_passes"), share(F.col("entries") - F.col("passes")).alias("more_nonpasses"),
    )


def status_counts(df: DataFrame, keys: list[str], status: str, values: list[str]) -> DataFrame:
    """Rows by keys, null keys as empty text, with a count for each status."""
    named = [F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys]
    return df.groupBy(*named).agg(*[F.count_if(F.col(status) == v).alias(f"n_{v.lower()}") for v in values], F.count("*").alias("n"))


def reasons(df: DataFrame, reason: Column, key: str) -> DataFrame:
    """By reason: rows, and different keys."""
    return df.groupBy(reason.alias("reason")).agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"))


def row_reasons(df: DataFrame, codes: str) -> DataFrame:
    """By code: how often the arrays hold it, and how many rows do; a row counts a repeated code once."""
    each = df.select(F.explode(F.col(codes)).alias("reason"), F.lit(0).alias("__once"))
    once = df.select(F.explode(F.array_distinct(codes)).alias("reason"), F.lit(1).alias("__once"))
    return each.unionByName(once).groupBy("reason").agg(F.count_if(F.col("__once") == 0).alias("n_reasons"), F.sum("__once").alias("n_rows"))


def histogram(df: DataFrame, key: str) -> DataFrame:
    """How many keys have how many rows."""
    return df.groupBy(key).agg(F.count("*").alias("repeats")).groupBy("repeats").agg(F.count("*").alias("n_keys"))


def summed_maps(df: DataFrame, column: str) -> DataFrame:
    """The sum of maps: a row for each key with the sum of its values."""
    return df.select(F.explode(column).alias("key", "value")).groupBy("key").agg(F.sum("value").alias("total"))
