"""Constraints of the channel table, as predicates over DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NON_NEGATIVE = ("total_video_visit", "video_count", "start_date_timestamp", "followers_count")


class QualityError(ValueError):
    """A strict load found rows that break a constraint."""


def row_rules() -> dict[str, Column]:
    """Rule name to the condition that breaks it. NULL passes a range rule."""
    rules = {f"{name} >= 0": F.col(name) < 0 for name in NON_NEGATIVE}
    rules["username not null"] = F.col("username").isNull()
    return {name: F.coalesce(broken, F.lit(False)) for name, broken in rules.items()}


def split_rows(channels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every row rule, and the others with the first rule they break."""
    rules = row_rules()
    broken = reduce(Column.__or__, rules.values())
    rule = F.coalesce(*[F.when(wrong, F.lit(name)) for name, wrong in rules.items()])
    return channels.where(~broken), channels.where(broken).withColumn("rule", rule)


def violations(channels: DataFrame) -> DataFrame:
    """``rule``, ``username``, ``n``: broken row rules and repeated usernames.

    Row rules and the uniqueness count are one aggregation, so each task sends at most one row per
    username and rule however often a username repeats.
    """
    rules = row_rules()
    per_name = channels.groupBy("username").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(wrong).alias(f"_rule{i}") for i, wrong in enumerate(rules.values())],
    )
    found = [
        F.struct(F.lit(name).alias("rule"), F.col(f"_rule{i}").alias("n"))
        for i, name in enumerate(rules)
    ]
    repeated = F.when(F.col("username").isNotNull() & (F.col("_rows") > 1), F.col("_rows"))
    found.append(
        F.struct(
            F.lit("username unique").alias("rule"), F.coalesce(repeated, F.lit(0)).alias("n")
        )
    )
    return (
        per_name.select("username", F.explode(F.array(*found)).alias("_found"))
        .select("_found.rule", "username", "_found.n")
        .where(F.col("n") > 0)
    )


def require(channels: DataFrame) -> DataFrame:
    """``channels`` unchanged, or an error that gives the number of violations and five examples."""
    found = violations(channels)
    bad = found.limit(5).collect()
    if bad:
        examples = "; ".join(f"{r['rule']}: {r['username']} ({r['n']})" for r in bad)
        raise QualityError(f"{found.count()} violations, among them {examples}")
    return channels
