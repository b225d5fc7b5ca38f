"""Operator opt-outs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.operators.merging import refused

# Fixed values.
METHODS = ["discover", "tools", "resources", "prompts"]
SCOPES = ["endpoint", "host", "server"]


def active_rules(rules: DataFrame, now) -> DataFrame:
    """Rules neither revoked nor in the future; ``now`` is the run's time."""
    return rules.filter(F.col("revoked_at").isNull() & (F.col("effective_at") <= now))


def methods_of(applies_to):
    """``all`` and anything unknown mean every method."""
    return F.when(applies_to.isin(METHODS), F.array(applies_to)).otherwise(F.array(*map(F.lit, METHODS)))


def expanded_rules(rules: DataFrame) -> DataFrame:
    """Scope, pattern (hosts in lower case), method: one row each; unknown scopes match nothing."""
    pattern = F.when(F.col("scope") == "host", F.lower("pattern")).otherwise(F.col("pattern"))
    return rules.filter(F.col("scope").isin(SCOPES)).select("scope", pattern.alias("pattern"), F.explode(methods_of(F.col("applies_to"))).alias("method")).distinct()


def with_match(targets: DataFrame, rules: DataFrame, method: str, columns: dict) -> DataFrame:
    """``match`` (scope, pattern) of the first scope, in order endpoint, host, server, that has a rule; NULL if none.

    ``columns`` names the targets' column of each scope. One table with a flag; excluded and dialable
    rows are filters of it, so they are disjoint and cover it. The optimizer broadcasts the rules if
    their measured size allows it and otherwise shuffles.
    """
    mine = expanded_rules(rules).filter(F.col("method") == method)
    out = targets
    for scope in SCOPES:
        one = mine.filter(F.col("scope") == scope).select(F.col("pattern").alias(f"_{scope}"))
        out = out.join(one, F.col(columns[scope]).cast("string") == F.col(f"_{scope}"), "left")
    found = F.coalesce(*[F.when(F.col(f"_{s}").isNotNull(), F.struct(F.lit(s).alias("scope"), F.col(f"_{s}").alias("pattern"))) for s in SCOPES])
    return out.withColumn("match", found).drop(*[f"_{s}" for s in SCOPES])


def exclusion_note(match):
    """F43."""
    return F.when(match.isNotNull(), F.format_string("excluded by operator request: %s %s", match["scope"], match["pattern"]))


def histogram(rows: DataFrame, column: str) -> DataFrame:
    """Rows of each value, most frequent first."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def placeholders(targets: DataFrame, url: str) -> DataFrame:
    """The targets that hold an unsubstituted placeholder."""
    return targets.filter(F.col(url).contains("{"))


def refuse_placeholders(targets: DataFrame, url: str) -> DataFrame:
    """One placeholder stops the whole listing run (R17): the job that meets it fails."""
    return refused(targets, F.col(url).contains("{"), "a target url holds a placeholder")
