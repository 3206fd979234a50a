"""Rules that a table must meet: counted in one pass, and raised where a job must not go on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class RulesFailed(ValueError):
    """Says which rules failed, and in how many rows each."""


def failures(df: DataFrame, rules: dict[tuple[str, str], Column]) -> DataFrame:
    """(rule, col, failures) for rules {(rule, col): condition of a bad row}: one aggregation, whatever their number."""
    one = df.agg(*[F.count_if(bad).alias(f"x{k}") for k, bad in enumerate(rules.values())])
    rows = [F.struct(F.lit(a).alias("rule"), F.lit(b).alias("col"), F.col(f"x{k}").alias("failures")) for k, (a, b) in enumerate(rules)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def require(df: DataFrame, rules: dict[tuple[str, str], Column], warn: frozenset[tuple[str, str]] = frozenset()) -> DataFrame:
    """df, if no row breaks a rule that is not in warn; else RulesFailed. An empty table breaks none. Reads df once more."""
    if not rules:
        return df
    bad = {(r.rule, r.col): r.failures for r in failures(df, rules).collect() if r.failures and (r.rule, r.col) not in warn}  # a row a rule
    if bad:
        raise RulesFailed("; ".join(f"{rule} of {col}: {n} rows" for (rule, col), n in sorted(bad.items())))
    return df


def counted_over(df: DataFrame, rules: dict[tuple[str, str], Column], write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(rule, col, failures) as failures() gives, over what write(df) returns, the written rows: df is computed once."""
    return failures(write(df), rules)
