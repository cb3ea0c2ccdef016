"""Constraints (NOT NULL, CHECK), validated writes, and pipeline expectations.

A NULL condition passes a CHECK rule, as in SQL, and fails an expectation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType


class RuleViolation(ValueError):
    """Rows break a constraint, or columns do not fit a table."""


@dataclass(frozen=True)
class Rule:
    """A named condition every row must meet."""

    name: str
    condition: str

    @staticmethod
    def not_null(column: str) -> Rule:
        return Rule(f"{column}_not_null", f"`{column}` IS NOT NULL")

    @staticmethod
    def check(name: str, condition: str) -> Rule:
        return Rule(name, condition)

    def broken(self) -> Column:
        """True where the condition is FALSE; a NULL condition is not a violation."""
        return F.coalesce(~F.expr(self.condition), F.lit(False))


def constraint_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of every rule, from one pass over the table."""
    counts = df.agg(*[F.count_if(r.broken()).alias(r.name) for r in rules])
    return counts.unpivot([], [r.name for r in rules], "rule", "violations")


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same rows, or a RuleViolation naming the broken rules, before anything is written."""
    broken = {r["rule"]: r["violations"] for r in constraint_report(df, rules).collect() if r["violations"]}
    if broken:
        raise RuleViolation(f"constraints violated: {broken}")
    return df


def guard(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same rows, failing the job that reads them at the first row that breaks a rule.

    No extra pass: a write of guarded rows either commits all of them or nothing.
    """
    out = df
    for r in rules:
        failed = F.raise_error(F.lit(f"constraint violated: {r.name}")).cast("boolean")
        out = out.where(F.when(r.broken(), failed).otherwise(F.lit(True)))
    return out


def with_violations(df: DataFrame, rules: Sequence[Rule], name: str = "violations") -> DataFrame:
    """Add the array of names of the rules a row breaks."""
    marks = F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules])
    return df.withColumn(name, F.array_compact(marks))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the names of those they break."""
    marked = with_violations(df, rules)
    return (marked.where(F.size("violations") == 0).drop("violations"),
            marked.where(F.size("violations") > 0))


def write_split(df: DataFrame, rules: Sequence[Rule], path: str) -> tuple[DataFrame, DataFrame]:
    """The two parts of `split_valid`, written in one pass as partitions `valid` of one folder, and read back."""
    marked = with_violations(df, rules).withColumn("valid", F.size("violations") == 0)
    marked.write.mode("errorifexists").partitionBy("valid").parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    return stored.where("valid").drop("valid", "violations"), stored.where("NOT valid").drop("valid")


def check_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Raise unless the frame has exactly the columns and types of `schema`, in any order."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    wrong = [f"missing {c}" for c in want if c not in have]
    wrong += [f"unknown {c}" for c in have if c not in want]
    wrong += [f"{c}: {have[c].simpleString()} instead of {want[c].simpleString()}"
              for c in want if c in have and have[c] != want[c]]
    if wrong:
        raise RuleViolation("schema mismatch: " + "; ".join(wrong))
    return df.select(*[F.col(f"`{c}`") for c in want])


# ---- expectations -------------------------------------------------------------------------------

Expectations = Mapping[str, "str | tuple[str, str]"]
ACTIONS = ("warn", "drop", "fail")


def _parsed(rules: Expectations) -> list[tuple[str, Column, str]]:
    out = []
    for name, rule in rules.items():
        condition, action = (rule, "warn") if isinstance(rule, str) else rule
        if action not in ACTIONS:
            raise ValueError(f"expectation {name}: action must be one of {ACTIONS}")
        out.append((name, F.coalesce(F.expr(condition), F.lit(False)), action))
    return out


def expectation_counts(rules: Expectations) -> list[Column]:
    """Aggregates counting the rows that fail each expectation, plus all rows."""
    return [F.count(F.lit(1)).alias("_records"),
            *[F.count_if(~passed).alias(name) for name, passed, _ in _parsed(rules)]]


def expect(df: DataFrame, rules: Expectations, metrics: str | Observation | None = None) -> DataFrame:
    """Apply expectations: `warn` keeps failing rows, `drop` removes them, `fail` aborts the query.

    With `metrics`, failures are counted while the rows flow by (no second pass): under that name
    in `StreamingQueryProgress.observedMetrics`, or for a static frame in the given Observation.
    """
    out = df.observe(metrics, *expectation_counts(rules)) if metrics else df
    for name, passed, action in _parsed(rules):
        if action == "fail":
            out = out.where(F.when(passed, F.lit(True)).otherwise(
                F.raise_error(F.lit(f"expectation failed: {name}")).cast("boolean")))
    for _, passed, action in _parsed(rules):
        if action == "drop":
            out = out.where(passed)
    return out


def expectation_metrics(df: DataFrame, rules: Expectations) -> DataFrame:
    """Passed and failed records and failure rate of every expectation, worst first, from one pass."""
    names = list(rules)
    counts = df.agg(*expectation_counts(rules))
    rate = F.col("failed_records") * F.lit(100).cast("decimal(5,0)") / F.col("_records")
    return (counts.unpivot("_records", names, "expectation_name", "failed_records")
            .select("expectation_name",
                    (F.col("_records") - F.col("failed_records")).alias("passed_records"),
                    "failed_records",
                    F.when(F.col("_records") > 0, F.round(rate, 2)).alias("failure_rate"))
            .orderBy(F.desc("failure_rate"), "expectation_name"))
