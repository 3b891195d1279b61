"""Data-quality expectations: count violations, and fail or publish on the result.

All rules of a data set are counted in one pass. A rule that evaluates to NULL counts as violated unless
null_passes is set, the way a CHECK constraint reads it.
"""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ExpectationFailed(Exception):
    """A rule with the action 'fail' was violated."""

    def __init__(self, violations: Mapping[str, int]):
        self.violations = dict(violations)
        super().__init__(", ".join(f"{rule}: {count} rows" for rule, count in self.violations.items()))


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = "warn"


def rules(predicates: Mapping[str, str], action: str = "warn") -> list[Rule]:
    return [Rule(name, predicate, action) for name, predicate in predicates.items()]


def violates(predicate: str, null_passes: bool = False) -> Column:
    return ~F.coalesce(F.expr(predicate), F.lit(null_passes))


def _metrics(rule_list: list[Rule], null_passes: bool) -> list[Column]:
    counted = (F.count_if(violates(r.predicate, null_passes)).alias(f"_rule{i}") for i, r in enumerate(rule_list))
    return [F.count(F.lit(1)).alias("_rows"), *counted]


def violation_counts(df: DataFrame, rule_list: list[Rule], null_passes: bool = False) -> DataFrame:
    """One row per rule: (rule, action, total_rows, violations, passed)."""
    report = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.action).alias("action"),
                F.col("_rows").alias("total_rows"),
                F.col(f"_rule{i}").alias("violations"),
                (F.col(f"_rule{i}") == 0).alias("passed"),
            )
            for i, r in enumerate(rule_list)
        )
    )
    return df.agg(*_metrics(rule_list, null_passes)).select(F.inline(report))


def row_count_verdicts(layers: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None) -> DataFrame:
    """Row count per layer, and whether it is the expected one (null where none is given)."""
    expected = expected or {}
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"),
            "row_count",
            (F.col("row_count") == F.lit(expected.get(layer)).cast("long")).alias("as_expected"),
        )
        for layer, df in layers.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def with_violated(df: DataFrame, rule_list: list[Rule], name: str = "_violated", null_passes: bool = False) -> DataFrame:
    """`df` with the names of the 'drop' rules that each row violates."""
    names = (F.when(violates(r.predicate, null_passes), F.lit(r.name)) for r in rule_list if r.action == "drop")
    return df.withColumn(name, F.array_compact(F.array(F.lit(None).cast("string"), *names)))


def require(df: DataFrame, rule_list: list[Rule], null_passes: bool = False) -> DataFrame:
    """Counts now, and returns `df` only if no 'fail' rule is violated.

    The counting is its own aggregate: a check inside a projection would be pruned with an unused column.
    """
    counts = df.agg(*_metrics(rule_list, null_passes)).first()
    _raise_on_failure(rule_list, counts.asDict())
    return df


def observed(df: DataFrame, rule_list: list[Rule], null_passes: bool = False) -> tuple[DataFrame, Observation]:
    """`df` carrying the counts along, so that the write which consumes it also counts."""
    observation = Observation()
    return df.observe(observation, *_metrics(rule_list, null_passes)), observation


def check_observed(observation: Observation, rule_list: list[Rule]) -> dict[str, int]:
    """Violations per rule once the observed write has run; raises for a violated 'fail' rule."""
    return _raise_on_failure(rule_list, observation.get)


def _raise_on_failure(rule_list: list[Rule], counts: Mapping[str, int]) -> dict[str, int]:
    violations = {rule.name: counts[f"_rule{i}"] for i, rule in enumerate(rule_list)}
    broken = {r.name: violations[r.name] for r in rule_list if r.action == "fail" and violations[r.name]}
    if broken:
        raise ExpectationFailed(broken)
    return violations
