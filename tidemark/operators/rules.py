"""Declarative row validation.

A rule set is an ordered table of ``(code, predicate)``. All rules of a data set
are evaluated in one projection; a predicate that is NULL does not fire.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
STATUS_ERROR = "ERROR"
STATUS_WARNING = "WARNING"
STATUS_VALID = "VALID"
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A code and the SQL predicate that raises it.

    ``{process_date}`` in the predicate stands for the processing date.
    """

    code: str
    predicate: str

    def sql(self, process_date: str) -> str:
        predicate = self.predicate.format(process_date=f"DATE'{process_date}'")
        return f"CASE WHEN {predicate} THEN '{self.code}' END"


@dataclass(frozen=True)
class RuleSet:
    errors: Sequence[Rule]
    warnings: Sequence[Rule] = ()


def rules(*pairs: tuple[str, str]) -> tuple[Rule, ...]:
    """Shorthand: a rule table from ``(code, predicate)`` pairs."""
    return tuple(Rule(code, predicate) for code, predicate in pairs)


def _codes(rule_list: Sequence[Rule], process_date: str) -> Column:
    if not rule_list:
        return F.lit(None).cast("string")
    fired = ", ".join(rule.sql(process_date) for rule in rule_list)
    return F.expr(f"nullif(concat_ws(',', {fired}), '')")


def validate(df: DataFrame, rule_set: RuleSet, process_date: str) -> DataFrame:
    """Add ``validation_errors`` and ``validation_warnings``, NULL when clean."""
    return df.withColumns(
        {
            "validation_errors": _codes(rule_set.errors, process_date),
            "validation_warnings": _codes(rule_set.warnings, process_date),
        }
    )


def add_status(df: DataFrame) -> DataFrame:
    """Add ``status``: an error outranks a warning."""
    return df.withColumn(
        "status",
        F.when(F.isnotnull("validation_errors"), STATUS_ERROR)
        .when(F.isnotnull("validation_warnings"), STATUS_WARNING)
        .otherwise(STATUS_VALID),
    )


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows without validation errors; a frame that was never validated passes whole."""
    if "validation_errors" not in df.columns:
        return df
    return df.where(F.isnull("validation_errors"))


def violation_counts(df: DataFrame, dataset: str) -> DataFrame:
    """How often each code fired: one row per severity and code."""
    exploded = df.select(
        F.explode(
            F.array(
                F.struct(F.lit("error").alias("severity"), F.col("validation_errors").alias("codes")),
                F.struct(F.lit("warning").alias("severity"), F.col("validation_warnings").alias("codes")),
            )
        ).alias("v")
    ).select("v.severity", F.explode(F.split("v.codes", ",")).alias("code"))
    return (
        exploded.groupBy("severity", "code")
        .agg(F.count("*").alias("violations"))
        .select(F.lit(dataset).alias("dataset"), "severity", "code", "violations")
    )
