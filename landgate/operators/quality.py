"""Record validity, null profiles, business rules and the verdict drawn from them.

Everything here is an expression over one row or one aggregate, so a caller can evaluate counts,
null profile and all rules in a single pass, or hang them on a running write as observed metrics.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgate.schemas import CORRUPT

# Fixed value: what counts as a number written as text. No exponent, no bare or leading dot.
NUMERIC_TEXT = r"^-?[0-9]+(\.[0-9]+)?$"

PASSED = "PASSED"
PASSED_WITH_WARNINGS = "PASSED WITH WARNINGS"
PARTIAL = "PARTIAL"
ISSUES = "ISSUES"


# --- validity -------------------------------------------------------------------------------


def is_valid(corrupt: str = CORRUPT) -> Column:
    return F.col(corrupt).isNull()


def split_valid(parsed: DataFrame, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Good rows without the corrupt column, and rejected rows with it."""
    return parsed.filter(is_valid(corrupt)).drop(corrupt), parsed.filter(~is_valid(corrupt))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, 0.0 of nothing."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def validity_metrics(corrupt: str = CORRUPT) -> list[Column]:
    # count_if, unlike a sum of flags, is 0 and not NULL over no rows.
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_valid(corrupt)).alias("valid"),
        F.count_if(~is_valid(corrupt)).alias("invalid"),
    ]


def validation_counts(parsed: DataFrame, corrupt: str = CORRUPT) -> DataFrame:
    """Total, valid and invalid records and their shares, in one pass."""
    return with_shares(parsed.agg(*validity_metrics(corrupt)))


def with_shares(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "valid_pct": percent(F.col("valid"), F.col("total")),
            "invalid_pct": percent(F.col("invalid"), F.col("total")),
        }
    )


def cut_text(column: Column, width: int) -> Column:
    """Text cut to ``width`` characters, marked with dots where something was cut."""
    return F.when(
        F.length(column) > width, F.concat(F.substring(column, 1, width), F.lit("..."))
    ).otherwise(column)


def reject_texts(invalid: DataFrame, width: int = 200, corrupt: str = CORRUPT) -> DataFrame:
    """The text of every rejected record, shortened for display."""
    return invalid.select(cut_text(F.col(corrupt), width).alias("rejected"))


def reject_sample(
    invalid: DataFrame, n: int = 5, width: int = 200, corrupt: str = CORRUPT
) -> DataFrame:
    """``n`` rejected records for a report; the first in text order, so that runs agree."""
    first = invalid.select(corrupt).orderBy(corrupt).limit(n)
    return reject_texts(first, width, corrupt)


# --- rules ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """``violated`` is a SQL condition true for an offending row; NULL counts as kept."""

    name: str
    violated: str
    message: str

    def count(self) -> Column:
        return F.count_if(F.expr(self.violated))


def required(column: str) -> Rule:
    return Rule(
        f"required({column})",
        f"{column} IS NULL",
        f"valid records with null {column}",
    )


def numeric_text(column: str) -> Rule:
    return Rule(
        f"numeric_text({column})",
        f"{column} IS NOT NULL AND NOT ({column} RLIKE r'{NUMERIC_TEXT}')",
        f"records with non-numeric {column}",
    )


def within(column: str, low: float, high: float) -> Rule:
    return Rule(
        f"within({column}, {low}, {high})",
        f"NOT ({column} BETWEEN {low} AND {high})",
        f"records with {column} outside {low} to {high}",
    )


BILLING_RULES = (required("billing_account_id"), numeric_text("cost"))


# --- one-pass profile -----------------------------------------------------------------------


def _null_name(i: int) -> str:
    return f"null_{i}"


def _rule_name(i: int) -> str:
    return f"rule_{i}"


def quality_metrics(
    fields: Sequence[str], rules: Sequence[Rule], among: Column | None = None
) -> list[Column]:
    """Aggregates for the null profile and all rules, counting only rows where ``among`` holds."""

    def scoped(condition: Column) -> Column:
        return F.count_if(condition if among is None else among & condition)

    nulls = [scoped(F.col(f).isNull()).alias(_null_name(i)) for i, f in enumerate(fields)]
    broken = [scoped(F.expr(r.violated)).alias(_rule_name(i)) for i, r in enumerate(rules)]
    return nulls + broken


def profile(df: DataFrame, fields: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """One row: ``valid`` plus one count per field and per rule, for the two arrays below."""
    return df.agg(F.count(F.lit(1)).alias("valid"), *quality_metrics(fields, rules))


def null_entries(fields: Sequence[str]) -> Column:
    """Array of (field, nulls, pct) over a one-row profile."""
    return F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(_null_name(i)).alias("nulls"),
                percent(F.col(_null_name(i)), F.col("valid")).alias("pct"),
            )
            for i, f in enumerate(fields)
        ]
    ).cast("array<struct<field: string, nulls: bigint, pct: double>>")


def violation_entries(rules: Sequence[Rule]) -> Column:
    """Array of (rule, violations, message) over a one-row profile, kept rules left out."""
    entries = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.col(_rule_name(i)).alias("violations"),
                F.concat_ws(" ", F.col(_rule_name(i)).cast("string"), F.lit(r.message)).alias(
                    "message"
                ),
            )
            for i, r in enumerate(rules)
        ]
    ).cast("array<struct<rule: string, violations: bigint, message: string>>")
    return F.filter(entries, lambda e: e["violations"] > 0)


def null_stats(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Null count and percentage per field, all fields in one pass."""
    return profile(df, fields, ()).select(F.inline(null_entries(fields)))


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violated rules with their counts, all rules in one pass."""
    return profile(df, (), rules).select(F.inline(violation_entries(rules)))


def verdict(invalid: Column, violations: Column) -> Column:
    """Four-way outcome of a gate from rejected records and violated rules."""
    return (
        F.when((invalid == 0) & (violations == 0), PASSED)
        .when(invalid == 0, PASSED_WITH_WARNINGS)
        .when(violations == 0, PARTIAL)
        .otherwise(ISSUES)
    )
