"""Counts over findings: per file, per group, per corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hazardlens.operators.classify import REVIEW, SAFE, VIOLATION

# ---- fixed values: the rules whose findings close the gate ----------------------------------------------------
DANGEROUS_RULES = (
    "HARDCODED_CRED",
    "AWS_KEY",
    "PRINT_LEAK",
    "LOG_LEAK",
    "DANGEROUS_CALL",
    "INSECURE_REQUEST",
)
# ---- end of fixed values --------------------------------------------------------------------------------------


def rule_counts(findings: Column) -> Column:
    """array of (pattern_type, n), by name, for the findings of one file; needs no shuffle."""

    def counted(names: Column) -> Column:
        return F.transform(
            F.array_sort(F.array_distinct(names)),
            lambda name: F.struct(
                name.alias("pattern_type"), F.size(F.filter(names, lambda x: x == name)).alias("n")
            ),
        )

    return F.transform(F.array(F.transform(findings, lambda f: f["pattern_type"])), counted)[0]


def summary_map(findings: Column) -> Column:
    return F.map_from_entries(rule_counts(findings))


def counts_by_file(detected: DataFrame, *keep: str) -> DataFrame:
    return detected.select(*keep, F.inline_outer(rule_counts(F.col("findings")))).where(F.col("n").isNotNull())


def counts_by(detected: DataFrame, *group: str) -> DataFrame:
    """Findings and files per rule and group; files are reduced to counts before the shuffle."""
    return (
        counts_by_file(detected, *group)
        .groupBy(*group, "pattern_type")
        .agg(F.sum("n").alias("findings"), F.count("*").alias("files"))
    )


def _totals() -> list[Column]:
    return [
        F.count("*").alias("files"),
        F.coalesce(F.sum(F.size("findings")), F.lit(0)).cast("long").alias("findings"),
        F.count_if(F.col("label") == SAFE).alias("safe"),
        F.count_if(F.col("label") == REVIEW).alias("needs_review"),
        F.count_if(F.col("label") == VIOLATION).alias("security_violation"),
    ]


def corpus_summary(classified: DataFrame) -> DataFrame:
    """One row of totals from a table with ``findings`` and ``label``."""
    return classified.agg(*_totals())


def observed_summary(classified: DataFrame) -> tuple[DataFrame, Observation]:
    """The same table, and the totals of ``corpus_summary`` that are taken while it is written or read.

    ``observation.get`` has them as a dictionary after the first action, which scans the corpus once for both.
    """
    totals = Observation("totals")
    return classified.observe(totals, *_totals()), totals


def is_dangerous(pattern_type: Column) -> Column:
    return pattern_type.isin(*DANGEROUS_RULES)


def gate(detected: DataFrame, *keep: str) -> DataFrame:
    """PASS or FAIL per file with the findings that decide it."""
    violations = F.transform(
        F.filter("findings", lambda f: is_dangerous(f["pattern_type"])),
        lambda f: F.struct(f["line"].alias("line"), f["pattern_type"].alias("type"), f["value"].alias("value")),
    )
    n = F.size("violations")
    return detected.select(*keep, violations.alias("violations")).select(
        *keep,
        F.when(n > 0, "FAIL").otherwise("PASS").alias("status"),
        F.when(n > 0, F.concat(n.cast("string"), F.lit(" violation(s) found")))
        .otherwise("No violations found")
        .alias("message"),
        n.alias("n_violations"),
        "violations",
    )
