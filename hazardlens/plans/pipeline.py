"""The whole scan as one lazy plan without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions.rules import RULES, Rule
from hazardlens.operators.classify import DEFAULT_TABLE, TransitionTable, classification
from hazardlens.operators.config_audit import audit, config_audit, missing_file, rejected_file
from hazardlens.operators.counts import summary_map
from hazardlens.operators.detect import tokens
from hazardlens.operators.rewrite import rewrite
from hazardlens.sources.tree import decoded, list_tree, read_listed

# ---- fixed values: texts of the report ------------------------------------------------------------------------
AUDITED_SUFFIX = ".conf"
PASS, FAIL, SKIPPED = "PASS", "FAIL", "N/A"
AUDIT_ERROR = "CFG_ERROR"
ACTION_REASON = "Action: "
# ---- end of fixed values --------------------------------------------------------------------------------------
NOT_AUDITED = "Validation applies to .conf files only"
VALIDATION = "struct<status:string,message:string,violations:array<struct<line:int,type:string,value:string>>>"


def analyze(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    table: TransitionTable = DEFAULT_TABLE,
    **rewrite_options,
) -> DataFrame:
    """One report row per file: findings, counts, label, rewritten text and, for config files, the audit.

    Findings have no excerpts here, which could multiply the text: ``report_json`` adds them, ``explode_excerpts``
    gives them as rows. ``rewrite_options`` go to ``rewrite``: ``rewriters``, ``actions``, ``redaction_marker``.
    """
    checked = F.struct(
        F.when(F.col("_audit.is_valid"), PASS).otherwise(FAIL).alias("status"),
        F.col("_audit.message").alias("message"),
        F.transform(
            "_audit.errors",
            lambda e: F.struct(
                e["line"].alias("line"), F.lit(AUDIT_ERROR).alias("type"), e["message"].alias("value")
            ),
        ).alias("violations"),
    )
    skipped = F.struct(
        F.lit(SKIPPED).alias("status"), F.lit(NOT_AUDITED).alias("message"), F.lit(None).alias("violations")
    )
    transformations = F.transform(
        "rewrites",
        lambda r: F.struct(
            r["line_number"].alias("line"),
            r["original_line"].alias("before"),
            r["transformed_line"].alias("after"),
            F.concat(F.lit(ACTION_REASON), r["action"]).alias("reason"),
        ),
    )
    return (
        rewrite(files, rules, text, **rewrite_options)
        .withColumn("tokens", tokens(F.col("findings")))
        .withColumn("_class", classification(F.col("tokens"), table))
        .withColumn("_audit", F.when(F.endswith(F.col(path), F.lit(AUDITED_SUFFIX)), audit(F.col(text))))
        .select(
            *(c for c in files.columns if c not in (path, text)),
            F.col(path).alias("filepath"),
            F.col(text).alias("source"),
            "findings",
            summary_map(F.col("findings")).alias("summary"),
            "tokens",
            F.col("_class.label").alias("classification"),
            F.col("_class.message").alias("classification_msg"),
            F.col("_class.final_state").alias("classification_state"),
            transformations.alias("transformations"),
            F.col("transformed_text").alias("transformed_source"),
            "has_changes",
            F.when(F.col("_audit").isNotNull(), checked.cast(VALIDATION))
            .otherwise(skipped.cast(VALIDATION))
            .alias("validation"),
        )
    )


def audit_contents(contents: DataFrame) -> DataFrame:
    """Audit of read contents (``path``, ``content``, ``reason``): a row per file, also of those that are missing, cannot be
    read or are not UTF-8; they are invalid results, not errors."""
    reason, name = F.col("reason"), F.col("path")
    result = (
        F.when(reason.isNull(), audit(F.col("text")))
        .when(reason == "not_found", missing_file(name))
        .otherwise(rejected_file(name, reason))
    )
    return decoded(contents).select("path", result.alias("_a")).select("path", "_a.*")


def audit_tree(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Audit of the configuration files under a path, as ``audit_contents`` gives it."""
    return audit_contents(read_listed(list_tree(spark, path, recursive, (AUDITED_SUFFIX,))))
