"""The scan on streams. Row-by-row operators (detect, rewrite, analyze, audit) take a streaming DataFrame as it is;
the jobs here add event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.rules import RULES, Rule
from hazardlens.operators.classify import REVIEW, SAFE, TOKEN_CLASSES, VIOLATION
from hazardlens.operators.counts import rule_counts
from hazardlens.operators.detect import detect


def findings_per_window(
    files: DataFrame,
    ts: str = "ts",
    window: str = "1 hour",
    watermark: str = "10 minutes",
    rules: tuple[Rule, ...] = RULES,
    text: str = "text",
) -> DataFrame:
    """Findings and files per rule and tumbling window; files are reduced to counts before the state store."""
    return (
        detect(files.withWatermark(ts, watermark), rules, text)
        .select(F.col(ts), F.inline_outer(rule_counts(F.col("findings"))))
        .where(F.col("n").isNotNull())
        .groupBy(F.window(ts, window).alias("w"), "pattern_type")
        .agg(F.sum("n").alias("findings"), F.count("*").alias("files"))
        .select(F.col("w.start").alias("window_start"), "pattern_type", "findings", "files")
    )


def session_labels(
    events: DataFrame,
    key: Sequence[str],
    ts: str = "ts",
    token: str = "token",
    gap: str = "30 minutes",
    watermark: str = "10 minutes",
) -> DataFrame:
    """Label of each session of tokens, emitted when the session closes.

    The label asks only whether a "hard" token occurs or a leak follows the first credential, so a session's
    state is a handful of times, not its tokens. Tokens at the same time count as simultaneous: a leak has to
    be later than the credential.
    """

    def is_class(name: str):
        return F.col(token).isin(*TOKEN_CLASSES[name])

    known = F.col(token).isin(*(t for names in TOKEN_CLASSES.values() for t in names))
    at = F.col(ts)
    facts = (
        events.withWatermark(ts, watermark)
        .groupBy(*key, F.session_window(ts, gap).alias("session"))
        .agg(
            F.min(F.when(is_class("cred"), at)).alias("_cred"),
            F.max(F.when(is_class("leak"), at)).alias("_leak"),
            F.count_if(is_class("hard")).alias("_hard"),
            F.count_if(known).alias("_known"),
            F.count_if(is_class("env")).alias("_env"),
            F.count("*").alias("n_tokens"),
        )
    )
    label = (
        F.when((F.col("_hard") > 0) | F.coalesce(F.col("_leak") > F.col("_cred"), F.lit(False)), VIOLATION)
        .when((F.col("_known") > 0) & (F.col("_known") == F.col("_env")), SAFE)
        .otherwise(REVIEW)
    )
    return facts.select(
        *key,
        F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"),
        "n_tokens",
        label.alias("label"),
    )
