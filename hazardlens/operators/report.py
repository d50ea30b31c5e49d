"""Per-file reports: JSON rows, the marked listing, and a readable text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.text import let, split_lines
from hazardlens.operators.counts import rule_counts
from hazardlens.operators.detect import with_excerpts

JSON_FIELDS = ("filepath", "findings", "summary", "tokens", "classification", "transformations", "validation")


def report_json(reports: DataFrame, context_lines: int = 2) -> DataFrame:
    """``filepath`` and ``json``: one JSON object per file. Text outside ASCII is kept as it is.

    Every finding carries its excerpt, so the object of a file with very many findings in long lines is large.
    """
    findings = F.transform(
        with_excerpts(F.col("findings"), F.col("source"), context_lines),
        lambda f: F.struct(*(f[c].alias(c) for c in ("pattern_type", "value", "line", "excerpt"))),
    )
    fields = [findings.alias(c) if c == "findings" else F.col(c) for c in JSON_FIELDS]
    return reports.select("filepath", F.to_json(F.struct(*fields)).alias("json"))


def write_report_json(reports: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line, in as many files as there are partitions."""
    report_json(reports).select(F.col("json").alias("value")).write.mode(mode).text(path)


def _marked_lines(text: Column, findings: Column) -> Column:
    """array of (line, marked, text).

    The finding lines, given as a string of line ends and marks, are cut at the line ends like the text itself;
    walking both side by side keeps the cost linear, where a lookup per line would not be.
    """
    lines = F.transform(
        split_lines(text),
        lambda x, i: F.struct((i + 1).cast("int").alias("line"), x.alias("text")),
    )
    return let(
        F.struct(lines.alias("lines"), F.array_distinct(F.transform(findings, lambda f: f["line"])).alias("hits")),
        lambda b: F.zip_with(
            b["lines"],
            _line_flags(b["hits"]),
            lambda line, flag: F.struct(
                line["line"].alias("line"), F.coalesce(flag, F.lit(False)).alias("marked"), line["text"].alias("text")
            ),
        ),
    )


def _line_flags(hits: Column) -> Column:
    """For ascending line numbers: array of booleans up to the last of them, true at each."""
    gaps = F.transform(
        F.zip_with(hits, F.concat(F.array(F.lit(0)), hits), lambda a, b: a - b),
        lambda n: F.concat(F.array_repeat(F.lit(False), n - 1), F.array(F.lit(True))),
    )
    return F.flatten(F.filter(gaps, lambda g: g.isNotNull()))


def listing(detected: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Every source line with its number and whether a finding starts on it."""
    return detected.select(*keep, F.inline_outer(_marked_lines(F.col(text), F.col("findings")))).where(
        F.col("line").isNotNull()
    )


def _block(title: str, *body: Column) -> Column:
    return F.concat_ws("\n", F.lit(f"\n[{title}]"), F.lit("-" * 40), *body)


def _numbered(lines: Column, width: str = "    %3d | %s") -> Column:
    return F.array_join(F.transform(lines, lambda x, i: F.format_string(width, i + 1, x)), "\n")


def report_text(reports: DataFrame) -> DataFrame:
    """``filepath`` and ``report_text`` with five blocks: source, detection, classification, changes, audit."""
    source = F.array_join(
        F.transform(
            _marked_lines(F.col("source"), F.col("findings")),
            lambda x: F.format_string(
                "  %s %3d | %s", F.when(x["marked"], ">>>").otherwise("   "), x["line"], x["text"]
            ),
        ),
        "\n",
    )
    found = F.array_join(
        F.transform(
            "findings", lambda f: F.format_string("    [%s] line %d -> %s", f["pattern_type"], f["line"], f["value"])
        ),
        "\n",
    )
    counts = F.array_join(
        F.transform(
            rule_counts(F.col("findings")), lambda c: F.format_string("    %s: %d", c["pattern_type"], c["n"])
        ),
        "\n",
    )
    detection = F.when(F.size("findings") == 0, "  No security patterns found.").otherwise(
        F.concat_ws(
            "\n",
            F.format_string("  %d pattern(s) found:\n", F.size("findings")),
            found,
            F.lit("\n  Counts:"),
            counts,
            F.lit("\n  Token sequence:"),
            F.concat(F.lit("    "), F.array_join("tokens", ", ")),
        )
    )
    changes = F.when(F.size("transformations") == 0, "  No changes needed.").otherwise(
        F.array_join(
            F.transform(
                "transformations",
                lambda t, i: F.format_string(
                    "  %d. Line %d - %s\n     Before: %s\n     After:  %s",
                    i + 1,
                    t["line"],
                    t["reason"],
                    t["before"],
                    t["after"],
                ),
            ),
            "\n",
        )
    )
    rewritten = F.when(
        F.col("has_changes"),
        F.concat(F.lit("\n  Rewritten text:\n" + "-" * 40 + "\n"), _numbered(split_lines(F.col("transformed_source")))),
    )
    violations = F.transform(
        F.coalesce(F.col("validation.violations"), F.array()),
        lambda v: F.format_string("    - Line %d: [%s] %s", v["line"], v["type"], v["value"]),
    )
    validation = F.concat_ws(
        "\n",
        F.format_string("  Status: [%s] %s", F.col("validation.status"), F.col("validation.message")),
        F.when(F.size(violations) > 0, F.array_join(violations, "\n")),
    )
    rule = "=" * 60
    text = F.concat_ws(
        "\n",
        F.lit(rule),
        F.concat(F.lit("  File: "), F.element_at(F.split("filepath", "/"), -1)),
        F.concat(F.lit("  Path: "), F.col("filepath")),
        F.lit(rule),
        _block("1 SOURCE", source),
        _block("2 DETECTION", detection),
        _block(
            "3 CLASSIFICATION",
            F.concat(F.lit("  Result: "), F.col("classification")),
            F.concat(F.lit("  Final state: "), F.col("classification_state")),
            F.concat(F.lit("  Message: "), F.col("classification_msg")),
        ),
        _block("4 CHANGES", changes, rewritten),
        _block("5 VALIDATION", validation),
    )
    return reports.select("filepath", text.alias("report_text"))
