"""Detection: typed, numbered findings of a text, row by row and without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.rules import RULES, Rule, hush, master_pattern, master_replacement, may_match, with_hints
from hazardlens.functions.text import (
    FIELD,
    MARK,
    count_newlines,
    let,
    part,
    separator,
    split_lines,
    strip,
)

FINDING = "struct<seq:int,pattern_type:string,value:string,line:int>"
FINDING_WITH_EXCERPT = "struct<seq:int,pattern_type:string,value:string,line:int,excerpt:string>"


def cut_at_matches(
    files: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text: str = "text",
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``_pieces``: gap, match, gap, ..., match, gap; null where no rule can match. Also ``_sep``.

    One pass of the pattern rewrites every match between separators; one split cuts the result. The whole text
    is one unit because matches may span lines. With ``only``, texts that none of these rules can match are
    passed over; the others are still cut with all rules, because a match takes its text from other rules.
    """
    defaults = set(rules) <= set(RULES)
    rules = with_hints(rules)
    wanted = rules if only is None else tuple(r for r in rules if r.name in only)
    # A guard could change what rules of others match.
    hushed = hush(F.col(text), F.col("_lower")) if defaults else F.struct(F.col(text).alias("text"), F.lit("").alias("guard"))
    marked = F.regexp_replace(
        F.col("_hushed")["text"], F.lit(master_pattern(rules)), master_replacement(F.col("_sep"), rules)
    )
    return (
        files.withColumn("_lower", F.lower(text))
        .withColumn("_sep", F.when(may_match(F.col(text), F.col("_lower"), wanted), separator(F.col(text))))
        .withColumn("_hushed", F.when(F.col("_sep").isNotNull(), hushed))
        .withColumn("_pieces", F.split(F.replace(marked, F.col("_hushed")["guard"], F.lit("")), F.col("_sep")))
        .drop("_lower", "_hushed")
    )


def rule_index(match: Column) -> Column:
    """Zero-based rule number of a match piece: its leading FIELDs. No rule can open with that character."""
    return F.length(match) - F.length(F.ltrim(match, F.lit(FIELD)))


def _is_odd(_: Column, i: Column) -> Column:
    return i % 2 == 1


def _match_lines(pieces: Column) -> Column:
    """The line each match starts on.

    An outline of the text holds its newlines and one mark per match. Cut at the newlines, the position of an element
    is its line and its length the number of matches on it.
    """
    newlines = F.transform(pieces, count_newlines)

    def outline(n: Column, i: Column) -> Column:
        return F.concat(F.when(_is_odd(n, i), MARK).otherwise(""), F.repeat(F.lit("\n"), n))

    return F.flatten(
        F.transform(
            F.split(F.array_join(F.transform(newlines, outline), ""), "\n"),
            lambda marks, i: F.array_repeat((i + 1).cast("int"), F.length(marks)),
        )
    )


def _findings(pieces: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.lit([r.name for r in rules])
    matches = F.zip_with(
        F.filter(pieces, _is_odd), _match_lines(pieces), lambda p, n: F.struct(p.alias("piece"), n.alias("line"))
    )

    def finding(m: Column, k: Column) -> Column:
        at = rule_index(m["piece"])
        value = F.substring(m["piece"], at + 1, F.length(m["piece"]) - (len(rules) - 1))
        return F.struct(
            (k + 1).cast("int").alias("seq"),
            F.get(names, at).alias("pattern_type"),
            strip(value).alias("value"),
            m["line"].alias("line"),
        )

    return F.when(F.size(pieces) > 1, F.transform(matches, finding)).otherwise(
        F.array().cast(f"array<{FINDING}>")
    )


def _excerpt(lines: Column, line: Column, context_lines: int) -> Column:
    first = F.greatest(F.lit(1), line - context_lines)
    last = F.least(F.size(lines), line + context_lines)
    shown = F.transform(F.sequence(first, last), lambda k: F.format_string("  %3d | %s", k, F.get(lines, k - 1)))
    # Line numbers count newlines only, of which there are never more than line ends of all kinds.
    return F.array_join(shown, "\n")


def with_excerpts(findings: Column, text: Column, context_lines: int = 2) -> Column:
    """Findings with ``excerpt``: the lines around each, numbered and cut at the ends of the text.

    The array holds the lines once per finding. Where a text may have very many findings in long lines, use
    ``explode_excerpts``.
    """
    both = F.struct(findings.alias("findings"), split_lines(text).alias("lines"))
    shown = let(
        both,
        lambda b: F.transform(
            b["findings"],
            lambda f: F.struct(
                f["seq"].alias("seq"),
                f["pattern_type"].alias("pattern_type"),
                f["value"].alias("value"),
                f["line"].alias("line"),
                _excerpt(b["lines"], f["line"], context_lines).alias("excerpt"),
            ),
        ),
    )
    return F.when(F.size(findings) > 0, shown).otherwise(F.array().cast(f"array<{FINDING_WITH_EXCERPT}>"))


def _by_line(findings: Column, text: Column, context_lines: int) -> Column:
    """One (excerpt, findings) per line with findings. Each line of the text is held a few times at most."""
    both = F.struct(findings.alias("findings"), split_lines(text).alias("lines"))

    def opens_line(found: Column) -> Column:
        at = F.transform(
            found, lambda f, i: F.when(F.coalesce(F.get(found, i - 1)["line"] != f["line"], F.lit(True)), i)
        )
        return F.filter(at, lambda i: i.isNotNull())

    def group(b: Column, i: Column, k: Column) -> Column:
        last = F.coalesce(F.get(b["opens"], k + 1), F.size(b["findings"]))
        line = F.get(b["findings"], i)["line"]
        return F.struct(
            _excerpt(b["lines"], line, context_lines).alias("excerpt"),
            part(b["findings"], i + 1, last).alias("of_line"),
        )

    groups = let(
        both,
        lambda b: let(
            F.struct(b["findings"].alias("findings"), b["lines"].alias("lines"), opens_line(b["findings"]).alias("opens")),
            lambda c: F.transform(c["opens"], lambda i, k: group(c, i, k)),
        ),
    )
    return F.when(F.size(findings) > 0, groups)


def detect(
    files: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text: str = "text",
    context_lines: int | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``findings``, in order of occurrence; with ``context_lines`` also their excerpts.

    With ``only``, findings of other rules are left out; ``seq`` still counts all findings of the text.
    """
    out = cut_at_matches(files, rules, text, only).withColumn("findings", _findings(F.col("_pieces"), rules))
    if only is not None:
        out = out.withColumn("findings", F.filter("findings", lambda f: f["pattern_type"].isin(*only)))
    if context_lines is not None:
        out = out.withColumn("findings", with_excerpts(F.col("findings"), F.col(text), context_lines))
    return out.drop("_pieces", "_sep")


def explode_findings(detected: DataFrame, *keep: str) -> DataFrame:
    """One row per finding, with the ``keep`` columns.

    The outer form is on purpose: for the inner form the optimizer adds a filter on the array's size and moves
    it down by copying the expression, which would run the pattern twice.
    """
    return detected.select(*keep, F.inline_outer("findings")).where(F.col("seq").isNotNull())


def explode_excerpts(detected: DataFrame, *keep: str, text: str = "text", context_lines: int = 2) -> DataFrame:
    """One row per finding, with the ``keep`` columns and ``excerpt``; excerpts multiply as rows only."""
    lines = detected.select(*keep, F.inline_outer(_by_line(F.col("findings"), F.col(text), context_lines)))
    return lines.select(*keep, F.inline_outer("of_line"), "excerpt").where(F.col("seq").isNotNull())


def tokens(findings: Column) -> Column:
    """The rule names in order of occurrence."""
    return F.transform(findings, lambda f: f["pattern_type"])
