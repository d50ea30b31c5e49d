"""Actions per finding, rewritten text with a change log, and per-finding suggestions. All row by row."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.rules import CREDENTIAL, IPV4, LOG_LEVELS, NOT_FROM_ENVIRONMENT, RULES, Rule
from hazardlens.functions.text import SPACE, WORD, S, any_case, let, one_of, separator, split_lines, strip
from hazardlens.operators.detect import detect

# ---- fixed values: actions, their priority, and what each token asks for --------------------------------------
ACTION_PRIORITY = ("ENFORCE_SSL", "REWRITE_CRED", "USE_HTTPS", "REMOVE_LEAK", "FLAG_IP", "PASSTHROUGH")
PASSTHROUGH = "PASSTHROUGH"

TOKEN_ACTIONS = {
    "HARDCODED_CRED": ("REWRITE_CRED",),
    "AWS_KEY": ("REWRITE_CRED",),
    "PRINT_LEAK": ("REMOVE_LEAK",),
    "IPv4": ("FLAG_IP", "PASSTHROUGH"),
    "ENV_REF": ("PASSTHROUGH",),
    "TODO": ("PASSTHROUGH",),
    "SUSPICIOUS_URL": ("USE_HTTPS",),
    "LOG_LEAK": ("REMOVE_LEAK",),
    "INSECURE_REQUEST": ("ENFORCE_SSL",),
    "DANGEROUS_CALL": ("PASSTHROUGH",),
}

HOST_PLACEHOLDER = "<HOST_PLACEHOLDER>"
LANGUAGE = "python"
ENVIRONMENT_CALL = ('os.getenv("', '")')
AWS_VARIABLE = "AWS_ACCESS_KEY_ID"
HOST_VARIABLE = "SERVER_HOST"
TLS_ON = "verify=True"
# ---- end of fixed values --------------------------------------------------------------------------------------

REDACTION_MARKER = "# [REDACTED] sensitive output removed"

# A run of blanks before the keyword is taken from its first blank only: a search that starts inside the run can
# find nothing that the search from its start would not, and would make long runs quadratic.
_INDENT = rf"((?<!{S}){S}++|(?<!{S}))"
_CREDENTIAL_LINE = (
    rf"{_INDENT}({CREDENTIAL}{WORD}*+){S}*+={S}*+{NOT_FROM_ENVIRONMENT}"
    rf"(?:\"[^\"]*\"|'[^']*'|[^{SPACE}'\"$\{{][^{SPACE}]*)"
)
_OUTPUT_CALL = rf"{_INDENT}(?:{any_case('print')}|{any_case('logging.')}{one_of(*LOG_LEVELS)}){S}*+\([^\n]*?\)"

Rewriter = Callable[[Column, Column], Column]


def environment_name(variable: Column) -> Column:
    return F.upper(F.replace(variable, F.lit("-"), F.lit("_")))


def rewrite_cred(line: Column, sep: Column) -> Column:
    """``name = literal`` becomes ``name = os.getenv("NAME")``, wherever it occurs in the line.

    ``sep`` is a string that does not occur in the line; the name between two of them is upper-cased.
    """
    opening, closing = ENVIRONMENT_CALL
    replacement = F.concat(F.lit(f"$1$2 = {opening}"), sep, F.lit("$2"), sep, F.lit(closing))
    fenced = F.regexp_replace(line, F.lit(_CREDENTIAL_LINE), replacement)
    parts = F.transform(
        F.split(fenced, sep), lambda p, i: F.when(i % 2 == 1, environment_name(p)).otherwise(p)
    )
    return F.array_join(parts, "")


def remove_leak(line: Column, sep: Column | None = None, marker: str = REDACTION_MARKER) -> Column:
    quoted = marker.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(line, F.lit(_OUTPUT_CALL), F.lit("$1" + quoted))


def flag_ip(line: Column, sep: Column | None = None) -> Column:
    return F.regexp_replace(line, F.lit(IPV4), F.lit(HOST_PLACEHOLDER))


def use_https(line: Column, sep: Column | None = None) -> Column:
    return F.replace(line, F.lit("http://"), F.lit("https://"))


def enforce_tls(line: Column, sep: Column | None = None) -> Column:
    return F.regexp_replace(line, F.lit(rf"verify{S}*={S}*False"), F.lit(TLS_ON))


REWRITERS: dict[str, Rewriter] = {
    "ENFORCE_SSL": enforce_tls,
    "REWRITE_CRED": rewrite_cred,
    "USE_HTTPS": use_https,
    "REMOVE_LEAK": remove_leak,
    "FLAG_IP": flag_ip,
}


def pick_action(token: str, token_actions: Mapping[str, tuple[str, ...]] = TOKEN_ACTIONS) -> str:
    """The action that wins for a token."""
    offered = token_actions.get(token, ())
    return min((a for a in offered if a in ACTION_PRIORITY), key=ACTION_PRIORITY.index, default=PASSTHROUGH)


def token_actions(spark, actions: Mapping[str, tuple[str, ...]] = TOKEN_ACTIONS) -> DataFrame:
    """The pairs (token, action, priority) as a relation."""
    rows = [(t, a, ACTION_PRIORITY.index(a)) for t, offered in actions.items() for a in offered]
    return spark.createDataFrame(rows, "token string, action string, priority int")


def _code(rule_number: int) -> str:
    return chr(ord("A") + rule_number)


def _findings_per_line(findings: Column, rules: tuple[Rule, ...]) -> Column:
    """For each line up to the last with a finding, one letter per finding that starts there, in order.

    A string of as many newlines as lie between the findings and a letter per finding, cut at the newlines: the
    position of an element is its line. Linear, where looking up the findings of each line would not be.
    """
    names = F.lit([r.name for r in rules])
    codes = F.lit([_code(k) for k in range(len(rules))])

    def outline(found: Column) -> Column:
        before = F.concat(F.array(F.lit(1)), F.transform(found, lambda f: f["line"]))
        return F.zip_with(
            found,
            before,
            lambda f, previous: F.concat(
                F.repeat(F.lit("\n"), f["line"] - previous),
                F.element_at(codes, F.array_position(names, f["pattern_type"]).cast("int")),
            ),
        )

    return F.split(F.array_join(let(findings, outline), ""), "\n")


def _apply(line: Column, codes: Column, sep: Column, rules: tuple[Rule, ...], rewriters, actions) -> Column:
    """Apply the actions of the line's findings one after the other.

    A rewriter that left the line as it is need not run again until another one changes the line; so a long line
    with thousands of findings is rewritten a few times, not thousands of times.
    """
    by_action: dict[str, list[str]] = {}
    for k, rule in enumerate(rules):
        by_action.setdefault(pick_action(rule.name, actions), []).append(_code(k))

    def one(current: Column, code: Column) -> Column:
        out = F.when(F.lit(False), current)
        for action, letters in by_action.items():
            if action in rewriters:
                out = out.when(code.isin(*letters), rewriters[action](current, sep))
        return out.otherwise(current)

    def state(text: Column, settled: Column) -> Column:
        return F.struct(text.alias("line"), settled.alias("settled"))

    def step(s: Column, code: Column) -> Column:
        applied = let(
            one(s["line"], code),
            lambda new: state(
                new, F.when(new == s["line"], F.concat(s["settled"], code)).otherwise(F.lit(""))
            ),
        )
        return F.when(F.contains(s["settled"], code), s).otherwise(applied)

    return F.aggregate(F.split(codes, ""), state(line, F.lit("")), step, lambda s: s["line"])


def rewrite(
    files: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text: str = "text",
    rewriters: Mapping[str, Rewriter] = REWRITERS,
    actions: Mapping[str, tuple[str, ...]] = TOKEN_ACTIONS,
    context_lines: int | None = None,
    redaction_marker: str | None = None,
) -> DataFrame:
    """Add ``findings``, ``rewrites`` (one per changed line), ``has_changes``, ``transformed_text``, ``language``.

    A change carries the action and token of its line's first finding, even if a later one made the change.
    ``redaction_marker`` is the comment put in place of removed output.
    """
    rewriters = dict(rewriters)
    if redaction_marker is not None:
        rewriters["REMOVE_LEAK"] = partial(remove_leak, marker=redaction_marker)
    found = detect(files, rules, text, context_lines)
    names = F.lit([r.name for r in rules])
    chosen = F.lit([pick_action(r.name, actions) for r in rules])

    def rewritten(line: Column, codes: Column, sep: Column) -> Column:
        return F.when(F.length(codes) > 0, _apply(line, codes, sep, rules, rewriters, actions)).otherwise(line)

    def lines_of(row: Column) -> Column:
        return F.zip_with(
            row["lines"],
            row["codes"],
            lambda line, codes: F.struct(
                line.alias("before"),
                F.when(line.isNotNull(), rewritten(line, codes, row["sep"])).alias("after"),
                codes.alias("codes"),
            ),
        )

    row = F.struct(
        split_lines(F.col(text), keep_ends=True).alias("lines"),
        _findings_per_line(F.col("findings"), rules).alias("codes"),
        separator(F.col(text)).alias("sep"),
    )
    without_end = lambda line: F.rtrim(line, F.lit("\n"))

    numbered = F.transform(
        F.col("_lines"),
        lambda x, i: F.struct(
            (i + 1).cast("int").alias("line_number"),
            without_end(x["before"]).alias("original_line"),
            without_end(x["after"]).alias("transformed_line"),
            F.get(chosen, F.ascii(x["codes"]) - ord("A")).alias("action"),
            F.get(names, F.ascii(x["codes"]) - ord("A")).alias("token_type"),
            (x["before"] != x["after"]).alias("changed"),
        ),
    )
    rewrites = F.transform(
        F.filter(numbered, lambda x: x["changed"]),
        lambda x: F.struct(
            *(x[c].alias(c) for c in ("line_number", "original_line", "transformed_line", "action", "token_type"))
        ),
    )
    no_rewrites = F.array().cast(
        "array<struct<line_number:int,original_line:string,transformed_line:string,action:string,token_type:string>>"
    )
    out = (
        found.withColumn("_lines", F.when(F.size("findings") > 0, let(row, lines_of)))
        .withColumn("rewrites", F.coalesce(rewrites, no_rewrites))
        .withColumn(
            "transformed_text",
            F.when(
                F.size("rewrites") > 0,
                F.array_join(F.transform("_lines", lambda x: F.coalesce(x["after"], F.lit(""))), ""),
            ).otherwise(F.col(text)),
        )
        .withColumn("has_changes", F.size("rewrites") > 0)
        .withColumn("language", F.lit(LANGUAGE))
    )
    return out.drop("_lines")


def line_actions(
    detected: DataFrame,
    *keep: str,
    rules: tuple[Rule, ...] = RULES,
    actions: Mapping[str, tuple[str, ...]] = TOKEN_ACTIONS,
) -> DataFrame:
    """One row per line with findings: ``line`` and its ``actions`` in order of the findings."""
    chosen = F.lit([pick_action(r.name, actions) for r in rules])
    numbered = F.transform(
        _findings_per_line(F.col("findings"), rules),
        lambda codes, i: F.struct((i + 1).cast("int").alias("line"), codes.alias("codes")),
    )
    lines = F.transform(
        F.filter(numbered, lambda x: F.length(x["codes"]) > 0),
        lambda x: F.struct(
            x["line"].alias("line"),
            F.transform(F.split(x["codes"], ""), lambda c: F.get(chosen, F.ascii(c) - ord("A"))).alias("actions"),
        ),
    )
    return detected.select(*keep, F.inline_outer(lines)).where(F.col("line").isNotNull())


# Reason codes and texts of the suggestions; callers may pass their own.
SUGGESTION_REASONS = {
    "HARDCODED_CRED": "MOVE_CREDENTIAL_TO_ENV",
    "AWS_KEY": "MOVE_AWS_KEY_TO_ENV",
    "PRINT_LEAK": "REMOVE_SENSITIVE_OUTPUT",
    "LOG_LEAK": "REMOVE_SENSITIVE_OUTPUT",
    "IPv4": "MOVE_HOST_TO_CONFIG",
    "SUSPICIOUS_URL": "USE_HTTPS",
    "INSECURE_REQUEST": "VERIFY_CERTIFICATES",
    "DANGEROUS_CALL": "AVOID_CODE_EXECUTION",
}
REMOVED_NOTE = "# [REMOVED] sensitive output"
DANGER_NOTE = "# DANGER: "


def suggestions(
    findings_long: DataFrame,
    reasons: Mapping[str, str] = SUGGESTION_REASONS,
    removed_note: str = REMOVED_NOTE,
    danger_note: str = DANGER_NOTE,
) -> DataFrame:
    """A proposal per finding (one row per finding in, kinds without a proposal dropped)."""
    kind, value = F.col("pattern_type"), F.col("value")
    variable = strip(F.substring_index(value, "=", 1))

    def from_environment(name: Column) -> Column:
        return F.concat(F.lit(ENVIRONMENT_CALL[0]), name, F.lit(ENVIRONMENT_CALL[1]))

    after = (
        F.when(kind == "HARDCODED_CRED", F.concat(variable, F.lit(" = "), from_environment(F.upper(variable))))
        .when(kind == "AWS_KEY", from_environment(F.lit(AWS_VARIABLE)))
        .when(kind.isin("PRINT_LEAK", "LOG_LEAK"), removed_note)
        .when(kind == "IPv4", from_environment(F.lit(HOST_VARIABLE)))
        .when(kind == "SUSPICIOUS_URL", use_https(value))
        .when(kind == "INSECURE_REQUEST", TLS_ON)
        .when(kind == "DANGEROUS_CALL", F.concat(F.lit(danger_note), value))
    )
    reason = F.when(F.lit(False), "")
    for name, code in reasons.items():
        reason = reason.when(kind == name, code)
    others = [c for c in findings_long.columns if c not in ("seq", "pattern_type", "value", "line", "excerpt")]
    return findings_long.where(kind.isin(*reasons)).select(
        *others, "seq", "line", value.alias("before"), after.alias("after"), reason.alias("reason")
    )
