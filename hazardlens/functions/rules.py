"""The detection rules as data, and the single pattern built from them.

A rule set is a plain list, so callers can pass their own; order decides between rules that match at the same
position.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlens.functions.hints import derived, is_telling
from hazardlens.functions.text import DIGIT, FIELD, ODD_CASE, SPACE, WORD, S, any_case, let, one_of


@dataclass(frozen=True)
class Rule:
    """``pattern`` must match at least one character and hold no capturing group.

    ``starts``: lower-case literals, one of which opens every match. ``needs``: groups of lower-case literals;
    a text can match only if it holds a member of each group. ``probe``: a cheap pattern found in every text
    that can match. All three only save time; where a rule has none of them, ``with_hints`` derives them.
    """

    name: str
    pattern: str
    starts: tuple[str, ...] = ()
    needs: tuple[tuple[str, ...], ...] = ()
    probe: str = ""


# ---- fixed values: words and shapes that decide what is found -------------------------------------------------
CREDENTIAL_WORDS = ("password", "passwd", "pwd", "secret", "api[_-]?key", "token", "credential")
LEAKED_WORDS = ("password", "api[_-]?key", "token", "secret", "pwd", "credential")
ENVIRONMENT_READS = ("os.getenv", "os.environ")
LOG_LEVELS = ("info", "debug", "warning", "error")
DANGEROUS_CALLS = ("eval", "exec", "pickle.loads")
# ---- end of fixed values --------------------------------------------------------------------------------------


def _words(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join("[_-]?".join(any_case(p) for p in w.split("[_-]?")) for w in words) + ")"


CREDENTIAL = _words(CREDENTIAL_WORDS)
LEAKED = _words(LEAKED_WORDS)
ENVIRONMENT = one_of(*ENVIRONMENT_READS)
NOT_FROM_ENVIRONMENT = rf"(?!{ENVIRONMENT}|{any_case('process.env')}|\$\{{)"
BARE_FIRST = rf"[^{SPACE}'\"$\{{]"
OCTET = rf"(?:25[0-5]|2[0-4]{DIGIT}|[01]?{DIGIT}{DIGIT}?)"
IPV4 = rf"(?<!{WORD})(?:{OCTET}\.){{3}}{OCTET}(?!{WORD})"

_CREDENTIAL_HINTS = ("passw", "pwd", "secret", "api", "token", "credential")
# First three letters shared by all members of a word list.
_CREDENTIAL_STARTS = ("pas", "pwd", "sec", "api", "tok", "cre")

# Open-ended repeats stay on single characters: the JVM runs those in a loop, while a repeated group recurses
# and can overflow the stack on long input. Repeats are possessive where what follows cannot be part of them, so
# that a failed attempt is not retried shorter; a call without closing bracket is turned away at once for the
# same reason.
RULES: tuple[Rule, ...] = (
    Rule(
        "AWS_KEY",
        any_case("AKIA") + rf"[0-9a-zA-Z{''.join(ODD_CASE.values())}]{{16}}",
        starts=("aki",),
        needs=(("akia",),),
    ),
    Rule(
        "HARDCODED_CRED",
        rf"{CREDENTIAL}{S}*+={S}*+{NOT_FROM_ENVIRONMENT}"
        rf"(?:\"[^\"][^\"]+\"|'[^'][^']+'|{BARE_FIRST}[^{SPACE}][^{SPACE}]+)",
        starts=_CREDENTIAL_STARTS,
        needs=(("=",), _CREDENTIAL_HINTS),
    ),
    Rule(
        "PRINT_LEAK",
        rf"{any_case('print')}{S}*+\({S}*+(?:[fF]?[\"'][^\n]*?)?{LEAKED}{WORD}*+{S}*+\)",
        starts=("pri",),
        needs=(("(",), ("print",), _CREDENTIAL_HINTS),
    ),
    Rule("IPv4", IPV4, starts=("0",), probe=rf"{DIGIT}\.{DIGIT}"),
    Rule(
        "ENV_REF",
        rf"{ENVIRONMENT}{S}*+[\[(][\"']?{WORD}++[\"']?[\])]",
        starts=("os.",),
        needs=(("(", "["), ENVIRONMENT_READS),
    ),
    Rule("TODO", rf"#{S}*+{any_case('todo')}[^\n]*", starts=("#",), needs=(("#",), ("todo",))),
    Rule("SUSPICIOUS_URL", rf"{any_case('http://')}[^{SPACE}'\"]+", starts=("htt",), needs=(("://",), ("http://",))),
    Rule(
        "LOG_LEAK",
        rf"{any_case('logging.')}{one_of(*LOG_LEVELS)}{S}*+\((?=[^)]*+\))[^)]*{LEAKED}[^)]*+\)",
        starts=("log",),
        needs=(("(",), ("logging.",), _CREDENTIAL_HINTS),
    ),
    Rule(
        "DANGEROUS_CALL",
        rf"{one_of(*DANGEROUS_CALLS)}{S}*+\(",
        starts=("eva", "exe", "pic"),
        needs=(("(",), DANGEROUS_CALLS),
    ),
    Rule(
        "INSECURE_REQUEST",
        rf"{any_case('verify')}{S}*+={S}*+{any_case('false')}",
        starts=("ver",),
        needs=(("=",), ("verify",), ("false",)),
    ),
)


def with_hints(rules: tuple[Rule, ...]) -> tuple[Rule, ...]:
    """The rules, those without any hint with hints derived from their patterns.

    A rule whose literals are single characters, or none, is its own probe: texts without a match are passed over before
    all rules are tried on them.
    """

    def hinted(rule: Rule) -> Rule:
        if rule.starts or rule.needs or rule.probe:
            return rule
        starts, needs = derived(rule.pattern)
        return replace(rule, starts=starts, needs=needs, probe="" if is_telling(needs) else rule.pattern)

    return tuple(map(hinted, rules))


def _guard(text: Column, char: str) -> Column:
    """A string that does not occur in ``text`` and that no rule can match at its start."""
    return F.when(F.contains(text, F.lit(char)), F.concat(F.lit(char), F.sha2(text, 256), F.lit(char))).otherwise(
        F.lit(char)
    )


def _close(dead: Column, opening: str, guard: Column) -> Column:
    return F.regexp_replace(dead, F.lit(opening), F.concat(F.lit("$1"), guard))


def _without(text: Column, *parts: Column) -> Column:
    return reduce(lambda t, p: F.replace(t, p, F.lit("")), parts, text)


def _after_last(text: Column, mark: Column) -> Column:
    return F.call_function("substring_index", text, mark, F.lit(-1))


def _hush_prints(text: Column, mark: Column, guard: Column) -> Column:
    """Bar print calls whose string is followed by no leaked word with a closing bracket in its line."""
    closed = F.concat(mark, F.lit(")"), mark)
    seen = F.regexp_replace(
        text, F.lit(rf"({LEAKED}{WORD}*+)({S}*+)(\)?)"), F.concat(F.lit("$1"), mark, F.lit("$3"), mark, F.lit("$2$3"))
    )

    def line_of(line: Column) -> Column:
        dead = _after_last(line, closed)
        live = F.substring(line, F.lit(1), F.length(line) - F.length(dead))
        plain = _without(dead, F.concat(mark, mark))
        opening = rf"({any_case('print')}{S}*+\({S}*+[fF]?)(?=[\"'])"
        return F.concat(_without(live, closed, F.concat(mark, mark)), _close(plain, opening, guard))

    return F.array_join(F.transform(F.split(seen, "\n"), line_of), "\n")


def _hush_logs(text: Column, mark: Column, guard: Column) -> Column:
    """Bar log calls without a leaked word before the next closing bracket, or without such a bracket."""
    opening = rf"({any_case('logging.')}{one_of(*LOG_LEVELS)}{S}*+)(?=\()"

    def stretch(parts: Column) -> Column:
        def of(part: Column, i: Column) -> Column:
            dead = F.when(i == F.size(parts) - 1, part).otherwise(_after_last(part, mark))
            live = F.substring(part, F.lit(1), F.length(part) - F.length(dead))
            return F.concat(_without(live, mark), _close(_without(dead, mark), opening, guard))

        return F.array_join(F.transform(parts, of), ")")

    return let(F.split(F.regexp_replace(text, F.lit(LEAKED), F.concat(F.lit("$0"), mark)), r"\)"), stretch)


def hush(text: Column, lowered: Column) -> Column:
    """struct(text, guard): the text with calls barred that can be no leak but would be searched to their line's, or
    the text's, end; each by ``guard`` before its string or bracket. Nothing else can match differently, and matches
    and gaps are as before once the guard is taken out. Only texts with two calls in one stretch are looked at.
    """
    marks = F.struct(text.alias("text"), _guard(text, "\u0003").alias("mark"), _guard(text, "\u0004").alias("guard"))
    prints = F.struct(
        F.when(lowered.rlike(r"print[^\n]*print"), let(marks, lambda m: _hush_prints(m["text"], m["mark"], m["guard"])))
        .otherwise(text)
        .alias("text"),
        _guard(text, "\u0003").alias("mark"),
        _guard(text, "\u0004").alias("guard"),
        lowered.rlike(r"logging\.[^)]*logging\.").alias("logs"),
    )
    return let(
        prints,
        lambda p: F.struct(
            F.when(p["logs"], _hush_logs(p["text"], p["mark"], p["guard"])).otherwise(p["text"]).alias("text"),
            p["guard"].alias("guard"),
        ),
    )


def _gate(rules: tuple[Rule, ...]) -> str:
    """Two lookaheads that turn most positions away before the alternation is tried.

    The first is one cheap class (everything above Latin Extended is let through to the second), the second
    the exact openings.
    """
    if not all(r.starts for r in rules):
        return ""
    starts = list(dict.fromkeys(s for r in rules for s in r.starts))
    first = "".join(sorted({v for s in starts if s != "0" for v in (s[0].lower(), s[0].upper())}))
    first_class = "[" + "".join("\\" + c if not c.isalnum() else c for c in first) + r"0-9\u0100-\x{10ffff}]"
    openings = "|".join(DIGIT if s == "0" else any_case(s) for s in starts)
    return f"(?={first_class})(?={openings})"


def master_pattern(rules: tuple[Rule, ...] = RULES) -> str:
    """One pattern for all rules; group k is rule k."""
    return _gate(rules) + "(?:" + "|".join(f"({r.pattern})" for r in rules) + ")"


def master_replacement(sep: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Replacement that fences a match with ``sep`` and shows the rule by the number of leading FIELDs."""
    groups = FIELD.join(f"${k}" for k in range(1, len(rules) + 1))
    return F.concat(sep, F.lit(groups), sep)


def may_match(text: Column, lowered: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """False only where no rule can match; ``lowered`` is ``lower(text)``.

    Plain substring search is many times cheaper than the pattern. Groups without letters are looked up first
    and in the raw text. Letters that lower-casing does not map to ASCII make the text a candidate.
    """

    def holds(literal: str) -> Column:
        return F.contains(lowered if any(c.isalpha() for c in literal) else text, F.lit(literal))

    def any_of(tests: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, tests)

    tests = [any_of([F.contains(text, F.lit(c)) for c in ODD_CASE["i"] + ODD_CASE["s"]])]
    for rule in rules:
        if rule.probe:
            tests.append(text.rlike(rule.probe))
        elif rule.needs:
            groups = sorted(rule.needs, key=lambda g: any(c.isalpha() for w in g for c in w))
            tests.append(reduce(lambda a, b: a & b, [any_of([holds(w) for w in g]) for g in groups]))
        else:
            return F.lit(True)
    return any_of(tests)
