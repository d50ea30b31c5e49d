"""Column helpers for whole-text work: Unicode classes, line cutting, linear array scans.

Everything here builds Spark columns; no Python runs on the executors.

Patterns spell their character classes out instead of using regex flags, so that a pattern means the same on
every JDK (the meaning of ``\\b``, ``\\w`` and case folding outside ASCII differs between releases and flags).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Body of a character class holding every character that counts as white space.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
S = f"[{SPACE}]"
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"

# Characters that end a line besides the newline; CR LF together is one line end.
RARE_LINE_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# Letters outside ASCII that equal an ASCII letter when case is ignored.
ODD_CASE = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}

MARK = "\u0001"
FIELD = "\u0002"


def any_case(literal: str) -> str:
    """A pattern for ``literal`` in any mix of upper and lower case."""
    out = []
    for ch in literal:
        if ch.isalpha():
            out.append(f"[{ch.lower()}{ch.upper()}{ODD_CASE.get(ch.lower(), '')}]")
        else:
            out.append(ch if ch.isalnum() or ch == "_" else "\\" + ch)
    return "".join(out)


def one_of(*literals: str) -> str:
    return "(?:" + "|".join(any_case(w) for w in literals) + ")"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it.

    Without this, the optimizer may move the expression behind ``value`` into a lambda and run it per element.
    The result is copied, so this is not for the accumulator of a fold.
    """
    return F.transform(F.array(value), body)[0]


def separator(text: Column) -> Column:
    """A string that does not occur in ``text`` and cannot be formed across its own edges.

    One control character normally; where the text already holds that character, the text's digest in control
    characters.
    """
    return F.when(F.contains(text, F.lit(MARK)), F.concat(F.lit(MARK), F.sha2(text, 256), F.lit(FIELD))).otherwise(
        F.lit(MARK)
    )


def count_newlines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def strip(text: Column) -> Column:
    """Remove all white space at both ends; ``trim`` removes blanks only."""
    return F.regexp_replace(text, F.lit(rf"\A{S}+|{S}+\z"), F.lit(""))


def normalize_newlines(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"\r\n?"), F.lit("\n"))


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{SPACE}]")


def _drop_empty_last(parts: Column) -> Column:
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def _has_rare_line_end(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in RARE_LINE_ENDS])


def split_lines(text: Column, keep_ends: bool = False) -> Column:
    """The lines of ``text``; a final line end opens no further line.

    Texts with newlines only, nearly all, are cut by plain search; the pattern for every kind of line end looks
    at each character.
    """
    rare = f"[{''.join(RARE_LINE_ENDS)}]".replace("\r", "")
    if keep_ends:
        simple = let(
            F.split(text, "\n"),
            lambda parts: F.transform(
                parts, lambda p, i: F.when(i < F.size(parts) - 1, F.concat(p, F.lit("\n"))).otherwise(p)
            ),
        )
        cut = f"(?<={rare[:-1]}\n])|(?<=\r)(?!\n)"
    else:
        simple = F.split(text, "\n")
        cut = f"\r\n|{rare[:-1]}\n\r]"
    return let(F.when(_has_rare_line_end(text), F.split(text, cut)).otherwise(simple), _drop_empty_last)


def part(items: Column, first: Column, last: Column) -> Column:
    """Elements ``first`` to ``last`` (1-based, both included, first <= last) of an array that is at hand.

    Unlike ``slice``, which copies the whole array each time, this costs only what it returns.
    """
    return F.transform(F.sequence(first, last), lambda k: F.get(items, k - 1))


def scan_array(
    items: Column,
    zero: Column,
    step: Callable[[Column, Column], Column],
    emit: Callable[[Column, Column], Column],
    emitted_type: str,
    block: int = 128,
) -> Column:
    """One emitted value per item, each from the state left by the items before it.

    ``step(state, item)`` gives the next state; ``emit(state, item)`` sees the state before the item. Results
    are collected block by block: appending to one growing array would copy it once per item.
    """

    def fold_block(state: Column, some: Column) -> Column:
        return F.aggregate(
            some,
            F.struct(state.alias("state"), F.array().cast(f"array<{emitted_type}>").alias("out")),
            lambda acc, x: F.struct(
                step(acc["state"], x).alias("state"),
                F.concat(acc["out"], F.array(emit(acc["state"], x).cast(emitted_type))).alias("out"),
            ),
        )

    def over(all_items: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_items), F.lit(block))
        nothing = F.struct(zero.alias("state"), F.array().cast(f"array<{emitted_type}>").alias("out"))
        # One (state, out) per block; the last one's state opens the next block.
        return F.aggregate(
            starts,
            F.array(nothing),
            lambda done, start: F.concat(
                done,
                F.array(
                    fold_block(
                        F.element_at(done, -1)["state"],
                        part(all_items, start, F.least(start + (block - 1), F.size(all_items))),
                    )
                ),
            ),
            lambda done: F.flatten(F.transform(done, lambda d: d["out"])),
        )

    return let(
        items,
        lambda a: F.when(F.size(a) > 0, over(a)).otherwise(F.array().cast(f"array<{emitted_type}>")),
    )
