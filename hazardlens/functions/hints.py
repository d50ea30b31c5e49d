"""What a text must hold so that a pattern can match it, read off the pattern.

A pattern is read once, on the driver, into literals every match contains and literals one of which opens every match.
Both are necessary conditions only: what is not understood counts as "anything", and a pattern with syntax that is not
known here gets no literals at all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import product

#: Sets of literals above this number of members are not multiplied further.
MOST = 64
#: A literal that opens a match is looked at this far; a digit of any kind is written as ``_DIGIT``.
OPENING = 3
_DIGIT = "\0"
_QUANTIFIER = re.compile(r"(?:([*+?])|\{(\d+)(,(\d*))?\})[+?]?")
_GROUP = re.compile(r"\(\?(?::|>|=|!|<=|<!|<[A-Za-z]\w*>|[ismu]+\)|[ismu]+:)|\((?!\?)")
_DIGITS = (r"\d", r"\p{Nd}", "[0-9]", r"[\p{Nd}]", r"[\d]")
_CODE = re.compile(r"\\(?:[pP]\{\w+\}|[pP]\w|x\{[0-9a-fA-F]+\}|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|k<\w+>|[1-9]\d?|[dDwWsShHvVRXtnrfae])")


class Unknown(ValueError):
    """Syntax that is not read here."""


@dataclass(frozen=True)
class Part:
    """A piece of a pattern: the only strings it matches, where they are few; sets one member of which a match holds;
    strings one of which opens it, where it cannot be empty. All in lower case."""

    exact: frozenset[str] | None = None
    needs: tuple[frozenset[str], ...] = ()
    starts: frozenset[str] | None = None

    def all_needs(self) -> tuple[frozenset[str], ...]:
        return self.needs if self.exact is None else ((self.exact,) if "" not in self.exact else ())

    def opening(self) -> frozenset[str] | None:
        return self.starts if self.exact is None else (self.exact if "" not in self.exact else None)


ANYTHING = Part()
NOTHING = Part(frozenset([""]))


def _in_a_row(parts: list[Part]) -> Part:
    run, needs, starts, opened = frozenset([""]), [], None, False
    for p in parts:
        if p.exact is not None and len(run) * len(p.exact) <= MOST:
            run = frozenset(a + b for a, b in product(run, p.exact))
            continue
        if not opened:
            more = p.opening()
            starts = frozenset(a + b[:OPENING] for a in run for b in more) if more else (None if "" in run else run)
            opened = True
        needs += ([run] if "" not in run else []) + list(p.needs)
        run = p.exact or frozenset([""])
    if not opened:
        return Part(run)
    return Part(None, (*needs, *([run] if "" not in run else [])), starts)


def _strength(need: frozenset[str]) -> tuple[int, int]:
    return min(map(len, need)), -len(need)


def _one_of(parts: list[Part]) -> Part:
    if len(parts) == 1:
        return parts[0]
    if all(p.exact is not None for p in parts):
        union = frozenset().union(*(p.exact for p in parts))
        if len(union) <= MOST:
            return Part(union)
    needs, openings = [p.all_needs() for p in parts], [p.opening() for p in parts]
    union = frozenset().union(*(max(n, key=_strength) for n in needs)) if all(needs) else frozenset()
    return Part(
        None,
        (union,) if 0 < len(union) <= MOST else (),
        frozenset().union(*openings) if all(openings) else None,
    )


def _repeated(part: Part, least: int, most: int | None) -> Part:
    if least == 0:
        return Part(part.exact | {""}) if most == 1 and part.exact is not None else ANYTHING
    if least == most and least <= OPENING:
        return _in_a_row([part] * least)
    return Part(None, part.all_needs(), part.opening())


def _letter(char: str) -> Part:
    return Part(frozenset([char.lower()])) if "\x20" <= char <= "\x7e" else ANYTHING


class _Reader:
    def __init__(self, pattern: str) -> None:
        self.pattern, self.at = pattern, 0

    def take(self, found: re.Match | None) -> str | None:
        if found:
            self.at = found.end()
            return found.group()
        return None

    def options(self) -> Part:
        branches = [[]]
        while self.at < len(self.pattern) and self.pattern[self.at] != ")":
            if self.pattern[self.at] == "|":
                self.at += 1
                branches.append([])
            else:
                branches[-1].append(self.repeated())
        return _one_of([_in_a_row(b) for b in branches])

    def repeated(self) -> Part:
        part = self.atom()
        found = _QUANTIFIER.match(self.pattern, self.at)
        if self.take(found):
            sign, low, upto, high = found.groups()
            least = int(low) if low else (1 if sign == "+" else 0)
            most = (1 if sign == "?" else None) if sign else (int(high) if high else None) if upto else least
            part = _repeated(part, least, most)
        return part

    def atom(self) -> Part:
        char = self.pattern[self.at]
        if char == "(":
            return self.group()
        if char == "[":
            return self.char_class()
        if char == "\\":
            return self.escape()
        if char in "*+?{":
            raise Unknown(f"{char} at {self.at}")
        self.at += 1
        return ANYTHING if char == "." else NOTHING if char in "^$" else _letter(char)

    def group(self) -> Part:
        opening = self.take(_GROUP.match(self.pattern, self.at))
        if opening is None:
            raise Unknown(f"group at {self.at}")
        if opening.endswith(")"):
            return NOTHING
        inside = self.options()
        if self.at >= len(self.pattern):
            raise Unknown("open group")
        self.at += 1
        return NOTHING if opening in ("(?=", "(?!", "(?<=", "(?<!") else inside

    def char_class(self) -> Part:
        start, depth = self.at, 0
        while True:
            if self.at >= len(self.pattern) or self.pattern.startswith(("[]", "[^]", r"\Q"), self.at):
                raise Unknown(f"class at {start}")
            char = self.pattern[self.at]
            depth += (char == "[") - (char == "]")
            self.at += 2 if char == "\\" else 1
            if not depth:
                break
        whole = self.pattern[start : self.at]
        inside = whole[1:-1]
        if whole in _DIGITS:
            return Part(None, (), frozenset([_DIGIT]))
        members = re.sub(r"\\([^A-Za-z0-9])", r"\1", inside)
        if inside.startswith("^") or re.search(r"[\[\]]|&&|\\[A-Za-z0-9]|(?<!^)-(?!$)", inside):
            return ANYTHING
        # Letters beyond ASCII that some rules list beside i, k and s: texts with them are looked at in any case.
        letters = {c.lower() for c in members if c not in "\u0130\u0131\u212a\u017f"}
        odd = {"\u0130": "i", "\u0131": "i", "\u212a": "k", "\u017f": "s"}
        letters |= {odd[c] for c in members if c in odd}
        return Part(frozenset(letters)) if all("\x20" <= c <= "\x7e" for c in letters) else ANYTHING

    def escape(self) -> Part:
        after = self.pattern[self.at + 1 : self.at + 2]
        if after and not after.isalnum():
            self.at += 2
            return _letter(after)
        if after and after in "bBAzZG":
            self.at += 2
            return NOTHING
        code = self.take(_CODE.match(self.pattern, self.at))
        if code is None:
            raise Unknown(f"escape at {self.at}")
        return Part(None, (), frozenset([_DIGIT])) if code in _DIGITS else ANYTHING


def read(pattern: str) -> Part:
    reader = _Reader(pattern)
    part = reader.options()
    if reader.at < len(pattern):
        raise Unknown(f"{pattern[reader.at]} at {reader.at}")
    return part


@lru_cache(maxsize=1024)
def derived(pattern: str) -> tuple[tuple[str, ...], tuple[tuple[str, ...], ...]]:
    """Literals one of which opens every match, and groups of literals one of each of which every match holds."""
    try:
        part = read(pattern)
    except (Unknown, RecursionError):
        return (), ()
    needs = dict.fromkeys(tuple(sorted(n)) for n in part.all_needs())
    cut = (s.partition(_DIGIT) for s in part.opening() or ())
    openings = {before[:OPENING] or "0" for before, _, _ in cut}
    return tuple(sorted(openings)), tuple(sorted(needs, key=lambda n: _strength(frozenset(n)), reverse=True))


def is_telling(needs: tuple[tuple[str, ...], ...]) -> bool:
    """Whether plain search for these literals passes over most texts."""
    return any(reduce(min, map(len, n)) > 1 for n in needs)
