"""Audit of nested ``section { key = value; }`` configuration texts.

The language has one kind of bracket, so structure needs only a depth counter; pieces, offsets, depth and
section paths are computed row by row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.text import DIGIT, FIELD, WORD, count_newlines, is_blank, let, scan_array, separator

# ---- fixed values: keys that may not hold literals, and result texts ------------------------------------------
SENSITIVE_KEYS = (
    "password",
    "passwd",
    "pwd",
    "secret",
    "api_key",
    "token",
    "credential",
    "db_password",
    "api_secret",
)
EMPTY_ERROR = "Empty configuration"
EMPTY_MESSAGE = "Configuration is empty"
UNREADABLE_MESSAGE = "File not readable: "
MISSING_MESSAGE = "File not found: "
KEY_ERROR = "Sensitive key '%s' must use env var reference (${...}), got literal value instead"
SYNTAX_MESSAGE = "Syntax error at line %d, col %d"
INSECURE_MESSAGE = "Found %d insecure key(s)"
VALID_MESSAGE = "Valid configuration with %d section(s)"
# ---- end of fixed values --------------------------------------------------------------------------------------

_B = r"[ \t\n\r]*"
_ID = rf"[\p{{L}}\p{{N}}_&&[^{DIGIT}]]{WORD}*+"
# A quoted string ends at its first quote without a backslash before it; only if there is none in the rest of the
# text, at the last quote of all. What a string is does not depend on what follows it: the group is atomic, so a
# string without a semicolon behind it is never tried longer. The possessive loop keeps no state per round, so many
# escaped quotes cannot overflow the stack.
_CLOSED = {q: rf"{q}[^{q}]*+(?:(?<=\\){q}[^{q}]*+)*+{q}" for q in ("\"", "'")}
_STRING = "(?>" + "|".join(rf"{closed}|{q}(?s:.*){q}" for q, closed in _CLOSED.items()) + ")"
_VALUE = rf"\$\{{{_B}({_ID}){_B}\}}|({_STRING})|([-+]?[0-9]++(?!{WORD}))|(true|false)"
# Groups: 1 section name, 2 key, 3-6 the value kinds, 7 closing bracket, 8 everything from the first misfit on.
_PIECE = rf"({_ID}){_B}\{{|({_ID}){_B}={_B}(?:{_VALUE}){_B};|(\}})|([^ \t\n\r](?s:.*))"
# What of a misfit is still in place, outside and inside of sections; the token behind it is the one that fails.
_IN_PLACE_OUTSIDE = rf"\A(?:{_ID}{_B})?"
_IN_PLACE_INSIDE = rf"\A(?:{_ID}{_B}(?:={_B}(?:(?!(?:true|false){WORD})(?:{_VALUE}){_B})?)?)?"
_VALUE_KINDS = ("ENV_REF", "STRING", "INT", "BOOL")

PIECE = "struct<pos:int,kind:string,key:string,value_kind:string,value:string,char_offset:int>"
ENTRY = (
    "struct<pos:int,kind:string,key:string,value_kind:string,value:string,char_offset:int,"
    "depth:int,section_path:array<string>>"
)
ERROR = "struct<message:string,line:int,column:int>"


def _leading_fields(text: Column) -> Column:
    return F.length(text) - F.length(F.ltrim(text, F.lit(FIELD)))


def _unquoted(kind: Column, raw: Column) -> Column:
    return F.when(kind == "STRING", F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)


def _read_fields(fields: Column) -> Column:
    """kind, key, value kind and value of the eight fields of a piece."""

    def assign(rest: Column) -> Column:
        # rest: the value's field among four, then two more
        at = _leading_fields(rest)
        raw = F.substring(rest, at + 1, F.length(rest) - 5)
        return F.struct(F.get(F.lit(list(_VALUE_KINDS)), at).alias("value_kind"), raw.alias("raw"))

    def read(f: Column) -> Column:
        lead = _leading_fields(f)
        key = F.when(lead == 0, F.substring_index(f, FIELD, 1)).when(
            lead == 1, F.substring_index(F.substring(f, F.lit(2), F.length(f)), FIELD, 1)
        )
        rest = F.when(lead == 1, F.substring(f, F.length(key) + 3, F.length(f)))
        kind = (
            F.when(lead == 0, "OPEN").when(lead == 1, "ASSIGN").when(lead == 6, "CLOSE").otherwise("BAD")
        )
        return let(
            assign(rest),
            lambda a: F.struct(
                kind.alias("kind"),
                key.alias("key"),
                F.when(lead == 1, a["value_kind"]).alias("value_kind"),
                F.when(lead == 1, _unquoted(a["value_kind"], a["raw"])).alias("value"),
            ),
        )

    return let(fields, read)


def config_pieces(text: Column) -> Column:
    """array of pieces in order: OPEN, ASSIGN, CLOSE, and at most one BAD, which ends the list."""

    def cut(t: Column) -> Column:
        def encode(sep: Column) -> Column:
            shown = FIELD.join(f"${k}" for k in range(1, 9))
            # Each match becomes two elements: the match itself and its fields.
            return F.split(
                F.regexp_replace(
                    t, F.lit(_PIECE), F.concat(sep, F.lit("$0"), sep, F.lit(shown), sep)
                ),
                sep,
            )

        return let(separator(t), encode)

    def build(elements: Column) -> Column:
        lengths = F.transform(elements, lambda e, i: F.when(i % 3 == 2, 0).otherwise(F.length(e)))
        offsets = scan_array(lengths, F.lit(0), lambda n, more: n + more, lambda n, _: n, "int")
        placed = F.zip_with(elements, offsets, lambda e, at: F.struct(e.alias("text"), at.alias("at")))
        starts = F.filter(placed, lambda _, i: i % 3 == 1)
        fields = F.filter(elements, lambda _, i: i % 3 == 2)
        both = F.zip_with(
            starts, F.transform(fields, _read_fields), lambda s, f: F.struct(s["at"].alias("at"), f.alias("f"))
        )
        return F.transform(
            both,
            lambda x, i: F.struct(
                i.cast("int").alias("pos"),
                x["f"]["kind"].alias("kind"),
                x["f"]["key"].alias("key"),
                x["f"]["value_kind"].alias("value_kind"),
                x["f"]["value"].alias("value"),
                x["at"].alias("char_offset"),
            ),
        )

    return F.when(text.isNotNull(), let(cut(text), build)).otherwise(F.array().cast(f"array<{PIECE}>"))


def with_paths(pieces: Column) -> Column:
    """The pieces with ``depth`` (brackets open after the piece) and ``section_path`` (sections around it).

    An OPEN piece is inside its own section. Meaningful for texts with valid structure.
    """

    def push(stack: Column, p: Column) -> Column:
        return F.when(p["kind"] == "OPEN", F.concat(stack, F.array(p["key"]))).otherwise(stack)

    def step(stack: Column, p: Column) -> Column:
        return F.when(
            p["kind"] == "CLOSE", F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))
        ).otherwise(push(stack, p))

    def emit(stack: Column, p: Column) -> Column:
        inside = push(stack, p)
        depth = F.size(inside) - F.when(p["kind"] == "CLOSE", 1).otherwise(0)
        names = ("pos", "kind", "key", "value_kind", "value", "char_offset")
        return F.struct(*(p[n].alias(n) for n in names), depth.alias("depth"), inside.alias("section_path"))

    return scan_array(pieces, F.array().cast("array<string>"), step, emit, ENTRY)


def structure(pieces: Column) -> Column:
    """struct(depth, sections, bad_at, bad_depth): final depth, top-level sections, the first misplaced piece, and the
    brackets open before it.

    ``bad_at`` is null where every piece is in place; the text is well formed iff it is null, depth is 0 and
    there is a section.
    """
    zero = F.struct(
        F.lit(0).alias("depth"),
        F.lit(0).alias("sections"),
        F.lit("").alias("previous"),
        F.lit(None).cast("int").alias("bad_at"),
        F.lit(None).cast("int").alias("bad_depth"),
    )

    def step(s: Column, p: Column) -> Column:
        misplaced = (
            (p["kind"] == "BAD")
            | ((s["depth"] == 0) & (p["kind"] != "OPEN"))
            | ((s["previous"] == "OPEN") & (p["kind"] == "CLOSE"))
        )
        change = F.when(p["kind"] == "OPEN", 1).when(p["kind"] == "CLOSE", -1).otherwise(0)
        return F.struct(
            (s["depth"] + change).alias("depth"),
            (s["sections"] + F.when((p["kind"] == "OPEN") & (s["depth"] == 0), 1).otherwise(0)).alias("sections"),
            p["kind"].alias("previous"),
            F.coalesce(s["bad_at"], F.when(misplaced, p["char_offset"])).alias("bad_at"),
            F.coalesce(s["bad_depth"], F.when(misplaced, s["depth"])).alias("bad_depth"),
        )

    return F.aggregate(
        pieces,
        zero,
        step,
        lambda s: F.struct(*(s[name].alias(name) for name in ("depth", "sections", "bad_at", "bad_depth"))),
    )


def failing_token(text: Column, bad_at: Column, bad_depth: Column) -> Column:
    """Offset of the first token that cannot stand where it does, in the piece at ``bad_at``."""
    rest = F.substring(text, bad_at + 1, F.length(text))
    return bad_at + F.length(
        F.when(bad_depth == 0, F.regexp_extract(rest, _IN_PLACE_OUTSIDE, 0)).otherwise(
            F.regexp_extract(rest, _IN_PLACE_INSIDE, 0)
        )
    )


def is_insecure(piece: Column, sensitive_keys: Sequence[str] = SENSITIVE_KEYS) -> Column:
    return (
        (piece["kind"] == "ASSIGN")
        & F.lower(piece["key"]).isin(*sensitive_keys)
        & (piece["value_kind"] != "ENV_REF")
    )


def _key_error(piece: Column) -> Column:
    return F.struct(
        F.format_string(KEY_ERROR, piece["key"]).alias("message"),
        # The offset of the assignment, not a line number; kept under this name for compatibility.
        piece["char_offset"].alias("line"),
        F.lit(0).alias("column"),
    )


def _result(is_valid: Column, sections: Column, message: Column, errors: Column) -> Column:
    return F.struct(
        is_valid.alias("is_valid"),
        sections.alias("sections_found"),
        F.size(errors).alias("n_errors"),
        message.alias("message"),
        errors.cast(f"array<{ERROR}>").alias("errors"),
    )


def _one_error(message: Column, line: Column, column: Column) -> Column:
    return F.array(F.struct(message.alias("message"), line.alias("line"), column.alias("column")))


def missing_file(path: Column) -> Column:
    """The audit of a file that is not there."""
    message = F.concat(F.lit(MISSING_MESSAGE), path)
    return _result(F.lit(False), F.lit(0), message, _one_error(message, F.lit(0), F.lit(0)))


def rejected_file(path: Column, reason: Column) -> Column:
    """The audit of a file that could not be read, or not decoded."""
    message = F.concat(F.lit(UNREADABLE_MESSAGE), path, F.lit(" ("), reason, F.lit(")"))
    return _result(F.lit(False), F.lit(0), message, _one_error(message, F.lit(0), F.lit(0)))


def audit(text: Column, sensitive_keys: Sequence[str] = SENSITIVE_KEYS) -> Column:
    """struct(is_valid, sections_found, n_errors, message, errors) of one configuration text."""
    empty = _result(
        F.lit(False), F.lit(0), F.lit(EMPTY_MESSAGE), _one_error(F.lit(EMPTY_ERROR), F.lit(1), F.lit(1))
    )

    def malformed(at: Column) -> Column:
        before = F.substring(text, F.lit(1), at)

        def describe(p: Column) -> Column:
            message = F.format_string(SYNTAX_MESSAGE, p["line"], p["column"])
            return _result(F.lit(False), F.lit(0), message, _one_error(message, p["line"], p["column"]))

        return let(
            F.struct(
                (count_newlines(before) + 1).alias("line"),
                (F.length(F.substring_index(before, "\n", -1)) + 1).alias("column"),
            ),
            describe,
        )

    def well_formed(pieces: Column, sections: Column) -> Column:
        errors = F.transform(F.filter(pieces, lambda p: is_insecure(p, sensitive_keys)), _key_error)
        return let(
            errors,
            lambda e: _result(
                F.size(e) == 0,
                sections,
                F.when(F.size(e) > 0, F.format_string(INSECURE_MESSAGE, F.size(e))).otherwise(
                    F.format_string(VALID_MESSAGE, sections)
                ),
                e,
            ),
        )

    def judge(x: Column) -> Column:
        s = x["structure"]
        return (
            F.when(s["bad_at"].isNotNull(), malformed(failing_token(text, s["bad_at"], s["bad_depth"])))
            .when((s["depth"] != 0) | (s["sections"] == 0), malformed(F.length(text)))
            .otherwise(well_formed(x["pieces"], s["sections"]))
        )

    judged = let(
        config_pieces(text),
        lambda p: let(F.struct(p.alias("pieces"), structure(p).alias("structure")), judge),
    )
    return F.when(text.isNull() | is_blank(text), empty).otherwise(judged)


def config_audit(configs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """One row per configuration text."""
    return configs.select(*keep, audit(F.col(text)).alias("_a")).select(*keep, "_a.*")


def config_issues(configs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """One row per error."""
    return (
        config_audit(configs, *keep, text=text)
        .select(*keep, F.posexplode_outer("errors").alias("error_no", "_e"))
        .where(F.col("_e").isNotNull())
        .select(*keep, "error_no", "_e.*")
    )


def config_pieces_long(configs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """One row per piece."""
    return configs.select(*keep, F.inline_outer(config_pieces(F.col(text)))).where(F.col("pos").isNotNull())


def config_entries(configs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Sections and assignments of well-formed texts, in order, with depth and section path."""
    staged = configs.select(*keep, config_pieces(F.col(text)).alias("_p")).withColumn(
        "_s", structure(F.col("_p"))
    )
    ok = F.col("_s.bad_at").isNull() & (F.col("_s.depth") == 0) & (F.col("_s.sections") > 0)
    return (
        staged.select(*keep, F.inline_outer(F.when(ok, with_paths(F.col("_p")))))
        .where(F.col("kind").isin("OPEN", "ASSIGN"))
    )
