"""Secret scans in DataFrame functions only.

Three patterns find assignments, access keys and hexadecimal strings. Besides, every long run of key characters is a
candidate: for each character class, its longest runs of the class's characters are cut out, so that a key is found
beside its name and whatever separates the two. A window slides over a run while the counts of the characters in the
window are kept up to date, one character in and one out, and with them the Shannon entropy. A candidate with a run of
which some window reaches the class's threshold is a secret, unless the allow-list knows that run.

Everything is row-local: no shuffle, no Python on the executors. Work is linear in the text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.text import let, scan_array

FENCE, OTHER = "\u0001", "\u0002"

_ASSIGN = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_KEYWORD = "(?:[pP](?i:assword|asswd)|[sS](?i:ecret)|[tT](?i:oken)|[aA](?i:pi_?key))"


@dataclass(frozen=True)
class CharacterClass:
    """An alphabet (upper case is folded where ``fold``), what a run must hold, and the entropy that tells.

    ``runs`` are the characters that runs are made of, each cut out on its own; without any the candidate is the run.
    What ``apart`` matches is no part of a run.
    """

    name: str
    alphabet: str
    fold: bool
    covers: str
    least_bits: float
    runs: tuple[str, ...] = ()
    apart: str = ""


_UUID = r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_MIXED = "(?:[0-9][A-Za-z]|[A-Za-z][0-9])"

#: Tried in this order. Runs of letters alone belong to none: they are words.
CLASSES = (
    CharacterClass(
        "hex",
        "0123456789abcdef",
        True,
        r"\A(?=.*[0-9])(?=.*[A-Fa-f])(?:[0-9a-f]+|[0-9A-F]+)\z",
        3.0,
        ("[0-9a-f]", "[0-9A-F]"),
    ),
    CharacterClass(
        "base36",
        "0123456789abcdefghijklmnopqrstuvwxyz",
        True,
        r"\A(?=.*[0-9].*[0-9])(?=.*[A-Za-z])(?:[0-9a-z]+|[0-9A-Z]+)\z",
        3.6,
        ("[0-9a-z]", "[0-9A-Z]"),
    ),
    # One case with separators: letters and digits meet in three places at least, unlike in dates and titles.
    CharacterClass(
        "separated",
        "0123456789abcdefghijklmnopqrstuvwxyz+/_-",
        True,
        rf"\A(?=.*{_MIXED}.*{_MIXED}.*{_MIXED})(?:[0-9a-z+/_-]+|[0-9A-Z+/_-]+)\z",
        3.9,
        ("[0-9a-z+/_-]", "[0-9A-Z+/_-]"),
        rf"(?<![0-9A-Za-z]){_UUID}(?![0-9A-Za-z])",
    ),
    CharacterClass(
        "base64",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-",
        False,
        r"\A(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/=_-]+\z",
        3.9,
        ("[A-Za-z0-9+/=_-]", "[A-Za-z0-9+/_-]", "[A-Za-z0-9+]"),
    ),
)

#: Runs that are no secrets: UUIDs, runs of alphabet and digits in order, marked examples, paths of plain words.
#: No group is repeated, as that would take stack for each time.
ALLOWED = (
    rf"\A{_UUID}\z",
    r"(?i)0123456789abcdef|abcdefghijklmnop|1234567890123",
    r"(?i)example|placeholder|changeme|your[_-]|xxxx",
    r"\A(?![_-])(?!.*[/_-][/_-])(?!.*[A-Za-z][0-9])(?!.*[0-9][A-Za-z])(?!.*[0-9]{5})[A-Za-z0-9/_-]*[A-Za-z0-9]/?\z",
)
WINDOW = 20
_CANDIDATE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{%d,}+"


def _spans(text: Column, may: Column, pattern: str, order: int, kind: str, keep) -> Column:
    """``start, order, kind, end`` of the matches of ``pattern`` that ``keep`` accepts, in code points.

    The pattern fences every match with a character that the text does not hold; the lengths of what lies between
    fences, summed up, are the places.
    """

    def located(pieces: Column) -> Column:
        lengths = F.transform(pieces, F.length)
        return let(
            scan_array(lengths, F.lit(0), lambda at, n: at + n, lambda at, _: at, "int"),
            lambda at: F.transform(
                F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)),
                lambda j: F.struct(
                    F.get(at, j).alias("start"),
                    F.lit(order).alias("order"),
                    F.lit(kind).alias("kind"),
                    (F.get(at, j) + F.length(F.get(pieces, j))).alias("end"),
                    F.get(pieces, j).alias("found"),
                ),
            ),
        )

    def bare(found: Column) -> Column:
        return F.transform(
            F.filter(found, lambda x: keep(x["found"])), lambda x: F.struct(x["start"], x["order"], x["kind"], x["end"])
        )

    nothing = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    fenced = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{FENCE}$0{FENCE}")), FENCE)
    return F.when(may, let(fenced, lambda p: F.when(F.size(p) > 2, bare(located(p))).otherwise(nothing))).otherwise(
        nothing
    )


def window_entropy(candidate: Column, kind: CharacterClass, window: int) -> Column:
    """The highest Shannon entropy, in bits, of ``window`` successive characters.

    The sum of c * log2(c) over the counts c in the window changes with two counts only at each step.
    """
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    text = F.lower(candidate) if kind.fold else candidate
    places = F.transform(F.split(text, ""), lambda ch: F.position(ch, F.lit(kind.alphabet)))

    def fold(at: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            new, old = F.get(at, i), F.coalesce(F.get(at, i - window), F.lit(0))
            n, o = F.element_at(state["counts"], new), F.element_at(state["counts"], F.greatest(old, F.lit(1)))
            gone = F.when(old > 0, F.get(weight, o - 1) - F.get(weight, o)).otherwise(0.0)
            total = F.when(new == old, state["total"]).otherwise(
                state["total"] + F.get(weight, n + 1) - F.get(weight, n) + gone
            )
            counts = F.transform(
                state["counts"], lambda c, j: c + (j + 1 == new).cast("int") - (j + 1 == old).cast("int")
            )
            # The outgoing character may be the incoming one; the counts are then unchanged.
            best = F.when(i >= window - 1, F.greatest(state["best"], math.log2(window) - total / window))
            return F.struct(
                counts.alias("counts"), total.alias("total"), F.coalesce(best, state["best"]).alias("best")
            )

        begin = F.struct(
            F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
            F.lit(0.0).alias("total"),
            F.lit(0.0).alias("best"),
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), begin, step, lambda s: s["best"])

    return let(places, fold)


def _tells(window: int, classes, allowed):
    def unknown(run: Column) -> Column:
        known = F.lit(False)
        for pattern in allowed:
            known = known | run.rlike(pattern)
        return ~known

    def tells(found: Column, kind: CharacterClass) -> Column:
        """Whether a run of the class's characters, at least a window long, is a secret."""
        text = F.regexp_replace(found, F.lit(kind.apart), F.lit(" ")) if kind.apart else found
        runs = [F.regexp_extract_all(text, F.lit(f"{r}{{{window},}}+"), F.lit(0)) for r in kind.runs]
        runs = F.array_distinct(F.concat(*runs)) if runs else F.array(text)
        return F.exists(
            F.filter(runs, lambda run: run.rlike(kind.covers) & unknown(run)),
            lambda run: window_entropy(run, kind, window) >= kind.least_bits,
        )

    def keep(found: Column) -> Column:
        high = F.lit(False)
        for kind in reversed(classes):
            high = F.when(tells(found, kind), True).otherwise(high)
        return high

    return keep


def find_secrets(text: Column, window: int = WINDOW, classes=CLASSES, allowed=ALLOWED) -> Column:
    """``array<struct<start, order, kind, end>>`` of the secrets of a text, by start, then kind; null is empty."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit(FENCE), F.lit(OTHER))
    candidate = _CANDIDATE % window
    value = rf"(?i:(password|passwd|secret|token|api_?key)){_ASSIGN}"

    def scanned(t: Column) -> Column:
        return F.array_sort(
            F.concat(
                _spans(
                    t,
                    t.rlike(rf"""{_KEYWORD}["']?\x20*[:=]"""),
                    _KEYWORD + _ASSIGN.replace("(", "(?:"),
                    0,
                    "assign",
                    lambda m: F.length(F.regexp_extract(m, value, 2)) >= 12,
                ),
                _spans(t, F.contains(t, F.lit("AKIA")), "AKIA[A-Z0-9]++", 1, "access", lambda m: F.length(m) >= 18),
                _spans(t, t.rlike("[0-9a-f]{16}"), "[0-9a-f]{16,}+", 2, "hex", lambda m: F.lit(True)),
                _spans(t, t.rlike(candidate), candidate, 3, "entropy", _tells(window, classes, allowed)),
            )
        )

    return let(text, scanned)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy`` per row.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. A null or empty text has none.
    Rows that repeat an id, or have none, are scanned as rows of their own. An empty table gives no rows. Other
    columns are not looked at.
    """
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), find_secrets(F.col(text_col), **options).alias("found")
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["order"] < 3)
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        count("entropy"),
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """The same rows and columns, with every secret of the text, overlapping ones together, replaced by ``mark``.

    A null text stays null, an empty one empty; every row stays, also those that repeat an id. An empty table gives no
    rows. Other columns are kept as they are.
    """
    block = 4096

    def merged(spans: Column) -> Column:
        """Overlapping spans as one; touching ones stay apart."""
        kind = "array<struct<start:int,end:int>>"
        state = F.struct(F.array().cast(kind).alias("done"), F.lit(-1).alias("start"), F.lit(-1).alias("end"))

        def closed(s: Column) -> Column:
            open_span = F.struct(s["start"].alias("start"), s["end"].alias("end"))
            return F.when(s["start"] < 0, s["done"]).otherwise(F.concat(s["done"], F.array(open_span)))

        def step(s: Column, x: Column) -> Column:
            over = x["start"] < s["end"]
            return F.struct(
                F.when(over, s["done"]).otherwise(closed(s)).alias("done"),
                F.when(over, s["start"]).otherwise(x["start"]).alias("start"),
                F.when(over, F.greatest(s["end"], x["end"])).otherwise(x["end"]).alias("end"),
            )

        return F.aggregate(spans, state, step, closed)

    def part(blocks: Column, start: Column, end: Column) -> Column:
        """Code points ``start`` to ``end``, from the blocks that hold them."""
        first, last = F.floor(start / block).cast("int"), F.floor((end - 1) / block).cast("int")
        pieces = F.transform(
            F.sequence(first, last),
            lambda b: F.substr(
                F.get(blocks, b),
                F.greatest(start - b * block, F.lit(0)) + 1,
                F.least(end, (b + 1) * block) - F.greatest(start, b * block),
            ),
        )
        return F.when(end > start, F.array_join(pieces, "")).otherwise("")

    def replaced(text: Column, spans: Column) -> Column:
        return let(
            F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), 0).alias("blocks"), spans.alias("spans")),
            lambda x: F.array_join(
                F.transform(
                    F.sequence(F.lit(0), F.size(x["spans"])),
                    lambda j: part(
                        x["blocks"],
                        F.coalesce(F.get(x["spans"], j - 1)["end"], F.lit(0)),
                        F.coalesce(F.get(x["spans"], j)["start"], F.length(text)),
                    ),
                ),
                mark,
            ),
        )

    text = F.col(text_col)
    return docs.withColumn(
        text_col,
        let(
            find_secrets(text, **options),
            lambda found: F.when(F.size(found) > 0, replaced(text, merged(found))).otherwise(text),
        ),
    )
