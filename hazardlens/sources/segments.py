"""Texts larger than a row, as segments that no finding of the default rules reaches across.

A text is cut behind a newline. Matches go on past a newline in three ways only, and a cut is made where none is open:

- white space between two parts of a match: the part before it ends in a letter, digit or underscore, ``=``, ``(`` or
  ``#``, so the last other character before the cut must be none of these;
- a quoted credential: its opening quote follows ``=`` and no quote of that kind comes after it, so the last quote of
  either kind before the cut must not follow ``=``;
- the arguments of a log call, which end at the first closing bracket: there must be one behind the last ``logging.``.

Each is necessary for a match across the cut, so without them the findings of the segments are those of the text. What
lies before the last cut need not be looked at: nothing reaches across that one.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from hazardlens.functions.rules import RULES, Rule
from hazardlens.functions.text import SPACE, any_case, count_newlines
from hazardlens.operators.detect import detect

#: Characters of a segment, and bytes that are read of a file at a time.
SEGMENT, BLOCK = 32 << 20, 4 << 20

_CANDIDATE = re.compile(rf"[^\w=(#{SPACE}][{SPACE}]*\n")
_LEADING = re.compile(rf"[{SPACE}]*\n")
_OPENS = re.compile(rf"(?:=|\A)[{SPACE}]*\Z")
_LOG = re.compile(any_case("logging."))
#: White space before a quote that is looked through; behind more of it no cut is made.
_FAR = 4096


def _open_quote(text: str, end: int) -> int:
    """Where the last quote of either kind before ``end`` stands, if it follows ``=``; else -1."""
    for quote in "\"'":
        at = text.rfind(quote, 0, end)
        near = text[max(0, at - _FAR) : max(0, at)]
        if at >= 0 and _OPENS.search(near) and (at > _FAR or "=" in near):
            return at
    return -1


def last_cut(text: str, start: int = 0) -> int:
    """The last place from ``start`` on where ``text``, which begins at a cut, may be cut; 0 if there is none."""
    places = [m.end() for m in _CANDIDATE.finditer(text, max(0, start - 1))]
    if not start and (blank := _LEADING.match(text)):
        places.insert(0, blank.end())
    logs = [m.end() for m in _LOG.finditer(text)] if places else []
    upto = len(text)
    for end in reversed(places):
        if end > upto:  # what is open there is open here
            continue
        while logs and logs[-1] > end:
            logs.pop()
        if logs and text.find(")", logs[-1], end) < 0:
            upto = logs[-1]
        elif (at := _open_quote(text, end)) >= 0:
            upto = at
        else:
            return end
    return 0


def cut(blocks: Iterable[str], size: int = SEGMENT) -> Iterator[str]:
    """Segments of about ``size`` characters of a text that comes in blocks; longer where it cannot be cut.

    A text that could not be cut is looked at again when it has grown by half, so the time stays linear.
    """
    parts, length, least, seen = [], 0, size, 0
    for block in blocks:
        parts.append(block)
        length += len(block)
        while length >= least:
            held = "".join(parts)
            end = last_cut(held, seen)
            if end:
                yield held[:end]
                held, seen, least = held[end:], 0, size
            else:
                seen, least = length, length + 1 + length // 2
            parts, length = [held], len(held)
    if length:
        yield "".join(parts)


def _blocks(text: str, size: int) -> Iterator[str]:
    return (text[k : k + size] for k in range(0, len(text), size))


def cut_texts(files: DataFrame, *keys: str, text: str = "text", size: int = SEGMENT) -> DataFrame:
    """``keys, segment, text``: the texts of a table in segments; a null or empty text is one empty segment."""
    rows = files.select(*keys, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = StructType([*rows.schema.fields[:-1], StructField("segment", LongType()), StructField("text", StringType())])

    def run(batches):
        for batch in batches:
            for i, whole in enumerate(batch.column("text").to_pylist()):
                kept = batch.slice(i, 1).select(list(keys))
                for k, part in enumerate(cut(_blocks(whole, size), size) if whole else [""]):
                    columns = [*kept.columns, pa.array([k], pa.int64()), pa.array([part], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, [*keys, "segment", "text"])

    return rows.mapInArrow(run, schema)


def _checked(path: str) -> str | None:
    """Why a file cannot be read as text; read in blocks."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        with open(path, "rb") as source:
            while data := source.read(BLOCK):
                decoder.decode(data)
            decoder.decode(b"", final=True)
    except FileNotFoundError:
        return "not_found"
    except UnicodeDecodeError:
        return "not_utf8"
    except OSError as error:
        return f"not_read: {error.strerror}"
    return None


def _read(size: int):
    names = ["path", "segment", "text", "reason"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]

    def row(*values):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

    def run(batches):
        for batch in batches:
            for path, reason in zip(batch.column("path").to_pylist(), batch.column("reason").to_pylist(), strict=True):
                reason = reason or _checked(path)
                if reason:
                    yield row(path, None, None, reason)
                    continue
                with open(path, encoding="utf-8", newline=None) as source:
                    number = -1
                    for number, part in enumerate(cut(iter(lambda: source.read(min(BLOCK, size)), ""), size)):
                        yield row(path, number, part, None)
                    if number < 0:
                        yield row(path, 0, "", None)

    return run


def read_segments(listing: DataFrame, size: int = SEGMENT, partitions: int | None = None) -> DataFrame:
    """``path, segment, text, reason`` of listed files of any size (``path, reason``, as ``list_tree`` gives them).

    A file is read twice, once for its encoding, and never held whole; its line ends become newlines. One that cannot
    be read is a row with a reason. Segments are dealt out to all tasks for what follows.
    """
    n = partitions or listing.sparkSession.sparkContext.defaultParallelism * 4
    dealt = listing.select("path", "reason").repartition(n, "path")
    found = dealt.mapInArrow(_read(size), "path string, segment long, text string, reason string")
    return found.repartition(n, "path", "segment")


def detect_segments(segments: DataFrame, *keys: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keys, seq, pattern_type, value, line`` of the findings of the texts that ``segments`` were cut from.

    Each segment is searched on its own; what findings and newlines came before is added up over the segments of a text,
    one row per segment without its text. Only the default rules, or some of them, are known not to reach across a cut.
    """
    if not set(rules) <= set(RULES):
        raise ValueError("texts can be cut for the default rules only")
    found = detect(segments.where(F.col("segment").isNotNull()).select(*keys, "segment", "text"), rules)
    found = found.select(*keys, "segment", "findings", count_newlines(F.col("text")).cast("long").alias("newlines"))
    before = Window.partitionBy(*keys).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select(
        *keys,
        "findings",
        F.coalesce(F.sum(F.size("findings")).over(before), F.lit(0)).alias("_found"),
        F.coalesce(F.sum("newlines").over(before), F.lit(0)).alias("_lines"),
    )
    rows = carried.select(*keys, "_found", "_lines", F.inline_outer("findings")).where(F.col("seq").isNotNull())
    return rows.select(
        *keys,
        (F.col("seq") + F.col("_found")).cast("int").alias("seq"),
        "pattern_type",
        "value",
        (F.col("line") + F.col("_lines")).cast("long").alias("line"),
    )
