"""Source files from a directory tree on a mounted (shared) file system.

Spark's own file sources skip names that start with ``_`` or ``.``, so package files such as ``__init__.py``
would be lost. Listing and reading are two steps. Listing is a table of open directories that is dealt anew to all tasks
turn by turn: a task examines a bounded number of entries for each and hands on what is left, directories as such and the
names of a crowded directory in batches. So neither one deep branch nor one crowded directory becomes one task. The listed
paths are spread by hash before any content is read.
"""

from __future__ import annotations

import os
import stat
import sys
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions.text import normalize_newlines

# Ship this module's code with the job, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_BYTES = 16 << 20
MAX_FILE_BYTES = (1 << 31) - (1 << 20)  # what a binary value of a row can hold
SOURCE_EXTENSIONS = (".py",)  # fixed value: what a directory scan picks up
#: Entries that are examined for an open directory in one turn, and names of a crowded one that are handed on together.
TURN = 10_000

_TURN_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("size", pa.int64()),
        ("reason", pa.string()),
        ("names", pa.list_(pa.string())),
        ("open", pa.bool_()),
    ]
)
_TURN_COLUMNS = "path string, size bigint, reason string, names array<string>, open boolean"


def _extension(name: str) -> str:
    return os.path.splitext(name)[1]


def _reason(error: OSError) -> str:
    return "not_found" if isinstance(error, FileNotFoundError) else f"not_listed: {error.strerror}"


def _bad_name(path: str) -> bool:
    """Names are bytes; those that are no UTF-8 cannot be told in a table."""
    return not path.isprintable() and any("\udc80" <= c <= "\udcff" for c in path)


def _refused(path: str, reason: str) -> tuple:
    return path.encode(errors="surrogateescape").decode(errors="replace"), None, reason, None, False


def _file(path: str) -> Iterator[tuple]:
    """The row of a regular file or of a link to one; nothing for what is neither."""
    try:
        found = os.stat(path)  # of a link, its target
    except OSError as error:  # of this entry only: the others are still listed
        yield _refused(path, _reason(error))
    else:
        if stat.S_ISREG(found.st_mode):
            yield path, found.st_size, None, None, False


def _examine(path: str, recursive: bool, extensions: tuple[str, ...], turn: int) -> Iterator[tuple]:
    """Files below a directory, until ``turn`` entries are examined; then what is open. Memory is bounded by ``turn``."""
    pending, seen = [path], 0
    while pending:
        here = pending.pop()
        if seen >= turn:
            yield here, None, None, None, True
            continue
        held: list[str] = []
        try:
            with os.scandir(here) as entries:
                for e in entries:
                    seen += 1
                    if _bad_name(e.path):
                        yield _refused(e.path, "not_listed: name is not UTF-8")
                        continue
                    try:
                        if e.is_dir(follow_symlinks=False):
                            if recursive and seen < turn:
                                pending.append(e.path)
                            elif recursive:
                                yield e.path, None, None, None, True
                            continue
                    except OSError as error:
                        yield _refused(e.path, _reason(error))
                        continue
                    if _extension(e.name) not in extensions:
                        continue
                    if seen <= turn:
                        yield from _file(e.path)
                        continue
                    held.append(e.name)
                    if len(held) == turn:
                        yield here, None, None, held, True
                        held = []
        except OSError as error:
            yield _refused(here, _reason(error))
        if held:
            yield here, None, None, held, True


def _take_turn(recursive: bool, extensions: tuple[str, ...], turn: int):
    """One turn of the open directories and batches of names of a task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, names in zip(batch.column("path").to_pylist(), batch.column("names").to_pylist(), strict=True):
                if names is None:
                    yield from _examine(path, recursive, extensions, turn)
                else:
                    for name in names:
                        yield from _file(os.path.join(path, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for row in rows(batches):
            held.append(row)
            weight += 1 + len(row[3] or ())
            if weight >= 10_000:
                yield _turn_batch(held)
                held, weight = [], 0
        if held:
            yield _turn_batch(held)

    return run


def _turn_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _TURN_SCHEMA, strict=True)], schema=_TURN_SCHEMA)


def _shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; unset, a temporary one, which only a local session can use."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="hazardlens-")
    return f"{base}/listing-{uuid.uuid4().hex}"


def list_tree(
    spark: SparkSession,
    path: str,
    recursive: bool = False,
    extensions: tuple[str, ...] = SOURCE_EXTENSIONS,
    turn: int = TURN,
    partitions: int | None = None,
) -> DataFrame:
    """``path``, ``size``, ``reason`` (null for files that can be read).

    A file named directly is taken whatever its extension. A missing path, an unreadable directory, a dangling link and a
    name that is no UTF-8 are rows with a reason; links to directories are not followed. The tree is listed when this is
    called, in turns that are written to the folder of ``spark.checkpoint.dir``.
    """
    n = partitions or 4 * spark.sparkContext.defaultParallelism
    folder = _shared_folder(spark)
    as_name = os.path.isfile(path)
    head, tail = os.path.split(path)
    start = [(head, [tail])] if as_name else [(path, None)]
    frontier = spark.createDataFrame(start, "path string, names array<string>")
    run = _take_turn(recursive, tuple(extensions), turn)
    k = 0
    while True:
        taken = f"{folder}/turn={k}"
        frontier.repartition(n).mapInArrow(run, _TURN_COLUMNS).write.parquet(taken)
        frontier = spark.read.schema(_TURN_COLUMNS).parquet(taken).where("open").select("path", "names")
        if frontier.isEmpty():
            break
        k += 1
    return spark.read.schema(_TURN_COLUMNS).parquet(folder).where("not open").select("path", "size", "reason")


_READ_SCHEMA = pa.schema([("path", pa.string()), ("content", pa.binary()), ("reason", pa.string())])


def _content_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_READ_SCHEMA.names, r)) for r in rows], _READ_SCHEMA)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Content of the listed paths, in batches of limited size."""
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for path, reason in zip(batch.column("path").to_pylist(), batch.column("reason").to_pylist()):
            content = None
            if reason is None:
                try:
                    if os.path.getsize(path) > MAX_FILE_BYTES:
                        raise OSError(0, "larger than a row can hold")
                    if held and held + os.path.getsize(path) > BATCH_BYTES:
                        yield _content_batch(rows)
                        rows, held = [], 0
                    with open(path, "rb") as f:
                        content = f.read()
                except FileNotFoundError:
                    reason = "not_found"
                except OSError as error:
                    reason = f"not_read: {error.strerror}"
            rows.append((path, content, reason))
            held += len(content or b"")
            if held >= BATCH_BYTES:
                yield _content_batch(rows)
                rows, held = [], 0
    if rows:
        yield _content_batch(rows)


def read_listed(listing: DataFrame, partitions: int | None = None) -> DataFrame:
    """``path``, ``content``, ``reason`` of listed files."""
    n = partitions or listing.sparkSession.sparkContext.defaultParallelism * 4
    return listing.select("path", "reason").repartition(n, "path").mapInArrow(
        _read_batches, "path string, content binary, reason string"
    )


def decoded(contents: DataFrame) -> DataFrame:
    """``path``, ``ext``, ``text``, ``reason``: a row per file, with its text or the reason why there is none.

    A file that is not valid UTF-8 is rejected, and line ends become newlines, as on reading in text mode. Everything that
    is to come of files and rejected ones alike can be computed from this in one reading.
    """
    text = F.col("content").cast("string")
    reason = F.when(F.col("reason").isNotNull(), F.col("reason")).when(~F.is_valid_utf8(text), "not_utf8")
    return contents.select("path", "content", reason.alias("reason")).select(
        "path",
        F.when(F.col("reason").isNull(), F.regexp_extract("path", r"[^/.][^/]*?(\.[^./]*)$", 1)).alias("ext"),
        F.when(F.col("reason").isNull(), normalize_newlines(text)).alias("text"),
        "reason",
    )


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.where(F.col("reason").isNull()).drop("reason"), rows.where(F.col("reason").isNotNull()).select("path", "reason")


def decode(contents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split read contents into ``files`` (path, ext, text) and ``rejected`` (path, reason)."""
    return _split(decoded(contents))


def store_decoded(contents: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """``files`` and ``rejected`` as ``decode`` gives them, from one reading: it is written to ``target`` with the two kinds
    in folders of their own, and each is then read from its folder only."""
    spark, rows = contents.sparkSession, decoded(contents)
    rows.withColumn("rejected", F.col("reason").isNotNull()).write.partitionBy("rejected").parquet(target)
    kept = spark.read.schema("path string, ext string, text string, reason string, rejected boolean").parquet(target)
    return (
        kept.where(~F.col("rejected")).select("path", "ext", "text"),
        kept.where(F.col("rejected")).select("path", "reason"),
    )


def read_tree(
    spark: SparkSession,
    path: str,
    recursive: bool = False,
    extensions: tuple[str, ...] = SOURCE_EXTENSIONS,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``files`` and ``rejected_files`` under a path; a file path is read whatever its extension.

    Each reads the files when it is used; ``store_decoded`` gives both from one reading.
    """
    return decode(read_listed(list_tree(spark, path, recursive, extensions), partitions))
