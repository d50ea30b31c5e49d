"""Tables and files in the folder that driver and executors share, and code shipped to the executors."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def new_column(df: DataFrame, name: str) -> str:
    """A name for a helper column that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release() -> None:
    """Hand memory that a task is done with back to the system: the next stage's work needs it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries do so on their own
        pass


def released(run):
    """A function of the batches of a task that releases memory when the task ends."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where it is unset and all runs in this process, as in tests, it is one temporary folder per context; on a cluster,
    whose executors could not see that, it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = getattr(sc, "_hazardlens_dir", None)
        if base is None:
            base = sc._hazardlens_dir = tempfile.mkdtemp(prefix="hazardlens-")
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/hazardlens/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: its lineage ends there."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it, on the driver or in a task."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors; once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_hazardlens_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="hazardlens-code-"), "hazardlens_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._hazardlens_shipped = True


def split_by_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose id is surely not among ``ids``, which no shuffle touches, and a written table of all the others.

    The others are about as many as ``ids`` has: a bit filter of fixed size decides, so the second part still needs a
    join. Rows without an id may be in either part.
    """
    mark = new_column(docs, "_hash_of_id")
    held = docs.sparkSession.sparkContext.broadcast(hash_filter(ids.select(F.xxhash64(id_col).alias("h")), "h", 24))

    def keep(wanted: bool):
        def run(batches):
            for batch in batches:
                hit = held.value.may_hold(batch.column(mark).to_numpy())
                yield batch.select([n for n in batch.schema.names if n != mark]).filter(pa.array(hit == wanted))

        return run

    marked = docs.withColumn(mark, F.xxhash64(id_col))
    kept, looked_at = (marked.mapInArrow(released(keep(wanted)), docs.schema) for wanted in (False, True))
    return kept, save(looked_at, "looked-at")


def thinned(rows: DataFrame, kind: str, key: str, wanted: int, seed: int) -> DataFrame:
    """About twice ``wanted`` rows of each kind, those whose key has the lowest hashes; all rows of rarer kinds.

    A bounded sample is then drawn from these, so that no task ever sorts more than a few times the sample. The kinds
    (labels, languages) are counted and their counts are collected.
    """
    counts = rows.groupBy(kind).count().collect()
    keep = F.lit(False)
    for row in counts:
        share = min(1 << 32, -(-2 * wanted * (1 << 32) // row["count"]))
        place = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 32))
        keep = keep | ((F.col(kind) == F.lit(row[kind])) & (place < F.lit(share)))
    return rows.where(keep)


class HashFilter:
    """A bit per hash value modulo 2**bits: a necessary condition for membership, of fixed size."""

    def __init__(self, packed: np.ndarray, bits: int):
        self.packed, self.bits = packed, bits

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.astype(np.uint64) & np.uint64((1 << self.bits) - 1)
        return (self.packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def hash_filter(df: DataFrame, column: str, bits: int = 24) -> HashFilter:
    """The filter of a column of 64-bit hashes.

    The bits are set on the executors; at most 2**bits / 8 bytes reach the driver, whatever the size of ``df``.
    A fuller filter lets more through, never less.
    """
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        df.where(F.col(column).isNotNull())
        .select(F.shiftright(at, 15).alias("bucket"), at.bitwiseAND(F.lit(0x7FFF)).alias("at"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
        .collect()
    )
    packed = np.zeros(max(4096, (1 << bits) // 8), dtype=np.uint8)
    for row in rows:
        part = np.frombuffer(row["bits"], dtype=np.uint8)
        packed[row["bucket"] * 4096 : row["bucket"] * 4096 + len(part)] = part
    return HashFilter(packed, bits)
