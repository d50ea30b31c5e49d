"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

1.  One pass over all texts counts shingles that are frequent in a part of the input; their sums give a list of the
    most frequent ones, of bounded length. It only sets an order in which shingles are looked at: rare before
    frequent, ties by hash. Any order gives the same result.
2.  A second pass writes per text the size of its shingle set, a class id (texts with equal sets share it), a parity
    bitmap of about one to two bits per shingle, and the first shingles in that order, as many as two linked sets
    must have one of in common.
3.  Classes meet on those shingles. The classes that hold one shingle are a run; runs of the same classes are taken
    once (they are known by a hash of their members; runs that share one by chance are looked at as one, which loses
    nothing). A run, ordered by set size, is cut into bands of bounded length, and pairs of bands make up the tiles.
    In a tile a pair can only be linked if the bits in which their bitmaps
    differ, a lower bound for the elements that only one of them has, are few enough. Only a star per component of
    the remaining pairs leaves a tile.
4.  The components of these pairs hold all possible links. Their texts' sets are read once more, cut into tiles of
    bounded size, and each pair not yet connected in its tile is checked by bitmap and then by exact intersection.
    The components of the exact links are the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hazardlens.llm import words as wd
from hazardlens.llm.components import connected_components
from hazardlens.llm.storage import hash_filter, new_column, released, save, ship, split_by_ids

#: Most entries of the list of frequent shingles, and the shingles of a text part counted at once.
FREQUENT, COUNTED = 1 << 19, 1 << 22
#: Least count in one part for a shingle to be reported at all.
REPORTED = 8
#: Members of a band of a shingle's run, and of a block of possible links.
BAND, PART = 512, 128


def shingle_sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``size`` make one shingle, none an empty set."""
    words, first = wd.word_hashes(batch.column("text"), wd.BLANK_SEPARATED)
    all_shingles = wd.combine(words, size)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            yield np.unique(all_shingles[a : b - size + 1])
        elif b > a:
            yield wd.combine(words[a:b], int(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _count_parts(size: int):
    def run(batches):
        held, count = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            keep = counts >= REPORTED
            total = np.zeros(int(keep.sum()) + 1, dtype=np.int64)
            total[-1] = counts.sum()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(values[keep], np.uint64(0)).view(np.int64)),
                    pa.array(np.append(counts[keep], 0)),
                    pa.array(total),
                ],
                ["shingle", "n", "total"],
            )

        for batch in batches:
            for part in wd.slices(batch):
                words, first = wd.word_hashes(part.column("text"), wd.BLANK_SEPARATED)
                found = wd.combine(words, size)
                inside = np.zeros(len(words) + 1, dtype=bool)
                for a, b in zip(first[:-1], first[1:], strict=True):
                    inside[a : max(a, b - size + 1)] = True
                held.append(found[inside[: len(found)]])
                count += len(held[-1])
                if count >= COUNTED:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    return run


def frequent_shingles(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted by hash, and their counts: at most ``FREQUENT``, whatever the input.

    A shingle is taken if it makes up more than a ``FREQUENT``-th of all shingles, so there are at most that many.
    """
    counted = save(docs.mapInArrow(released(_count_parts(size)), "shingle long, n long, total long"), "counts")
    total = counted.agg(F.sum("total")).first()[0] or 0
    least = max(16, total // FREQUENT + 1)
    rows = (
        counted.where("n > 0").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()
    )
    order = np.argsort(rows["shingle"].to_numpy(np.int64).view(np.uint64))
    return (
        rows["shingle"].to_numpy(np.int64).view(np.uint64)[order],
        rows["n"].to_numpy(np.int64)[order],
    )


def class_id(shingles: np.ndarray) -> int:
    """A 64-bit id of a shingle set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the number of shingles on each of 2**k bits, at least 64 and at least one per shingle."""
    bits = 1 << max(6, int(len(shingles) - 1).bit_length())
    at = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _sketches(size: int, num: int, den: int, frequent):
    def run(batches):
        hot, hot_counts = frequent.value
        for batch in batches:
            for part in wd.slices(batch):
                n, ids, bits, first = [], [], [], []
                for s in shingle_sets(part, size):
                    n.append(len(s))
                    if not len(s):
                        ids.append(None), bits.append(None), first.append(None)
                        continue
                    wanted = len(s) - (num * len(s) + den - 1) // den + 1
                    at = np.minimum(np.searchsorted(hot, s), max(0, len(hot) - 1))
                    is_hot = hot[at] == s if len(hot) else np.zeros(len(s), dtype=bool)
                    chosen = s[~is_hot][:wanted]
                    if len(chosen) < wanted:
                        rest, counts = s[is_hot], hot_counts[at[is_hot]]
                        chosen = np.append(chosen, rest[np.lexsort((rest, counts))][: wanted - len(chosen)])
                    ids.append(class_id(s)), bits.append(bitmap(s)), first.append(chosen.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(n, pa.int64()),
                        pa.array(ids, pa.int64()),
                        pa.array(bits, pa.binary()),
                        pa.array(first, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "cls", "bits", "first"],
                )

    return run


def _sets(size: int, wanted):
    """The shingle sets of texts whose class may be among the wanted ones, one row per class and part."""

    def run(batches):
        for batch in batches:
            for part in wd.slices(batch):
                found: dict[int, np.ndarray] = {}
                for s in shingle_sets(part, size):
                    if len(s):
                        found.setdefault(class_id(s), s)
                ids = np.fromiter(found, dtype=np.int64, count=len(found))
                keep = wanted.value.may_hold(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[keep]),
                        pa.array([found[i].tobytes() for i in ids[keep].tolist()], pa.binary()),
                    ],
                    ["cls", "shingles"],
                )

    return run


class Member:
    """A class in a tile: id, set size, bitmap as an integer and its length, and the set where it is at hand."""

    __slots__ = ("bits", "cls", "n", "shingles", "width")

    def __init__(self, cls: int, n: int, bits: bytes, shingles: np.ndarray | None = None):
        self.cls, self.n, self.shingles = cls, n, shingles
        self.width, self.bits = 8 * len(bits), int.from_bytes(bits, "little")

    def folded(self, width: int) -> int:
        bits, have = self.bits, self.width
        while have > width:
            have //= 2
            bits = (bits >> have) ^ (bits & ((1 << have) - 1))
        return bits


def linked(x: Member, y: Member, num: int, den: int) -> bool:
    """By size and bitmaps whether the two may be linked; exactly, where both sets are at hand."""
    if den * min(x.n, y.n) < num * max(x.n, y.n):
        return False
    both = x.n + y.n
    if x.width == y.width:
        differ = (x.bits ^ y.bits).bit_count()
    else:
        width = min(x.width, y.width)
        differ = (x.folded(width) ^ y.folded(width)).bit_count()
    if (den + num) * differ > (den - num) * both:
        return False
    if x.shingles is None:
        return True
    common = len(np.intersect1d(x.shingles, y.shingles, assume_unique=True))
    return den * common >= num * (both - common)


def spanning_links(members: list[Member], num: int, den: int) -> tuple[list[int], list[int]]:
    """The components of the links among the members of a tile, each as a star around its first member.

    A pair already connected is not looked at. Tiles that share most of their members mostly give the same edges, which
    then count once; the links themselves would differ from tile to tile.
    """
    a, b = [], []
    rest = sorted(members, key=lambda m: (m.n, m.cls))
    while rest:
        centre, queue, rest = rest[0].cls, [rest[0]], rest[1:]
        while queue and rest:
            x, apart = queue.pop(), []
            for y in rest:
                if linked(x, y, num, den):
                    a.append(centre), b.append(y.cls)
                    queue.append(y)
                else:
                    apart.append(y)
            rest = apart
    return a, b


def _tile_links(key: tuple[str, ...], num: int, den: int):
    """Links of the tiles of partitions that are sorted by the columns ``key``; one tile is held at a time."""

    def run(batches):
        now, members = None, []
        for batch in batches:
            keys = list(zip(*[batch.column(k).to_pylist() for k in key], strict=True))
            ids, out = batch.column("cls").to_pylist(), ([], [])
            exact = "shingles" in batch.schema.names
            data = batch.column("shingles" if exact else "bits").to_pylist()
            sizes = None if exact else batch.column("n").to_pylist()
            for i, k in enumerate(keys):
                if k != now:
                    for side, more in zip(out, spanning_links(members, num, den), strict=True):
                        side += more
                    now, members = k, []
                if exact:
                    s = np.frombuffer(data[i], dtype=np.uint64)
                    members.append(Member(ids[i], len(s), bitmap(s), s))
                else:
                    members.append(Member(ids[i], sizes[i], data[i]))
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in out], ["a", "b"])
        a, b = spanning_links(members, num, den)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _pairs_of_parts(parts, part):
    """The tiles that a member of one part belongs to: one for each pair of its part with any part."""
    return F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda other: F.struct(F.least(part, other).alias("low"), F.greatest(part, other).alias("high")),
    )


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 4, den: int = 5
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row: the smallest id reachable over links of similarity >= num/den.

    Sets are distinct shingles of ``words`` words (A-Z lower-cased, ASCII white space between). A null, empty or
    blank text has size 0, is linked with nothing and its component is its own id. Rows that repeat an id or have a
    null id are rows of their own; a null id is never the smallest unless a component has no other. Other columns
    are not looked at. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = docs.select("text")
    frequent = spark.sparkContext.broadcast(frequent_shingles(texts, words))
    sketches = save(
        docs.mapInArrow(
            released(_sketches(words, num, den, frequent)),
            "doc_id long, n long, cls long, bits binary, first array<long>",
        ),
        "sketches",
    )
    frequent.destroy()
    classes = sketches.where("cls is not null").dropDuplicates(["cls"])

    run = W.partitionBy("key")
    met = (
        classes.select("cls", "n", F.explode("first").alias("key"))
        .withColumn("members", F.count("*").over(run))
        .withColumn("run", F.bit_xor(F.xxhash64("cls")).over(run))
        .where("members > 1")
        .select(F.xxhash64("run", "members").alias("run"), "cls", "n")
        .repartition("run")
        .dropDuplicates(["run", "cls"])
    )
    of_run = W.partitionBy("run")
    met = (
        met.withColumn("bands", F.ceil(F.count("*").over(of_run) / BAND).cast("int"))
        .withColumn("band", F.floor((F.row_number().over(of_run.orderBy("n", "cls")) - 1) / BAND).cast("int"))
        .withColumn("tile", F.explode(_pairs_of_parts(F.col("bands"), F.col("band"))))
        .select("run", "tile.low", "tile.high", "cls")
    )
    tiles = (
        met.join(classes.select("cls", "n", "bits"), "cls")
        .repartition("run", "low", "high")
        .sortWithinPartitions("run", "low", "high")
    )
    possible = tiles.mapInArrow(released(_tile_links(("run", "low", "high"), num, den)), "a long, b long").distinct()
    blocks = connected_components(possible)

    wanted = spark.sparkContext.broadcast(hash_filter(blocks, "node", 26))
    sets = texts.mapInArrow(released(_sets(words, wanted)), "cls long, shingles binary").dropDuplicates(["cls"])
    parts = blocks.groupBy("root").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    dealt = (
        blocks.join(parts, "root")
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("tile", F.explode(_pairs_of_parts(F.col("parts"), F.col("part"))))
        .select("root", "tile.low", "tile.high", F.col("node").alias("cls"))
        .join(sets, "cls")
        .repartition("root", "low", "high")
        .sortWithinPartitions("root", "low", "high")
    )
    links = dealt.mapInArrow(released(_tile_links(("root", "low", "high"), num, den)), "a long, b long")
    joined = connected_components(links).select(F.col("node").alias("cls"), "root")

    smallest = sketches.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("smallest"))
    named = smallest.join(joined, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = save(named, "classes")
    wanted.destroy()
    roots = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
    of_class = named.join(roots, "root").select("cls", "component_id")
    return sketches.select("doc_id", F.col("n").alias("n_shingles"), "cls").join(of_class, "cls", "left").select(
        "doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one row per component: of those with the smallest id, one.

    Rows are told apart by a number they are saved with, so rows that repeat an id with different texts are documents
    of their own; a row without an id stays only if its component has none with an id. Rows without words (a null,
    empty or blank text) are linked with nothing and stay. An empty table gives no rows.
    """
    row = new_column(docs, "_row_of_table")
    rows = save(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = jaccard_components(rows, row, text_col, **options).select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"))
    found = save(found.join(ids, "row"), "components")
    least = F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"]
    stay = found.groupBy("component_id").agg(least.alias("row")).select("row")
    gone = save(found.select("row").join(stay, "row", "left_anti").withColumnRenamed("row", row), "gone")
    sure, others = split_by_ids(rows, gone, row)
    return sure.select(docs.columns).union(others.join(gone, row, "left_anti").select(docs.columns))
