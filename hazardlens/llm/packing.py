"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm on islands.

A chromosome is a grouping: each gene a whole bin. Crossover injects some of the fullest bins of one parent into
another, removes the bins that hold a document now present twice, and places the displaced documents best-fit,
longest first. Pieces are dealt into shards of bounded size; each shard evolves on several islands with seeds of
their own, in rounds. After a round the best grouping of each island, its elite, migrates to the next island, which
starts the next round from it and its own; the last round of a shard starts from the elites of all islands. Bins that
are not nearly full are then broken up: their pieces, from all shards, are dealt anew and evolve once more.

Only piece numbers and lengths are shuffled, never texts or ids.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm import tokens
from hazardlens.llm.storage import save, ship

#: Pieces of a shard, islands of a shard, rounds that elites migrate between, groupings of a population, generations.
SHARD, ISLANDS, ROUNDS, POPULATION, GENERATIONS = 1024, 2, 3, 6, 8
#: Share of a sequence from which a bin counts as full; other bins are broken up and dealt anew once.
FULL = 0.98
END_ID = 1


class Grouping:
    """Bins of piece numbers, and how full they are."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray):
        self.bins, self.fill = bins, [int(sum(lengths[i] for i in b)) for b in bins]

    def rank(self) -> tuple[int, int]:
        """Fewer bins first; among equals the one whose fullest bins are fullest."""
        return len(self.bins), -sum(f * f for f in self.fill)


def best_fit(bins: list[list[int]], fill: list[int], order, lengths, capacity: int) -> None:
    """Place the pieces ``order`` one by one where the least room is left; ``bins`` and ``fill`` are changed."""
    room = sorted((capacity - f, k) for k, f in enumerate(fill))
    for i in order:
        need = int(lengths[i])
        at = bisect_left(room, (need, -1))
        if at == len(room):
            bins.append([i])
            fill.append(need)
            insort(room, (capacity - need, len(bins) - 1))
        else:
            left, k = room.pop(at)
            bins[k].append(i)
            fill[k] += need
            insort(room, (left - need, k))


def packed(order, lengths: np.ndarray, capacity: int) -> Grouping:
    bins, fill = [], []
    best_fit(bins, fill, order, lengths, capacity)
    return Grouping(bins, lengths)


def crossover(one: Grouping, two: Grouping, lengths: np.ndarray, capacity: int, rng) -> Grouping:
    """``one`` with some of the fullest bins of ``two`` in place of its own."""
    fullest = sorted(range(len(two.bins)), key=lambda k: -two.fill[k])
    fullest = fullest[: max(1, len(fullest) // 2)]
    chosen = rng.choice(len(fullest), size=max(1, len(fullest) // 2), replace=False)
    injected = [list(two.bins[fullest[k]]) for k in chosen]
    present = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in one.bins:
        if present.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [i for i in b if i not in present]
    child = Grouping(injected + kept, lengths)
    best_fit(child.bins, child.fill, sorted(displaced, key=lambda i: (-lengths[i], i)), lengths, capacity)
    return child


def evolve(
    lengths: np.ndarray, elites: list[np.ndarray], capacity: int, seed, generations: int = GENERATIONS
) -> Grouping:
    """The best grouping found; it needs no more bins than any elite or best-fit decreasing.

    Generations end early only when no grouping can need fewer bins.
    """
    rng = np.random.default_rng(seed)
    falling = np.lexsort((np.arange(len(lengths)), -lengths)).tolist()
    least = -(-int(lengths.sum()) // capacity)
    population = [packed(falling, lengths, capacity)]
    for elite in elites:
        bins: dict[int, list[int]] = {}
        for i, k in enumerate(elite.tolist()):
            bins.setdefault(k, []).append(i)
        population.append(Grouping(list(bins.values()), lengths))
    while len(population) < max(POPULATION, len(elites) + 2):
        shaken = -lengths * rng.uniform(0.8, 1.2, len(lengths))
        population.append(packed(np.argsort(shaken, kind="stable").tolist(), lengths, capacity))
    for _ in range(generations):
        population.sort(key=Grouping.rank)
        if len(population[0].bins) == least:
            break
        one, two = rng.choice(len(population), size=2, replace=False)
        population[-1] = min(
            population[-1], crossover(population[one], population[two], lengths, capacity, rng), key=Grouping.rank
        )
    return min(population, key=Grouping.rank)


def _evolve_island(capacity: int, turn: int, generations: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)
        lengths = pdf["length"].to_numpy(np.int64)
        elites = [np.array(e) for e in zip(*pdf["elites"], strict=True)]
        shard, island = int(pdf["shard"][0]), int(pdf["island"][0])
        best = evolve(lengths, elites, capacity, (shard, island, turn), generations)
        bins, offsets, fill = (np.zeros(len(pdf), dtype=np.int64) for _ in range(3))
        for k, b in enumerate(best.bins):
            b = np.sort(b)
            bins[b], fill[b] = k, best.fill[k]
            offsets[b] = np.cumsum(lengths[b]) - lengths[b]
        return pdf[["shard", "island", "uid", "length"]].assign(bin=bins, offset=offsets, fill=fill)

    return run


def migrated(elites, island):
    """What an island starts a round from: its own elite, and that of its neighbour."""
    return F.array(F.get(elites, island), F.get(elites, (island + ISLANDS - 1) % ISLANDS))


def _pack_level(pieces: DataFrame, capacity: int, level: int) -> DataFrame:
    """``uid, length, shard, bin, offset, fill`` of the pieces ``uid, length``, dealt into shards evenly by number."""
    shards = max(1, -(-pieces.count() // SHARD))
    schema = "shard long, island int, uid long, length long, bin long, offset long, fill long"
    now = pieces.select(
        F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)).alias("shard"),
        "uid",
        "length",
        F.array().cast("array<long>").alias("elites"),
    )
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    for turn in range(ROUNDS):
        islands = now.select("*", everywhere)
        if turn:
            islands = islands.withColumn("elites", migrated(F.col("elites"), F.col("island")))
        run = _evolve_island(capacity, turn, GENERATIONS)
        best = islands.groupBy("shard", "island").applyInPandas(run, schema)
        now = best.groupBy("shard", "uid", "length").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("island", "bin"))), lambda x: x["bin"]).alias("elites")
        )
    run = _evolve_island(capacity, ROUNDS, GENERATIONS)
    last = now.withColumn("island", F.lit(ISLANDS)).groupBy("shard", "island").applyInPandas(run, schema)
    return save(last.drop("island"), "packed")


def _pieces(capacity: int, vocabulary: str, remembered: int):
    def run(batches):
        end = np.array([END_ID], dtype="<u4")
        for part, found in tokens.encoded(batches, vocabulary, remembered):
            rows = [], [], [], [], []
            for name, ids in zip(part.column("doc_id").to_pylist(), found, strict=True):
                ids = np.append(ids, end)
                for k, start in enumerate(range(0, len(ids), capacity)):
                    piece = ids[start : start + capacity]
                    row = name, k, start, len(piece), zlib.crc32(piece)
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names)

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    vocabulary: str = tokens.VOCABULARY,
    remembered: int = tokens.REMEMBERED,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece of every text.

    A text's ids are the tokenizer's and then id 1; only longer ones are cut, every ``capacity`` ids. A null or empty
    text is the end id alone. Rows that repeat an id, or have none, are packed as rows of their own. An empty table
    gives no rows. Other columns are not looked at. Each task remembers ids of words in ``remembered``
    bytes: fewer take less memory and more time.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = docs.mapInArrow(
        _pieces(capacity, vocabulary, remembered), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )
    pieces = save(found.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    open_pieces = pieces.where(F.col("length") < capacity).select("uid", "length")
    first = _pack_level(open_pieces, capacity, 1)
    enough = F.lit(int(FULL * capacity))
    again = _pack_level(first.where(F.col("fill") < enough).select("uid", "length"), capacity, 2)

    def numbered(level: DataFrame, number: int) -> DataFrame:
        return level.select(
            "uid", (F.col("shard") * F.lit(8192) + F.col("bin") * 2 + F.lit(number)).alias("packed"), "offset"
        )

    placed = numbered(first.where(F.col("fill") >= enough), 0).union(numbered(again, 1))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = pieces.where(F.col("length") >= capacity).select(
        *columns, (F.col("uid") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return whole.union(
        pieces.where(F.col("length") < capacity)
        .join(placed, "uid")
        .select(*columns, (F.col("packed") * 2 + 1).alias("sequence_id"), "offset")
    )
