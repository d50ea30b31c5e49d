"""Exact top-k search by inner product.

Vectors are scaled to integers. A rotation from the singular value decomposition of a bounded sample puts most of
their length into the first coordinates. Candidates are processed by descending length, in blocks; against each block
of queries a block is passed over if its longest vector cannot reach what the query has already (Cauchy-Schwarz).
Else the inner product of the first rotated coordinates, plus the product of the lengths of the rest, bounds every
score from above, in two steps; what is left is scored exactly, in integers.

Queries are a table of blocks in the shared folder. A task reads them one block at a time, so neither queries nor
candidates are ever collected or broadcast; only the longest few thousand candidates are, of a fixed number, to give
every query a first limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hazardlens.llm.storage import file_system, new_path, save, ship

#: Vectors for the rotation; candidates that give the first limits; queries and candidates of a block.
SAMPLE, HEAD, QUERY_BLOCK, BLOCK = 4096, 2048, 512, 8192
#: Shares of the coordinates after which a bound is taken.
STEPS = (0.25, 0.5)
#: Bounds are raised by this share, for the rounding of floating point numbers.
SLACK = 1e-6
#: Within this all sums of products of integers are exact in floating point.
EXACT = 2.0**52


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=np.int64)


def by_dimension(batches, columns: tuple[str, ...], size: int):
    """Blocks of at most ``size`` rows of one dimension, in order: the dimension, the other columns, the vectors."""
    held: dict[int, list] = {}
    for batch in batches:
        lengths = batch.column("v").value_lengths().to_numpy()
        for d in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == d)
            part = batch.take(pa.array(rows))
            block = [np.asarray(part.column(c)) for c in columns] + [matrix(part.column("v"))]
            for k in range(0, len(rows), size):
                piece = [x[k : k + size] for x in block]
                have = held.get(d)
                if have is not None and len(have[-1]) + len(piece[-1]) > size:
                    yield d, have
                    have = None
                held[d] = piece if have is None else [np.concatenate(x) for x in zip(have, piece, strict=True)]
    yield from held.items()


def rotation(sample: np.ndarray) -> np.ndarray:
    """Orthogonal directions, those along which the sample is longest first."""
    d = sample.shape[1]
    if not len(sample):
        return np.eye(d)
    scaled = sample / max(1.0, float(np.abs(sample).max()))
    return np.linalg.eigh(scaled.T @ scaled)[1][:, ::-1]


class Rotated:
    """Integer vectors with their rotated coordinates, lengths, and the lengths that remain after each step."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray):
        self.vectors = vectors
        self.float = vectors.astype(np.float64)
        self.turned = self.float @ turn
        self.length = np.sqrt((self.float**2).sum(axis=1))
        d = vectors.shape[1]
        self.steps = [min(d, max(1, int(d * s))) for s in STEPS]
        self.rest = [np.sqrt((self.turned[:, s:] ** 2).sum(axis=1)) for s in self.steps]


def candidates(q: Rotated, c: Rotated, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of query and candidate rows whose upper bound reaches the query's limit."""
    alive = np.flatnonzero(q.length * (c.length.max() if len(c.length) else 0) * (1 + SLACK) + 1 >= limit)
    if not len(alive):
        return alive, alive
    kept, done, partial = None, 0, 0.0
    for step, rest_q, rest_c in zip(q.steps, q.rest, c.rest, strict=True):
        partial = partial + q.turned[alive, done:step] @ c.turned[:, done:step].T
        slack = SLACK * np.outer(q.length[alive], c.length) + 1
        kept = partial + np.outer(rest_q[alive], rest_c) + slack >= limit[alive, None]
        done = step
    rows, columns = np.nonzero(kept)
    return alive[rows], columns


def exact_scores(q: np.ndarray, c: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs; sums beyond 64 bits wrap around."""
    out = np.empty(len(rows), dtype=np.int64)
    for k in range(0, len(rows), 1 << 16):
        out[k : k + (1 << 16)] = np.einsum("ij,ij->i", q[rows[k : k + (1 << 16)]], c[columns[k : k + (1 << 16)]])
    return out


def best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Which pairs are among the ``k`` best of their query: highest score first, then smallest id."""
    order = np.lexsort((ids, -scores, rows))
    first = np.searchsorted(rows[order], rows[order])
    return order[np.arange(len(order)) - first < k]


def _query_blocks(turns, head, k: int):
    """Rows of queries with the limit that the longest candidates give: the k-th best score among them."""

    def run(batches):
        heads = {d: (ids, Rotated(v, turns.value[d])) for d, (ids, v) in head.value.items()}
        for d, (ids, vectors) in by_dimension(batches, ("vec_id",), QUERY_BLOCK):
            limit = np.full(len(ids), -np.inf)
            if d in heads:
                head_ids, c = heads[d]
                scores = vectors.astype(np.float64) @ c.float.T
                scores[ids[:, None] == head_ids[None, :]] = -np.inf
                if scores.shape[1] >= k:
                    limit = np.partition(scores, -k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(list(vectors), pa.list_(pa.int64())), pa.array(limit)],
                ["vec_id", "v", "query_limit"],
            )

    return run


def _search(path: str, turns, k: int):
    def run(batches):
        from pyarrow.fs import FileSelector

        fs, folder = file_system(path)
        files = sorted(f.path for f in fs.get_file_info(FileSelector(folder)) if f.path.endswith(".parquet"))
        for d, (ids, vectors) in by_dimension(batches, ("vec_id",), BLOCK):
            c = Rotated(vectors, turns.value[d])
            for name in files:
                with fs.open_input_file(name) as source:
                    for rows in pq.ParquetFile(source).iter_batches(QUERY_BLOCK):
                        keep = rows.filter(pa.array(rows.column("v").value_lengths().to_numpy() == d))
                        if not keep.num_rows:
                            continue
                        query_ids, limit = np.asarray(keep.column("vec_id")), np.asarray(keep.column("query_limit"))
                        q = Rotated(matrix(keep.column("v")), turns.value[d])
                        a, b = candidates(q, c, limit)
                        own = query_ids[a] == ids[b]
                        a, b = a[~own], b[~own]
                        scores = exact_scores(q.vectors, vectors, a, b)
                        reach = scores >= limit[a]
                        a, b, scores = a[reach], b[reach], scores[reach]
                        chosen = best(a, ids[b], scores, k)
                        a, b = a[chosen], b[chosen]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(query_ids[a]), pa.array(ids[b]), pa.array(scores[chosen])],
                            ["query_id", "vec_id", "score"],
                        )

    return run


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query with all other rows.

    Components become floor(scale * x). Queries are the rows whose id is divisible by ``every``. Null vectors, those
    with a null, NaN or infinite component, empty ones and rows without an id take no part; only vectors of the
    query's dimension count. Ties go to the smaller id. Rows that repeat an id with the same vector count as one; the
    rows of one id are each a candidate, none of them for a query of that id, and a query id with several vectors
    gets the best over them, each candidate row once per vector. Components, and scores, beyond 2**52 in size are out
    of the operator's range. Empty tables give no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    ship(spark)
    x = F.col(vector_col)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = (
        vectors.where(F.col(id_col).isNotNull() & x.isNotNull())
        .where((F.size(x) > 0) & fine)
        .select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"),
        )
        .dropDuplicates(["vec_id", "v"])
        .withColumn("length", F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double")))
    )
    rows = save(rows, "vectors")
    dimensions = [r[0] for r in rows.select(F.size("v")).distinct().collect()]
    turns, head = {}, {}
    for d in dimensions:
        own = rows.where(F.size("v") == d)
        sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
        turns[d] = rotation(matrix(sample.column("v").combine_chunks()).astype(np.float64))
        longest = own.orderBy(F.desc("length"), "vec_id").limit(HEAD).select("vec_id", "v").toArrow()
        head[d] = np.asarray(longest.column("vec_id")), matrix(longest.column("v").combine_chunks())
    turns, head = spark.sparkContext.broadcast(turns), spark.sparkContext.broadcast(head)
    path = new_path(spark, "queries")
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "v")
    queries.mapInArrow(_query_blocks(turns, head, k), "vec_id long, v array<long>, query_limit double").write.parquet(
        path
    )
    parts = max(1, -(-rows.count() // (4 * BLOCK)))
    falling = rows.repartitionByRange(parts, F.desc("length"), F.xxhash64("vec_id")).sortWithinPartitions(
        F.desc("length"), "vec_id"
    )
    found = falling.select("vec_id", "v").mapInArrow(
        _search(path, turns, k), "query_id long, vec_id long, score long"
    )
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
