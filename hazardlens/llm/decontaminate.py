"""Benchmark decontamination with a distributed positional inverted index.

The index is cut by documents: each block of documents has the postings of its words, as ascending places in the
block's word sequence (documents are set apart by a gap, so no phrase reaches over two). Only words that may occur in
a benchmark item are stored, by a bit filter of fixed size. Blocks are rows of a table in the shared folder.

Benchmark items are cut into windows, also a table. Each block meets the windows part by part: windows of which a
word does not occur in the block fall away at once; for the others the posting lists, less the word's place in the
window, are intersected from the shortest list on. Blocks hold whole documents, so no hot word or document exists for
a shuffle to suffer from; nothing but results leaves a block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm import words as wd
from hazardlens.llm.storage import (
    file_system,
    hash_filter,
    new_column,
    new_path,
    released,
    save,
    ship,
    split_by_ids,
)

#: Words of a window, and windows that a task holds at a time.
WINDOW, WINDOWS_AT_ONCE = 13, 1 << 15
#: Bytes of text of a block of the index.
BLOCK_BYTES = 24 << 20
#: Bits of the filter of benchmark words, as a power of two.
FILTER_BITS = 24


def _item_windows(size: int):
    def run(batches):
        for batch in batches:
            for part in wd.slices(batch):
                words, first = wd.word_hashes(part.column("text"), wd.LETTERS_DIGITS)
                rows = [], []
                for name, a, b in zip(part.column("item_id").to_pylist(), first[:-1], first[1:], strict=True):
                    own = np.ascontiguousarray(words[a:b])
                    for k in range(max(1, b - a - size + 1)) if b > a else ():
                        rows[0].append(name)
                        rows[1].append(own[k : k + size].tobytes())
                for k in range(0, len(rows[0]), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(rows[0][k : k + 10_000], pa.string()),
                            pa.array(rows[1][k : k + 10_000], pa.binary()),
                        ],
                        ["item_id", "words"],
                    )

    return run


def _words_of_windows(batches):
    for batch in batches:
        data = b"".join(batch.column("words").to_pylist())
        found = np.unique(np.frombuffer(data, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(found)], ["word"])


def _index_blocks(wanted):
    """One row per block: ids and word counts of its documents, and postings of the words that may be wanted."""

    def run(batches):
        for batch in batches:
            for block in wd.slices(batch, limit=BLOCK_BYTES):
                counts, words, places, base = [], [], [], 0
                for part in wd.slices(block):
                    found, first = wd.word_hashes(part.column("text"), wd.LETTERS_DIGITS)
                    counts.append(np.diff(first))
                    keep = np.flatnonzero(wanted.value.may_hold(found))
                    document = np.searchsorted(first, keep, side="right") - 1
                    words.append(found[keep])
                    places.append(base + keep + document)
                    base += len(found) + part.num_rows
                words, places = np.concatenate(words), np.concatenate(places)
                order = np.argsort(words, kind="stable")
                terms, begin = np.unique(words[order], return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([np.concatenate(counts)], pa.list_(pa.int64())),
                        pa.array([terms.tobytes()], pa.binary()),
                        pa.array([np.append(begin, len(places)).astype(np.int64).tobytes()], pa.binary()),
                        pa.array([places[order].astype(np.int32).tobytes()], pa.binary()),
                    ],
                    ["doc_ids", "n_words", "terms", "begin", "places"],
                )

    return run


class Block:
    """The postings of a block of documents."""

    def __init__(self, terms: bytes, begin: bytes, places: bytes):
        self.terms = np.frombuffer(terms, dtype=np.uint64)
        self.begin = np.frombuffer(begin, dtype=np.int64)
        self.places = np.frombuffer(places, dtype=np.int32).astype(np.int64)

    def lists(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the posting list of each word and its length; 0 where the word does not occur."""
        if not len(self.terms):
            return np.zeros(words.shape, dtype=np.int64), np.zeros(words.shape, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return at, np.where(self.terms[at] == words, self.begin[at + 1] - self.begin[at], 0)

    def search(self, lists: np.ndarray, lengths: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Begins of exact occurrences of a phrase, and of those where each word is within ``slop`` of its place.

        Lists are intersected in order of length, the rarest word first; ties by the place in the phrase.
        """
        order = np.argsort(lengths, kind="stable")
        k = order[0]
        starts = self.places[self.begin[lists[k]] : self.begin[lists[k] + 1]] - k
        exact = np.ones(len(starts), dtype=bool)
        for k in order[1:]:
            held = self.places[self.begin[lists[k]] : self.begin[lists[k] + 1]]
            low = np.searchsorted(held, starts + (k - slop))
            near = low < np.searchsorted(held, starts + (k + slop), side="right")
            at = np.searchsorted(held, starts + k)
            exact &= held[np.minimum(at, len(held) - 1)] == starts + k
            starts, exact = starts[near], exact[near]
            if not len(starts):
                break
        return starts[exact], starts[~exact]


def window_parts(path: str):
    """The windows of a written table, a bounded number at a time: item ids, and by length the word matrices."""
    fs, folder = file_system(path)
    from pyarrow.fs import FileSelector

    for info in sorted(fs.get_file_info(FileSelector(folder)), key=lambda x: x.path):
        if not info.path.endswith(".parquet"):
            continue
        with fs.open_input_file(info.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(WINDOWS_AT_ONCE):
                words = batch.column("words").to_pylist()
                items = batch.column("item_id").to_pylist()
                by_length: dict[int, list[int]] = {}
                for i, w in enumerate(words):
                    by_length.setdefault(len(w) // 8, []).append(i)
                for rows in by_length.values():
                    matrix = np.frombuffer(b"".join(words[i] for i in rows), dtype=np.uint64).reshape(len(rows), -1)
                    yield [items[i] for i in rows], matrix


def _matches(path: str, slop: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, n_words = batch.column("doc_ids")[i].values, np.asarray(batch.column("n_words")[i].values)
                block = Block(*(batch.column(c)[i].as_py() for c in ("terms", "begin", "places")))
                start = np.concatenate([[0], np.cumsum(n_words + 1)])
                change = np.zeros(start[-1] + 1, dtype=np.int64)
                items: dict[int, set] = {}
                n_near = np.zeros(len(n_words), dtype=np.int64)
                for names, matrix in window_parts(path):
                    lists, lengths = block.lists(matrix)
                    for w in np.flatnonzero(lengths.all(axis=1)):
                        exact, near = block.search(lists[w], lengths[w], slop)
                        if len(near):
                            holder = np.searchsorted(start, near + matrix.shape[1] // 2, side="right") - 1
                            np.add.at(n_near, np.clip(holder, 0, len(n_words) - 1), 1)
                        if len(exact):
                            np.add.at(change, exact, 1)
                            np.add.at(change, exact + matrix.shape[1], -1)
                            holder = np.unique(np.searchsorted(start, exact, side="right") - 1)
                            for d in holder.tolist():
                                items.setdefault(d, set()).add(names[w] or "")
                hit = np.concatenate([[0], np.cumsum(np.cumsum(change) > 0)])
                n_hit = hit[start[1:]] - hit[start[:-1]]
                named = [",".join(sorted(items.get(d, ()))) for d in range(len(n_words))]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n_words),
                        pa.array(n_hit),
                        pa.array([len(items.get(d, ())) for d in range(len(n_words))], pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in named]),
                        pa.array((n_hit > 0) & (20 * n_hit >= n_words)),
                        pa.array(named),
                        pa.array(n_near),
                    ],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "n_near"],
                )

    return run


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slop: int = 2,
) -> DataFrame:
    """One row per document: what part of it lies in exact occurrences of windows of the items, and of which items.

    Words are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII. An item's windows are its
    runs of ``window`` words; a shorter item is one window; an item without words has none. A document is
    ``contaminated`` if a twentieth of its words or more is hit. ``n_near`` counts proximity matches: places where
    all words of a window are within ``slop`` words of their place, but not all in it.

    A null or empty text has no words. Items with a null id count under the empty id; items that share an id count
    once. Rows that repeat a document id, or have none, are rows of their own. Empty tables give no rows, or documents
    without hits. Other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).alias("text"))
    windows_path, index_path = new_path(spark, "windows"), new_path(spark, "index")
    items.mapInArrow(released(_item_windows(window)), "item_id string, words binary").write.parquet(windows_path)
    windows = spark.read.schema("item_id string, words binary").parquet(windows_path)
    words = windows.select("words").mapInArrow(released(_words_of_windows), "word long")
    wanted = spark.sparkContext.broadcast(hash_filter(words, "word", FILTER_BITS))
    schema = "doc_ids array<long>, n_words array<long>, terms binary, begin binary, places binary"
    docs.mapInArrow(released(_index_blocks(wanted)), schema).write.parquet(index_path)
    wanted.destroy()
    return (
        spark.read.schema(schema)
        .parquet(index_path)
        .mapInArrow(
            released(_matches(windows_path, slop)),
            "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
            "items string, n_near long",
        )
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is not contaminated.

    Rows are told apart by a number they are saved with, so each is judged by its own text, whether it has an id, shares
    it or not. Null and empty texts stay. An empty table of documents gives no rows, one of items drops none.
    """
    row = new_column(docs, "_row_of_table")
    rows = save(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = decontaminate(rows, items, row, text_col, **options)
    gone = save(found.where("contaminated").select(F.col("doc_id").alias(row)), "contaminated")
    sure, others = split_by_ids(rows, gone, row)
    return sure.select(docs.columns).union(others.join(gone, row, "left_anti").select(docs.columns))
