"""Token ids as binary files of fixed-width bit packing, with block offsets for random access.

A file holds whole documents in order:

    magic ``TKB1``, then little-endian: u32 bits per id, u32 ids per block, u64 documents, u64 ids, u64 blocks
    i64 per document: its id;  u8 per document: 1 if it has an id;  u64 per document: its number of ids
    u64 per block and one more: where the block begins in the payload, and where the last one ends
    payload: blocks of 64-bit words, each id in the least number of bits that holds the vocabulary

A block is packed on its own, so any id is found from its number alone: ``read_ids`` reads only the blocks it needs.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazardlens.llm import tokens
from hazardlens.llm.storage import file_system, released, ship

MAGIC, HEAD = b"TKB1", "<4sIIQQQ"
BLOCK = 4096
END_ID = 2
#: Ids after which a file is closed; bytes of text for each task that writes, at least and at most.
FILE_IDS, TASK_BYTES, MOST_BYTES = 8 << 20, 24 << 20, 512 << 20
#: Where the folder lists its files, tasks whose files are added up together, and tasks that read at once.
LIST, GROUP, READERS = "files", 1024, 100_000


def width(vocabulary_size: int) -> int:
    """The least number of bits that holds every id."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids end to end in ``bits`` bits each, 64 of them in ``bits`` words; the last words are filled with zeros."""
    groups = -(-len(ids) // 64)
    lanes = np.zeros(groups * 64, dtype=np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(groups, 64)
    out = np.zeros((groups, bits), dtype=np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        out[:, word] |= lanes[:, k] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= lanes[:, k] >> np.uint64(64 - shift)
    return out.astype("<u8").tobytes()


def unpack_ids(data: bytes, count: int, bits: int) -> np.ndarray:
    words = np.frombuffer(data, dtype="<u8").reshape(-1, bits)
    out = np.empty((len(words), 64), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        lane = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lane = lane | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, k] = lane & mask
    return out.reshape(-1)[:count]


def file_bytes(doc_ids: list, counts: list[int], ids: np.ndarray, bits: int) -> list[bytes]:
    """The parts of a file."""
    blocks = [pack_ids(ids[k : k + BLOCK], bits) for k in range(0, len(ids), BLOCK)]
    begins = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    return [
        struct.pack(HEAD, MAGIC, bits, BLOCK, len(doc_ids), len(ids), len(blocks)),
        np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
        np.array([d is not None for d in doc_ids], dtype="u1").tobytes(),
        np.array(counts, dtype="<u8").tobytes(),
        begins.tobytes(),
        *blocks,
    ]


class TokenFile:
    """An open file: its directory, and ids by number."""

    def __init__(self, source):
        self.source = source
        size = struct.calcsize(HEAD)
        magic, self.bits, self.block, docs, self.n_ids, blocks = struct.unpack(HEAD, source.read(size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        ids = np.frombuffer(source.read(8 * docs), dtype="<i8").tolist()
        known = source.read(docs)
        self.doc_ids = [i if k else None for i, k in zip(ids, known, strict=True)]
        self.counts = np.frombuffer(source.read(8 * docs), dtype="<u8").astype(np.int64)
        self.begins = np.frombuffer(source.read(8 * (blocks + 1)), dtype="<u8").astype(np.int64)
        self.payload = size + 17 * docs + 8 * (blocks + 1)

    def read_ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only the blocks that hold them are read."""
        if stop <= start:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // self.block, (stop - 1) // self.block + 1
        self.source.seek(int(self.payload + self.begins[first]))
        data = self.source.read(int(self.begins[last] - self.begins[first]))
        held = unpack_ids(data, min(self.n_ids, last * self.block) - first * self.block, self.bits)
        return held[start - first * self.block : stop - first * self.block]


def _write(folder: str, vocabulary: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        end = np.array([end_id], dtype="<u4")
        bits = width(max(tokens.encoder(vocabulary).size, end_id + 1))
        fs, path = file_system(folder)
        task, number = TaskContext.get().partitionId(), 0
        names, counts, held, size = [], [], [], 0

        def close():
            # The name is this attempt's own: a repeated task never touches a file that another one has reported.
            name = f"ids-{task:06d}-{number:04d}-{uuid.uuid4().hex[:12]}.tkb"
            with fs.open_output_stream(f"{path}/{name}") as out:
                for part in file_bytes(names, counts, np.concatenate(held), bits):
                    out.write(part)
            row = [name], [task], [number], [len(names)], [size]
            return pa.RecordBatch.from_arrays(
                [pa.array(row[0]), *[pa.array(r, pa.int64()) for r in row[1:]]],
                ["file", "task", "number", "n_docs", "n_ids"],
            )

        for part, found in tokens.encoded(batches, vocabulary):
            for name, ids in zip(part.column("doc_id").to_pylist(), found, strict=True):
                names.append(name)
                held += [ids, end]
                counts.append(len(ids) + 1)
                size += counts[-1]
                if size >= FILE_IDS:
                    yield close()
                    number += 1
                    names, counts, held, size = [], [], [], 0
        if names:
            yield close()

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = tokens.VOCABULARY,
    end_id: int = END_ID,
) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending order of the document id.

    Rows without an id come first; rows that repeat an id stand in the order of a hash of their text, then of the
    text. A null or empty text is the end id alone. An empty table gives a folder with an empty list of files. Other
    columns are not looked at. The list of files is a table beside them, written by the same tasks: what it does not
    name is left from lost attempts and is not read. A large corpus has fewer, longer tasks; each file is bounded.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    keys = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("text")]
    least, most = -(-size // MOST_BYTES), -(-size // TASK_BYTES)
    tasks = max(1, least, min(most, 16 * docs.sparkSession.sparkContext.defaultParallelism))
    ordered = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange(tasks, *keys[:2])
    written = (
        ordered.sortWithinPartitions(*keys)
        .select("doc_id", "text")
        .mapInArrow(_write(folder, vocabulary, end_id), "file string, task long, number long, n_docs long, n_ids long")
    )
    written.write.parquet(f"{folder}/{LIST}")


def _read(folder: str):
    def run(batches):
        fs, path = file_system(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with fs.open_input_file(f"{path}/{name}") as source:
                    file = TokenFile(source)
                    ids = file.read_ids(0, file.n_ids).astype("<u4")
                ends = np.cumsum(file.counts)
                begins = ends - file.counts
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.doc_ids, pa.int64()),
                        pa.array(start + begins),
                        pa.array(file.counts),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, n_docs, n_ids, start`` per file: ``start`` is the number of ids in all files before it.

    Files are added up within groups of tasks, and the groups before each group as one row each.
    """
    schema = "file string, task long, number long, n_docs long, n_ids long"
    files = spark.read.schema(schema).parquet(f"{folder}/{LIST}")
    files = files.withColumn("group", F.floor(F.col("task") / GROUP))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("group").orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    groups = files.groupBy("group").agg(F.sum("n_ids").alias("ids"))
    groups = groups.select("group", F.coalesce(F.sum("ids").over(before.orderBy("group")), F.lit(0)).alias("earlier"))
    start = F.col("earlier") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    return files.join(groups, "group").select("file", "n_docs", "n_ids", start.alias("start"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files of a folder."""
    ship(spark)
    files = listed_files(spark, folder)
    listed = files.select("file", "start").repartition(max(1, min(files.count(), READERS)), "file")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return listed.mapInArrow(released(_read(folder)), schema)
