"""Prefix trie of conversations, with subtree totals by time-forward processing.

Nodes are identified by the exclusive or of 128-bit hashes of (position, turn) over their path, which partial results of
any cut of a conversation combine to; so a conversation of any length is numbered and hashed in ranges of rows.

Totals go up the trie by time-forward processing. A shard holds the paths of some conversations, a partial trie whose
nodes Spark sorts externally in reverse level order; each node takes the messages sent to it from a priority queue that
spills, adds its own value, and sends the total to its parent. Totals are sums, so what shards find for a node that they
share adds up, and no shard grows with a popular first turn. Paths are cut into blocks of ``LEVELS`` levels, and the tops
of blocks are the shard roots: they form a trie of their own, whose totals are found in the same way before the blocks
below send theirs, as messages from outside, into the blocks above. So long conversations are spread over shards too.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazardlens.llm.lookup import lookup
from hazardlens.llm.storage import file_system, new_path, save, ship

#: Levels of a block, rows of a shard, messages that a queue holds in memory, bytes of ids that are kept together.
LEVELS, SHARD, QUEUE, CHUNK = 64, 1 << 18, 1 << 18, 64 << 10
#: Rows of a range of the sorted turns.
RANGE = 1 << 18
_MESSAGE = struct.Struct("<qqqqq")


class SpillingQueue:
    """Messages (level, node, node, leaves, saved), least first; beyond ``limit`` they are written out as sorted runs.

    Messages to one node that meet in memory are added up before they are written.
    """

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit = folder, limit
        self.heap: list[tuple] = []
        self.runs: list[str] = []
        self.heads: list[tuple] = []
        self.open: dict[int, tuple] = {}

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        fs, path = file_system(self.folder)
        fs.create_dir(path, recursive=True)
        name = f"{path}/{uuid.uuid4().hex}"
        with fs.open_output_stream(name) as out:
            now = None
            for m in sorted(self.heap):
                if now is not None and now[:3] == m[:3]:
                    now = (*m[:3], now[3] + m[3], now[4] + m[4])
                    continue
                if now is not None:
                    out.write(_MESSAGE.pack(*now))
                now = m
            out.write(_MESSAGE.pack(*now))
        self.heap.clear()
        number = len(self.runs)
        self.runs.append(name)
        self.open[number] = fs.open_input_stream(name, buffer_size=1 << 16)
        self._next(number)

    def _next(self, number: int) -> None:
        data = self.open[number].read(_MESSAGE.size)
        if data:
            heapq.heappush(self.heads, (_MESSAGE.unpack(data), number))
        else:
            self.open.pop(number).close()

    def least(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            message, number = heapq.heappop(self.heads)
            self._next(number)
            return message
        return heapq.heappop(self.heap)

    def close(self) -> None:
        for source in self.open.values():
            source.close()
        if self.runs:
            fs, path = file_system(self.folder)
            fs.delete_dir(path)
        self.__init__(self.folder, self.limit)


def forward(nodes, queue: SpillingQueue) -> Iterator[tuple]:
    """(x, y, leaves, saved) with the totals of nodes (level, x, y, parent x, parent y, top, leaves, saved).

    Nodes come in the order of (level, x, y), where ``level`` is the negative depth: the deepest first. The ``top`` of
    a block sends nothing.
    """
    for level, x, y, px, py, top, leaves, saved in nodes:
        while (least := queue.least()) is not None and least[:3] <= (level, x, y):
            message = queue.pop()
            if message[:3] != (level, x, y):
                raise ValueError("a message to a node that the shard does not hold")
            leaves += message[3]
            saved += message[4]
        if not top:
            queue.push((level + 1, px, py, leaves, saved))
        yield x, y, leaves, saved


def _forward(folder: str, limit: int):
    def run(batches):
        queue = SpillingQueue(f"{folder}/{uuid.uuid4().hex}", limit)

        def nodes():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        try:
            found, names = [], ["x", "y", "leaves", "saved"]
            for row in forward(nodes(), queue):
                found.append(row)
                if len(found) == 10_000:
                    yield _batch(found, names)
                    found = []
            if found:
                yield _batch(found, names)
        finally:
            queue.close()

    return run


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def _top(depth) -> F.Column:
    """The depth of the top of the block that a depth lies in."""
    return depth - F.pmod(depth - 1, F.lit(LEVELS))


_PLACE = ["depth", "x", "y", "px", "py"]


def _from_below(steps: DataFrame, values: DataFrame, deepest: int) -> DataFrame:
    """What the blocks below send: ``conv, depth, x, y, px, py, leaves, saved`` at the parents of their tops."""
    depth = F.col("depth")
    tops = steps.where(_top(depth) == depth)
    upper = tops.select("conv", (depth + LEVELS).alias("depth"), F.col("x").alias("ux"), F.col("y").alias("uy"))
    number = ((depth - 1) / LEVELS).cast("long") + 1
    roots = tops.drop("px", "py").join(upper, ["conv", "depth"], "left").select(
        "conv", number.alias("depth"), "x", "y", *(F.coalesce(c, F.lit(0)).alias(p) for c, p in (("ux", "px"), ("uy", "py")))
    )
    roots = save(roots, "shard-roots")
    sums = values.groupBy("conv", (((depth - 1) / LEVELS).cast("long") + 1).alias("depth")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    of_roots = save(roots.join(sums, ["conv", "depth"]), "shard-root-values")
    totals = subtree_totals(roots, of_roots, (deepest - 1) // LEVELS + 1)
    who = tops.where(depth > 1).groupBy("x", "y").agg(F.min("conv").alias("conv"), (F.min("depth") - 1).alias("depth"))
    sent = who.join(totals, ["x", "y"]).select("conv", "depth", "leaves", "saved")
    return sent.join(steps, ["conv", "depth"]).select("conv", *_PLACE, "leaves", "saved")


def subtree_totals(steps: DataFrame, values: DataFrame, deepest: int) -> DataFrame:
    """``x, y, leaves, saved``: of every node, the sums of the values in its subtree.

    ``steps``: ``conv, depth, x, y, px, py``, a row per conversation and node on its path. ``values``: the same with
    ``leaves, saved``, any number of rows per node, each on the path of the conversation it names. Both are saved.
    """
    if deepest > LEVELS:
        values = values.unionByName(_from_below(steps, values, deepest))
    shards = max(1, -(-steps.count() // SHARD))
    none = [F.lit(0).cast("long").alias(c) for c in ("leaves", "saved")]
    shard = F.pmod(F.xxhash64("conv"), F.lit(shards)).alias("shard")
    everything = steps.select(shard, *_PLACE, *none).union(values.select(shard, *_PLACE, "leaves", "saved"))
    block = ((F.col("depth") - 1) / LEVELS).cast("long").alias("block")
    nodes = everything.groupBy("shard", block, *_PLACE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    level = (-F.col("depth")).alias("level")
    ordered = (
        nodes.repartition("shard", "block")
        .sortWithinPartitions("shard", "block", F.col("depth").desc(), "x", "y")
        .select(level, "x", "y", "px", "py", (_top(F.col("depth")) == F.col("depth")).alias("top"), "leaves", "saved")
    )
    folder = new_path(steps.sparkSession, "messages")
    found = ordered.mapInArrow(_forward(folder, QUEUE), "x long, y long, leaves long, saved long")
    return found.groupBy("x", "y").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _chunks(size: int):
    def run(batches):
        out, node, first, held, length = [], None, None, [], 0
        names = ["x", "y", "first", "ids"]
        for batch in batches:
            for x, y, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node != (x, y) or length >= size:
                    if held:
                        out.append((*node, first, ",".join(held)))
                    node, first, held, length = (x, y), conv, [], 0
                held.append(str(conv))
                length += len(held[-1]) + 1
            if out:
                yield _batch(out, names)
                out = []
        if held:
            yield _batch([(*node, first, ",".join(held))], names)

    return run


def _digests(batches):
    node, digest, names = None, None, ["x", "y", "ends_sha256"]
    for batch in batches:
        out = []
        for x, y, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node != (x, y):
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (x, y), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield _batch(out, names)
    if node is not None:
        yield _batch([(*node, digest.hexdigest())], names)


def end_digests(ends: DataFrame) -> DataFrame:
    """``x, y, ends_sha256`` of the conversations ``conv`` that end at each node, in ascending order.

    Ids are put together in chunks where Spark sorted them, so what a task reads for a node that very many
    conversations end at is a few long rows; the digest of one node is computed in one task, as it must be.
    """
    ids = ends.select("x", "y", "conv").repartitionByRange("x", "y", "conv").sortWithinPartitions("x", "y", "conv")
    chunks = ids.mapInArrow(_chunks(CHUNK), "x long, y long, first long, ids string")
    ordered = chunks.repartition("x", "y").sortWithinPartitions("x", "y", "first")
    return ordered.mapInArrow(_digests, "x long, y long, ends_sha256 string")


def turn_paths(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    every: int = 100,
    heads: int = 6,
) -> tuple[DataFrame, DataFrame]:
    """Saved tables ``conv`` and ``conv, seg, pos, digest, n`` of rebuilt conversations and their turns.

    Turns are in the order of ``turn``, null first, equal ones in the order of a digest of role and text; null roles
    and texts are empty. A conversation c begins with the first crc32(c) % ``heads`` turns of conversation
    c - c % ``every`` in place of as many of its own. Rows without an id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("long").alias("n"),
    )
    ranges = max(1, -(-turns.count() // RANGE))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    placed = (
        turns.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select("conv", "digest", "n")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("seg", F.shiftright("at", 33))
    )
    placed = save(placed, "turns")
    counted = placed.groupBy("conv", "seg").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    upto = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    counted = save(counted.withColumn("before", F.coalesce(F.sum("c").over(upto), F.lit(0))), "segments")
    convs = counted.groupBy("conv").agg(F.sum("c").alias("total"))
    crc = F.crc32(F.col("conv").cast("string").cast("binary"))
    convs = convs.withColumn("h", F.pmod(crc, F.lit(heads)) if heads else F.lit(0).cast("long"))
    convs = convs.withColumn("base", F.col("conv") - F.pmod("conv", F.lit(every)))
    bases = convs.select(F.col("conv").alias("base"), F.col("total").alias("held"))
    convs = convs.join(bases, "base", "left").withColumn("b", F.least("h", F.coalesce("held", F.lit(0))))
    convs = save(convs.select("conv", "base", "h", "b"), "conversations")
    numbered = placed.join(counted.join(convs, "conv"), ["conv", "seg"]).select(
        "conv", "seg", "digest", "n", "h", "b", (F.col("before") + F.col("at") - F.col("first") + 1).alias("index")
    )
    own = numbered.where(F.col("index") > F.col("h")).select(
        "conv", "seg", (F.col("index") - F.col("h") + F.col("b")).alias("pos"), "digest", "n"
    )
    first = numbered.where((F.pmod("conv", F.lit(every)) == 0) & (F.col("index") < heads)).select(
        F.col("conv").alias("base"), F.col("index").alias("pos"), "digest", "n"
    )
    given = convs.where(F.col("b") > 0).join(first, "base").where(F.col("pos") <= F.col("b"))
    path = own.unionByName(given.select("conv", F.lit(-1).cast("long").alias("seg"), "pos", "digest", "n"))
    return convs.select("conv"), save(path, "paths")


def prefix_trie(convs: DataFrame, path: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` per node.

    ``convs`` has the conversations, ``path`` their turns: ``conv, seg, pos, digest, n``, where ``seg`` cuts a
    conversation into ranges of ascending ``pos`` and ``n`` is what a turn costs. A node is a distinct sequence of first
    turns; ``conv_id`` the least conversation that begins with it, which with ``depth`` names it. The root is the node
    of depth 0; with no conversation there is no node. ``saved_tokens`` is the sum over the subtree of the cost of each
    node's last turn, once less than conversations hold it.
    """
    spark = convs.sparkSession
    ship(spark)
    path = path.withColumn("hx", F.xxhash64("digest", "pos")).withColumn("hy", F.xxhash64(F.lit("y"), "pos", "digest"))
    sums = path.groupBy("conv", "seg").agg(F.bit_xor("hx").alias("cx"), F.bit_xor("hy").alias("cy"))
    upto = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "conv", "seg", *(F.coalesce(F.bit_xor(c).over(upto), F.lit(0)).alias(c) for c in ("cx", "cy"))
    )
    inside = Window.partitionBy("conv", "seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    steps = path.join(carried, ["conv", "seg"]).select(
        "conv",
        F.col("pos").alias("depth"),
        "n",
        "hx",
        "hy",
        F.col("cx").bitwiseXOR(F.bit_xor("hx").over(inside)).alias("x"),
        F.col("cy").bitwiseXOR(F.bit_xor("hy").over(inside)).alias("y"),
    )
    parent = [F.col(a).bitwiseXOR(F.col(b)).alias(p) for a, b, p in (("x", "hx", "px"), ("y", "hy", "py"))]
    steps = save(steps.select("conv", "depth", "x", "y", *parent, "n"), "steps")
    nodes = steps.groupBy("x", "y").agg(
        F.count("*").alias("n_convs"),
        F.min("conv").alias("conv_id"),
        *(F.min(c).alias(c) for c in ("depth", "px", "py", "n")),
    )
    nodes = save(nodes, "nodes")
    below = nodes.groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(below, ["x", "y"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    values = nodes.select(
        F.col("conv_id").alias("conv"),
        *_PLACE,
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n")).alias("saved"),
    )
    deepest = steps.agg(F.max("depth")).first()[0] or 0
    totals = save(subtree_totals(steps.drop("n"), save(values, "values"), deepest), "totals")
    last = steps.groupBy("conv").agg(F.max_by(F.struct("x", "y"), "depth").alias("last"))
    ends = convs.join(last, "conv", "left").select(
        "conv", *(F.coalesce(F.col(f"last.{c}"), F.lit(0)).alias(c) for c in ("x", "y"))
    )
    digests = save(end_digests(ends), "ends")
    empty = hashlib.sha256(b"").hexdigest()

    columns = ["conv_id", "depth", "n_convs", "n_children", "leaves", "saved"]
    known = nodes.join(totals, ["x", "y"]).select("x", "y", "px", "py", *columns)
    all_convs = convs.agg(F.count("*"), F.min("conv")).first()
    if not all_convs[0]:
        root = spark.createDataFrame([], known.schema)
    else:
        top = known.where(F.col("depth") == 1).agg(F.count("*"), F.sum("leaves"), F.sum("saved")).first()
        row = (0, 0, None, None, all_convs[1], 0, all_convs[0], top[0], top[1] or 1, top[2] or 0)
        root = spark.createDataFrame([row], known.schema.simpleString()[7:-1].replace(":", " "))
    whole = known.union(root).join(digests, ["x", "y"], "left")
    whole = save(whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty))), "trie")
    parents = whole.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    below = lookup(whole.where(F.col("px").isNotNull()), parents, ["px", "py"])
    top = whole.where(F.col("px").isNull()).withColumn("parent_conv_id", F.lit(None).cast("long"))
    return below.unionByName(top).select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )
