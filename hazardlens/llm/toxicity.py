"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a logistic score over hashed features of its words (the whole word
and its beginnings); a document is toxic if any sentence is, so its score is the noisy-or of its sentences' scores.
Only documents have labels; the likelihood of a document's label trains the sentence scores, which then also tell
where the offending sentences stand.

Training reads a bounded sample of labelled documents, balanced by label; scoring reads every text in whole and
shuffles nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm import words as wd
from hazardlens.llm.storage import release, released, ship, thinned

#: Most documents of each label in the training sample.
SAMPLE = 2500
#: Features: weights by hash, and the lengths in bytes of the word beginnings that are features beside the word.
BUCKETS, BEGINNINGS = 1 << 20, (4, 5, 6, 7, 8, 10)
EPOCHS, RATE, DECAY = 10, 0.5, 1e-3
#: Training documents that must have a feature for it to get a weight.
LEAST_DOCUMENTS = 4
#: Bytes that end a sentence.
SENTENCE_ENDS = np.zeros(256, dtype=bool)
SENTENCE_ENDS[list(b".!?\n")] = True


class Sentences:
    """The sentences of many texts: feature buckets of their words, and where sentences and texts begin."""

    def __init__(self, column: pa.Array):
        data, at = wd.text_bytes(column)
        data = wd.LOWER[data]
        starts, ends, first = wd.find(data, at, wd.LETTERS_DIGITS)
        closed = np.concatenate([[0], np.cumsum(SENTENCE_ENDS[data])]) if len(data) else np.zeros(1, dtype=np.int64)
        number = closed[starts]  # sentence ends before each word
        opens = np.zeros(len(starts), dtype=bool)
        opens[first[:-1][first[:-1] < len(starts)]] = True
        opens[1:] |= number[1:] != number[:-1]
        self.sentence = np.flatnonzero(opens)  # first word of each sentence
        self.text = np.searchsorted(self.sentence, first)  # first sentence of each text
        whole = wd.hashes(data, starts, ends)
        # A word counts once in a sentence.
        self.of = np.repeat(np.arange(len(self.sentence)), np.diff(np.append(self.sentence, len(starts))))
        order = np.lexsort((whole, self.of))
        again = np.zeros(len(starts), dtype=bool)
        again[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (self.of[order[1:]] == self.of[order[:-1]])
        lengths = ends - starts
        columns = [whole]
        for size in BEGINNINGS:
            cut = wd.hashes(data, starts, np.minimum(ends, starts + size))
            columns.append(wd.mix(cut + np.uint64(size)))
            columns[-1][lengths < size] = 0
        self.features = (np.stack(columns, axis=1) & np.uint64(BUCKETS - 1)).astype(np.int32)
        self.features[:, 1:][lengths[:, None] < np.array(BEGINNINGS)] = 0  # bucket 0 is never trained
        self.features[again] = 0

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        """The probability of each sentence."""
        if not len(self.sentence):
            return np.zeros(0)
        words = weights[self.features].sum(axis=1, dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(np.add.reduceat(words, self.sentence) + bias, -40, 40)))


def noisy_or(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One minus the product of the complements, per text; 0 for a text without sentences."""
    logs = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-12)))])
    return np.clip(1 - np.exp(logs[first[1:]] - logs[first[:-1]]), 0.0, 1.0)


def train(texts: list[str | None], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias that make the labels likely: stochastic gradient steps, one document at a time.

    Without two kinds of labels nothing can be learnt: the weights are 0 and the bias tells the labels' share.
    """
    weights, bias = np.zeros(BUCKETS, dtype=np.float64), -4.0
    share = float(np.mean(labels)) if labels else 0.0
    if not 0 < share < 1:
        return weights.astype(np.float32), 40.0 if share else -40.0
    squares, bias_square = np.ones(BUCKETS), 1.0
    bags = [Sentences(pa.array([t], pa.string())) for t in texts]
    kept, bags = bags[::6], [b for i, b in enumerate(bags) if i % 6]
    kept_labels, labels = labels[::6], [x for i, x in enumerate(labels) if i % 6]
    held = np.zeros(BUCKETS, dtype=np.int32)
    for bag in bags:
        held[np.unique(bag.features)] += 1
    for bag in bags:
        bag.features[held[bag.features] < LEAST_DOCUMENTS] = 0
    # Of each document the trained features, each once per sentence it occurs in.
    uses = []
    for bag in bags:
        at, _ = np.nonzero(bag.features)
        buckets, of = bag.features[bag.features > 0], bag.of[at]
        touched, place = np.unique(buckets, return_inverse=True)
        uses.append((touched, place.astype(np.int32), of.astype(np.int32), len(bag.sentence)))
    del bags
    rng = np.random.default_rng(seed)
    weight = {0: 1.0, 1: (1 - share) / share}
    for _ in range(epochs):
        for i in rng.permutation(len(uses)):
            touched, place, of, sentences = uses[i]
            if not sentences:
                continue
            z = np.bincount(of, weights=weights[touched][place], minlength=sentences) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            bag_p = float(noisy_or(p, np.array([0, len(p)]))[0])
            slope = weight[labels[i]] * (p if not labels[i] else -p * (1 - bag_p) / max(bag_p, 1e-9))
            step = np.bincount(place, weights=slope[of], minlength=len(touched)) + DECAY * weights[touched]
            squares[touched] += step**2
            weights[touched] -= RATE * step / np.sqrt(squares[touched])
            whole = float(slope.sum())
            bias_square += whole**2
            bias -= RATE * whole / np.sqrt(bias_square)
    # The sixth of the sample that was not trained on sets steepness and bias: the least cost, a rejected clean
    # document counting twice; among equals the gentlest.
    best = None
    for steep in (1.0, 1.2, 1.4, 1.7, 2.0):
        for shift in (0.0, -0.5, 0.5, -1.0, 1.0, 1.5):
            sharp, moved = (weights * steep).astype(np.float32), bias + shift
            scores = [noisy_or(p, np.array([0, len(p)]))[0] for p in (b.scores(sharp, moved) for b in kept)]
            cost = sum((1 + (x == 0)) * ((s >= 0.5) != x) for s, x in zip(scores, kept_labels, strict=True))
            if best is None or cost < best[0]:
                best = cost, sharp, moved
    return best[1], best[2]


def held_out(column: str = "doc_id"):
    """Whether the crc32 of the id as text leaves no remainder by 5; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Train on at most ``SAMPLE`` documents of each label, the first by a hash of the id, that are not held out."""
    marked = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(F.col("doc_id").isNotNull() & ~held_out())
    order = [F.xxhash64("doc_id", F.lit(5)), F.col("doc_id")]
    few = thinned(marked, "toxic", "doc_id", SAMPLE, 55)
    chosen = None
    for label in (0, 1):
        some = few.where(F.col("toxic") == label).orderBy(*order).limit(SAMPLE)
        chosen = some if chosen is None else chosen.union(some)
    wanted = {r["doc_id"]: r["toxic"] for r in chosen.collect()}
    if not wanted:
        return train([], [])
    spark = docs.sparkSession
    # 2 * SAMPLE rows at most.
    listed = F.broadcast(spark.createDataFrame(list(wanted.items()), "doc_id long, toxic int"))
    rows = docs.join(listed, "doc_id").dropDuplicates(["doc_id"]).orderBy(*order).collect()
    found = train([r["text"] for r in rows], [r["toxic"] for r in rows])
    del rows
    release()
    return found


def _score(model):
    def run(batches):
        weights, bias = model.value
        for batch in batches:
            for part in wd.slices(batch, limit=1 << 20):
                bag = Sentences(part.column("text"))
                p = bag.scores(weights, bias)
                score = noisy_or(p, bag.text)
                worst, place = [], []
                for a, b in zip(bag.text[:-1], bag.text[1:], strict=True):
                    bad = np.flatnonzero(p[a:b] >= 0.5)
                    worst.append(bad.tolist())
                    place.append(float(p[a:b].max()) if b > a else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(score),
                        pa.array((score >= 0.5).astype(np.int32)),
                        pa.array(worst, pa.list_(pa.int32())),
                        pa.array(place, pa.float64()),
                    ],
                    ["doc_id", "score", "predicted", "offending", "worst"],
                )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, offending, worst`` per row.

    ``offending`` lists the sentences with a score of at least one half, by their number among the text's sentences
    that have words (sentences end at ``.!?`` or a newline); ``worst`` is the highest sentence score. A null, empty
    or wordless text scores 0. Rows that repeat an id, or have none, are scored as rows of their own; one of them is
    taken for training if the id is labelled (a label of 1 wins over 0; other labels do not count). Empty tables give
    no rows; without labels of both kinds every text with words gets the score of the only kind, or 0. Other columns
    are not looked at, neither for training nor for scores.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    scored = docs.mapInArrow(
        released(_score(model)), "doc_id long, score double, predicted int, offending array<int>, worst double"
    )
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "offending", "worst")


def _keep_clean(model, text_col: str):
    def run(batches):
        weights, bias = model.value
        for batch in batches:
            for part in wd.slices(batch, text_col, 1 << 20):
                bag = Sentences(part.column(text_col))
                yield part.filter(pa.array(noisy_or(bag.scores(weights, bias), bag.text) < 0.5))

    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``toxicity`` does not predict toxic.

    Null, empty and wordless texts stay, as do all rows if nothing can be learnt from the labels but that they are 0.
    Rows that repeat an id, or have none, are judged each by its own text. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    model = docs.sparkSession.sparkContext.broadcast(fit(known, labels))
    return docs.mapInArrow(released(_keep_clean(model, text_col)), docs.schema)


def is_held_out(doc_id: int | None) -> bool:
    """The same rule in plain Python."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
