"""Language identification with averaged hashed subword embeddings and a linear softmax.

The subwords of a word are its runs of bytes of a few lengths, its beginning, its end and the whole. Each is hashed to
an embedding; a text is the average of the embeddings of all its subwords, and a linear softmax gives the language.
Both are trained by stochastic gradient descent in numpy on a bounded sample. A fifth of the sample is kept back to
set the temperature of the softmax and the score below which a prediction is rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hazardlens.llm import words as wd
from hazardlens.llm.storage import ship, thinned

#: Most documents of each language in the training sample.
SAMPLE = 600
#: Embeddings and their width, and the lengths in bytes of subwords.
BUCKETS, WIDTH, RUNS, EDGE = 1 << 18, 10, (3, 4), 3
EPOCHS, RATE = 5, 0.5
#: Share of right predictions that may be rejected.
REJECTED = 0.01
UNKNOWN = "und"
LETTERS = np.zeros(256, dtype=bool)
LETTERS[97:123] = LETTERS[128:] = True


def subwords(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Kinds of subwords: buckets in text order, and the first of each text (one more entry: their number)."""
    data, at = wd.text_bytes(column)
    data = wd.LOWER[data]
    starts, ends, first = wd.find(data, at, LETTERS)
    mask = np.uint64(BUCKETS - 1)
    out = []
    size = np.minimum(ends - starts, EDGE)
    for kind, (a, b) in enumerate(((starts, ends), (starts, starts + size), (ends - size, ends))):
        out.append(((wd.mix(wd.hashes(data, a, b) + np.uint64(kind)) & mask).astype(np.int32), first))
    lengths = ends - starts
    for run in RUNS:
        count = np.maximum(lengths - run + 1, 0)
        before = np.concatenate([[0], np.cumsum(count)])
        begin = np.repeat(starts - before[:-1], count) + np.arange(before[-1])
        code = np.zeros(len(begin), dtype=np.uint64)
        for k in range(run):
            code = (code << np.uint64(8)) | data[begin + k]
        out.append(((wd.mix(code + np.uint64(run << 56)) & mask).astype(np.int32), before[first]))
    return out


def sums(kinds, table: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sum of the rows of ``table`` over all its subwords, and their number."""
    total, count = np.zeros((texts, table.shape[1])), np.zeros(texts, dtype=np.int64)
    for buckets, first in kinds:
        n = np.diff(first)
        some = np.flatnonzero(n)
        if len(some):
            total[some] += np.add.reduceat(table[buckets], first[:-1][some], axis=0)
        count += n
    return total, count


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """Languages, a logit row per bucket, biases, temperature and the least score that is accepted."""

    def __init__(self, languages, logits, bias, temperature, least):
        self.languages, self.logits, self.bias = languages, logits, bias
        self.temperature, self.least = temperature, least

    def probabilities(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        total, count = sums(subwords(column), self.logits, len(column))
        return softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature), count


def train(texts: list[str], languages: list[str], seed: int = 3) -> Model:
    """A model of the languages given; without any it knows none, with one it always predicts that one."""
    names = sorted(set(languages))
    rng = np.random.default_rng(seed)
    embeddings = (rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH).astype(np.float32)
    linear, bias = np.zeros((WIDTH, len(names)), dtype=np.float32), np.zeros(len(names), dtype=np.float32)
    labels = np.array([names.index(x) for x in languages], dtype=np.int64)
    kept = np.arange(len(texts)) % 5 == 4
    rows = []
    for i in np.flatnonzero(~kept):
        buckets = np.concatenate([b for b, _ in subwords(pa.array([texts[i]], pa.string()))])
        if len(buckets):
            rows.append((*np.unique(buckets, return_counts=True), labels[i]))
    steps, step = max(1, EPOCHS * len(rows)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            rate = RATE * (1 - step / steps)
            step += 1
            buckets, counts, label = rows[i]
            share = (counts / counts.sum()).astype(np.float32)
            hidden = share @ embeddings[buckets]
            error = softmax(hidden @ linear + bias)
            error[label] -= 1
            back = linear @ error
            linear -= rate * np.outer(hidden, error)
            bias -= rate * 0.1 * error
            # Scaled by the text's size, so that subwords of long texts move as far as those of short ones.
            embeddings[buckets] -= rate * min(len(buckets), 200) * np.outer(share, back)
    model = Model(names, (embeddings @ linear).astype(np.float32), bias, 1.0, 0.0)
    if kept.any() and len(names) > 1:
        column = pa.array([t for t, k in zip(texts, kept, strict=True) if k], pa.string())
        total, count = sums(subwords(column), model.logits, len(column))
        z, right = total / np.maximum(count, 1)[:, None] + bias, labels[kept]
        z, right = z[count > 0], right[count > 0]
        if len(z):
            loss = {
                t: -np.log(softmax(z / t)[np.arange(len(z)), right] + 1e-12).mean() for t in np.geomspace(0.05, 4, 24)
            }
            model.temperature = float(min(loss, key=loss.get))
            p = softmax(z / model.temperature)
            sure = p.max(axis=1)[p.argmax(axis=1) == right]
            model.least = float(np.quantile(sure, REJECTED)) if len(sure) else 0.0
    return model


def held_out(column: str = "doc_id"):
    """Whether the crc32 of the id as text leaves the remainder 2 by 4; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame) -> Model:
    """Train on at most ``SAMPLE`` documents of each language, the first by a hash of the id, that are not held out."""
    marked = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    key = F.xxhash64("doc_id", F.lit(6))
    first = W.partitionBy("lang").orderBy(key, "doc_id")
    few = thinned(marked.select("doc_id", "lang"), "lang", "doc_id", SAMPLE, 66)
    chosen = few.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= SAMPLE)
    wanted = [(r["doc_id"], r["lang"]) for r in chosen.collect()]
    if not wanted:
        return train([], [])
    # SAMPLE rows per language at most.
    listed = F.broadcast(docs.sparkSession.createDataFrame(wanted, "doc_id long, lang string"))
    rows = marked.join(listed, ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"]).orderBy(key, "doc_id", "lang").collect()
    return train([r["text"] or "" for r in rows], [r["lang"] for r in rows])


def _predict(shared):
    def run(batches):
        model = shared.value
        n = len(model.languages)
        for batch in batches:
            for part in wd.slices(batch, limit=max(1 << 16, (8 << 20) // max(n, 1))):
                texts = part.column("text")
                if n:
                    p, count = model.probabilities(texts)
                    best, score = p.argmax(axis=1), p.max(axis=1)
                else:
                    best, score, count = [], np.zeros(part.num_rows), np.zeros(part.num_rows, dtype=np.int64)
                names, scores, accepted = [], [], []
                for i in range(part.num_rows):
                    known = n and count[i] and _has_letters(texts[i])
                    names.append(model.languages[best[i]] if known else UNKNOWN)
                    scores.append(float(score[i]) if known else 0.0)
                    accepted.append(bool(known and score[i] >= model.least))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names), pa.array(scores), pa.array(accepted, pa.bool_())],
                    ["doc_id", "lang_pred", "score", "accepted"],
                )

    return run


def _has_letters(text: pa.StringScalar) -> bool:
    """Bytes beyond ASCII may be no letters; the search ends at the first one."""
    return any(c.isalpha() for c in text.as_py())


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` per row.

    A null text, or one without letters, is ``und`` with score 0, and so is every text if no language is given.
    ``accepted`` is whether the calibrated score is high enough; a rejected row keeps its prediction. Rows that repeat
    an id, or have none, are predicted as rows of their own. An empty table gives no rows. Other columns are not
    looked at, neither for training nor for predictions.
    """
    ship(docs.sparkSession)
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    found = docs.select("doc_id", "text").mapInArrow(
        _predict(model), "doc_id long, lang_pred string, score double, accepted boolean"
    )
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")
