"""Phrase collocations by Toivonen's sampling: sampled phrases and their negative border, counted exactly.

A sample of the rows proposes phrases: those that reach a lowered count in it. A pass over all rows counts the proposed
phrases and their negative border exactly: every phrase of which both parts that lack an end word are proposed, and
every word. A phrase of the border that turns out to be frequent is a failure: with it, longer phrases could be frequent
that were not counted. So it joins the proposed ones, and another pass counts what the border grew by, until no failure
is left. Whatever the sample, the counts of all frequent phrases are then complete and exact.

Tasks hold what is proposed as bit filters of fixed size, so a pass may also count phrases that nothing asked for; it
never misses one. Words of a slice of texts are numbered, and phrases are counted by these numbers, exactly. Between
tasks a phrase is a hash of 96 bits: counts are shuffled as packed arrays, by bins of hashes, and added up there. What is
frequent in the end is spelled out, most of it from the sample, the rest in a last pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazardlens.llm import words as wd
from hazardlens.llm.lookup import lookup
from hazardlens.llm.storage import HashFilter, hash_filter, released, save, ship

#: Share of the rows that propose, the part of its expected count that a phrase must reach there, and the least count.
SAMPLE, LOWERED, PROPOSES = 0.2, 0.75, 2
#: Bits of a filter, as a power of two: 4 MB each. A fuller filter costs time, not results.
FILTER_BITS = 25
#: Bytes of text that are counted together; bytes of text for each bin of counts; counts of a bin that are held before
#: equal ones are added up; rows of spelled phrases that are sent together.
SLICE, BIN, TOGETHER, SENT = 8 << 20, 4 << 20, 2 << 20, 200_000
#: The language of texts without one.
UNKNOWN = "und"

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*(ord(c) for c in ".,;:!?"), *range(10, 14)]] = True
_WORD = ~_BREAK
_WORD[[9, 32]] = False
#: A count as it is sent, the largest that fits, and a count as it is added up.
_ENTRY = np.dtype([("hash", "<u8"), ("other", "<u4"), ("n", "u1")])
_MOST = 255
_SUM = np.dtype([("hash", "<u8"), ("other", "<u4"), ("n", "<i8")])
_SPELLED = "lang string, size int, phrase string, hash long, other long, n long"
#: Another order of the bytes, for the second half of a hash.
_OTHER = np.arange(256, dtype=np.uint8) ^ np.uint8(0xA5)


def _phrase_hashes(words: np.ndarray) -> np.ndarray:
    """The hashes of phrases, given the hashes of their words in rows."""
    h = np.full(len(words), words.shape[1], dtype=np.uint64)
    for column in words.T:
        h = wd.mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + column)
    return h


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of whole numbers: where each distinct one first stands, how often it does, and which one stands at each place."""
    coded = pa.array(keys).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    first = np.empty(len(coded.dictionary), dtype=np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    return first, np.bincount(codes, minlength=len(first)), codes


class Border:
    """What a pass counts.

    ``known[k]`` holds the proposed phrases of k words, ``before[k]`` those of the pass before. A phrase is counted
    where both its parts are known now and were not both known before, so no two passes count the same one. Words are
    counted where ``words`` is set. A pass with ``wanted`` spells out what that holds and counts all words instead.
    """

    def __init__(self, most: int, known: dict, before: dict, words: bool, wanted: dict | None = None):
        self.most, self.known, self.before, self.words, self.wanted = most, known, before, words, wanted

    @staticmethod
    def holds(filters: dict[int, HashFilter], size: int, hashes: np.ndarray) -> np.ndarray:
        return filters[size].may_hold(hashes) if size in filters else np.zeros(len(hashes), dtype=bool)


def _joined(columns: list, sign: str) -> pa.Array:
    """Texts put together row by row, with a sign between them."""
    columns = [pa.scalar(c, pa.large_string()) if isinstance(c, str) else c for c in columns]
    return pc.binary_join_element_wise(*columns, pa.scalar(sign, pa.large_string()))


def _segments(texts: pa.Array) -> Iterator[np.ndarray]:
    """Lower-cased bytes of texts, each with a line end behind it, cut where pieces end."""
    data, _ = wd.text_bytes(_joined([texts.cast(pa.large_string()).fill_null(""), ""], "\n"))
    start = 0
    while start < len(data):
        end = start + SLICE
        if end < len(data):
            stops = np.flatnonzero(_BREAK[data[start:end]])
            while not len(stops):
                stops = end - start + np.flatnonzero(_BREAK[data[end : end + SLICE]])
                end += SLICE
            end = start + int(stops[-1]) + 1
        yield wd.LOWER[data[start:end]]
        start = end


def count_segment(data: np.ndarray, lang: str, border: Border) -> Iterator[tuple]:
    """(size, hashes, other hashes, counts, phrases) of the phrases in some bytes that the border asks for.

    The phrases are None unless they are to be spelled out; then size 0 has the count of all words.
    """
    starts, ends, _ = wd.find(data, np.array([0, len(data)]), _WORD)
    if not len(starts):
        return
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    joined = np.ascontiguousarray(data[_WORD[data]])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined))
    words = words.dictionary_encode()
    spelled, codes = words.dictionary, words.indices.to_numpy().astype(np.int64)
    sign = np.frombuffer(lang.encode() + b"\n", dtype=np.uint8)
    letters, at = wd.text_bytes(spelled)
    hashes, others = (
        wd.mix(wd.hashes(order[letters], at[:-1], at[1:]) ^ wd.hashes(order[sign], np.array([0]), np.array([len(sign)])))
        for order in (wd.IDENTITY, _OTHER)
    )
    now, counts = _phrase_hashes(hashes[:, None]), np.bincount(codes, minlength=len(spelled))
    if border.wanted is not None:
        zero = np.zeros(1, dtype=np.uint64)
        yield 0, zero, zero, np.array([len(codes)]), pa.array([""], pa.large_string())
    if border.words or border.wanted is not None:
        yield from _asked(border, 1, now, counts, np.arange(len(spelled)), spelled, [np.arange(len(spelled))], others)
    breaks = np.cumsum(_BREAK[data], dtype=np.int32)
    follows = np.append(breaks[starts[1:]] == breaks[ends[:-1] - 1], False)
    del breaks, joined, words, starts, ends
    # At each word: the number of the phrase of `size` words that begins there, or -1, and what is known of it.
    number, distinct = codes, len(spelled)
    now, then = Border.holds(border.known, 1, now), Border.holds(border.before, 1, now)
    for size in range(2, border.most + 1):
        good = (number >= 0) & now[number]
        here = np.flatnonzero(good[:-1] & good[1:] & follows[:-1])
        if not len(here):
            return
        one, two = number[here], number[here + 1]
        first, counts, which = _numbered(one * distinct + two)
        again = then[one[first]] & then[two[first]]
        places = here[first]
        columns = [codes[places + k] for k in range(size)]
        of_phrases = _phrase_hashes(np.stack([hashes[c] for c in columns], axis=1))
        new = np.flatnonzero(~again) if border.wanted is None else np.arange(len(first))
        yield from _asked(border, size, of_phrases, counts, new, spelled, columns, others)
        number, distinct = np.full(len(codes), -1, dtype=np.int64), len(first)
        number[here] = which
        now = Border.holds(border.known, size, of_phrases)
        then = Border.holds(border.before, size, of_phrases) & again


def _asked(border, size, hashes, counts, new, spelled, columns, others) -> Iterator[tuple]:
    """The ``new`` ones of distinct phrases, or those of them that are to be spelled out."""
    if border.wanted is not None:
        new = new[Border.holds(border.wanted, size, hashes[new])]
    if not len(new):
        return
    columns = [c[new] for c in columns]
    phrases = None
    if border.wanted is not None:
        phrases = [spelled.take(pa.array(c)) for c in columns]
        phrases = _joined(phrases, " ") if size > 1 else phrases[0]
    other = _phrase_hashes(np.stack([others[c] for c in columns], axis=1))
    yield size, hashes[new], other, counts[new], phrases


def _found(batches, border: Border) -> Iterator[tuple]:
    """Language and phrases of each segment of the texts of a task."""
    for batch in batches:
        for part in wd.slices(batch, limit=SLICE):
            langs = part.column("lang")
            for lang in pc.unique(langs).to_pylist():
                for data in _segments(part.column("text").filter(pc.equal(langs, lang))):
                    for found in count_segment(data, lang, border):
                        yield lang, *found


def _count(border, bins: int):
    """Counts of a segment as one row of packed bytes for each bin of hashes."""

    def run(batches):
        for _, size, hashes, others, counts, _ in _found(batches, border.value):
            entries = np.empty(len(hashes), dtype=_ENTRY)
            entries["hash"], entries["other"] = hashes, others >> np.uint64(32)
            # What does not fit an entry is told in entries of its own.
            entries["n"] = np.minimum(counts, _MOST)
            large = np.flatnonzero(counts > _MOST)
            if len(large):
                more = np.repeat(entries[large], (counts[large] - 1) // _MOST)
                ends = np.cumsum((counts[large] - 1) // _MOST) - 1
                more["n"][ends] = counts[large] - _MOST * ((counts[large] - 1) // _MOST)
                entries = np.concatenate([entries, more])
            bin_of = (entries["hash"] % np.uint64(bins)).astype(np.int64)
            order = np.argsort(bin_of.astype(np.uint16) if bins < 65536 else bin_of, kind="stable")
            entries, bin_of = entries[order], bin_of[order]
            first = np.flatnonzero(np.diff(bin_of, prepend=-1))
            data, at = entries.tobytes(), np.append(first, len(entries)) * _ENTRY.itemsize
            rows = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            sizes = pa.array(np.full(len(rows), size, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([sizes, pa.array(bin_of[first]), pa.array(rows, pa.binary())], ["size", "bin", "data"])

    return released(run)


def added_up(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, other) and the sums of their counts."""
    order = np.argsort(entries["hash"], kind="stable")
    hashes, others = entries["hash"][order], entries["other"][order]
    new = np.diff(hashes, prepend=~hashes[:1]) != 0
    if ((np.diff(others, prepend=others[:1]) != 0) & ~new).any():
        order = np.lexsort((entries["other"], entries["hash"]))
        hashes, others = entries["hash"][order], entries["other"][order]
        new = (np.diff(hashes, prepend=~hashes[:1]) != 0) | (np.diff(others, prepend=others[:1]) != 0)
    first = np.flatnonzero(new)
    return hashes[first], others[first], np.add.reduceat(entries["n"][order].astype(np.int64), first)


def _add_up(least: int):
    """The frequent phrases of bins, whose rows follow one another; equal ones meet whenever enough has come in."""

    def run(batches):
        now, held, size = None, [], 0

        def settled():
            hashes, others, n = added_up(np.concatenate(held))
            frequent = n >= least
            count = int(frequent.sum())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(count, now[0], dtype=np.int32)),
                    pa.array(hashes[frequent].view(np.int64)),
                    pa.array(others[frequent].astype(np.int64)),
                    pa.array(n[frequent]),
                ],
                ["size", "hash", "other", "n"],
            )

        for batch in batches:
            for s, b, data in zip(*(batch.column(c).to_pylist() for c in ("size", "bin", "data")), strict=True):
                if now is not None and now != (s, b):
                    yield settled()
                    held, size = [], 0
                now = s, b
                part = np.frombuffer(data, dtype=_ENTRY).astype(_SUM)
                held.append(part)
                size += len(part)
                if size > TOGETHER:
                    hashes, others, n = added_up(np.concatenate(held))
                    whole = np.empty(len(n), dtype=_SUM)
                    whole["hash"], whole["other"], whole["n"] = hashes, others, n
                    held, size = [whole], 0
        if held:
            yield settled()

    return released(run)


def _spell(border):
    def run(batches):
        for lang, size, hashes, others, counts, phrases in _found(batches, border.value):
            for k in range(0, len(hashes), SENT):
                end = k + SENT
                columns = {
                    "lang": pa.array([lang] * len(hashes[k:end]), pa.string()),
                    "size": pa.array(np.full(len(hashes[k:end]), size, dtype=np.int32)),
                    "phrase": phrases.slice(k, SENT).cast(pa.string()),
                    "hash": pa.array(hashes[k:end].view(np.int64)),
                    "other": pa.array((others[k:end] >> np.uint64(32)).astype(np.int64)),
                    "n": pa.array(counts[k:end].astype(np.int64)),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return released(run)


def _frequent(texts: DataFrame, border: Border, least: int, bins: int, name: str) -> DataFrame:
    """One pass: ``size, hash, other, n`` of the phrases that the border asks for, as often as ``least`` or more."""
    held = texts.sparkSession.sparkContext.broadcast(border)
    counts = texts.mapInArrow(_count(held, bins), "size int, bin long, data binary")
    met = counts.repartition("bin").sortWithinPartitions("bin", "size")
    out = save(met.mapInArrow(_add_up(least), "size int, hash long, other long, n long"), name)
    held.destroy()
    return out


def _spelled(texts: DataFrame, border: Border, name: str) -> DataFrame:
    """``lang, size, phrase, hash, other`` of wanted phrases; ``seen`` of size 0 is the number of all words."""
    held = texts.sparkSession.sparkContext.broadcast(border)
    keys = ["lang", "size", "phrase", "hash", "other"]
    out = save(texts.mapInArrow(_spell(held), _SPELLED).groupBy(keys).agg(F.sum("n").alias("seen")), name)
    held.destroy()
    return out


def _grown(known: dict[int, HashFilter], found: DataFrame, sizes) -> dict[int, HashFilter]:
    """The filters with the phrases of ``found`` in them as well."""
    out = dict(known)
    for k in sizes:
        more = hash_filter(found.where(F.col("size") == k), "hash", FILTER_BITS)
        out[k] = HashFilter(known[k].packed | more.packed, FILTER_BITS) if k in known else more
    return out


def frequent_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str | None = "lang",
    most: int = 3,
    least: int = 10,
    sample: float = SAMPLE,
    seed: int = 1,
) -> DataFrame:
    """``lang, size, phrase, n`` of all phrases of 1 to ``most`` words that occur ``least`` times in a language.

    The row of size 0 has the number of all words of the language. Texts have A-Z in lower case and are cut at
    ``.,;:!?`` and line ends into pieces, these at blanks and tabs into words; a phrase lies within a piece. A null or
    empty text has no words, a null language is ``und``. Repeated rows count each. An empty table gives no rows.
    Other columns are not looked at.
    """
    ship(docs.sparkSession)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)) if lang_col else F.lit(UNKNOWN)
    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    some = docs.sample(sample, seed).select(lang.alias("lang"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    lowered = max(PROPOSES, int(least * sample * LOWERED))
    bins = max(1, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BIN))
    few = max(1, int(bins * sample))
    known: dict[int, HashFilter] = {}
    for size in range(1, most):
        found = _frequent(some, Border(size, known, _upto(known, size - 2), size == 1), lowered, few, f"proposed-{size}")
        known = _grown(known, found, [size])
    before: dict[int, HashFilter] = {}
    passes = []
    while True:
        found = _frequent(texts, Border(most, known, before, not passes), least, bins, f"counted-{len(passes)}")
        passes.append(found)
        grown = _grown(known, found, range(1, most))
        if all((grown[k].packed == known[k].packed).all() for k in known):
            break
        known, before = grown, known
    counted = passes[0]
    for found in passes[1:]:
        counted = counted.union(found)
    wanted = _grown(known, counted, [most]) if most not in known else known
    # Nearly all that is frequent stands in the sample too; the pass over all rows spells out what does not.
    keys, columns = ["size", "hash", "other"], ["lang", "size", "phrase", "n"]
    there = _spelled(some, Border(most, known, {}, False, wanted), "spelled-sample").where(F.col("size") > 0)
    rest = save(counted.join(there, keys, "left_anti"), "not-spelled")
    wanted = _grown({}, rest, range(1, most + 1))
    all_rows = _spelled(texts, Border(most, known, {}, False, wanted), "spelled")
    totals = all_rows.where(F.col("size") == 0).withColumn("n", F.col("seen"))
    out = totals.select(columns)
    for asked, found in ((counted, there), (rest, all_rows.where(F.col("size") > 0))):
        out = out.union(found.join(asked, keys).select(columns))
    return out


def _upto(known: dict[int, HashFilter], size: int) -> dict[int, HashFilter]:
    """The filters of phrases of at most ``size`` words: what a pass over the sample has counted before."""
    return {k: f for k, f in known.items() if k <= size}


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str | None = "lang",
    most: int = 3,
    least: int = 10,
    covered: int = 50,
    top: int | None = 2000,
    sample: float = SAMPLE,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language by score (all, if None).

    A phrase of 2 to ``most`` words that occurs a >= ``least`` times is cut in two behind each of its words but the
    last; with l and r occurrences of the parts, the cut of the lowest floor(1000000 a a / (l r)) counts, of equal
    ones the first. A phrase is left out if a longer one that holds it occurs in ``covered`` per cent of its places
    or more. Ties in score go to the larger a, then to the phrase in the order of its bytes. Rows, nulls and empty
    tables are as in ``frequent_phrases``.
    """
    found = save(frequent_phrases(docs, text_col, lang_col, most, least, sample), "frequent")
    known = found.where(F.col("size") > 0).select("lang", "phrase", "n")
    longer = found.where(F.col("size") > 1).select("lang", "size", "phrase", F.col("n").alias("a"))
    words, k = F.split("phrase", " "), F.col("k")
    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        table = known.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        cuts = lookup(save(cuts, f"cuts-{name}"), table, ["lang", side])
    a, first, rest = (F.col(c).cast("decimal(15,0)") for c in "alr")
    cuts = cuts.withColumn("a2", (a * a).cast("decimal(31,0)")).withColumn("lr", (first * rest).cast("decimal(31,0)"))
    scored = cuts.withColumn("score", F.expr("(cast(1000000 as decimal(7,0)) * a2) div lr"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = longer.where(F.col("size") > 2).select(
        "lang",
        F.col("a").alias("outer"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda s: F.transform(
                        F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: F.array_join(F.slice(words, i, s), " ")
                    ),
                )
            )
        ).alias("phrase"),
    )
    covers = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = lowest.join(covers, ["lang", "phrase"], "left").where(
        F.col("outer").isNull() | (F.col("outer") * 100 < F.col("a") * covered)
    )
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    total = found.where(F.col("size") == 0).groupBy("lang").agg(F.sum("n").alias("n"))
    cut = [F.col(f"cut.{c}").alias(c) for c in ("l", "r")]
    return ranked.join(total, "lang").select(
        "lang", "rank", "phrase", "a", *cut, "n", F.col("cut.score").alias("score")
    )
