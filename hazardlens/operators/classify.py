"""Classification of ordered token sequences with a state transition table.

Three forms of the same computation:

* ``classify`` folds an array column, row by row (the tokens of one file).
* ``classify_long`` works on a long table for the default table, with nothing but min/max/count per key, so
  that a key holding any share of the rows is reduced before it is shuffled.
* ``classify_long_runs`` works on a long table for any transition table: the table is cut into ranges of ordered
  rows, the rows of a key in a range are folded from every state, and the vectors of a key are composed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from hazardlens.functions.text import let

# ---- fixed values: labels, states, transitions, messages ------------------------------------------------------
SAFE, REVIEW, VIOLATION = "SAFE", "NEEDS_REVIEW", "SECURITY_VIOLATION"

TOKEN_CLASSES = {
    "cred": ("HARDCODED_CRED", "AWS_KEY"),
    "leak": ("PRINT_LEAK", "LOG_LEAK"),
    "weak": ("IPv4", "TODO", "SUSPICIOUS_URL"),
    "env": ("ENV_REF",),
    "hard": ("DANGEROUS_CALL", "INSECURE_REQUEST"),
}

# Next state by (state, token class).
NEXT_STATE = {
    "q_start": {"cred": "q_cred", "leak": "q_review", "weak": "q_review", "env": "q_safe", "hard": "q_violation"},
    "q_safe": {"cred": "q_cred", "leak": "q_review", "weak": "q_review", "env": "q_safe", "hard": "q_violation"},
    "q_review": {"cred": "q_cred", "leak": "q_review", "weak": "q_review", "env": "q_review", "hard": "q_violation"},
    "q_cred": {"cred": "q_cred", "leak": "q_violation", "weak": "q_cred", "env": "q_cred", "hard": "q_violation"},
    "q_violation": {"cred": "q_sink", "leak": "q_sink", "weak": "q_sink", "env": "q_sink", "hard": "q_sink"},
    "q_sink": {"cred": "q_sink", "leak": "q_sink", "weak": "q_sink", "env": "q_sink", "hard": "q_sink"},
}

STATE_LABEL = {
    "q_safe": SAFE,
    "q_review": REVIEW,
    "q_cred": REVIEW,
    "q_violation": VIOLATION,
    "q_sink": VIOLATION,
}

STATE_MESSAGE = {
    "q_cred": "Needs review: hardcoded credential found — waiting to see if it is leaked.",
    "q_violation": "Security violation: a hardcoded credential was found and then exposed via print() or console.log().",
    "q_review": "Needs review: suspicious patterns detected (leaked output, hardcoded IP, or TODO) but no confirmed "
    "credential leak.",
    "q_safe": "Safe: only secure environment variable references found.",
    "q_sink": "Security violation: confirmed credential leak (post-violation state).",
}
EMPTY_MESSAGE = "No security-relevant patterns detected."
UNKNOWN_MESSAGE = "Unknown state reached."

HEURISTIC = {"violation": "Security Violation", "review": "Needs Review", "safe": "Safe"}
HEURISTIC_LEAKS = ("PRINT_LEAK", "CONSOLE_LEAK")
HEURISTIC_WARNINGS = ("IPv4", "TODO")
# ---- end of fixed values --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TransitionTable:
    """``rows`` are (state, token, next state); a missing pair leaves the state as it is."""

    start: str
    rows: tuple[tuple[str, str, str], ...]
    labels: dict[str, str] = field(default_factory=dict)
    messages: dict[str, str] = field(default_factory=dict)
    other_label: str = REVIEW
    other_message: str = UNKNOWN_MESSAGE
    empty_label: str = SAFE
    empty_message: str = EMPTY_MESSAGE

    @property
    def states(self) -> list[str]:
        seen = [self.start] + [s for row in self.rows for s in (row[0], row[2])]
        return list(dict.fromkeys(seen))

    @property
    def alphabet(self) -> list[str]:
        return list(dict.fromkeys(token for _, token, _ in self.rows))

    def token_code(self, token: Column) -> Column:
        """1-based place in the alphabet, 0 for an unknown token."""
        return F.coalesce(F.array_position(F.lit(self.alphabet), token), F.lit(0)).cast("int")

    def step(self, state: Column, code: Column) -> Column:
        """Next state number; one array access, and code 0 is the identity."""
        states, width = self.states, len(self.alphabet) + 1
        flat = [k for k in range(len(states)) for _ in range(width)]
        for source, token, target in self.rows:
            flat[states.index(source) * width + self.alphabet.index(token) + 1] = states.index(target)
        return F.get(F.lit(flat), state * width + code)

    def result(self, state: Column, is_empty: Column) -> dict[str, Column]:
        """``label``, ``final_state`` and ``message`` for a state name."""

        def lookup(entries: dict[str, str], other: str) -> Column:
            out = F.when(F.lit(False), "")
            for name, value in entries.items():
                out = out.when(state == name, value)
            return out.otherwise(other)

        return {
            "label": F.when(is_empty, self.empty_label).otherwise(lookup(self.labels, self.other_label)),
            "final_state": F.when(is_empty, self.start).otherwise(state),
            "message": F.when(is_empty, self.empty_message).otherwise(lookup(self.messages, self.other_message)),
        }


DEFAULT_TABLE = TransitionTable(
    start="q_start",
    rows=tuple(
        (state, token, target)
        for state, by_class in NEXT_STATE.items()
        for cls, target in by_class.items()
        for token in TOKEN_CLASSES[cls]
    ),
    labels=STATE_LABEL,
    messages=STATE_MESSAGE,
)


def final_state(tokens: Column, table: TransitionTable = DEFAULT_TABLE) -> Column:
    """Name of the state an array of tokens ends in."""
    return F.aggregate(
        F.transform(tokens, table.token_code),
        F.lit(0),
        table.step,
        lambda s: F.get(F.lit(table.states), s),
    )


def classification(tokens: Column, table: TransitionTable = DEFAULT_TABLE) -> Column:
    """struct(label, final_state, token_path, message) of an array of tokens; a null array counts as empty."""
    path = F.coalesce(tokens, F.array().cast("array<string>"))

    def describe(both: Column) -> Column:
        parts = table.result(both["state"], F.size(both["path"]) == 0)
        return F.struct(
            parts["label"].alias("label"),
            parts["final_state"].alias("final_state"),
            both["path"].alias("token_path"),
            parts["message"].alias("message"),
        )

    return let(
        path, lambda p: let(F.struct(p.alias("path"), final_state(p, table).alias("state")), describe)
    )


def classify(df: DataFrame, tokens: str = "tokens", table: TransitionTable = DEFAULT_TABLE) -> DataFrame:
    """Add ``label``, ``final_state``, ``token_path`` and ``message``. No shuffle."""
    return df.withColumn("_c", classification(F.col(tokens), table)).select(*df.columns, "_c.*")


def heuristic_label(tokens: Column) -> Column:
    """Label that ignores order."""

    def has(names: Sequence[str]) -> Column:
        return F.arrays_overlap(tokens, F.lit(list(names)))

    cred, leak = has(TOKEN_CLASSES["cred"]), has(HEURISTIC_LEAKS)
    return (
        F.when(cred & leak, HEURISTIC["violation"])
        .when(cred | leak | has(HEURISTIC_WARNINGS), HEURISTIC["review"])
        .otherwise(HEURISTIC["safe"])
    )


def composite_order(ts: str, tie_breaker: str) -> Column:
    """One number that orders by timestamp, then by a non-negative id.

    A number, unlike a struct, can be updated in place by hash aggregation, so min and max need no sort.
    """
    micros = F.unix_micros(ts).cast("decimal(19,0)")
    return micros * F.lit("1" + "0" * 19).cast("decimal(20,0)") + F.col(tie_breaker).cast("decimal(19,0)")


def classify_long(
    df: DataFrame, key: Sequence[str], order: Column, token: str = "token", salts: int = 256
) -> DataFrame:
    """Classify each key of a long token table with the default table.

    ``order`` must be unique within a key. A key turns to violation at its first "hard" token or at the first
    leak after its first credential, whichever is earlier; the exact state asks whether anything follows. A few
    aggregates answer that, except where three or more leaks surround the first credential and the last token is
    a leak: only the leaks of those keys are read again. They meet their key's credential in ``salts`` places, so
    that a key with most of the leaks is counted by as many tasks.
    """
    key = list(key)

    def is_class(name: str) -> Column:
        return F.col(token).isin(*TOKEN_CLASSES[name])

    known = F.col(token).isin(*DEFAULT_TABLE.alphabet)
    # One struct as key: equal to itself also where a key column is null.
    rows = df.select(F.struct(*key).alias("_key"), token, order.alias("_pos"))
    facts = rows.groupBy("_key").agg(
        F.min(F.when(is_class("cred"), F.col("_pos"))).alias("_cred"),
        F.min(F.when(is_class("hard"), F.col("_pos"))).alias("_hard"),
        F.min(F.when(is_class("leak"), F.col("_pos"))).alias("_leak_first"),
        F.max(F.when(is_class("leak"), F.col("_pos"))).alias("_leak_last"),
        F.max(F.when(known, F.col("_pos"))).alias("_last"),
        F.count_if(is_class("leak")).alias("_leaks"),
        F.count_if(known & ~is_class("env")).alias("_not_env"),
        F.count("*").alias("n_tokens"),
    )
    cred, hard, last = F.col("_cred"), F.col("_hard"), F.col("_last")
    leak_after = F.coalesce(F.col("_leak_last") > cred, F.lit(False))
    unclear = (
        hard.isNull()
        & leak_after
        & (F.col("_leak_last") == last)
        & (F.col("_leaks") >= 3)
        & (F.col("_leak_first") < cred)
        # Implied by the above; with every aggregate in use, both readers of the facts share one shuffle.
        & (F.col("_not_env") >= 4)
        & (F.col("n_tokens") >= 4)
    )
    again = (
        rows.where(is_class("leak"))
        .select("_key", "_pos", F.pmod(F.xxhash64("_pos"), F.lit(salts)).cast("int").alias("_salt"))
        .join(
            facts.where(unclear).select(
                "_key", "_cred", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
            ),
            ["_key", "_salt"],
        )
        .groupBy("_key", "_salt")
        .agg(F.count_if(F.col("_pos") > cred).alias("_n"))
        .groupBy("_key")
        .agg((F.sum("_n") > 1).alias("_more_leaks"))
    )
    more_leaks = (
        F.when(F.col("_leak_first") > cred, F.col("_leaks") > 1)
        .when(F.col("_leaks") < 3, F.lit(False))
        .otherwise(F.coalesce(F.col("_more_leaks"), F.lit(False)))
    )
    state = (
        F.when(last.isNull(), "q_start")
        .when(hard < last, "q_sink")
        .when(hard.isNotNull(), F.when(leak_after, "q_sink").otherwise("q_violation"))
        .when(
            leak_after,
            F.when(F.col("_leak_last") < last, "q_sink")
            .when(more_leaks, "q_sink")
            .otherwise("q_violation"),
        )
        .when(cred.isNotNull(), "q_cred")
        .when(F.col("_not_env") == 0, "q_safe")
        .otherwise("q_review")
    )
    parts = DEFAULT_TABLE.result(F.col("_state"), F.lit(False))
    return (
        facts.join(again, "_key", "left")
        .select("_key.*", "n_tokens", state.alias("_state"))
        .select(*key, "n_tokens", *(parts[c].alias(c) for c in ("label", "final_state", "message")))
    )


FOLDED = ("_run", "_n", "_ends")


def _fold(steps: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """End state per start state for each stretch of ``codes``; ``starts`` are the places where a stretch begins.

    Neighbours are composed in pairs, turn by turn, so the work is linear and a stretch takes the logarithm of its length
    in turns.
    """
    ends = steps.T[codes]
    stretch = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(codes))))
    while len(ends) > len(starts):
        first = np.searchsorted(stretch, stretch)
        left = np.flatnonzero((np.arange(len(stretch)) - first) % 2 == 0)
        paired = left[:-1] if left[-1] == len(stretch) - 1 else left
        paired = paired[stretch[paired + 1] == stretch[paired]]
        ends[paired] = np.take_along_axis(ends[paired + 1], ends[paired], axis=1)
        ends, stretch = ends[left], stretch[left]
    return ends


def _stretches(df: DataFrame, key: Sequence[str], order: Sequence[str], token: str, table: TransitionTable, rows: int):
    """Key, ``_run``, ``_n`` and ``_ends``: the rows of a key in a partition as one vector, ``_run`` in their order.

    Partitions are ranges of (key, order), so a key has as many of them as its share of the rows asks for.
    """
    width, states = len(table.alphabet) + 1, table.states
    steps = np.repeat(np.arange(len(states), dtype=np.int32)[:, None], width, axis=1)
    for source, symbol, target in table.rows:
        steps[states.index(source), table.alphabet.index(symbol) + 1] = states.index(target)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 40
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                keys = part.select(list(range(len(key))))
                new = np.zeros(part.num_rows, dtype=bool)
                new[0] = True
                for column in keys.columns:
                    numbers = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
                    new[1:] |= numbers[1:] != numbers[:-1]
                starts = np.flatnonzero(new)
                ends = _fold(steps, part.column("_code").to_numpy(), starts)
                counts = np.diff(np.append(starts, part.num_rows))
                found = keys.take(pa.array(starts))
                # The last stretch may go on in the next rows, so it is held back.
                if held is not None:
                    if held[0].to_pylist() == found.slice(0, 1).to_pylist():
                        ends[0] = ends[0][held[2]]
                        counts[0] += held[1]
                    else:
                        yield told(held[0], run, [held[1]], held[2][None])
                        run += 1
                done = len(starts) - 1
                if done:
                    yield told(found.slice(0, done), run, counts[:done], ends[:done])
                    run += done
                held = (found.slice(done, 1), counts[done], ends[done])
        if held is not None:
            yield told(held[0], run, [held[1]], held[2][None])

    def told(keys: pa.RecordBatch, run: int, counts: Sequence[int], ends: np.ndarray) -> pa.RecordBatch:
        offsets = np.arange(len(ends) + 1, dtype=np.int32) * ends.shape[1]
        vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ends.ravel()))
        numbers = pa.array(np.arange(run, run + len(ends), dtype=np.int64))
        return pa.RecordBatch.from_arrays(
            [*keys.columns, numbers, pa.array(counts, pa.int64()), vectors], names=[*keys.schema.names, *FOLDED]
        )

    ordered = (
        df.select(*key, *order, table.token_code(F.col(token)).alias("_code"))
        .repartitionByRange(*key, *order)
        .sortWithinPartitions(*key, *order, "_code")
        .select(*key, "_code")
    )
    schema = StructType(
        [StructField(f.name, f.dataType) for f in ordered.schema.fields[:-1]]
        + [
            StructField(name, kind)
            for name, kind in zip(FOLDED, (LongType(), LongType(), ArrayType(IntegerType())), strict=True)
        ]
    )
    return ordered.mapInArrow(fold, schema)


def classify_long_runs(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    token: str = "token",
    table: TransitionTable = DEFAULT_TABLE,
    run_rows: int = 65536,
) -> DataFrame:
    """Classify each key of a long token table with any transition table.

    Rows are shuffled once, to ranges of (key, order). Each task folds its sorted rows, ``run_rows`` at a time, to one
    vector per key, the end state for each start state; vectors are composed per key in the order of the ranges. So a key
    has at most one vector per partition, whatever its number of rows. Rows of equal order are taken by token.
    """
    key = list(key)
    composed = (
        _stretches(df, key, order, token, table, run_rows)
        .groupBy(*key)
        .agg(F.sum("_n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("_run", "_ends"))).alias("_runs"))
        .select(
            *key,
            "n_tokens",
            F.aggregate("_runs", F.lit(0), lambda state, r: F.get(r["_ends"], state)).alias("_number"),
        )
        .select(*key, "n_tokens", F.get(F.lit(table.states), F.col("_number")).alias("_state"))
    )
    parts = table.result(F.col("_state"), F.lit(False))
    return composed.select(*key, "n_tokens", *(parts[c].alias(c) for c in ("label", "final_state", "message")))


def transitions(spark, table: TransitionTable = DEFAULT_TABLE) -> DataFrame:
    """The transition table as a relation."""
    return spark.createDataFrame(list(table.rows), "state string, token string, next_state string")
