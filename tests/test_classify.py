import itertools
import random

import pytest
from pyspark.sql import functions as F

from hazardlens.operators import classify as c

K, A, P, G, I, T, U, E, D, R = (
    "HARDCODED_CRED", "AWS_KEY", "PRINT_LEAK", "LOG_LEAK", "IPv4", "TODO", "SUSPICIOUS_URL", "ENV_REF",
    "DANGEROUS_CALL", "INSECURE_REQUEST",
)
CASES = [
    ([], "SAFE", "q_start"),
    ([E], "SAFE", "q_safe"),
    ([E, E, E], "SAFE", "q_safe"),
    *(([x], "NEEDS_REVIEW", "q_review") for x in (P, I, T, U, G)),
    ([K], "NEEDS_REVIEW", "q_cred"),
    ([K, I], "NEEDS_REVIEW", "q_cred"),
    ([P, K], "NEEDS_REVIEW", "q_cred"),
    ([P, T], "NEEDS_REVIEW", "q_review"),
    ([E, T], "NEEDS_REVIEW", "q_review"),
    ([U, G], "NEEDS_REVIEW", "q_review"),
    ([K, P], "SECURITY_VIOLATION", "q_violation"),
    ([A, P], "SECURITY_VIOLATION", "q_violation"),
    ([K, G], "SECURITY_VIOLATION", "q_violation"),
    ([D], "SECURITY_VIOLATION", "q_violation"),
    ([R], "SECURITY_VIOLATION", "q_violation"),
    ([G, R], "SECURITY_VIOLATION", "q_violation"),
    ([K, K, P], "SECURITY_VIOLATION", "q_violation"),
    ([K, I, P], "SECURITY_VIOLATION", "q_violation"),
    ([K, T, P], "SECURITY_VIOLATION", "q_violation"),
    ([T, K, P], "SECURITY_VIOLATION", "q_violation"),
    ([K, P, E, T], "SECURITY_VIOLATION", "q_sink"),
    ([K, K, I, P, P], "SECURITY_VIOLATION", "q_sink"),
    (["X", "Y"], "NEEDS_REVIEW", "q_start"),
    (["X", E], "SAFE", "q_safe"),
]


def test_table_size():
    assert len(c.DEFAULT_TABLE.rows) == 60
    assert len(c.DEFAULT_TABLE.states) == 6
    assert len(c.DEFAULT_TABLE.alphabet) == 10


def test_cases(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(CASES)], "k int, tokens array<string>")
    got = {r.k: r for r in c.classify(df).collect()}
    for k, (tokens, label, state) in enumerate(CASES):
        assert (got[k].label, got[k].final_state, got[k].token_path) == (label, state, tokens)
    assert got[0].message == c.EMPTY_MESSAGE
    assert got[len(CASES) - 2].message == c.UNKNOWN_MESSAGE


def test_null_tokens(spark):
    row = c.classify(spark.sql("SELECT CAST(NULL AS array<string>) AS tokens")).first()
    assert (row.label, row.final_state, row.token_path) == ("SAFE", "q_start", [])


def test_heuristic(spark):
    df = spark.createDataFrame([([P, K],), ([K],), ([G],), ([D],), ([T],), ([],)], "tokens array<string>")
    got = [r[0] for r in df.select(c.heuristic_label(F.col("tokens"))).collect()]
    assert got == ["Security Violation", "Needs Review", "Safe", "Safe", "Needs Review", "Safe"]


def _sequences():
    one_per_class = [K, P, T, E, D, "X"]
    out = [list(s) for n in range(1, 5) for s in itertools.product(one_per_class, repeat=n)]
    rng = random.Random(5)
    for _ in range(400):
        out.append([rng.choice([K, P, G, E]) for _ in range(rng.randint(5, 9))])
        out.append([rng.choice([P, P, G, T, K]) for _ in range(rng.randint(3, 9))])
    return out


@pytest.fixture(scope="module")
def long_table(spark):
    rng = random.Random(11)
    rows = []
    for key, seq in enumerate(_sequences()):
        # ties in ts are broken by id
        rows += [(key, pos // 3, pos, token) for pos, token in enumerate(seq)]
    # one key with a third of all rows; its first leak after a credential is its very last token
    hot = [rng.choice([P, G, T, E]) for _ in range(len(rows) // 4)] + [K]
    hot += [rng.choice([T, E, K]) for _ in range(len(rows) // 4)] + [P]
    rows += [(-1, pos, pos, token) for pos, token in enumerate(hot)]
    rows += [(-2, pos, pos, token) for pos, token in enumerate(hot + [P])]
    # a key that is null
    rows += [(None, pos, pos, token) for pos, token in enumerate([P, P, K, T, P, P])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, t long, id long, token string")
    return df.withColumn("ts", F.timestamp_micros("t")).repartition(6)


def _by_fold(df):
    rows = F.array_sort(F.collect_list(F.struct("ts", "id", "token")))
    return c.classify(df.groupBy("k").agg(F.transform(rows, lambda x: x["token"]).alias("tokens")))


def _as_set(df):
    return {tuple(r) for r in df.select("k", "label", "final_state", "message").collect()}


def test_long_forms_equal_the_fold(long_table):
    want = _as_set(_by_fold(long_table))
    assert {r[2] for r in want if r[0] is not None and r[0] < 0} == {"q_violation", "q_sink"}
    assert _as_set(c.classify_long(long_table, ["k"], c.composite_order("ts", "id"))) == want
    for run_rows in (3, 17, 4096):
        assert _as_set(c.classify_long_runs(long_table, ["k"], ["ts", "id"], run_rows=run_rows)) == want


def test_runs_of_one_key_with_nearly_all_rows(spark):
    # Only the first and the last token decide; in between nothing may be lost or swapped.
    n = 20_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"),
        "id",
        F.when(F.col("id") == 1, K).when(F.col("id") == n - 1, P).otherwise(E).alias("token"),
    )
    for run_rows in (8, 100):
        got = {r.k: (r.n_tokens, r.final_state) for r in c.classify_long_runs(rows, ["k"], ["id"], run_rows=run_rows).collect()}
        assert got[-1] == (n - n // 10, "q_violation") and len(got) == 1 + n // 10


def test_a_hot_key_is_shared_out(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), "id", F.lit(E).alias("token")
    )
    tasks = c._stretches(rows.repartition(8), ["k"], ["id"], "token", c.DEFAULT_TABLE, 1000).where("k = -1")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        counts = [r._n for r in tasks.collect()]
    finally:
        spark.conf.unset(coalesce)
    assert sum(counts) == 36_000 and max(counts) < 1.5 * 40_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = c.classify_long_runs(rows, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Generate" not in plan


def test_fold_equals_steps_one_by_one():
    import numpy as np

    rng = np.random.default_rng(2)
    steps = rng.integers(0, 5, (5, 4))
    for n in (1, 2, 3, 7, 64, 501):
        codes = rng.integers(0, 4, n)
        starts = np.unique(np.append(0, rng.integers(0, n, n // 3)))
        got = c._fold(steps, codes, starts)
        for where, (a, b) in enumerate(zip(starts, np.append(starts[1:], n), strict=True)):
            for state in range(5):
                end = state
                for code in codes[a:b]:
                    end = steps[end, code]
                assert got[where, state] == end


def test_other_table(spark):
    parity = c.TransitionTable("even", (("even", "x", "odd"), ("odd", "x", "even")), {"even": "E", "odd": "O"})
    rows = [(k, pos, "x" if pos % 2 else "y") for k in range(5) for pos in range(k * 3)]
    df = spark.createDataFrame(rows, "k long, pos long, token string")
    got = {r.k: r.final_state for r in c.classify_long_runs(df, ["k"], ["pos"], table=parity, run_rows=2).collect()}
    assert got == {k: "odd" if (k * 3 // 2) % 2 else "even" for k in range(1, 5)}
