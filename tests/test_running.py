import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hazardlens.operators.classify import TransitionTable, classify_long, composite_order
from hazardlens.plans.corpora import event_tokens
from hazardlens.streaming.running import running_labels

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    yield spark
    spark.conf.set(PROVIDER, before)


def run(stream, folder):
    out = str(folder / "out")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(folder / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return out


def one_file_per_batch(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def last_of(rows, key):
    return rows.groupBy(*key).agg(F.max_by(F.struct("n_tokens", "label", "final_state"), "interval_end").alias("x")).select(
        *key, "x.*"
    )


def test_final_states_equal_the_table_form(rocks, sf_dir, tmp_path):
    tokens = event_tokens(rocks, sf_dir)
    # whole seconds and few event numbers: many rows of equal time
    tied = tokens.withColumn("ts", F.date_trunc("hour", "ts"))
    path = str(tmp_path / "events")
    first, last = tied.agg(F.min("ts"), F.max("ts")).first()
    middle = first + (last - first) / 2
    tied.where(F.col("ts") < middle).coalesce(1).write.parquet(path)
    tied.where(F.col("ts") >= middle).coalesce(1).write.mode("append").parquet(path)
    end = tied.limit(1).select(F.lit(-1).cast("long").alias("user_id"), "day", F.lit(last + dt.timedelta(days=400)).alias("ts"), "event_id", "token")
    end.coalesce(1).write.mode("append").parquet(path)
    stream = one_file_per_batch(rocks, tied.schema, path)
    got = running_labels(stream, ["user_id"], ["ts", "event_id"], interval="1 day", watermark="1 hour")
    out = rocks.read.parquet(run(got, tmp_path)).where("user_id >= 0")
    want = classify_long(tied, ["user_id"], composite_order("ts", "event_id")).select(
        "user_id", "n_tokens", "label", "final_state"
    )
    assert out.count() > want.count() > 10
    assert sorted(map(tuple, last_of(out, ["user_id"]).collect())) == sorted(map(tuple, want.collect()))


PARITY = TransitionTable("even", (("even", "x", "odd"), ("odd", "x", "even")), {"even": "E", "odd": "O"})


def write_batches(spark, path, batches):
    for batch in batches:
        frame = spark.createDataFrame(batch, "k string, minute int, id long, token string")
        stamped = frame.withColumn("ts", F.timestamp_seconds(F.col("minute") * 60 + 1_700_000_040)).drop("minute")
        stamped.coalesce(1).write.mode("append").parquet(path)
    return stamped.schema


def test_order_between_batches_nulls_and_late_rows(rocks, tmp_path):
    path = str(tmp_path / "in")
    rng = random.Random(3)
    early = [(k, rng.randint(0, 30), n, rng.choice("xy")) for n, k in enumerate(["a", "b", None] * 40)]
    rng.shuffle(early)
    schema = write_batches(
        rocks, path, [early, [("end", 100, 0, "x")], [("a", 5, 999, "x"), ("a", 120, 1000, "x")], [("end", 900, 1, "x")]]
    )
    stream = one_file_per_batch(rocks, schema, path)
    got = running_labels(stream, ["k"], ["ts", "id"], watermark="10 minutes", table=PARITY)
    out = rocks.read.parquet(run(got, tmp_path))
    last = {r.k: (r.n_tokens, r.final_state) for r in last_of(out, ["k"]).collect()}
    for k in ("a", "b", None):
        kept = [t for key, _, _, t in early if key == k] + (["x"] if k == "a" else [])
        # the row of minute 5 came after minute 100 less 10 and takes no part
        assert last[k] == (len(kept), "odd" if kept.count("x") % 2 else "even")
    assert out.groupBy("k", "interval_end").count().where("count > 1").count() == 0


def test_idle_keys_are_let_go_and_begin_anew(rocks, tmp_path):
    path = str(tmp_path / "in")
    schema = write_batches(
        rocks, path,
        [[("a", 0, 0, "x")], [("b", 30, 1, "x")], [("b", 200, 2, "x")], [("a", 201, 3, "y")], [("b", 400, 4, "x")]],
    )
    stream = one_file_per_batch(rocks, schema, path)
    got = running_labels(stream, ["k"], ["ts", "id"], watermark="1 minute", idle_seconds=3600, table=PARITY)
    out = rocks.read.parquet(run(got, tmp_path)).where("k = 'a'")
    rows = [(r.n_tokens, r.final_state, r.closed) for r in out.orderBy("interval_end", "closed").collect()]
    assert rows[:3] == [(1, "odd", False), (1, "odd", True), (1, "even", False)]
