import pytest
from pyspark.sql import functions as F

from hazardlens import analyze
from hazardlens.operators.classify import classify_long, composite_order
from hazardlens.plans.corpora import code_files, event_tokens
from hazardlens.streaming.jobs import findings_per_window, session_labels


def run(stream, spark, name, mode="append"):
    query = (
        stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(name)


@pytest.fixture(scope="module")
def stamped(spark, sf_dir, tmp_path_factory):
    """Code files with a time, as a folder of files a stream can read."""
    out = str(tmp_path_factory.mktemp("stream") / "files")
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    files = code_files(spark, sf_dir).withColumn("ts", start + F.make_interval(mins=F.col("doc_id").cast("int")))
    files.repartition(4).write.parquet(out)
    return out, spark.read.parquet(out).schema


def test_rowwise_operators_take_a_stream(spark, stamped):
    path, schema = stamped
    columns = ["filepath", "classification_state", "transformed_source"]
    streamed = run(analyze(spark.readStream.schema(schema).parquet(path)).select(columns), spark, "reports")
    batch = analyze(spark.read.parquet(path)).select(columns)
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_findings_per_window(spark, stamped):
    path, schema = stamped
    late = "100 days"
    streamed = run(
        findings_per_window(spark.readStream.schema(schema).parquet(path), watermark=late), spark, "w", "complete"
    )
    batch = findings_per_window(spark.read.parquet(path), watermark=late)
    assert streamed.count() > 10
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_session_labels(spark, sf_dir, tmp_path):
    path = str(tmp_path / "events")
    tokens = event_tokens(spark, sf_dir)
    # an event far ahead lets the watermark close every other session
    last = tokens.limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 400 DAYS"))
    tokens.repartition(1).write.parquet(path)
    last.withColumn("user_id", F.lit(-1).cast("long")).write.mode("append").parquet(path)
    stream = spark.readStream.schema(tokens.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = run(session_labels(stream, ["user_id"], watermark="60 days"), spark, "s").where("user_id >= 0")
    got.select("user_id", "session_start", "session_end", "label", "n_tokens").write.parquet(str(tmp_path / "sessions"))
    sessions = spark.read.parquet(str(tmp_path / "sessions"))
    joined = tokens.join(sessions.drop("label"), "user_id").where("ts >= session_start AND ts < session_end")
    want = classify_long(joined, ["user_id", "session_start"], composite_order("ts", "event_id"))
    assert sessions.count() > 500
    assert sorted(tuple(r) for r in sessions.select("user_id", "session_start", "label", "n_tokens").collect()) == sorted(
        tuple(r) for r in want.select("user_id", "session_start", "label", "n_tokens").collect()
    )
