"""The corpus pipeline: documents to packed training sequences, one operator of ``hazardlens.llm`` per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.llm import decontaminate, jaccard, packing, secret_scan, toxicity
from hazardlens.llm.storage import save

#: Bytes; an executor of 3000 MB also holds its JVM and what workers keep of the stages before.
REMEMBERED = 16 << 20
#: No stage but the fourth can be said in SQL; the tests hold the result against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more of their 5-word shingles, that with the smallest id stays."""
    return jaccard.drop_near_copies(docs, words=5, num=4, den=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more lies in 13-word windows of the benchmark go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    cleaned = secret_scan.redact(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens.

    Workers that also serve the other stages remember less.
    """
    return packing.pack(docs, remembered=REMEMBERED)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
