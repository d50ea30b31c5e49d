"""Totals that are taken while the scan is written equal those of a scan of their own."""

from pyspark.sql import functions as F

from hazardlens import classify, corpus_summary, detect, tokens
from hazardlens.operators.counts import observed_summary
from hazardlens.plans.corpora import code_files


def test_observed_totals(spark, sf_dir, tmp_path):
    classified = classify(detect(code_files(spark, sf_dir)).withColumn("tokens", tokens(F.col("findings"))))
    both, totals = observed_summary(classified)
    both.select("doc_id", "label").write.parquet(str(tmp_path / "out"))
    assert totals.get == corpus_summary(classified).first().asDict()
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    empty, totals = observed_summary(classified.limit(0))
    empty.write.format("noop").mode("overwrite").save()
    assert totals.get == corpus_summary(classified.limit(0)).first().asDict()
