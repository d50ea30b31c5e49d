"""The streamed reports parse to the objects of ``report_json``."""

import json
import os

from hazardlens import analyze, report_json
from hazardlens.plans.corpora import code_files
from hazardlens.sources import report_sink
from hazardlens.sources.report_sink import stream_report_json


def objects(folder):
    out = {}
    for name in os.listdir(folder):
        with open(os.path.join(folder, name), encoding="utf-8") as source:
            for line in source:
                found = json.loads(line)
                assert found["filepath"] not in out
                out[found["filepath"]] = found
    return out


def test_equal_to_rows(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(report_sink, "TOGETHER", 2)
    odd = [("a.py", None), ("b.py", ""), ("é\".conf", 'x { token = "é\\"" }'), ("c.py", "eval(1);" * 7 + "\n\neval(2)")]
    files = code_files(spark, sf_dir).selectExpr("concat('d', doc_id, '.py') AS path", "text")
    files = files.unionByName(spark.createDataFrame(odd, "path string, text string")).repartition(5)
    reports = analyze(files)
    stream_report_json(reports, str(tmp_path / "out"))
    want = {r["filepath"]: json.loads(r["json"]) for r in report_json(reports).collect()}
    assert objects(tmp_path / "out") == want and len(want) > 100
    stream_report_json(reports.limit(0), str(tmp_path / "out"))
    assert len(objects(tmp_path / "out")) == len(want)


def test_very_many_findings_in_a_line(spark, tmp_path):
    """An object of findings times line length (40 MB) is written from rows that hold the line once."""
    count = 2_000
    files = spark.createDataFrame([("x.py", "eval(1); x" * count)], "path string, text string")
    stream_report_json(analyze(files), str(tmp_path / "out"), context_lines=0)
    (found,) = objects(tmp_path / "out").values()
    assert len(found["findings"]) == count and all(f["line"] == 1 for f in found["findings"])
    assert found["findings"][0]["excerpt"] == "    1 | " + "eval(1); x" * count
    assert found["summary"] == {"DANGEROUS_CALL": count}
