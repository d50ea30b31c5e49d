"""JSON reports written as they come: the object of a file is never held whole.

``write_report_json`` of the operators makes each object in one row, with the excerpt of a line once per finding on it.
Here a row is one line of a file with its findings and the excerpt once; the writer puts the rows of a file, which follow
one another, into one object. Part files get their names when the job commits, so that lost attempts leave none.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from hazardlens.functions.text import part
from hazardlens.operators.detect import _by_line
from hazardlens.operators.report import JSON_FIELDS

# Ship this module's code with the job, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Findings of a line that share a row; a line with more has several rows.
TOGETHER = 4096
ROWS = (
    "filepath string, first boolean, last boolean, excerpt string, "
    "found array<struct<seq:int,pattern_type:string,value:string,line:int>>, rest string"
)


def report_rows(reports: DataFrame, context_lines: int = 2) -> DataFrame:
    """``filepath, first, last, excerpt, found, rest``: per line with findings these and their excerpt, in order.

    ``rest`` has the other fields of the object, on the last row of a file only; a file without findings is one row.
    """
    lines = _by_line(F.col("findings"), F.col("source"), context_lines)
    fields = F.to_json(F.struct(*(F.col(c) for c in JSON_FIELDS if c not in ("filepath", "findings"))))
    rows = reports.select("filepath", fields.alias("_rest"), F.size("findings").alias("_n"), F.inline_outer(lines))
    size = F.size("of_line")
    cuts = F.transform(
        F.sequence(F.lit(1), F.greatest(size, F.lit(1)), F.lit(TOGETHER)),
        lambda k: F.when(size > 0, part(F.col("of_line"), k, F.least(size, k + (TOGETHER - 1)))),
    )
    rows = rows.select("filepath", "_rest", "_n", "excerpt", F.explode(cuts).alias("found"))
    last = F.coalesce(F.element_at("found", -1)["seq"] >= F.col("_n"), F.lit(True))
    first = F.coalesce(F.get("found", F.lit(0))["seq"] == 1, F.lit(True))
    return rows.select(
        "filepath", first.alias("first"), last.alias("last"), "excerpt", "found", F.when(last, F.col("_rest")).alias("rest")
    )


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


class _ReportWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path
        self.waiting = os.path.join(path, f"_waiting-{uuid.uuid4().hex}")

    def write(self, iterator) -> WriterCommitMessage:
        os.makedirs(self.waiting, exist_ok=True)
        name, out = f"part-{uuid.uuid4().hex}.json", None
        try:
            for row in iterator:
                out = out or open(os.path.join(self.waiting, name), "w", encoding="utf-8")
                if row["first"]:
                    out.write('{"filepath":' + json.dumps(row["filepath"], ensure_ascii=False) + ',"findings":[')
                excerpt = json.dumps(row["excerpt"], ensure_ascii=False)
                for f in row["found"] or ():
                    if f["seq"] > 1:
                        out.write(",")
                    known = {k: f[k] for k in ("pattern_type", "value", "line") if f[k] is not None}
                    out.write(json.dumps(known, ensure_ascii=False, separators=(",", ":"))[:-1])
                    out.write(',"excerpt":' + excerpt + "}")
                if row["last"]:
                    out.write("]" + ("," if row["rest"] != "{}" else "") + row["rest"][1:] + "\n")
        finally:
            if out:
                out.close()
        return _Written(name if out else None)

    def commit(self, messages) -> None:
        os.makedirs(self.path, exist_ok=True)
        for m in messages:
            if m is not None and m.name:
                os.replace(os.path.join(self.waiting, m.name), os.path.join(self.path, m.name))
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        if os.path.isdir(self.waiting):
            for name in os.listdir(self.waiting):
                os.remove(os.path.join(self.waiting, name))
            os.rmdir(self.waiting)


class ReportSink(DataSource):
    """``df.write.format("json_reports")`` of ``report_rows``; option ``path``: a folder on a shared mount."""

    @classmethod
    def name(cls) -> str:
        return "json_reports"

    def schema(self) -> str:
        return ROWS

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _ReportWriter(self.options["path"])


def stream_report_json(reports: DataFrame, path: str, context_lines: int = 2) -> None:
    """The objects of ``report_json``, one per line, added to a folder as a part file per task that has any.

    No task holds more of a file than its row of the report and one line with its excerpt.
    """
    reports.sparkSession.dataSource.register(ReportSink)
    report_rows(reports, context_lines).write.format("json_reports").mode("append").option("path", path).save()
