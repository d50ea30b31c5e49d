"""The named queries: each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions.rules import RULES
from hazardlens.operators import classify as c
from hazardlens.operators import config_audit as ca
from hazardlens.operators import counts as n
from hazardlens.operators import detect as d
from hazardlens.operators import report as rep
from hazardlens.operators import rewrite as rw
from hazardlens.plans.corpora import code_files, code_turns, config_files, event_tokens
from hazardlens.plans.pipeline import analyze, audit_contents
from hazardlens.sources.corpus import read_table
from hazardlens.sources.segments import cut_texts, detect_segments
from hazardlens.sources.tree import decode, decoded

Query = Callable[[SparkSession, str], DataFrame]


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.detect(code_files(spark, sf_dir))


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir).withColumn("tokens", d.tokens(F.col("findings")))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.classify(_tokens(spark, sf_dir))


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.explode_findings(_found(spark, sf_dir), "doc_id")


def label_by_source(spark, sf_dir):
    """Files and findings per source and label."""
    return (
        _classified(spark, sf_dir)
        .groupBy("source", "label")
        .agg(F.count("*").alias("files"), F.sum(F.size("findings")).alias("findings"))
    )


def findings_in_segments(spark, sf_dir):
    """The findings of files that are cut into segments of some 200 characters first."""
    segments = cut_texts(code_files(spark, sf_dir), "doc_id", size=200)
    return detect_segments(segments, "doc_id").withColumn("line", F.col("line").cast("int"))


def findings_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.explode_findings(d.detect(docs), "doc_id")


def findings_pages(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    return d.explode_findings(d.detect(pages, text="html"), "page_id")


def findings_conversations(spark, sf_dir):
    """Findings in the turns of conversations, each with a code passage behind it."""
    return d.explode_findings(d.detect(code_turns(spark, sf_dir)), "conv_id", "turn")


def _rule_query(name: str) -> Query:
    def query(spark, sf_dir):
        found = d.detect(code_files(spark, sf_dir), only=[name])
        return d.explode_findings(found, "doc_id").select("doc_id", "seq", "value", "line")

    return query


def rule_counts_by_file(spark, sf_dir):
    return n.counts_by_file(_found(spark, sf_dir), "doc_id")


def rule_counts_by_source(spark, sf_dir):
    return n.counts_by(_found(spark, sf_dir), "source")


def token_sequence(spark, sf_dir):
    return _tokens(spark, sf_dir).select("doc_id", F.array_join("tokens", ",").alias("tokens"))


def finding_lines(spark, sf_dir):
    """Distinct lines with findings, per file."""
    lines = F.array_distinct(F.transform("findings", lambda f: f["line"]))
    return (
        _found(spark, sf_dir)
        .select("doc_id", F.explode_outer(lines).alias("line"))
        .where(F.col("line").isNotNull())
    )


def finding_excerpt(spark, sf_dir):
    return d.explode_excerpts(_found(spark, sf_dir), "doc_id").select("doc_id", "seq", "excerpt")


def marked_listing(spark, sf_dir):
    return rep.listing(_found(spark, sf_dir), "doc_id")


def classify_files(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", "label", "final_state", "message")


def classify_events(spark, sf_dir):
    return c.classify_long(
        event_tokens(spark, sf_dir), ["user_id", "day"], c.composite_order("ts", "event_id")
    )


def classify_event_users(spark, sf_dir):
    return c.classify_long(event_tokens(spark, sf_dir), ["user_id"], c.composite_order("ts", "event_id"))


def classify_events_chunked(spark, sf_dir):
    return c.classify_long_runs(event_tokens(spark, sf_dir), ["user_id", "day"], ["ts", "event_id"])


def heuristic_label(spark, sf_dir):
    return _tokens(spark, sf_dir).select("doc_id", c.heuristic_label(F.col("tokens")).alias("label"))


def label_disagreement(spark, sf_dir):
    """How the label that looks at order and the one that does not go together."""
    return (
        _classified(spark, sf_dir)
        .groupBy("label", c.heuristic_label(F.col("tokens")).alias("heuristic"))
        .agg(F.count("*").alias("files"))
    )


def corpus_summary(spark, sf_dir):
    return n.corpus_summary(_classified(spark, sf_dir))


def token_actions(spark, sf_dir):
    """All actions a finding allows, by priority, and the one that is taken."""
    pairs = rw.token_actions(spark)
    per_token = pairs.groupBy(F.col("token").alias("pattern_type")).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("priority", "action"))), lambda x: x["action"]), ","
        ).alias("actions"),
        F.min_by("action", "priority").alias("action"),
    )
    return (
        _long(spark, sf_dir)
        .join(F.broadcast(per_token), "pattern_type", "left")
        .select("doc_id", "seq", "pattern_type", "actions", F.coalesce("action", F.lit(rw.PASSTHROUGH)).alias("action"))
    )


def line_actions(spark, sf_dir):
    return rw.line_actions(_found(spark, sf_dir), "doc_id").select(
        "doc_id", "line", F.array_join("actions", ",").alias("actions")
    )


def _rewrite_query(action: str) -> Query:
    def query(spark, sf_dir):
        only = {action: rw.REWRITERS[action]}
        return _changes(rw.rewrite(code_files(spark, sf_dir), rewriters=only)).select(
            "doc_id", "line_number", "original_line", "transformed_line"
        )

    return query


def _changes(rewritten: DataFrame) -> DataFrame:
    return rewritten.select("doc_id", F.inline_outer("rewrites")).where(F.col("line_number").isNotNull())


def change_log(spark, sf_dir):
    return _changes(rw.rewrite(code_files(spark, sf_dir)))


def rewritten_files(spark, sf_dir):
    return rw.rewrite(code_files(spark, sf_dir)).select(
        "doc_id",
        "language",
        "has_changes",
        F.md5(F.col("transformed_text").cast("binary")).alias("text_md5"),
        F.length("transformed_text").alias("text_length"),
    )


def suggestions(spark, sf_dir):
    return rw.suggestions(_long(spark, sf_dir))


def gate(spark, sf_dir):
    return n.gate(_found(spark, sf_dir), "doc_id").select("doc_id", "status", "message", "n_violations")


def gate_violations(spark, sf_dir):
    return d.explode_findings(d.detect(code_files(spark, sf_dir), only=n.DANGEROUS_RULES), "doc_id")


def config_pieces(spark, sf_dir):
    return ca.config_pieces_long(config_files(spark, sf_dir), "c_custkey")


def config_structure(spark, sf_dir):
    pieces = config_files(spark, sf_dir).select("c_custkey", ca.config_pieces(F.col("text")).alias("p"))
    s = F.col("s")
    return pieces.select("c_custkey", ca.structure(F.col("p")).alias("s")).select(
        "c_custkey",
        s["depth"].alias("depth"),
        s["sections"].alias("sections"),
        s["bad_at"].alias("bad_at"),
        (s["bad_at"].isNull() & (s["depth"] == 0) & (s["sections"] > 0)).alias("well_formed"),
    )


def config_entries(spark, sf_dir):
    return ca.config_entries(config_files(spark, sf_dir), "c_custkey").withColumn(
        "section_path", F.array_join("section_path", "/")
    )


def config_issues(spark, sf_dir):
    return ca.config_issues(config_files(spark, sf_dir), "c_custkey")


def config_audit(spark, sf_dir):
    return ca.config_audit(config_files(spark, sf_dir), "c_custkey").drop("errors")


def config_audit_summary(spark, sf_dir):
    return (
        ca.config_audit(config_files(spark, sf_dir), "c_custkey")
        .groupBy("is_valid", "sections_found")
        .agg(F.count("*").alias("files"), F.sum("n_errors").alias("errors"))
    )


def _all_files(spark, sf_dir) -> DataFrame:
    return code_files(spark, sf_dir).select("path", "text").union(config_files(spark, sf_dir).select("path", "text"))


def _file_report(files: DataFrame) -> DataFrame:
    return analyze(files).select(
        "filepath",
        F.size("findings").alias("findings"),
        F.size("summary").alias("rules"),
        "classification",
        "classification_state",
        F.size("transformations").alias("transformations"),
        "has_changes",
        F.col("validation.status").alias("validation"),
        F.when(F.col("validation.status") != "N/A", F.col("validation.message")).alias("validation_message"),
    )


def file_report(spark, sf_dir):
    """The whole scan over code and configuration files, in scalar columns."""
    return _file_report(_all_files(spark, sf_dir))


def file_report_json(spark, sf_dir):
    return rep.report_json(analyze(_all_files(spark, sf_dir)))


def file_report_text(spark, sf_dir):
    return rep.report_text(analyze(_all_files(spark, sf_dir)))


def decode_files(spark, sf_dir):
    """Decoding with bad files set aside: German texts get CR LF line ends, French ones a stray byte."""
    text, lang = F.col("text"), F.col("lang")
    raw = (
        F.when(lang == "fr", F.concat(text.cast("binary"), F.unhex(F.lit("FF"))))
        .when(lang == "de", F.replace(text, F.lit("\n"), F.lit("\r\n")).cast("binary"))
        .otherwise(text.cast("binary"))
    )
    contents = read_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".py")).alias("path"),
        raw.alias("content"),
        F.lit(None).cast("string").alias("reason"),
    )
    return decoded(contents).select("path", "ext", F.md5(F.col("text").cast("binary")).alias("text_md5"), "reason")


def _contents(files: DataFrame) -> DataFrame:
    """Files as they could be read: by the number in the path some are missing, broken, or have CR LF line ends."""
    text, kind = F.col("text"), F.regexp_extract("path", "[0-9]+", 0).cast("bigint") % 11
    raw = F.replace(text, F.lit("\n"), F.when(kind == 5, "\r\n").otherwise("\n")).cast("binary")
    return files.select(
        "path",
        F.when(kind != 7, F.when(kind == 3, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw)).alias("content"),
        F.when(kind == 7, "not_found").alias("reason"),
    )


def audit_read_files(spark, sf_dir):
    """From read configuration files to their audit, missing and broken ones included."""
    return audit_contents(_contents(config_files(spark, sf_dir))).drop("errors")


def file_report_read(spark, sf_dir):
    """From read files to their reports; missing and broken ones have none."""
    files, _ = decode(_contents(_all_files(spark, sf_dir)))
    return _file_report(files)


def insecure_page_urls(spark, sf_dir):
    """Plain-HTTP page addresses and their secure form."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return (
        d.explode_findings(d.detect(pages, text="url", only=["SUSPICIOUS_URL"]), "page_id")
        .select("page_id", "value", rw.use_https(F.col("value")).alias("secure"))
    )


REWRITE_QUERIES = {
    "rewrite_cred": "REWRITE_CRED",
    "rewrite_leak": "REMOVE_LEAK",
    "rewrite_ip": "FLAG_IP",
    "rewrite_https": "USE_HTTPS",
    "rewrite_tls": "ENFORCE_SSL",
}

QUERIES: dict[str, Query] = {
    "label_by_source": label_by_source,
    "findings": _long,
    "findings_in_segments": findings_in_segments,
    "findings_documents": findings_documents,
    "findings_pages": findings_pages,
    "findings_conversations": findings_conversations,
    **{f"rule_{r.name.lower()}": _rule_query(r.name) for r in RULES},
    "rule_counts_by_file": rule_counts_by_file,
    "rule_counts_by_source": rule_counts_by_source,
    "token_sequence": token_sequence,
    "finding_lines": finding_lines,
    "finding_excerpt": finding_excerpt,
    "marked_listing": marked_listing,
    "classify_files": classify_files,
    "classify_events": classify_events,
    "classify_event_users": classify_event_users,
    "classify_events_chunked": classify_events_chunked,
    "heuristic_label": heuristic_label,
    "label_disagreement": label_disagreement,
    "corpus_summary": corpus_summary,
    "token_actions": token_actions,
    "line_actions": line_actions,
    **{name: _rewrite_query(action) for name, action in REWRITE_QUERIES.items()},
    "change_log": change_log,
    "rewritten_files": rewritten_files,
    "suggestions": suggestions,
    "gate": gate,
    "gate_violations": gate_violations,
    "config_pieces": config_pieces,
    "config_structure": config_structure,
    "config_entries": config_entries,
    "config_issues": config_issues,
    "config_audit": config_audit,
    "config_audit_summary": config_audit_summary,
    "file_report": file_report,
    "file_report_json": file_report_json,
    "file_report_text": file_report_text,
    "decode_files": decode_files,
    "audit_read_files": audit_read_files,
    "file_report_read": file_report_read,
    "insecure_page_urls": insecure_page_urls,
}
