"""Security scans over tables of source files, configuration files and ordered events, as Spark jobs."""

from hazardlens.functions.rules import RULES, Rule
from hazardlens.operators.classify import (
    DEFAULT_TABLE,
    TransitionTable,
    classify,
    classify_long,
    classify_long_runs,
    heuristic_label,
)
from hazardlens.operators.config_audit import config_audit, config_entries, config_issues
from hazardlens.operators.counts import corpus_summary, counts_by, counts_by_file, gate, observed_summary
from hazardlens.operators.detect import detect, explode_excerpts, explode_findings, tokens
from hazardlens.operators.report import listing, report_json, report_text, write_report_json
from hazardlens.operators.rewrite import line_actions, rewrite, suggestions
from hazardlens.plans.pipeline import analyze, audit_tree
from hazardlens.sources.report_sink import stream_report_json
from hazardlens.sources.segments import cut_texts, detect_segments, read_segments
from hazardlens.sources.tree import read_tree

__all__ = [
    "DEFAULT_TABLE",
    "RULES",
    "Rule",
    "TransitionTable",
    "analyze",
    "audit_tree",
    "classify",
    "classify_long",
    "classify_long_runs",
    "config_audit",
    "config_entries",
    "config_issues",
    "corpus_summary",
    "counts_by",
    "counts_by_file",
    "cut_texts",
    "detect",
    "detect_segments",
    "explode_excerpts",
    "explode_findings",
    "gate",
    "heuristic_label",
    "line_actions",
    "listing",
    "observed_summary",
    "read_segments",
    "read_tree",
    "report_json",
    "report_text",
    "rewrite",
    "stream_report_json",
    "suggestions",
    "tokens",
    "write_report_json",
]
