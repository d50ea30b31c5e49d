"""SQL that computes the registered queries a second way, for checking results.

It uses a regular-expression dialect without lookaround, window sums instead of array scans, and the closed form
of the transition table instead of a fold. Where a rule forbids something after ``=``, a control character is put
there first and excluded from what may follow; it is taken out of the values again.
"""

from __future__ import annotations

from hazardlens.plans.corpora import CODE_FILES_SQL, CODE_TURNS_SQL, CONFIG_FILES_SQL, EVENT_TOKENS_SQL

# ---- fixed values: the patterns in the dialect of the check ---------------------------------------------------
_WORDS = "password|passwd|pwd|secret|api[_-]?key|token|credential"
_LEAK_WORDS = "password|api[_-]?key|token|secret|pwd|credential"
_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d\d?)"
_IP = rf"\b(?:{_OCTET}\.){{3}}{_OCTET}\b"
_PATTERNS = {
    "AWS_KEY": r"AKIA[0-9A-Z]{16}",
    "HARDCODED_CRED": rf"(?:{_WORDS})\s*=\s*(?:\"[^\"]{{2,}}\"|'[^']{{2,}}'|[^\s'\"${{\x03][^\s]{{2,}})",
    "PRINT_LEAK": rf"print\s*\(\s*(?:f?[\"'].*?)?(?:{_LEAK_WORDS})\w*\s*\)",
    "IPv4": _IP,
    "ENV_REF": r"os\.(?:getenv|environ)\s*[\[(][\"']?\w+[\"']?[\])]",
    "TODO": r"#\s*TODO[^\n]*",
    "SUSPICIOUS_URL": r"http://[^\s'\"]+",
    "LOG_LEAK": rf"logging\.(?:info|debug|warning|error)\s*\(\s*[^)]*(?:{_LEAK_WORDS})\w*[^)]*\)",
    "DANGEROUS_CALL": r"(?:eval|exec|pickle\.loads)\s*\(",
    "INSECURE_REQUEST": r"verify\s*=\s*False",
}
_CONFIG = (
    r"([^\W\d]\w*)[ \t\n\r]*\{|([^\W\d]\w*)[ \t\n\r]*=[ \t\n\r]*(?:\$\{[ \t\n\r]*([^\W\d]\w*)[ \t\n\r]*\}"
    # A string ends at its first quote without a backslash before it; no shape has a string without such a quote.
    r"|(\"(?:[^\"\\]|\\+[^\"\\]|\\+\")*\"|'(?:[^'\\]|\\+[^'\\]|\\+')*')|([-+]?[0-9]+\b)|(true|false))[ \t\n\r]*;"
    r"|(\})|([^ \t\n\r](?s:.*))"
)
_IN_PLACE_OUTSIDE = r"^(?:[^\W\d]\w*[ \t\n\r]*)?"
_IN_PLACE_INSIDE = (
    r"^(?:[^\W\d]\w*[ \t\n\r]*(?:=[ \t\n\r]*(?:(?:\$\{[ \t\n\r]*[^\W\d]\w*[ \t\n\r]*\}"
    r"|\"(?:[^\"\\]|\\+[^\"\\]|\\+\")*\"|'(?:[^'\\]|\\+[^'\\]|\\+')*'|[-+]?[0-9]+\b|(?:true|false)\b)[ \t\n\r]*)?)?)?"
)
# ---- end of fixed values --------------------------------------------------------------------------------------

_MASTER = "(?i)" + "|".join(f"({p})" for p in _PATTERNS.values())
_CRED_LINE = (
    rf"(?i)(\s*)((?:{_WORDS})\w*)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s'\"${{\x03][^\s]*)"
)
_OUTPUT_LINE = r"(?i)(\s*)(?:print|logging\.(?:info|debug|warning|error))\s*\(.*?\)"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _fence(text: str) -> str:
    return rf"regexp_replace({text}, '(=\s*)(os\.(?:getenv|environ)|process\.env)', '\1' || chr(3) || '\2', 'gi')"


def _newlines(text: str) -> str:
    return f"(len({text}) - len(replace({text}, chr(10), '')))"


def _findings(base: str, keys: str) -> str:
    """CTEs ``files`` and ``findings`` (keys, seq, pattern_type, value, line) over ``base`` (keys, text)."""
    groups = ", ".join(
        f"regexp_extract_all(t, {_q(_MASTER)}, {k}) AS g{k}" for k in range(len(_PATTERNS) + 1)
    )
    kind = " ".join(f"WHEN coalesce(g{k}[i], '') <> '' THEN '{name}'" for k, name in enumerate(_PATTERNS, 1))
    by = f"(PARTITION BY {keys} ORDER BY i"
    return f"""
files AS ({base}),
hits AS (SELECT {keys}, {groups}, regexp_split_to_array(t, {_q(_MASTER)}) AS gaps
  FROM (SELECT {keys}, {_fence('text')} AS t FROM files)),
each AS (SELECT {keys}, i, g0[i] AS m, gaps[i] AS gap, CASE {kind} END AS pattern_type
  FROM (SELECT *, unnest(range(1, len(g0) + 1)) AS i FROM hits)),
findings AS (SELECT {keys}, CAST(i AS INTEGER) AS seq, pattern_type,
  regexp_replace(replace(m, chr(3), ''), '^\\s+|\\s+$', '', 'g') AS value,
  CAST(1 + sum({_newlines('gap')}) OVER {by})
    + coalesce(sum({_newlines('m')}) OVER {by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER)
    AS line
  FROM each)"""


_CODE = "WITH " + _findings(CODE_FILES_SQL, "doc_id")

_CRED = "token IN ('HARDCODED_CRED', 'AWS_KEY')"
_LEAK = "token IN ('PRINT_LEAK', 'LOG_LEAK')"
_HARD = "token IN ('DANGEROUS_CALL', 'INSECURE_REQUEST')"
_MESSAGE = """CASE final_state
  WHEN 'q_cred' THEN 'Needs review: hardcoded credential found — waiting to see if it is leaked.'
  WHEN 'q_violation' THEN 'Security violation: a hardcoded credential was found and then exposed via print() or console.log().'
  WHEN 'q_review' THEN 'Needs review: suspicious patterns detected (leaked output, hardcoded IP, or TODO) but no confirmed credential leak.'
  WHEN 'q_safe' THEN 'Safe: only secure environment variable references found.'
  WHEN 'q_sink' THEN 'Security violation: confirmed credential leak (post-violation state).'
  ELSE 'Unknown state reached.' END"""
_LABEL = """CASE WHEN final_state = 'q_safe' THEN 'SAFE'
  WHEN final_state IN ('q_violation', 'q_sink') THEN 'SECURITY_VIOLATION' ELSE 'NEEDS_REVIEW' END"""


def _states(tokens: str, keys: str) -> str:
    """CTE ``states`` (keys, n_tokens, final_state) from a relation (keys, pos, token) by the closed form."""
    on = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    names = ", ".join(f"a.{k.strip()}" for k in keys.split(","))
    return f"""
known AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY pos) AS k FROM {tokens} WHERE token <> 'CLICK'),
marks AS (SELECT {keys}, max(k) AS n, min(k) FILTER ({_CRED}) AS cred, min(k) FILTER ({_HARD}) AS hard,
  bool_and(token = 'ENV_REF') AS only_env FROM known GROUP BY {keys}),
leaks AS (SELECT {names}, min(a.k) AS leak FROM known a JOIN marks b ON {on} AND a.k > b.cred
  WHERE {_LEAK} GROUP BY {names}),
totals AS (SELECT {keys}, count(*) AS n_tokens FROM {tokens} GROUP BY {keys}),
states AS (SELECT {keys}, n_tokens, CASE
    WHEN n IS NULL THEN 'q_start'
    WHEN least(hard, leak) = n THEN 'q_violation'
    WHEN least(hard, leak) < n THEN 'q_sink'
    WHEN cred IS NOT NULL THEN 'q_cred'
    WHEN only_env THEN 'q_safe' ELSE 'q_review' END AS final_state
  FROM totals LEFT JOIN marks USING ({keys}) LEFT JOIN leaks USING ({keys}))"""


def _labels(files: str = "files", keys: str = "doc_id") -> str:
    """CTE ``labels_`` (keys, label, final_state, message): every file, also those without findings."""
    return f"""
tokens AS (SELECT {keys}, seq AS pos, pattern_type AS token FROM findings),{_states('tokens', keys)},
labels_ AS (SELECT {keys}, coalesce(label, 'SAFE') AS label, coalesce(final_state, 'q_start') AS final_state,
    coalesce(message, 'No security-relevant patterns detected.') AS message
  FROM {files} LEFT JOIN (SELECT *, {_LABEL} AS label, {_MESSAGE} AS message FROM states) USING ({keys}))"""


_CODE_LABELS = _CODE + "," + _labels()

_HEURISTIC = """heuristic AS (SELECT doc_id, CASE
    WHEN bool_or(pattern_type IN ('HARDCODED_CRED', 'AWS_KEY')) AND bool_or(pattern_type = 'PRINT_LEAK')
      THEN 'Security Violation'
    WHEN bool_or(pattern_type IN ('HARDCODED_CRED', 'AWS_KEY', 'PRINT_LEAK', 'IPv4', 'TODO')) THEN 'Needs Review'
    ELSE 'Safe' END AS label FROM files LEFT JOIN findings USING (doc_id) GROUP BY doc_id)"""

_ACTION = """CASE WHEN pattern_type IN ('HARDCODED_CRED', 'AWS_KEY') THEN 'REWRITE_CRED'
  WHEN pattern_type IN ('PRINT_LEAK', 'LOG_LEAK') THEN 'REMOVE_LEAK' WHEN pattern_type = 'IPv4' THEN 'FLAG_IP'
  WHEN pattern_type = 'SUSPICIOUS_URL' THEN 'USE_HTTPS' WHEN pattern_type = 'INSECURE_REQUEST' THEN 'ENFORCE_SSL'
  ELSE 'PASSTHROUGH' END"""


def _rewritten_cred(line: str) -> str:
    fenced, pattern = _fence(line), _q(_CRED_LINE)

    def group(k: int) -> str:
        return f"regexp_extract_all({fenced}, {pattern}, {k})[i]"

    rebuilt = (
        f"array_to_string(list_transform(range(1, len(regexp_split_to_array({fenced}, {pattern})) + 1), lambda i: "
        f"regexp_split_to_array({fenced}, {pattern})[i] || coalesce({group(1)} || {group(2)} || ' = os.getenv(\"' || "
        f"upper(replace({group(2)}, '-', '_')) || '\")', '')), '')"
    )
    return f"replace({rebuilt}, chr(3), '')"


_STEPS = {
    "REWRITE_CRED": _rewritten_cred("l"),
    "REMOVE_LEAK": rf"regexp_replace(l, {_q(_OUTPUT_LINE)}, '\1# [REDACTED] sensitive output removed', 'g')",
    "FLAG_IP": f"regexp_replace(l, {_q(_IP)}, '<HOST_PLACEHOLDER>', 'g')",
    "USE_HTTPS": "replace(l, 'http://', 'https://')",
    "ENFORCE_SSL": r"regexp_replace(l, 'verify\s*=\s*False', 'verify=True', 'g')",
}


def _changes(files: str = "files", keys: str = "doc_id", only: str | None = None) -> str:
    """CTE ``changes``: lines with findings after their actions, applied in order; ``only`` one action's rewriter."""
    steps = " ".join(f"WHEN a = '{k}' THEN {v}" for k, v in _STEPS.items() if only in (None, k))
    return f"""
per_line AS (SELECT {keys}, line, list({_ACTION} ORDER BY seq) AS actions, list(pattern_type ORDER BY seq) AS kinds
  FROM findings GROUP BY {keys}, line),
applied AS (SELECT {keys}, line, actions, kinds, string_split(text, chr(10))[line] AS before,
    list_reduce(list_concat([string_split(text, chr(10))[line]], actions),
      lambda l, a: CASE {steps} ELSE l END) AS after
  FROM per_line JOIN {files} USING ({keys})),
changes AS (SELECT {keys}, line AS line_number, before AS original_line, after AS transformed_line,
  actions[1] AS action, kinds[1] AS token_type FROM applied WHERE before <> after)"""


def _lines(key: str = "doc_id") -> str:
    """CTEs ``lines`` (key, line, text) and ``excerpts`` (key, seq, excerpt)."""
    return f"""
lines AS (SELECT {key}, CAST(i AS INTEGER) AS line, l[i] AS text FROM (
  SELECT {key}, l, unnest(range(1, len(l) + 1 - CASE WHEN l[len(l)] = '' THEN 1 ELSE 0 END)) AS i FROM (
    SELECT {key}, string_split(text, chr(10)) AS l FROM files))),
excerpts AS (SELECT {key}, seq, string_agg(printf('  %3d | %s', l.line, l.text), chr(10) ORDER BY l.line) AS excerpt
  FROM findings f JOIN lines l USING ({key}) WHERE l.line BETWEEN f.line - 2 AND f.line + 2 GROUP BY {key}, seq)"""


_CONFIG_GROUPS = ", ".join(f"regexp_extract_all(text, {_q(_CONFIG)}, {k}) AS g{k}" for k in range(9))


def _pieces(base: str, key: str) -> str:
    """CTEs ``configs``, ``pieces`` (key, pos, kind, key, value_kind, value, char_offset) and ``walked``."""
    by = f"(PARTITION BY {key} ORDER BY i"
    return f"""
configs AS ({base}),
cut AS (SELECT *, unnest(range(1, len(g0) + 1)) AS i FROM (
  SELECT {key}, {_CONFIG_GROUPS}, regexp_split_to_array(text, {_q(_CONFIG)}) AS gaps FROM configs
  WHERE regexp_matches(text, {_q(_CONFIG)}))),
named AS (SELECT *,
    CASE WHEN g1[i] <> '' THEN 'OPEN' WHEN g2[i] <> '' THEN 'ASSIGN' WHEN g7[i] <> '' THEN 'CLOSE' ELSE 'BAD' END AS kind,
    CASE WHEN coalesce(g2[i], '') = '' THEN NULL WHEN g3[i] <> '' THEN 'ENV_REF' WHEN g4[i] <> '' THEN 'STRING'
      WHEN g5[i] <> '' THEN 'INT' ELSE 'BOOL' END AS value_kind,
    CAST(sum(len(gaps[i])) OVER {by})
      + coalesce(sum(len(g0[i])) OVER {by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS starts_at
  FROM cut),
pieces AS (SELECT {key}, CAST(i - 1 AS INTEGER) AS pos, kind,
    CASE kind WHEN 'OPEN' THEN g1[i] WHEN 'ASSIGN' THEN g2[i] END AS key, value_kind,
    CASE value_kind WHEN 'ENV_REF' THEN g3[i] WHEN 'STRING' THEN substr(g4[i], 2, len(g4[i]) - 2)
      WHEN 'INT' THEN g5[i] WHEN 'BOOL' THEN g6[i] END AS value,
    starts_at AS char_offset FROM named),
walked AS (SELECT *, lag(kind) OVER {by.replace('ORDER BY i', 'ORDER BY pos')}) AS previous,
    CAST(sum(CASE kind WHEN 'OPEN' THEN 1 WHEN 'CLOSE' THEN -1 ELSE 0 END) OVER {by.replace('ORDER BY i', 'ORDER BY pos')})
      AS INTEGER) AS depth FROM pieces),
checked AS (SELECT *, kind = 'BAD' OR depth < 0 OR (kind = 'ASSIGN' AND depth < 1)
    OR (kind = 'CLOSE' AND previous = 'OPEN') AS misplaced FROM walked),
shape AS (SELECT {key}, CAST(max_by(depth, pos) AS INTEGER) AS depth,
    CAST(count(*) FILTER (kind = 'OPEN' AND depth = 1) AS INTEGER) AS sections,
    min(char_offset) FILTER (misplaced) AS bad_at, min_by(depth, char_offset) FILTER (misplaced) AS bad_depth FROM checked GROUP BY {key}),
structure AS (SELECT {key}, text, coalesce(depth, 0) AS depth, coalesce(sections, 0) AS sections, bad_at, bad_depth,
    bad_at IS NULL AND coalesce(depth, 0) = 0 AND coalesce(sections, 0) > 0 AS well_formed
  FROM configs LEFT JOIN shape USING ({key})),
insecure AS (SELECT {key}, pos, key, char_offset FROM pieces JOIN structure USING ({key})
  WHERE well_formed AND kind = 'ASSIGN' AND value_kind <> 'ENV_REF' AND lower(key) IN ('password', 'passwd', 'pwd',
    'secret', 'api_key', 'token', 'credential', 'db_password', 'api_secret')),
spots AS (SELECT *, regexp_matches(text, '^\\s*$') AS blank, substr(text, 1, coalesce(bad_at + len(
    CASE WHEN bad_depth = 0 THEN regexp_extract(substr(text, bad_at + 1), {_q(_IN_PLACE_OUTSIDE)})
      ELSE regexp_extract(substr(text, bad_at + 1), {_q(_IN_PLACE_INSIDE)}) END), len(text))) AS prefix
  FROM structure),
audit AS (SELECT {key}, NOT blank AND well_formed AND coalesce(n, 0) = 0 AS is_valid,
    CAST(CASE WHEN NOT blank AND well_formed THEN sections ELSE 0 END AS INTEGER) AS sections_found,
    CAST(CASE WHEN blank OR NOT well_formed THEN 1 ELSE coalesce(n, 0) END AS INTEGER) AS n_errors,
    CASE WHEN blank THEN 'Configuration is empty'
      WHEN NOT well_formed THEN 'Syntax error at line ' || line || ', col ' || col
      WHEN n > 0 THEN 'Found ' || n || ' insecure key(s)'
      ELSE 'Valid configuration with ' || sections || ' section(s)' END AS message,
    blank, well_formed, line, col
  FROM (SELECT *, 1 + {_newlines('prefix')} AS line,
      1 + len(string_split(prefix, chr(10))[-1]) AS col FROM spots)
    LEFT JOIN (SELECT {key}, count(*) AS n FROM insecure GROUP BY {key}) USING ({key}))"""


def _issues(key: str) -> str:
    """CTE ``issues`` (key, error_no, message, line, column)."""
    return f"""
issues AS (SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY pos) - 1 AS INTEGER) AS error_no,
  'Sensitive key \'\'' || key || '\'\' must use env var reference (${{...}}), got literal value instead' AS message,
  char_offset AS line, CAST(0 AS INTEGER) AS column FROM insecure
UNION ALL SELECT {key}, 0, CASE WHEN blank THEN 'Empty configuration' ELSE message END,
  CAST(CASE WHEN blank THEN 1 ELSE line END AS INTEGER), CAST(CASE WHEN blank THEN 1 ELSE col END AS INTEGER)
  FROM audit WHERE blank OR NOT well_formed)"""


_CONFIGS = "WITH " + _pieces(CONFIG_FILES_SQL, "c_custkey")

# Section paths by walking the pieces of a text one after the other.
_ENTRIES = (
    "WITH RECURSIVE "
    + _pieces(CONFIG_FILES_SQL, "c_custkey")
    + """,
ok AS (SELECT p.* FROM walked p JOIN structure USING (c_custkey) WHERE well_formed),
walk AS (
  SELECT c_custkey, pos, kind, [key] AS inside, [key] AS path FROM ok WHERE pos = 0
  UNION ALL
  SELECT o.c_custkey, o.pos, o.kind,
    CASE o.kind WHEN 'OPEN' THEN list_append(w.inside, o.key) WHEN 'CLOSE' THEN w.inside[1:len(w.inside) - 1]
      ELSE w.inside END,
    CASE o.kind WHEN 'OPEN' THEN list_append(w.inside, o.key) ELSE w.inside END
  FROM walk w JOIN ok o ON o.c_custkey = w.c_custkey AND o.pos = w.pos + 1)
SELECT c_custkey, pos, kind, key, value_kind, value, char_offset, depth, array_to_string(path, '/') AS section_path
FROM ok JOIN (SELECT c_custkey, pos, path FROM walk) USING (c_custkey, pos) WHERE kind IN ('OPEN', 'ASSIGN')"""
)

_EVENTS = f"WITH events_ AS ({EVENT_TOKENS_SQL}), sequence AS (SELECT user_id, day, (ts, event_id) AS pos, token FROM events_)"
_EVENT_RESULT = f"n_tokens, {_LABEL} AS label, final_state, {_MESSAGE} AS message FROM states"
_EVENTS_BY_DAY = f"{_EVENTS},{_states('sequence', 'user_id, day')} SELECT user_id, day, {_EVENT_RESULT}"

_SUGGESTION = """CASE pattern_type
  WHEN 'HARDCODED_CRED' THEN trim(string_split(value, '=')[1], ' ' || chr(9) || chr(10)) || ' = os.getenv("'
    || upper(trim(string_split(value, '=')[1], ' ' || chr(9) || chr(10))) || '")'
  WHEN 'AWS_KEY' THEN 'os.getenv("AWS_ACCESS_KEY_ID")'
  WHEN 'PRINT_LEAK' THEN '# [REMOVED] sensitive output' WHEN 'LOG_LEAK' THEN '# [REMOVED] sensitive output'
  WHEN 'IPv4' THEN 'os.getenv("SERVER_HOST")' WHEN 'SUSPICIOUS_URL' THEN replace(value, 'http://', 'https://')
  WHEN 'INSECURE_REQUEST' THEN 'verify=True' WHEN 'DANGEROUS_CALL' THEN '# DANGER: ' || value END"""
_REASON = """CASE pattern_type WHEN 'HARDCODED_CRED' THEN 'MOVE_CREDENTIAL_TO_ENV' WHEN 'AWS_KEY' THEN 'MOVE_AWS_KEY_TO_ENV'
  WHEN 'PRINT_LEAK' THEN 'REMOVE_SENSITIVE_OUTPUT' WHEN 'LOG_LEAK' THEN 'REMOVE_SENSITIVE_OUTPUT'
  WHEN 'IPv4' THEN 'MOVE_HOST_TO_CONFIG' WHEN 'SUSPICIOUS_URL' THEN 'USE_HTTPS'
  WHEN 'INSECURE_REQUEST' THEN 'VERIFY_CERTIFICATES' WHEN 'DANGEROUS_CALL' THEN 'AVOID_CODE_EXECUTION' END"""
_DANGEROUS = (
    "pattern_type IN ('HARDCODED_CRED', 'AWS_KEY', 'PRINT_LEAK', 'LOG_LEAK', 'DANGEROUS_CALL', 'INSECURE_REQUEST')"
)

_ALL_FILES = (
    f"SELECT path AS file, text FROM ({CODE_FILES_SQL}) UNION ALL SELECT path AS file, text FROM ({CONFIG_FILES_SQL})"
)

_REPORT = (
    "WITH "
    + _findings(_ALL_FILES, "file")
    + ","
    + _labels(keys="file")
    + ","
    + _changes(keys="file")
    + ","
    + _pieces("SELECT file, text FROM files WHERE file LIKE '%.conf'", "file")
)

ORACLES: dict[str, str] = {
    "label_by_source": _CODE_LABELS
    + " SELECT source, label, count(*) AS files, CAST(sum(coalesce(n, 0)) AS BIGINT) AS findings FROM files"
    " JOIN labels_ USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM findings GROUP BY doc_id)"
    " USING (doc_id) GROUP BY source, label",
    "findings": _CODE + " SELECT * FROM findings",
    "findings_in_segments": _CODE + " SELECT * FROM findings",
    "findings_documents": "WITH " + _findings("SELECT doc_id, text FROM documents", "doc_id") + " SELECT * FROM findings",
    "findings_pages": "WITH "
    + _findings("SELECT page_id, html AS text FROM pages", "page_id")
    + " SELECT * FROM findings",
    "findings_conversations": "WITH "
    + _findings(CODE_TURNS_SQL, "conv_id, turn")
    + " SELECT * FROM findings",
    **{
        f"rule_{name.lower()}": _CODE + f" SELECT doc_id, seq, value, line FROM findings WHERE pattern_type = '{name}'"
        for name in _PATTERNS
    },
    "rule_counts_by_file": _CODE
    + " SELECT doc_id, pattern_type, CAST(count(*) AS INTEGER) AS n FROM findings GROUP BY doc_id, pattern_type",
    "rule_counts_by_source": _CODE
    + " SELECT source, pattern_type, count(*) AS findings, count(DISTINCT doc_id) AS files"
    " FROM findings JOIN files USING (doc_id) GROUP BY source, pattern_type",
    "token_sequence": _CODE
    + " SELECT doc_id, coalesce(string_agg(pattern_type, ',' ORDER BY seq), '') AS tokens"
    " FROM files LEFT JOIN findings USING (doc_id) GROUP BY doc_id",
    "finding_lines": _CODE + " SELECT DISTINCT doc_id, line FROM findings",
    "finding_excerpt": _CODE + "," + _lines() + " SELECT doc_id, seq, excerpt FROM excerpts",
    "marked_listing": _CODE
    + ","
    + _lines()
    + " SELECT doc_id, line, h.line IS NOT NULL AS marked, text FROM lines"
    " LEFT JOIN (SELECT DISTINCT doc_id, line FROM findings) h USING (doc_id, line)",
    "classify_files": _CODE_LABELS + " SELECT doc_id, label, final_state, message FROM labels_",
    "classify_events": _EVENTS_BY_DAY,
    "classify_events_chunked": _EVENTS_BY_DAY,
    "classify_event_users": f"{_EVENTS},{_states('sequence', 'user_id')} SELECT user_id, {_EVENT_RESULT}",
    "heuristic_label": _CODE + "," + _HEURISTIC + " SELECT doc_id, label FROM heuristic",
    "label_disagreement": _CODE_LABELS
    + ","
    + _HEURISTIC
    + " SELECT l.label, h.label AS heuristic, count(*) AS files"
    " FROM labels_ l JOIN heuristic h USING (doc_id) GROUP BY l.label, h.label",
    "corpus_summary": _CODE_LABELS
    + " SELECT count(*) AS files, (SELECT count(*) FROM findings) AS findings,"
    " count(*) FILTER (label = 'SAFE') AS safe, count(*) FILTER (label = 'NEEDS_REVIEW') AS needs_review,"
    " count(*) FILTER (label = 'SECURITY_VIOLATION') AS security_violation FROM labels_",
    "token_actions": _CODE
    + f" SELECT doc_id, seq, pattern_type, {_ACTION} || CASE WHEN pattern_type = 'IPv4' THEN ',PASSTHROUGH' ELSE '' END"
    f" AS actions, {_ACTION} AS action FROM findings",
    "line_actions": _CODE
    + f" SELECT doc_id, line, string_agg({_ACTION}, ',' ORDER BY seq) AS actions FROM findings GROUP BY doc_id, line",
    **{
        name: _CODE
        + ","
        + _changes(only=action)
        + " SELECT doc_id, line_number, original_line, transformed_line FROM changes"
        for name, action in {
            "rewrite_cred": "REWRITE_CRED",
            "rewrite_leak": "REMOVE_LEAK",
            "rewrite_ip": "FLAG_IP",
            "rewrite_https": "USE_HTTPS",
            "rewrite_tls": "ENFORCE_SSL",
        }.items()
    },
    "change_log": _CODE + "," + _changes() + " SELECT * FROM changes",
    "rewritten_files": _CODE
    + ","
    + _changes()
    + """,
numbered AS (SELECT doc_id, l[i] AS line, i FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM files))),
whole AS (SELECT doc_id, string_agg(coalesce(transformed_line, line), chr(10) ORDER BY i) AS text,
    count(transformed_line) > 0 AS has_changes
  FROM numbered LEFT JOIN (SELECT doc_id, CAST(line_number AS BIGINT) AS i, transformed_line FROM changes)
    USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, 'python' AS language, has_changes, md5(text) AS text_md5, CAST(len(text) AS INTEGER) AS text_length
FROM whole""",
    "suggestions": _CODE
    + f" SELECT doc_id, seq, line, value AS before, {_SUGGESTION} AS after, {_REASON} AS reason FROM findings"
    " WHERE pattern_type NOT IN ('TODO', 'ENV_REF')",
    "gate": _CODE
    + " SELECT doc_id, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,"
    " CASE WHEN n > 0 THEN n || ' violation(s) found' ELSE 'No violations found' END AS message, n AS n_violations"
    f" FROM (SELECT doc_id, CAST(count(pattern_type) FILTER ({_DANGEROUS}) AS INTEGER) AS n"
    " FROM files LEFT JOIN findings USING (doc_id) GROUP BY doc_id)",
    "gate_violations": _CODE + f" SELECT * FROM findings WHERE {_DANGEROUS}",
    "config_pieces": _CONFIGS + " SELECT * FROM pieces",
    "config_structure": _CONFIGS + " SELECT c_custkey, depth, sections, bad_at, well_formed FROM structure",
    "config_entries": _ENTRIES,
    "config_issues": _CONFIGS + "," + _issues("c_custkey") + " SELECT * FROM issues",
    "config_audit": _CONFIGS + " SELECT c_custkey, is_valid, sections_found, n_errors, message FROM audit",
    "config_audit_summary": _CONFIGS
    + " SELECT is_valid, sections_found, count(*) AS files, CAST(sum(n_errors) AS BIGINT) AS errors FROM audit"
    " GROUP BY is_valid, sections_found",
    "file_report": _REPORT
    + """ SELECT file AS filepath, coalesce(f.n, 0) AS findings, coalesce(f.r, 0) AS rules, l.label AS classification,
  l.final_state AS classification_state, coalesce(c.n, 0) AS transformations, coalesce(c.n, 0) > 0 AS has_changes,
  CASE WHEN a.file IS NULL THEN 'N/A' WHEN a.is_valid THEN 'PASS' ELSE 'FAIL' END AS validation,
  a.message AS validation_message
FROM files LEFT JOIN (SELECT file, CAST(count(*) AS INTEGER) AS n, CAST(count(DISTINCT pattern_type) AS INTEGER) AS r
    FROM findings GROUP BY file) f USING (file)
  JOIN labels_ l USING (file) LEFT JOIN (SELECT file, CAST(count(*) AS INTEGER) AS n FROM changes GROUP BY file) c
    USING (file) LEFT JOIN audit a USING (file)""",
    "file_report_json": _REPORT
    + ","
    + _lines("file")
    + ","
    + _issues("file")
    + """,
found AS (SELECT file, to_json(list({'pattern_type': pattern_type, 'value': value, 'line': line, 'excerpt': excerpt}
    ORDER BY seq)) AS items, to_json(list(pattern_type ORDER BY seq)) AS tokens
  FROM findings JOIN excerpts USING (file, seq) GROUP BY file),
counted AS (SELECT file, string_agg(printf('"%s":%d', pattern_type, n), ',' ORDER BY pattern_type) AS counts
  FROM (SELECT file, pattern_type, count(*) AS n FROM findings GROUP BY file, pattern_type) GROUP BY file),
changed AS (SELECT file, to_json(list({'line': line_number, 'before': original_line, 'after': transformed_line,
    'reason': 'Action: ' || action} ORDER BY line_number)) AS items FROM changes GROUP BY file),
faults AS (SELECT file, to_json(list({'line': line, 'type': 'CFG_ERROR', 'value': message} ORDER BY error_no)) AS items
  FROM issues GROUP BY file)
SELECT file AS filepath, concat('{"filepath":', to_json(file), ',"findings":', coalesce(f.items, '[]'),
  ',"summary":{', n.counts, '},"tokens":', coalesce(f.tokens, '[]'), ',"classification":"', l.label,
  '","transformations":', coalesce(c.items, '[]'), ',"validation":{"status":',
  CASE WHEN a.file IS NULL THEN '"N/A","message":"Validation applies to .conf files only"'
    ELSE concat(CASE WHEN a.is_valid THEN '"PASS"' ELSE '"FAIL"' END, ',"message":', to_json(a.message),
      ',"violations":', coalesce(v.items, '[]')) END, '}}') AS json
FROM files JOIN labels_ l USING (file) LEFT JOIN found f USING (file) LEFT JOIN counted n USING (file)
  LEFT JOIN changed c USING (file) LEFT JOIN audit a USING (file) LEFT JOIN faults v USING (file)""",
    "file_report_text": _REPORT
    + ","
    + _lines("file")
    + ","
    + _issues("file")
    + """,
listed AS (SELECT file, string_agg(printf('  %s %3d | %s', CASE WHEN h.line IS NULL THEN '   ' ELSE '>>>' END, line, text),
    chr(10) ORDER BY line) AS shown
  FROM lines LEFT JOIN (SELECT DISTINCT file, line FROM findings) h USING (file, line) GROUP BY file),
found AS (SELECT file, count(*) AS n, string_agg(printf('    [%s] line %d -> %s', pattern_type, line, value), chr(10)
    ORDER BY seq) AS shown, string_agg(pattern_type, ', ' ORDER BY seq) AS tokens FROM findings GROUP BY file),
counted AS (SELECT file, string_agg(printf('    %s: %d', pattern_type, n), chr(10) ORDER BY pattern_type) AS shown
  FROM (SELECT file, pattern_type, count(*) AS n FROM findings GROUP BY file, pattern_type) GROUP BY file),
steps AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY line_number) AS k FROM changes),
changed AS (SELECT file, string_agg(concat(printf('  %d. Line %d - Action: %s', k, line_number, action), chr(10),
    '     Before: ', original_line, chr(10), '     After:  ', transformed_line), chr(10) ORDER BY k) AS shown
  FROM steps GROUP BY file),
renewed AS (SELECT file, string_agg(printf('    %3d | %s', line, coalesce(transformed_line, text)), chr(10) ORDER BY line)
    AS shown
  FROM lines LEFT JOIN (SELECT file, line_number AS line, transformed_line FROM changes) USING (file, line) GROUP BY file),
faults AS (SELECT file, string_agg(printf('    - Line %d: [CFG_ERROR] %s', line, message), chr(10) ORDER BY error_no) AS shown
  FROM issues GROUP BY file),
frame AS (SELECT repeat('=', 60) AS bar, repeat('-', 40) AS rule, chr(10) AS nl)
SELECT file AS filepath, concat_ws(nl, bar, '  File: ' || file, '  Path: ' || file, bar,
  nl || '[1 SOURCE]', rule, coalesce(s.shown, ''),
  nl || '[2 DETECTION]', rule, CASE WHEN f.n IS NULL THEN '  No security patterns found.' ELSE concat_ws(nl,
    '  ' || f.n || ' pattern(s) found:' || nl, f.shown, nl || '  Counts:', n.shown, nl || '  Token sequence:',
    '    ' || f.tokens) END,
  nl || '[3 CLASSIFICATION]', rule, '  Result: ' || l.label, '  Final state: ' || l.final_state,
  '  Message: ' || l.message,
  nl || '[4 CHANGES]', rule, coalesce(c.shown, '  No changes needed.'),
  CASE WHEN c.shown IS NOT NULL THEN concat_ws(nl, nl || '  Rewritten text:', rule, r.shown) END,
  nl || '[5 VALIDATION]', rule, CASE WHEN a.file IS NULL THEN '  Status: [N/A] Validation applies to .conf files only'
    ELSE concat('  Status: [', CASE WHEN a.is_valid THEN 'PASS' ELSE 'FAIL' END, '] ', a.message) END,
  v.shown) AS report_text
FROM files CROSS JOIN frame JOIN labels_ l USING (file) LEFT JOIN listed s USING (file) LEFT JOIN found f USING (file)
  LEFT JOIN counted n USING (file) LEFT JOIN changed c USING (file) LEFT JOIN renewed r USING (file)
  LEFT JOIN audit a USING (file) LEFT JOIN faults v USING (file)""",
    "decode_files": "SELECT 'doc_' || doc_id || '.py' AS path, CASE WHEN lang <> 'fr' THEN '.py' END AS ext,"
    " CASE WHEN lang <> 'fr' THEN md5(text) END AS text_md5, CASE WHEN lang = 'fr' THEN 'not_utf8' END AS reason"
    " FROM documents",
    "insecure_page_urls": "WITH "
    + _findings("SELECT page_id, url AS text FROM pages", "page_id")
    + " SELECT page_id, value, replace(value, 'http://', 'https://') AS secure FROM findings"
    " WHERE pattern_type = 'SUSPICIOUS_URL'",
}

# Files as they could be read: by the number in the path some are missing or broken.
_KIND = "CAST(regexp_extract(%s, '[0-9]+', 0) AS BIGINT) %% 11"
ORACLES |= {
    "audit_read_files": f"""SELECT path, is_valid AND kind NOT IN (3, 7) AS is_valid,
  CASE WHEN kind IN (3, 7) THEN 0 ELSE sections_found END AS sections_found,
  CASE WHEN kind IN (3, 7) THEN 1 ELSE n_errors END AS n_errors,
  CASE kind WHEN 3 THEN 'File not readable: ' || path || ' (not_utf8)' WHEN 7 THEN 'File not found: ' || path
    ELSE message END AS message
FROM (SELECT *, 'customer_' || c_custkey || '.conf' AS path, {_KIND % "CAST(c_custkey AS VARCHAR)"} AS kind
  FROM ({ORACLES["config_audit"]}))""",
    "file_report_read": f"SELECT * FROM ({ORACLES['file_report']}) WHERE {_KIND % 'filepath'} NOT IN (3, 7)",
}
