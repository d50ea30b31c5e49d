import itertools
import random

import checker
from pyspark.sql import functions as F

from hazardlens.operators import config_audit as ca

VALID = [
    "cache { ttl = 300; } queue { depth = 7; }",
    'mail { from = "ops"; relay { verify = true; } }',
    "mail{relay{n=0;}}",
    "store { password = ${STORE_KEY}; secret = ${\n STORE_SECRET \n}; }",
    "w { x { y { token = ${T}; } } }",
    'k { open = "{"; close = \'}\'; both = "a;b=c"; }',
    'k { q = "say \\"hi\\""; none = ""; n = -12; _p2 = false; }',
    'k { only = "ends in an escaped quote\\"; }',
    "größe { wert = 5; }",
    '\n\t k { two = "line one\nline two"; }\r\n',
]
MALFORMED = [
    "cache { ttl = 300;",
    "cache { ttl = 300 }",
    "cache { ttl 300; }",
    "ttl = 300;",
    "cache { }",
    "cache { inner { } }",
    "cache { ttl = 0.5; }",
    "cache { ttl = 300; } }",
    "cache { ttl = 300; } queue = 1;",
    "cache { on = falsey; }",
    "cache { n = 7up; }",
    "cache { 2nd = 7; }",
    "cache { name = 'open; }",
    "// note\ncache { ttl = 300; }",
    "cache { key = ${9}; }",
    "}",
    "{ ttl = 300; }",
    "cache",
    # A string ends where it ends, whether a semicolon follows or not.
    'db { a = "x" password = "hunter"; }',
    "db { a = 'x' password = 'hunter'; }",
    'db {\n  user = "bob"\n  password = "hunter22";\n}',
    'db { a = "x" }\nweb { token = "t"; }',
    "db { a = 'x' }\nweb { token = 't'; }",
    'a { x = "p\\"; y = "q"; }',
    'a { x = "1"; password = "k" ; z = "w" q = "r"; }',
]
INSECURE = [
    ('db { password = "hunter22"; }', 1),
    ("web { Token = 'abc'; }", 1),
    ('bus { SECRET = "s3"; user = "u"; }', 1),
    ("a { b { db_password = 1; } secret = true; }", 2),
]


def audit(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "file_id int, text string")
    return ca.config_audit(df, "file_id").orderBy("file_id").collect()


def test_valid(spark):
    for text, row in zip(VALID, audit(spark, VALID)):
        assert (row.is_valid, row.n_errors, row.errors) == (True, 0, []), text
    row = audit(spark, [VALID[0]])[0]
    assert (row.sections_found, row.message) == (2, "Valid configuration with 2 section(s)")


def test_malformed(spark):
    for text, row in zip(MALFORMED, audit(spark, MALFORMED)):
        assert (row.is_valid, row.sections_found, row.n_errors) == (False, 0, 1), text
        assert row.message.startswith("Syntax error at line "), text
    row = audit(spark, ["a {\n  x = 1;\n  oops\n}"])[0]
    assert row.message == "Syntax error at line 4, col 1"


def test_empty(spark):
    for row in audit(spark, ["", " \n\t", "  ", None]):
        assert (row.is_valid, row.sections_found, row.message) == (False, 0, "Configuration is empty")
        assert [tuple(e) for e in row.errors] == [("Empty configuration", 1, 1)]


def test_sensitive_keys(spark):
    rows = audit(spark, [t for t, _ in INSECURE])
    for (text, n), row in zip(INSECURE, rows):
        assert (row.is_valid, row.n_errors, row.message) == (False, n, f"Found {n} insecure key(s)"), text
        assert all(e.column == 0 for e in row.errors)
    assert rows[0].errors[0].line == len("db { ")
    assert rows[0].errors[0].message == (
        "Sensitive key 'password' must use env var reference (${...}), got literal value instead"
    )
    assert [e.line for e in rows[3].errors] == [8, 27]


def test_other_keys_are_not_sensitive(spark):
    assert audit(spark, ['a { aws_secret = "x"; apikey = "y"; passwords = 1; }'])[0].is_valid


def test_structure_equals_reduction(spark):
    """All strings of up to eight pieces, against repeated reduction of innermost sections."""
    texts = {"o": "s { ", "a": "k = 1; ", "c": "} "}
    strings = ["".join(s) for n in range(1, 9) for s in itertools.product("oac", repeat=n)]
    rows = spark.createDataFrame(
        [(s, "".join(texts[p] for p in s)) for s in strings], "kinds string, text string"
    ).repartition(8)
    got = {r.kinds: r.is_valid for r in ca.config_audit(rows, "kinds").collect()}
    assert sum(got.values()) > 20
    assert [s for s in strings if got[s] != checker.well_formed(s)] == []


def _nested(rng, depth, path, out):
    parts = []
    for _ in range(rng.randint(1, 3)):
        name = rng.choice(["a", "token", "db_1", "Pwd"])
        if depth < 4 and rng.random() < 0.4:
            out.append(("OPEN", name, path + [name]))
            parts.append(f"{name} {{ {_nested(rng, depth + 1, path + [name], out)} }}")
        else:
            value = rng.choice(["1", '"}{"', "${X}", "false", "'a;b'"])
            out.append(("ASSIGN", name, path))
            parts.append(f"{name} = {value};")
    return "\n".join(parts)


def test_entries_of_random_nesting(spark):
    rng = random.Random(3)
    texts, wanted = [], []
    for _ in range(120):
        out = [("OPEN", "root", ["root"])]
        texts.append(f"root {{ {_nested(rng, 1, ['root'], out)} }}")
        wanted.append(out)
    df = spark.createDataFrame(list(enumerate(texts)), "file_id int, text string")
    rows = ca.config_entries(df, "file_id").orderBy("file_id", "pos").collect()
    got = [[] for _ in texts]
    for r in rows:
        got[r.file_id].append((r.kind, r.key, r.section_path))
        assert texts[r.file_id][r.char_offset :].startswith(r.key)
        assert r.depth == len(r.section_path)
    assert got == wanted


def test_pieces_of_values(spark):
    text = 'a { k = "x\u0001\u0002y"; e = ${ V }; n = -7; b = true; s = \'q\'; } '
    df = spark.createDataFrame([(1, text)], "file_id int, text string")
    rows = ca.config_pieces_long(df, "file_id").where("kind = 'ASSIGN'").orderBy("pos").collect()
    assert [(r.key, r.value_kind, r.value) for r in rows] == [
        ("k", "STRING", "x\u0001\u0002y"), ("e", "ENV_REF", "V"), ("n", "INT", "-7"), ("b", "BOOL", "true"), ("s", "STRING", "q"),
    ]


def test_large_text(spark):
    n = 5_000
    text = "a { " + " ".join(f'k{i} = "v\\"{i}";' for i in range(n)) + ' pwd = "' + '\\"' * 20_000 + '"; }'
    df = spark.createDataFrame([(1, text)], "file_id int, text string")
    assert ca.config_audit(df, "file_id").first().message == "Found 1 insecure key(s)"
    assert ca.config_entries(df, "file_id").agg(F.count("*"), F.max("pos")).first() == (n + 2, n + 1)


FAILING = [
    # (text, what stands at the reported place)
    ('db { a = "x" password = "y"; }', 'password = "y"'),
    ('db {\n  host "x";\n}', '"x";'),
    ('db { a = 5x; }', "5x;"),
    ("db { a = trueish; }", "trueish;"),
    ('db { a = "x"b; }', "b; }"),
    ("db { a = ${X} }", "}"),
    ("db { = 3; }", "= 3;"),
    ('host = "x";\n', '= "x"'),
    ("db 5 { }", "5 {"),
    ("db { }", "}"),
    ("db { a = 1; } }", "}"),
    ("db { a = 1;\n", ""),
    ("db { a", ""),
]


def test_place_of_the_failing_token(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(FAILING)], "k int, text string")
    for row in ca.config_issues(df, "k").collect():
        text, token = FAILING[row.k]
        lines = text.split("\n")
        at = sum(len(x) + 1 for x in lines[: row.line - 1]) + row.column - 1
        assert text[at:].startswith(token) and (token or at == len(text)), (text, row.line, row.column)
