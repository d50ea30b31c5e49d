import random
import time

import checker
import pytest
from pyspark.sql import functions as F

from hazardlens.functions.rules import RULES, Rule
from hazardlens.operators.detect import detect, explode_excerpts, explode_findings

SNIPPETS = [
    # (text, rules found, in order)
    ('api_key = "AKIA' + "Q" * 16 + '"', ["HARDCODED_CRED"]),
    ('where = "AKIA' + "Q" * 16 + '"', ["AWS_KEY"]),
    ("AKIA" + "7" * 13, []),
    ("AKIA" + "7" * 15, []),
    ("AKIA" + "7" * 16, ["AWS_KEY"]),
    ("akia" + "z" * 16, ["AWS_KEY"]),
    ('password = "horse battery"', ["HARDCODED_CRED"]),
    ("token = 'f00ba4'", ["HARDCODED_CRED"]),
    ('secret = "under the mat"', ["HARDCODED_CRED"]),
    ('credential = "me/you"', ["HARDCODED_CRED"]),
    ('password = os.getenv("DB_PW")', ["ENV_REF"]),
    ("password = os.environ['DB_PW']", ["ENV_REF"]),
    ("token = process.env.CI_TOKEN", []),
    ("token = ${CI_TOKEN}", []),
    ("print(password)", ["PRINT_LEAK"]),
    ("print( secret )", ["PRINT_LEAK"]),
    ('print("good morning")', []),
    ("print(colour)", []),
    ('print(f"{password}")', []),
    ("pprint(token_value )", ["PRINT_LEAK"]),
    ("route add 172.31.255.254 via eth1", ["IPv4"]),
    ("allow=203.0.113.7,203.0.113.8", ["IPv4", "IPv4"]),
    ("build 260.14.7.300 of 3.14", []),
    ("1.2.3.4.5", ["IPv4"]),
    ("é1.2.3.4", []),
    ("1.2.3.4é", []),
    ("١.٢.٣.٤", ["IPv4"]),
    ("home = os.getenv( 'HOME')", []),
    ("home = os.getenv ('HOME')", ["ENV_REF"]),
    ("shell = os.environ[SHELL]", ["ENV_REF"]),
    ('os.getenv("A", "b")', []),
    ("x = 1  #todo tidy up the loop", ["TODO"]),
    ("#   ToDo", ["TODO"]),
    ("# nothing to do here", []),
    ("#\nTODO x", ["TODO"]),
    ('# TODO password = "abc"', ["TODO"]),
    ("<a href='http://shop.example/cart?n=2'>", ["SUSPICIOUS_URL"]),
    ("git clone https://code.example/r.git", []),
    ("http://10.0.0.1/x", ["SUSPICIOUS_URL"]),
    ("logging.warning('rotated', old_token, n)", ["LOG_LEAK"]),
    ("LOGGING.Error ( credential_id )", ["LOG_LEAK"]),
    ("logging.debug('queue is empty')", []),
    ('logging.info(\n"x",\n token)', ["LOG_LEAK"]),
    ("logging.info(token", []),
    ("logging.critical(token)", []),
    ("y = eval (formula)", ["DANGEROUS_CALL"]),
    ("cursor.Exec(plan)", ["DANGEROUS_CALL"]),
    ("return pickle.loads(queue.get())", ["DANGEROUS_CALL"]),
    ("evaluate(formula)", []),
    ("retrieval(x)", ["DANGEROUS_CALL"]),
    ("session.verify = false", ["INSECURE_REQUEST"]),
    ("Client(verify=ca_bundle)", []),
    ("DB_PASSWORD=x12", ["HARDCODED_CRED"]),
    ("password = get_secret()", ["HARDCODED_CRED"]),
    ('password_hash = "abc"', []),
    ('password = "a\nb"', ["HARDCODED_CRED"]),
    ('password = "a"', []),
    ("", []),
    ("\n#\n", []),
    ("pwd='oak'\ncredential = elm-tree\nprint( pwd )\n", ["HARDCODED_CRED", "HARDCODED_CRED", "PRINT_LEAK"]),
    ("a = os.environ['A']\nb = os.getenv(\"B\")", ["ENV_REF", "ENV_REF"]),
    ("toKen = abcd", ["HARDCODED_CRED"]),
    ("paſsword = abcd", ["HARDCODED_CRED"]),
    ("credentİal = abcd", ["HARDCODED_CRED"]),
    ("\u0001password = ab\u0002c\u0001 print(token)", ["HARDCODED_CRED", "PRINT_LEAK"]),
]


def collect(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "file_id int, text string")
    out = {k: [] for k in range(len(texts))}
    for r in explode_findings(detect(df, **options), "file_id").orderBy("file_id", "seq").collect():
        out[r.file_id].append(r)
    return [out[k] for k in range(len(texts))]


def test_snippets(spark):
    got = collect(spark, [t for t, _ in SNIPPETS])
    for (text, want), rows in zip(SNIPPETS, got):
        assert [r.pattern_type for r in rows] == want, text
        assert [(r.pattern_type, r.value, r.line) for r in rows] == checker.findings(text), text
        assert [r.seq for r in rows] == list(range(1, len(rows) + 1))


def test_positions_and_null_text(spark):
    rows = collect(spark, ["\n\npwd = 'granite'\n", None, "a\r\ntoken = abcd\r\n"])
    assert [(r.value, r.line) for r in rows[0]] == [("pwd = 'granite'", 3)]
    assert rows[1] == []
    assert [(r.value, r.line) for r in rows[2]] == [("token = abcd", 2)]


PARTS = [t for t, _ in SNIPPETS if t] + [
    "\n", "\n", " ", "\t", "x", "\r\n", "\x0b", " ", "\x85", " ", "=", "(", ")", '"', "'", "#", "${", "}",
    "password", "Token", "os.getenv", "print(", "logging.debug(", "127.0.0.1", "http://", "verify = False", "é",
    "\x1c", "\U0001f600", "$1", "\\", "\u0001", "\u0002", "secret =", "\nsecond line\n",
]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def test_random_texts_agree_with_checker(spark):
    texts = random_texts(1500, 7)
    for text, rows in zip(texts, collect(spark, texts, context_lines=2)):
        want = checker.findings(text)
        assert [(r.pattern_type, r.value, r.line) for r in rows] == want, repr(text)
        assert [r.excerpt for r in rows] == [checker.excerpt(text, line) for _, _, line in want], repr(text)


CALL_PARTS = [
    'print("', "print(f'", 'PRINT ( "', "print(", "logging.info(", "Logging.error (", "token", "secretoken", "Pwd", "api_key",
    '"', "'", ")", ") ", "(", " ", "\n", "\n", "\r", "x", "_", "password = '", "http://", "eval(", "\u0003", "\u0004", "\u0001",
]


def test_random_calls_agree_with_checker(spark):
    rng = random.Random(31)
    texts = ["".join(rng.choice(CALL_PARTS) for _ in range(rng.randint(4, 40))) for _ in range(2500)]
    for text, rows in zip(texts, collect(spark, texts)):
        assert [(r.pattern_type, r.value, r.line) for r in rows] == checker.findings(text), repr(text)


@pytest.mark.parametrize("call", ['print("a");', "logging.info(x;"])
def test_many_calls_without_a_leak(spark, call):
    # Searched to the end for each call, these would take hours.
    text = "token " + call * (1_000_000 // len(call)) + ')\nprint(token)'
    start = time.time()
    (rows,) = collect(spark, [text])
    assert [r.pattern_type for r in rows] == ["PRINT_LEAK"]
    assert time.time() - start < 60


def test_excerpt_rows_agree_with_checker(spark):
    texts = ["", "eval(a) eval(b)\neval(c)"] + random_texts(300, 19)
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "file_id int, text string")
    got = {}
    for r in explode_excerpts(detect(df), "file_id").orderBy("file_id", "seq").collect():
        got.setdefault(r.file_id, []).append((r.pattern_type, r.value, r.line, r.excerpt))
    for k, text in enumerate(texts):
        want = [(rule, value, line, checker.excerpt(text, line)) for rule, value, line in checker.findings(text)]
        assert got.get(k, []) == want, repr(text)
    assert -1 not in got


def test_excerpts_of_one_line_multiply_as_rows_only(spark):
    n = 20_000
    df = spark.createDataFrame([("eval(x);" * n,)], "text string")
    rows = explode_excerpts(detect(df))
    assert rows.agg(F.count("*"), F.min(F.length("excerpt")), F.max("line")).first() == (n, 8 + 8 * n, 1)


def test_excerpt_numbers_long_files(spark):
    text = "\n".join(["x = 1"] * 1200 + ["eval(x)"] + ["y"] * 3)
    (rows,) = collect(spark, [text], context_lines=1)
    assert rows[0].line == 1201
    assert rows[0].excerpt == "  1200 | x = 1\n  1201 | eval(x)\n  1202 | y"


def test_many_findings_in_one_text(spark):
    n = 20_000
    (rows,) = collect(spark, ["\n".join(f"ip 10.0.{k // 256 % 256}.{k % 256}" for k in range(n))])
    assert len(rows) == n
    assert all(r.line == r.seq for r in rows)


def test_line_numbers_of_many_findings(spark):
    text = "".join(f"eval(a)\n\n# TODO {k} 1.2.3.4\n1.2.3.4 password = 'two\nlines' http://x{k}" for k in range(1500))
    (rows,) = collect(spark, [text])
    assert [(r.pattern_type, r.value, r.line) for r in rows] == checker.findings(text)
    assert len(rows) > 5000


def test_long_runs_do_not_overflow_the_stack(spark):
    mixed = "a\U0001f600" * 60_000
    texts = [f'password = "{mixed}"', f"token = {mixed}", f"http://{mixed}", f"# TODO {mixed}", f"logging.info({mixed}token)"]
    assert [[r.pattern_type for r in rows] for rows in collect(spark, texts)] == [
        ["HARDCODED_CRED"], ["HARDCODED_CRED"], ["SUSPICIOUS_URL"], ["TODO"], ["LOG_LEAK"],
    ]


@pytest.mark.parametrize("name", [r.name for r in RULES])
def test_only_one_rule(spark, name):
    texts = [t for t, _ in SNIPPETS] + random_texts(100, 3)
    df = spark.createDataFrame(list(enumerate(texts)), "file_id int, text string")
    got = explode_findings(detect(df, only=[name]), "file_id").collect()
    want = explode_findings(detect(df), "file_id").where(F.col("pattern_type") == name).collect()
    assert sorted(got) == sorted(want)


def test_own_rules(spark):
    own = (Rule("HEX", "0x[0-9a-f]+"), Rule("WORD", "foo|bar", starts=("foo", "bar"), needs=(("foo", "bar"),)))
    (rows,) = collect(spark, ["foo 0x1f\nbar"], rules=own)
    assert [(r.pattern_type, r.value, r.line) for r in rows] == [("WORD", "foo", 1), ("HEX", "0x1f", 1), ("WORD", "bar", 2)]
