import random
import re
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from hazardlens.functions.hints import derived
from hazardlens.functions.rules import RULES, Rule, with_hints
from hazardlens.operators.detect import detect, explode_findings
from hazardlens.plans.corpora import code_files

CASES = [
    ("foo|bar", ("bar", "foo"), (("bar", "foo"),)),
    ("AbC[0-9]+dEf", ("abc",), (("def",), ("abc",))),
    (r"(?<!\w)api[_-]?key\s*=", ("api",), (("api-key", "api_key", "apikey"), ("=",))),
    (r"(?:ab|cd+)x", ("ab", "cd"), (("ab", "c"), ("x",))),
    (r"\d+\.\d", ("0",), ((".",),)),
    (r"x*y", (), (("y",),)),
    (r"[^a]b", (), (("b",),)),
    (r"(?i)SELECT\s", ("sel",), (("select",),)),
    (r"(?:ab){2}\w", ("aba",), (("abab",),)),
    (r"a(?=zzz)b(?!q).", ("ab",), (("ab",),)),
    (r"\Qa.b\E", (), ()),
    (r"(?x)a b", (), ()),
    (r"[a&&[b]]c", (), (("c",),)),
    (r"é+x", (), (("x",),)),
    ("a|", (), ()),
]


@pytest.mark.parametrize(("pattern", "starts", "needs"), CASES)
def test_literals_of_a_pattern(pattern, starts, needs):
    got_starts, got_needs = derived(pattern)
    assert got_starts == starts and set(got_needs) == set(needs)


def _random_pattern(rng, depth=0):
    def atom():
        kind = rng.randint(0, 9 if depth < 3 else 6)
        if kind <= 3:
            return "".join(rng.choice("abAB=.").replace(".", r"\.") for _ in range(rng.randint(1, 3)))
        if kind == 4:
            return rng.choice(["[ab]", "[^a]", "[aA]", r"\d", ".", r"\w", "[0-9]", "[a-c]"])
        if kind == 5:
            return rng.choice(["(?=a)", "(?!b)", "(?<=a)", "(?<!=)", r"\b"])
        if kind == 6:
            return "b"
        return "(?:" + _random_pattern(rng, depth + 1) + ")"

    def piece():
        a = atom()
        if a.startswith(("(?=", "(?!", "(?<", r"\b")) or rng.random() < 0.6:
            return a
        return "(?:" + a + ")" + rng.choice(["?", "*", "+", "{2}", "{0,2}", "{1,3}", "{4}", "*+", "+?"])

    return "|".join("".join(piece() for _ in range(rng.randint(1, 3))) for _ in range(rng.choice([1, 1, 2, 3])))


def test_hints_hold_for_every_match():
    rng = random.Random(8)
    told = matched = 0
    for _ in range(4000):
        pattern = _random_pattern(rng)
        starts, needs = derived(pattern)
        told += bool(starts or needs)
        for _ in range(12):
            text = "".join(rng.choice("abABcC=.01\n") for _ in range(rng.randint(0, 14)))
            for m in re.finditer(pattern, text):
                matched += 1
                low = text.lower()
                assert all(any(w in low for w in group) for group in needs), (pattern, text, needs)
                if starts:
                    opens = m.group().lower()
                    rest = low[m.start() :]
                    assert any(rest.startswith(s) or (s == "0" and opens[:1].isdigit()) for s in starts), (pattern, text)
    assert told > 1500 and matched > 5000


BARE = tuple(replace(r, starts=(), needs=(), probe="") for r in RULES)


def test_default_rules_without_hints_find_the_same(spark, sf_dir):
    for given, own in zip(RULES, with_hints(BARE), strict=True):
        assert own.starts and (own.needs or own.probe), own
        assert given.name == own.name
    files = code_files(spark, sf_dir)
    want = explode_findings(detect(files), "doc_id").collect()
    got = explode_findings(detect(files, BARE), "doc_id").collect()
    assert len(want) > 200 and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_texts_without_the_literals_are_passed_over(spark):
    # would take minutes if the pattern were tried on each of these texts
    slow = (Rule("SLOW", r"(?:a+)+b#marker"),)
    texts = spark.range(200).select(F.expr("repeat('a', 60)").alias("text"))
    started = time.time()
    assert detect(texts, slow).where(F.size("findings") > 0).count() == 0
    assert time.time() - started < 30


def test_own_rules_equal_a_plain_pattern(spark, sf_dir):
    own = (Rule("CALL", r"[a-z_]+\((?:[^()\n]*)\)"), Rule("WORDS", r"(?:pass|tok)[a-z]*\s*=\s*\S+"), Rule("NUM", r"\d\d+"))
    joined = "|".join(f"(?P<{r.name}>{r.pattern})" for r in own)
    files = code_files(spark, sf_dir).select("doc_id", "text")
    got = {(r.doc_id, r.seq): (r.pattern_type, r.value) for r in explode_findings(detect(files, own), "doc_id").collect()}
    want = {}
    for row in files.collect():
        for k, m in enumerate(re.finditer(joined, row.text, re.ASCII)):
            want[row.doc_id, k + 1] = (m.lastgroup, m.group().strip())
    assert got == want and len(want) > 100
