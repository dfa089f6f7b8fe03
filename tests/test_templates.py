"""Texts that templates ask for, and the choice among templates against plain Python."""

import random
import re

from pyspark.sql import functions as F

from treeshred.functions import regex as X
from treeshred.operators import rename as R


def test_required_literals():
    told = {r"^SEQ/ACK analysis$": "SEQ/ACK analysis", r"^(.+): 12$": ": 12", r"Leng?th\.here": "th.here", r"abcd+e": "abcd",
            r"[Tt]ype \w+ of": "ype ", r"a(?:bcd)efg": "efg", r"(?<n>x)abc": "abc", r"x{3}abc": "abc", r"a\$\$\$": "a$$$"}
    assert {p: X.required_literal(p) for p in told} == told
    for silent in (None, "", ".*", "a|bcdef", "(?i)abcdef", r"\x41bcdef", r"(a)\1bcdef", "(abcdef)", "(?<!x)abcdef", "[a[b]]cdef", r"\Qab\Ecdef", "abc*"):
        assert X.required_literal(silent) is None


def test_what_matches_holds_the_literal():
    rnd = random.Random(3)
    atoms = ["a", "b", "c", ": ", r"\.", r"\d", ".", "[ab]", "[^c]", "(a)", "(?:bc)", "(?<n>b)", r"\w", "^", "$"]
    found = told = 0
    for _ in range(60_000):
        pattern = "".join(rnd.choice(atoms) + rnd.choice(["", "", "", "*", "?", "+", "{2}", "{0,1}", "*?"]) for _ in range(rnd.randint(1, 7)))
        pattern = re.sub(r"([\^$])(?:[*?+]+|\{[^}]*\})+", r"\1", pattern).replace("(?<n>", "(?P<n>", 1).replace("(?<n>", "(")
        literal = X.required_literal(pattern.replace("(?P<n>", "(?<n>"))
        if literal is None:
            continue
        told += 1
        for _ in range(60):
            text = "".join(rnd.choice("abc:. 1") for _ in range(rnd.randint(0, 14)))
            if re.search(pattern, text):
                found += 1
                assert literal in text, (pattern, text, literal)
    assert told > 500 and found > 100


def test_one_pattern_finds_any_text():
    rnd = random.Random(5)
    for _ in range(300):
        texts = ["".join(rnd.choice("ab.$\\ ") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 12))]
        pattern = X.any_of(texts)
        for _ in range(20):
            at = "".join(rnd.choice("ab.$\\ ") for _ in range(rnd.randint(0, 9)))
            assert bool(re.search(pattern, at)) == any(t in at for t in texts)


def test_last_fitting_template_counts(spark):
    rnd = random.Random(7)
    words = ["Flow rate", "Time to live", "Type", "Len", "x.y", "(none)"]
    rules = []
    for i in range(120):
        kind = rnd.randrange(4)
        word = rnd.choice(words)
        show = (f"^{re.escape(word)}", f"{re.escape(word)}: (\\d+)$", rf"(\w)\w* {i % 9}$", ".*: 7$|^Len")[kind]
        rules.append({"parentName": rnd.choice([".*", "^tcp"]), "name": "", "show": show.replace("\\ ", " "), "showname": ".*",
                      "value": ".*", "nameFormat": f"n{i}", "valueFormat": "$(1)"})
    nodes = [(i, rnd.random() < 0.9, rnd.choice(["tcp.flags", "ip", None]), rnd.choice([None, None, None, "named"]),
              rnd.choice([None, f"{rnd.choice(words)}: {rnd.randrange(9)}", f"{rnd.choice(words)} {rnd.randrange(9)}"])) for i in range(600)]
    df = spark.createDataFrame(nodes, "i int, fresh boolean, p_name string, n_name string, n_show string").withColumns(
        {"n_showname": F.lit("s"), "n_value": F.lit("v"), "n_hit": F.lit(False)})
    got = {r.i: (r.n_name, r.n_show) for r in R.template_rename(df, rules).collect()}
    hits = 0
    for i, fresh, parent, name, show in nodes:
        want = (name, show)
        for rule in rules:
            found = re.search(rule["show"], show or "")
            fits = rule["parentName"] == ".*" or re.search(rule["parentName"], parent or "")
            if fresh and not name and found and fits:
                taken = "$(1)" if not found.re.groups else found[1] or ""
                want, hits = (rule["nameFormat"], taken), hits + 1
        assert got[i] == want
    assert hits > 100
