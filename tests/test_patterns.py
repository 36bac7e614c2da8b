"""Required literals of patterns, and the join that uses them."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from rosterflow.functions.patterns import required_literals
from rosterflow.operators import netrange
from tests.test_plans import plan_text

CASES = {
    r"^10[.]3[.]5[0-9]?[.]": ["10.3.5"], r"a|bc": ["a", "bc"], r"^foo.*bar$": ["foo"], r"(abc)+xyz": ["xyz"],
    r"x\.y\*z+q": ["x.y*z"], r"(?i)abc": [""], r"\x41bc": [""], r"ab{2}cd?e": ["e"], r"a\\b.c": ["a\\b"], r"(a|b)(c|d)": [""],
    "": [""], r"abc(d(e(f)))?g": ["abc"], r"[a-z&&[^b]]x": [""], r"a\+b|c\|d": ["a+b", "c|d"], "a||b": ["a", "", "b"], "^$": [""],
    r"x{2,}yy": ["yy"], r"\bword\b": ["word"], "(x": [""], "é+漢字": ["漢字"], r"\d+\.\d+": ["."],
}


def test_required_literals(spark):
    df = spark.createDataFrame([(p,) for p in CASES], "p string").select("p", required_literals(F.col("p")).alias("found"))
    assert {r.p: r.found for r in df.collect()} == CASES


def random_pattern(rng):
    atom = lambda: rng.choice(["a", "b", "1", r"\.", "[.]", ".", "[ab]", "[^1]", r"\d", "(ab|1)", "(a(b|1)?)", "b1a"])
    part = lambda: "".join(atom() + rng.choice(["", "", "", "*", "+", "?", "{2}", "{0,1}", "+?"]) for _ in range(rng.randint(1, 5)))
    return rng.choice(["", "^"]) + "|".join(part() for _ in range(rng.choice([1, 1, 2]))) + rng.choice(["", "$"])


def test_a_match_always_holds_a_required_literal(spark):
    rng = random.Random(7)
    patterns = sorted({random_pattern(rng) for _ in range(400)})
    values = sorted({"".join(rng.choice("ab1.c") for _ in range(rng.randint(0, 9))) for _ in range(300)})
    found = {r.p: r.found for r in spark.createDataFrame([(p,) for p in patterns], "p string")
             .select("p", required_literals(F.col("p")).alias("found")).collect()}
    for p in patterns:
        for v in values:
            if re.search(p, v):
                assert any(x in v for x in found[p]), (p, v, found[p])
    assert sum(found[p] != [""] for p in patterns) > len(patterns) / 3


def brute(ranges, targets):
    def long(x):
        m = re.fullmatch(r"(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})", x)
        parts = [int(g) for g in m.groups()] if m else [256]
        return None if max(parts) > 255 else sum(p << s for p, s in zip(parts, (24, 16, 8, 0)))

    def hit(value, target):
        if value == target:
            return True
        net, slash, bits = target.partition("/")
        if slash and bits.isdigit() and int(bits) <= 32 and long(net) is not None:
            return long(value) is not None and long(value) >> (32 - int(bits)) == long(net) >> (32 - int(bits))
        return bool(re.search(netrange.REGEX_CHARS, target) and re.search(target, value))

    out = {}
    for i, *ends in ranges:
        values = {e.strip() for e in ends if e and e.strip()}
        best = min((n for n, t in targets if t is not None and any(hit(v, t) for v in values)), default=None)
        if best is not None:
            out[i] = dict(targets)[best]
    return out


def test_ip_match_equals_brute_force(spark):
    rng = random.Random(11)
    ip = lambda: ".".join(str(rng.choice([0, 1, 10, 127, 255])) for _ in range(4))
    ranges = [(i, ip(), rng.choice([ip(), None, "", " host-a1.b "])) for i in range(300)]
    targets = [(n, t) for n, t in enumerate([
        None, "x", "10.0.0.0/8", "127.255.0.0/16", r"^1\.1\.", r"(10|127)\.0[.]10", "255.255.255.255", r"host-[a-z]1\.b$", "0.0.0.0/33",
        r"^(?!1).*\.127$", "1.10.0.0/12", r"\.10\.10$", "^$", "10.127.1.0/31", r"127$|^0\.0"])]
    df = spark.createDataFrame(ranges, "range_id int, start_ip string, end_ip string")
    t = spark.createDataFrame(targets, "target_order int, target string")
    got = {r.range_id: r.target for r in netrange.ip_match(df, t).collect()}
    assert got == brute(ranges, targets) and len(set(got.values())) > 8


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_patterns_need_no_nested_loop(spark, no_broadcast):
    """10,000 patterns against 1,000,000 values."""
    octet = lambda h, n: F.pmod(F.xxhash64("id", F.lit(h)), F.lit(n)).cast("string")
    values = spark.range(1_000_000).select(F.col("id").alias("range_id"), F.concat_ws(".", F.lit("10"), octet(1, 100), octet(2, 100), octet(3, 250))
                                           .alias("start_ip"), F.lit(None).cast("string").alias("end_ip"))
    targets = spark.range(10_000).select(F.col("id").alias("target_order"), F.concat(
        F.lit("^10[.]"), (F.col("id") % 100).cast("string"), F.lit("[.]"), F.floor(F.col("id") / 100).cast("string"), F.lit("[.][0-9]{1,2}$"))
        .alias("target"))
    found = netrange.ip_match(values, targets)
    plan = plan_text(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    start = time.time()
    rows = found.join(values, "range_id").where("NOT start_ip RLIKE target").count(), found.count()
    assert rows[0] == 0 and rows[1] == values.where("length(substring_index(start_ip, '.', -1)) <= 2").count()
    assert time.time() - start < 240
