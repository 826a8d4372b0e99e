"""Numbers in three limbs against Python's own decimals."""

from __future__ import annotations

import random
from decimal import Decimal, getcontext

from pyspark.sql import functions as F

from tidyledger.functions import wide


def value(limbs) -> Decimal | None:
    return None if limbs is None else (int(limbs.high) * 10**18 + int(limbs.low)) + Decimal(int(limbs.part)).scaleb(-18)


def numbers(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choices("0123456789", k=k))
    out = ["0", "-0", "0.01", "-0.01", "1" + "0" * 35, "-" + "9" * 36 + "." + "9" * 18, "." + "0" * 17 + "1", "9" * 18, "-" + "9" * 18]
    for _ in range(n):
        whole, part = digits(rng.choice([0, 1, 3, 17, 18, 19, 30, 36])), digits(rng.choice([0, 1, 2, 8, 9, 18]))
        if whole or part:
            out.append(rng.choice(["", "-", "+"]) + whole + (f".{part}" if part else ""))
    return out


def test_reads_every_form(rows):
    getcontext().prec = 120
    texts = numbers(1, 120) + ["1e3", "1.5E-3", "-2.50e+2", "12e-18", "1e35", "5.", ".5", "0e5", "00012.500"]
    not_held = ["1" + "0" * 36, "0." + "0" * 18 + "1", "1e36", "1e-19", "1e999999"]
    no_numbers = [None, "", ".", "+", "e5", "1,0", "1 0", "nan", "inf", "0x1", "1e"]
    df = rows("t string", *[(t,) for t in texts + not_held + no_numbers])
    got = [(r.t, value(r.w)) for r in df.select("t", wide.wide(F.col("t")).alias("w")).collect()]
    for t, w in got:
        assert w == (Decimal(t) if t in texts else None), t


def test_limbs_sort_as_numbers(rows):
    getcontext().prec = 120
    texts = numbers(2, 150)
    got = rows("t string", *[(t,) for t in texts]).select("t", wide.wide(F.col("t")).alias("w")).orderBy("w", "t").collect()
    assert [Decimal(r.t) for r in got] == sorted(Decimal(t) for t in texts)


def test_working_decimals_have_the_same_limbs(rows):
    texts = ["0", "-0.00000001", "12.34", "-12.34", "999999999999999.99999999", "-999999999999999.99999999", "-1", None]
    got = rows("t string", *[(t,) for t in texts]).select(
        wide.from_working(F.col("t").cast("decimal(23,8)")).alias("a"), wide.wide(F.col("t")).alias("b")
    )
    assert all(r.a == r.b for r in got.collect())


def test_arithmetic(rows):
    getcontext().prec = 120
    rng = random.Random(3)
    cases = [(rng.choice(numbers(i, 3)), rng.choice(numbers(i + 500, 3)), str(rng.randint(-(10**18) + 1, 10**18 - 1))) for i in range(150)]
    cases += [("12.35", "12.34", "1"), ("12.3500000001", "12.34", "-7"), (None, "1", "1"), ("1", None, None)]
    df = rows("a string, b string, q string", *cases)
    a, b = wide.wide(F.col("a")), wide.wide(F.col("b"))
    got = df.select(
        "*", wide.minus(a, b).alias("d"), wide.hundredths_apart(wide.minus(a, b)).alias("far"), wide.negative(a).alias("n"),
        wide.times(F.col("q").cast("decimal(18,0)"), b).alias("p"), wide.text(wide.minus(a, b), F.lit(18)).alias("text"),
        wide.text(a, F.lit(0)).alias("whole"),
    ).collect()
    for r in got:
        if r.a is None or r.b is None:
            assert r.d is None and r.text is None
            continue
        x, y = Decimal(r.a), Decimal(r.b)
        assert value(r.d) == x - y and value(r.n) == -x and value(r.p) == int(r.q) * y
        assert r.far == (abs(x - y) > Decimal("0.01"))
        assert Decimal(r.text) == x - y and r.text.split(".")[1].isdigit() and len(r.text.split(".")[1]) == 18
        assert r.whole.lstrip("-") == str(int(abs(x)))


def test_whole_numbers(rows):
    texts = {"5": 5, "-5": -5, "5.5": None, "9" * 18: 10**18 - 1, "-" + "9" * 18: 1 - 10**18, "1" + "0" * 18: None, "0": 0, "1e3": 1000, None: None}
    df = rows("t string", *[(t,) for t in texts])
    for r in df.select("t", wide.whole_of(wide.wide(F.col("t"))).alias("n")).collect():
        assert r.n == texts[r.t], r.t
