"""Exact numbers wider than Spark's 38 digits: 36 digits before the point and 18 after it, in three limbs.

A limb is a whole number below 10^18; the value is ``high`` * 10^18 + ``low`` + ``part`` / 10^18, and only ``high`` can be negative.
So limbs compare field by field as numbers do, and a struct of them is its own sort key. Sums, differences and
products are built limb by limb and carried.

Each function is one lambda over its argument, written as SQL text and parsed once: values in it are computed once, and it
stays out of generated code, so a plan that needs it for few rows is no larger for the others.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB = 18
WHOLE_DIGITS, DECIMALS = 2 * LIMB, LIMB

_BASE = f"1{'0' * LIMB}BD"
_NUMBER = r"r'^([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,9}))?$'"
_LIMBS = ("high", "low", "part")


def let(value: Column, use: str) -> Column:
    """The lambda ``use`` of a value."""
    return F.get(F.call_function("transform", F.array(value), F.expr(use)), F.lit(0))


def sql_let(value: str, name: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _limbs(*values: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', cast({v} as decimal(38,0))" for n, v in zip(_LIMBS, values, strict=True)) + ")"


def _over(x: str) -> str:
    """How often a limb holds 10^18; the division is exact."""
    return f"cast(({x} - pmod({x}, {_BASE})) / {_BASE} as decimal(38,0))"


def _carried(*values: str) -> str:
    """The same value with ``low`` and ``part`` from 0 to below 10^18."""
    first = _limbs("c0.high", f"c0.low + {_over('c0.part')}", f"pmod(c0.part, {_BASE})")
    second = _limbs(f"c1.high + {_over('c1.low')}", f"pmod(c1.low, {_BASE})", "c1.part")
    return sql_let(_limbs(*values), "c0", sql_let(first, "c1", second))


def sql_minus(a: str, b: str) -> str:
    return _carried(*[f"cast({a}.{n} - {b}.{n} as decimal(38,0))" for n in _LIMBS])


def sql_negative(x: str) -> str:
    return _carried(*[f"-{x}.{n}" for n in _LIMBS])


def sql_magnitude(x: str) -> str:
    return f"if({x}.high < 0, {sql_negative(x)}, {x})"


def _unless_null(x: str, body: str) -> str:
    return f"if({x} is null, null, {body})"


SQL_PARTS = sql_let(
    "named_struct(" + ", ".join(f"'{n}', regexp_extract(n, {_NUMBER}, {i})" for i, n in enumerate(("sign", "whole", "part", "shift"), 1)) + ")",
    "t",
    sql_let(
        "named_struct('digits', concat(t.whole, t.part), 'sign', if(t.sign = '-', -1, 1), 'shift', try_cast(t.shift as int), "
        "'point', length(t.whole) + coalesce(try_cast(t.shift as int), 0))",
        "d",
        "if(d.digits = '' or abs(coalesce(d.shift, 0)) > 1000, null, named_struct('sign', d.sign, 'whole', "
        "regexp_replace(if(d.point > 0, rpad(left(d.digits, d.point), d.point, '0'), ''), '^0+', ''), 'part', "
        "regexp_replace(if(d.point >= 0, substring(d.digits, d.point + 1), concat(repeat('0', -d.point), d.digits)), '0+$', '')))",
    ),
)
SQL_PARTS = f"if(n rlike {_NUMBER}, {SQL_PARTS}, null)"
_WHOLE = f"lpad(p.whole, {WHOLE_DIGITS}, '0')"
_SIGNED = [f"cast({x} as decimal(38,0)) * cast(p.sign as decimal(1,0))" for x in (
    f"left({_WHOLE}, {LIMB})", f"right({_WHOLE}, {LIMB})", f"rpad(p.part, {DECIMALS}, '0')")]
_WIDE = sql_let(SQL_PARTS, "p", f"if(length(p.whole) <= {WHOLE_DIGITS} and length(p.part) <= {DECIMALS}, {_carried(*_SIGNED)}, null)")


def parts(number: Column) -> Column:
    """(sign, whole, part) of a finite number's text: its digits before the point without leading zeros, those after it
    without trailing ones. NULL if the text is no number or has an exponent beyond 1,000."""
    return let(number, f"n -> {SQL_PARTS}")


def wide(number: Column) -> Column:
    """The limbs of a number's text; NULL if it is none or has more digits than they hold."""
    return let(number, f"n -> {_WIDE}")


def from_working(amount: Column) -> Column:
    """A decimal of at most 15 digits before the point and 8 after it."""
    part = f"cast(cast((a - floor(a)) as decimal(9,8)) * 1{'0' * 8}BD as decimal(9,0)) * 1{'0' * (LIMB - 8)}BD"
    whole = "cast(floor(a) as decimal(19,0))"
    limbs = _limbs("if(a < 0, -1, 0)", f"if(a < 0, {whole} + {_BASE}, {whole})", part)
    return let(amount, f"a -> {_unless_null('a', limbs)}")


def minus(a: Column, b: Column) -> Column:
    return let(F.struct(a.alias("a"), b.alias("b")), f"d -> if(d.a is null or d.b is null, null, {sql_minus('d.a', 'd.b')})")


def negative(a: Column) -> Column:
    return let(a, f"x -> {_unless_null('x', sql_negative('x'))}")


def whole_of(a: Column) -> Column:
    """A whole number of at most 18 digits out of its limbs; NULL for any other."""
    one = f"case x.high when 0 then x.low when -1 then x.low - {_BASE} end"
    return let(a, f"x -> if(x.part = 0 and abs({one}) < {_BASE}, try_cast({one} as decimal(18,0)), null)")


def times(whole: Column, a: Column) -> Column:
    """A whole number of at most 18 digits times limbs whose ``high`` has at most 18 digits."""
    limbs = [f"cast(cast(m.w as decimal(18,0)) * cast(m.a.{n} as decimal(19,0)) as decimal(38,0))" for n in _LIMBS]
    return let(F.struct(whole.alias("w"), a.alias("a")), f"m -> if(m.w is null or m.a is null, null, {_carried(*limbs)})")


def magnitude(a: Column) -> Column:
    return let(a, f"x -> {sql_magnitude('x')}")


def sql_apart(difference: str) -> str:
    """Whether a difference is more than 0.01, up or down."""
    return sql_let(sql_magnitude(difference), "m", f"m.high > 0 or m.low > 0 or m.part > 1{'0' * (LIMB - 2)}BD")


def sql_text(a: str, places: str) -> str:
    """``a`` with ``places`` decimals, further ones cut off."""
    plain = lambda limb: f"lpad(cast({limb} as string), {LIMB}, '0')"
    digits = f"regexp_replace(concat(cast(m.high as string), {plain('m.low')}), '^0+(?=.)', '')"
    point = f"if({places} > 0, concat('.', left({plain('m.part')}, {places})), '')"
    return sql_let(sql_magnitude(a), "m", f"concat(if({a}.high < 0, '-', ''), {digits}, {point})")


def hundredths_apart(difference: Column) -> Column:
    return let(difference, f"x -> {sql_apart('x')}")


def text(a: Column, places: Column) -> Column:
    return let(F.struct(a.alias("a"), places.alias("places")), f"x -> {_unless_null('x.a', sql_text('x.a', 'x.places'))}")


def cents(a: Column, kind: str) -> Column:
    """Rounded half up to a decimal type with two decimals; NULL where it has no room."""
    up, unit = f"(m.part + 5{'0' * (LIMB - 3)}BD)", f"1{'0' * (LIMB - 2)}BD"
    whole = f"(m.low * 100BD + cast(({up} - pmod({up}, {unit})) / {unit} as decimal(38,0)))"
    signed = f"cast(if(x.high < 0, -{whole}, {whole}) as decimal(18,0))"
    read = sql_let(sql_magnitude("x"), "m", f"if(m.high = 0 and m.low < 1{'0' * 15}BD, try_cast({signed} * 0.01BD as {kind}), null)")
    return let(a, f"x -> {_unless_null('x', read)}")
