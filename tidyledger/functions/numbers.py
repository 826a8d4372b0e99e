"""Numbers out of raw text. A value that is missing or does not parse becomes NULL."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyledger.functions import wide
from tidyledger.functions.text import sql_strip, strip

#: Amounts and prices in the rules: 15 digits before the point and 8 after it. Any other is worked on in limbs.
WORKING = "decimal(23,8)"
#: Quantities in the rules, up to 18 digits in limbs.
WHOLE = "decimal(14,0)"
#: Any quantity times any price; its difference from an amount still has 8 decimals within Spark's 38 digits.
PRODUCT = "decimal(37,8)"
#: Amounts of the curated tables.
MONEY = "decimal(12,2)"
#: Wide enough that a fraction such as 2.0000001 is still seen when testing for whole numbers.
EXACT = "decimal(38,18)"

_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"

# Fixed value: amounts further apart than this disagree.
TOLERANCE = Decimal("0.01")


def digits(c: Column) -> Column:
    """A number as written: stripped, without digit underscores."""
    return F.replace(strip(c), F.lit("_"), F.lit(""))


def to_decimal(c: Column, kind: str = WORKING) -> Column:
    """Signs, exponents and digit underscores are accepted; ``$36``, ``1,000``, nan and inf are not."""
    return digits(c).try_cast(kind)


def to_whole(c: Column) -> Column:
    """``2`` and ``2.0`` give 2; ``2.5`` gives NULL. Negatives pass through."""
    exact = to_decimal(c, EXACT)
    return F.when(exact == F.floor(exact), exact.try_cast(WHOLE))


def to_int(c: Column) -> Column:
    """The stored quantity."""
    return to_whole(c).try_cast("int")


def times(quantity: Column, price: Column) -> Column:
    """Both as the rules read them."""
    return (quantity * price).cast(PRODUCT)


def is_number(c: Column) -> Column:
    """Whether the text is a finite number, of any size. NULL is not."""
    return F.coalesce(digits(c).rlike(_NUMBER), F.lit(False))


def is_beyond(c: Column) -> Column:
    """A number that the working type would lose digits of. Few digits in a row settle that it would not."""
    d = digits(c)
    lost = ~F.coalesce(to_decimal(c, EXACT) == to_decimal(c), F.lit(False)) | d.rlike(r"\.\d{18}\d*[1-9]")
    return F.when(d.rlike(r"\d{9}|[eE]"), is_number(c) & lost).otherwise(F.lit(False))


def limbs(c: Column, more: Decimal | None = None) -> Column:
    """The number in the text, exact in any width up to 36 digits before the point and 18 after it, and ``more`` than it."""
    working, exact = to_decimal(c), wide.wide(digits(c))
    if more is not None:
        working, exact = working + F.lit(more), wide.minus(exact, wide.from_working(F.lit(-more).cast(WORKING)))
    return F.when(is_beyond(c), exact).otherwise(wide.from_working(working))


def is_oversized_whole(c: Column) -> Column:
    """A whole number that ``to_whole`` has no room for."""
    d = digits(c)
    ends = F.coalesce(wide.parts(d)["part"] == "", ~d.rlike("[eE]-"))
    return F.when(d.rlike(r"\d{15}|[eE]"), is_number(c) & to_whole(c).isNull() & ends).otherwise(F.lit(False))


def large_whole(c: Column) -> Column:
    """An oversized whole number of up to 18 digits."""
    return F.when(is_oversized_whole(c), wide.whole_of(wide.wide(digits(c))))


def amount_problem(c: Column) -> Column:
    """Why the rules or the curated tables do not hold the number in the text; NULL if they do."""
    return F.when(
        is_number(c),
        F.when(is_beyond(c) & wide.wide(digits(c)).isNull(), F.lit("too large to be checked")).when(
            money(c).isNull(), F.lit("too large for the curated table")
        ),
    )


def quantity_problem(c: Column) -> Column:
    """The same for quantities; one that is not whole is a violation of its rule and not reported here."""
    large = is_oversized_whole(c)
    return F.when(large & large_whole(c).isNull(), F.lit("too large to be checked")).when(
        large | (to_whole(c).isNotNull() & to_int(c).isNull()), F.lit("too large for the curated table")
    )


def money(c: Column) -> Column:
    """The number in the text, rounded once to the stored type."""
    return to_decimal(c, MONEY)


def to_money(amount: Column) -> Column:
    """Round a working amount to the stored type."""
    return amount.try_cast(MONEY)


def disagree(a: Column, b: Column) -> Column:
    """True when both amounts are known and differ by more than the tolerance."""
    return F.abs(a - b) > F.lit(TOLERANCE)


def sql_digits(name: str) -> str:
    return f"replace({sql_strip(name)}, '_', '')"


def sql_decimals(name: str) -> str:
    """Decimal places as written in the source (0 to 18); exponent notation shows eight at least."""
    written = f"least(length(regexp_extract(n, r'\\.(\\d+)$', 1)), {wide.DECIMALS})"
    body = f"if(n rlike '[eE]', greatest(8, least(length({wide.SQL_PARTS}.part), {wide.DECIMALS})), {written})"
    return wide.sql_let(sql_digits(name), "n", body)


def decimals_in(c: Column) -> Column:
    return wide.let(c, f"raw -> {sql_decimals('raw')}")
