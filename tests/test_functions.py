"""Column rules against plain-Python readings of the same rule."""

from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal, InvalidOperation

import pytest
from dateutil import parser as dates
from pyspark.sql import functions as F

from tidyledger.functions import contact, geography, numbers, text, timestamps, wide

# Formats of the feeds.
FORMATS = (
    "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y/%m/%d %H:%M:%S",
    "%Y/%m/%d %H:%M", "%m/%d/%Y %H:%M", "%m-%d-%Y %H:%M", "%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%m-%d-%Y",
)


def apply(rows, fn, values):
    df = rows("i int, v string", *enumerate(values))
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def python_timestamp(value):
    value = value.strip()
    for fmt in FORMATS:
        try:
            return datetime.strptime(value, fmt)
        except ValueError:
            pass
    try:
        return dates.parse(value).replace(tzinfo=None)
    except (ValueError, OverflowError):
        return None


TIMESTAMPS = [
    "2025-03-05T16:45:00Z", "2025-03-02T11:00:00", "2025-03-01 10:15:00", "2025-03-07 11:30", "2025/03/03 09:00:59",
    "2025/03/03 09:00", "03/02/2025 14:20", "05-06-2025 16:30", "2025-01-04", "2025/01/14", "01/12/2025",
    "03-06-2025", "3/2/2025", "2025-1-4 7:05", "2025-02-30", "13/45/2025", "2025-13-40", "bad_timestamp",
    " 2025-03-01 10:15\t", "2025-03-01  10:15", "2025-03-01 24:00", "2025-03-01 10:60", "2025-03-01 10:15:60",
    "2025-03-05t16:45:00z", "0000-01-01", "2024-02-29", "2025-02-29", "13/02/2025", "31-12-2024 08:00",
    "2025-03-05T16:45", "2025-03-05T16:45:00.123", "2025-03-05 16:45:00.123456", "2025-03-05T16:45:00+02:00",
    "2025-03-05T16:45:00.5-0500", "March 5, 2025", "Mar 5, 2025 10:15", "5 Mar 2025", "5-Sep-2025", "sept 5 2025",
    "20250301", "20250301T101500", "202503011015", "2025.03.01", "03/02/2025 02:20 PM", "03/02/2025 12:05 am",
    "3/2/2025 2:20:30 pm", "03/02/2025 13:20 PM", "5 Foo 2025", "2025-03-09 02:30", "2025-11-02 01:30:00",
    "03/02/2025 14:20:30",
]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_timestamps_match_the_listed_formats(spark, rows, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = apply(rows, lambda c: timestamps.parse_timestamp(c).cast("string"), TIMESTAMPS)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = [python_timestamp(v) for v in TIMESTAMPS]
    shown = [w and w.isoformat(sep=" ").rstrip("0").rstrip(".") if w and w.microsecond else w and w.isoformat(sep=" ") for w in want]
    assert dict(zip(TIMESTAMPS, got)) == dict(zip(TIMESTAMPS, shown))


FREE_FORMS = [
    "Jan 5th 2025", "Sunday, January 5, 2025", "05-Jan-25", "1/5/25", "Sun Jan 5 10:15:00 2025", "5th of January 2025 at 10am",
    "January 5, 2025 10:15 PM", "5jan2025", "Jan-05-2025", "2025 January 5", "2025-Jan-05", "Sun, 05 Jan 2025 10:15:00 GMT",
    "Sun, 05 Jan 2025 10:15:00 +0200", "13/1/25", "99/1/5", "31 Feb 2025", "Jan 5 2025 25:00", "Jan 5 2025 13:00 PM", "12 am Jan 5 2025",
    "Jan 5 2025 12am", "5 Jan 68", "Sept 5 2025", "Jan 5 2025 Jan", "marble 5 2025", "5.1.25", "1-5-25 10:15", "Jan. 5, 2025",
    "January 5 2025 10:15:30.25", "Mon Jan 5 2025 T10:15", "march 3 25", "2025 5 Jan", "1/5/2025 at 10:15", "the 5th of Jan 2025",
    "Jan 5 20255", "Jan 0 2025", "1/2/3", "Jan 5, 2025, 10:15 a.m.", "Jan 5 2025 am", "may be 3", "13/13/25",
]


def test_free_forms_match_a_general_parser(rows):
    got = apply(rows, timestamps.parse_timestamp, FREE_FORMS)
    assert dict(zip(FREE_FORMS, got)) == {v: python_timestamp(v) for v in FREE_FORMS}


def test_years_of_two_digits_have_a_fixed_century(rows):
    got = apply(rows, timestamps.parse_date, ["5 Jan 00", "5 Jan 68", "5 Jan 69", "1/5/99"])
    assert [d.year for d in got] == [2000, 2068, 1969, 1999]


def test_incomplete_timestamps_are_not_filled_from_today(rows):
    values = ["10:15", "2025", "2025-03", "March", "", "  ", None, "T10:15", "1", "Jan 5", "Jan 2025", "Sunday", "5th", "1/5", "Sunday 10:15"]
    assert apply(rows, timestamps.parse_timestamp, values) == [None] * len(values)
    assert apply(rows, timestamps.is_blank, values) == [v is None or not v.strip() for v in values]


NUMBERS = ["36", " 36.50 ", "-21.00", "+5", "1e3", "1E-2", ".5", "5.", "1_000", "_1__0_", "$36", "1,000", "nan", "inf",
           "-Infinity", "", "  ", None, "abc", "1.2.3", "_", "2.0", "2.5", "-3.0", "2.0000001", "0x10", "1d", "\t7\n"]


def python_decimal(value):
    try:
        d = Decimal((value or "").strip())
    except InvalidOperation:
        return None
    return d if d.is_finite() else None


def test_decimals(rows):
    got = apply(rows, lambda c: numbers.to_decimal(c), NUMBERS)
    want = [None if (d := python_decimal(v)) is None else d.quantize(Decimal("0.00000001")) for v in NUMBERS]
    assert dict(zip(NUMBERS, got)) == dict(zip(NUMBERS, want))


def test_integers(rows):
    got = apply(rows, numbers.to_int, NUMBERS)
    want = [None if (d := python_decimal(v)) is None or d != d.to_integral_value() else int(d) for v in NUMBERS]
    assert dict(zip(NUMBERS, got)) == dict(zip(NUMBERS, want))
    assert apply(rows, numbers.to_int, ["99999999999"]) == [None]
    large = ["3000000000", "99999999999999", "100000000000000", "-3000000000.0", "1e13"]
    assert apply(rows, numbers.to_whole, large) == [3000000000, 99999999999999, None, -3000000000, 10**13]


def test_numbers_are_told_from_junk_whatever_their_size(rows):
    want = [v is not None and python_decimal(v) is not None for v in NUMBERS]
    assert dict(zip(NUMBERS, apply(rows, numbers.is_number, NUMBERS))) == dict(zip(NUMBERS, want))
    assert apply(rows, numbers.is_number, ["9" * 60, "1e300", "-" + "9" * 20 + ".5"]) == [True] * 3


def test_numbers_without_room_have_a_reason(rows):
    curated, checked = "too large for the curated table", "too large to be checked"
    amounts = {
        "12.00": None, "9999999999.99": None, "12345678901.00": curated, "123456789012345.67": curated, "9" * 16: curated,
        "9" * 36: curated, "9" * 37: checked, "1e300": checked, "0.123456789": None, "0." + "1" * 18: None, "0." + "1" * 19: checked,
        "1.50" + "0" * 30: None, "x": None, None: None,
    }
    assert apply(rows, numbers.amount_problem, list(amounts)) == list(amounts.values())
    quantities = {
        "2": None, "2.5": None, "3000000000": curated, "9" * 15: curated, "9" * 18: curated, "9" * 19: checked, "9" * 30: checked,
        "-" + "9" * 15: curated, "1e40": checked, "1e2000": checked, "9" * 30 + ".5": None, "x": None, None: None,
    }
    assert apply(rows, numbers.quantity_problem, list(quantities)) == list(quantities.values())


def test_numbers_beyond_the_working_type(rows):
    texts = {
        "12.34": False, "123456789.12345678": False, "0.123456789": True, "12.340000000": False, "9" * 15: False, "9" * 16: True,
        "1e3": False, "1e-9": True, "1e15": True, "1_000.00": False, "12." + "0" * 19: False, "12." + "0" * 19 + "1": True, "x" * 20: False,
        None: False,
    }
    assert apply(rows, numbers.is_beyond, list(texts)) == list(texts.values())
    whole = {"9" * 14: None, "9" * 15: 10**15 - 1, "-" + "9" * 18: 1 - 10**18, "1e17": 10**17, "9" * 19: None, "9" * 16 + ".5": None}
    assert apply(rows, numbers.large_whole, list(whole)) == list(whole.values())


def test_amounts_are_rounded_once(rows):
    assert [str(x) for x in apply(rows, numbers.money, ["0.00499999999", "0.005", "-2.345", "1_0"])] == ["0.00", "0.01", "-2.35", "10.00"]
    limbs = lambda c: wide.cents(numbers.limbs(c), "decimal(12,2)")
    got = apply(rows, limbs, ["0.00499999999", "0.005", "-2.345", "9999999999.994", "9999999999.995", "9" * 20, None])
    assert [None if x is None else str(x) for x in got] == ["0.00", "0.01", "-2.35", "9999999999.99", None, None, None]


def test_amounts_print_as_written(rows):
    values = ["50.00", "50", "-6.5", "0.125", "-0.50", "12.1234567", "9" * 30 + ".123456789"]
    show = lambda c: wide.text(numbers.limbs(c), numbers.decimals_in(c))
    assert apply(rows, show, values) == values
    assert apply(rows, show, ["1e3", "1.23456789012e0"]) == ["1000.00000000", "1.23456789012"]


def test_tolerance_is_strict(rows):
    df = rows(
        "a string, b string", ("1.00", "1.01"), ("1.00", "1.011"), ("1.01", "1.00"), ("1.00", "x"), ("10.00", "10.01000001"),
        ("123456789012345.67", "123456789012345.69"),
    )
    got = df.select(numbers.disagree(numbers.to_decimal(F.col("a")), numbers.to_decimal(F.col("b")))).collect()
    assert [r[0] for r in got] == [False, True, False, None, True, True]


def test_geography(rows):
    countries = ["US", " usa ", "U.S.", "u.s.a.", "United States of America", "Canada", " Canada ", "", "  ", None]
    assert apply(rows, geography.standardize_country, countries) == (
        ["USA"] * 5 + ["Canada", "Canada", None, None, None]
    )
    states = ["il", "IL", "Illinois", "NEW YORK", " district of columbia", "Ontario", " ON ", "", None]
    assert apply(rows, geography.standardize_state, states) == (
        ["IL", "IL", "IL", "NY", "DC", "Ontario", "ON", None, None]
    )
    assert len(geography.STATE_CODES) == 51


def test_geo_columns_keep_the_raw_values(rows):
    df = rows("country string, state string", ("US", "texas"))
    both = geography.standardize_geo_columns(df, "country", "state").first().asDict()
    assert both == {"country": "USA", "state": "TX", "country_raw": "US", "state_raw": "texas"}
    assert geography.standardize_geo_columns(df, state_col="state").columns == ["country", "state", "state_raw"]


def test_email(rows):
    assert apply(rows, contact.normalize_email, [" A@X.com ", "", " ", None]) == ["a@x.com", None, None, None]
    good = ["a@x.com", " A.b+c@sub.example.co ", "o'hara@example.com", "用户@example.com", "a@bücher.de", "x" * 64 + "@x.com"]
    bad = ["", None, "a", "a@", "@x.com", "a@x", "a..b@x.com", ".a@x.com", "a.@x.com", "a@-x.com", "a@x-.com", "a b@x.com",
           "a@x..com", "a@@x.com", "a@x.c0m1", "a@localhost", "a@foo.test", "a@foo.local", "x" * 65 + "@x.com",
           "a@" + "x" * 64 + ".com", '"a"@x.com', "a@[1.2.3.4]", "bad..4@x.com"]
    assert apply(rows, contact.is_valid_email, good) == [True] * len(good)
    assert dict(zip(bad, apply(rows, contact.is_valid_email, bad))) == dict.fromkeys(bad, False)


def test_encoded_host_names(rows):
    """Against the standard library's encoding."""
    rng = random.Random(3)
    pool = "abcxyz019-" + "üéñßжщ日本語한글🙂𝒜ā"
    labels = ["ü" * n for n in (1, 2, 55, 56, 57, 58, 59, 60)] + ["bücher", "пример", "a", "a-b", "🙂" * 30, "日" * 30 + "本" * 20]
    labels += ["".join(rng.choices(pool, k=rng.randint(1, 40))) for _ in range(100)]
    want = [len(x) if x.isascii() else 4 + len(x.encode("punycode")) for x in labels]
    assert apply(rows, contact.encoded_length, labels) == want
    hosts = {"a@" + "ü" * 50 + ".com": True, "a@" + "ü" * 60 + ".com": False, "a@" + ".".join(["ü" * 40] * 6) + ".com": False,
             "a@" + ".".join(["ü" * 40] * 4) + ".com": True, "a@" + "x" * 63 + ".com": True}
    assert apply(rows, contact.is_valid_email, list(hosts)) == list(hosts.values())


def test_active_flag(rows):
    values = ["Y", " yes ", "TRUE", "1", "true", "N", "", None, "0", "T"]
    assert apply(rows, contact.is_active, values) == [True] * 5 + [False] * 5


def test_strip_removes_what_python_strips(rows):
    values = ["\t a \n", "\xa0b　", "\x1cc\x85", " d e ", "​"]
    assert apply(rows, text.strip, values) == [v.strip() for v in values]


def test_text_helpers(rows):
    assert apply(rows, lambda c: text.message("k={k}: '{v}'!", k="v", v="i + 1"), ["a", None]) == [
        "k=a: '1'!", "k=<missing>: '2'!",
    ]
    long = "x" * 121
    cells = apply(rows, text.table_cell, ["a|b", "x" * 120, long, None])
    assert cells == ["a\\|b", "x" * 120, "x" * 117 + "...", None]
    assert apply(rows, lambda c: text.dollars(c.cast("decimal(18,2)")), ["1234.5", "-3", "1234567.891"]) == [
        "$1,234.50", "$-3.00", "$1,234,567.89",
    ]
    assert apply(rows, lambda c: text.same_word(c, "completed"), [" Completed ", "COMPLETED", "x", None]) == [
        True, True, False, False,
    ]
    names = rows("a string, b string", (" Ann ", "Lee"), (None, "Lee"))
    assert [r[0] for r in names.select(text.full_name(F.col("a"), F.col("b"))).collect()] == ["Ann Lee", None]
