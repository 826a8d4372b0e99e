"""Mixed-format timestamps out of raw text, independent of the session time zone.

The formats of the feeds (all accept unpadded fields, dates with slashes or dashes that do not start
with a year are month-first):

    yyyy-M-dTH:m:sZ   yyyy-M-dTH:m:s   yyyy-M-d H:m:s   yyyy-M-d H:m   yyyy-M-d
    yyyy/M/d H:m:s    yyyy/M/d H:m     yyyy/M/d
    M/d/yyyy H:m      M/d/yyyy         M-d-yyyy H:m     M-d-yyyy

A value in one of these shapes is put in year-month-day order and cast once; nothing runs through a list of
parsers and a bad value costs no exception. Anything else passes through a chain of rewrites, each of which
leaves text it does not match alone. The chain also accepts ISO with a fraction, an offset or no seconds, AM/PM,
dotted dates, day-first dates whose first number exceeds 12, compact dates, and English month names. Offsets
are dropped: the wall-clock time as written is kept.

What is still unread, and has a month's name or three short numbers, is cut into words and numbers, which are folded
one by one into a date: weekdays, ordinals and filler words may stand anywhere, the year may come last, and years may have
two digits (69 to 99 are 1969 to 1999, others 2000 to 2068). Forms that would need today's date to fill a gap (a bare
time, a bare month, a day without a year) are not accepted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyledger.functions.text import sql_text, strip

_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?"

#: Shapes Spark's own cast reads as they are.
_READY = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}(?:T\d{1,2}:\d{1,2}:\d{1,2}Z?| \d{1,2}:\d{1,2}(?::\d{1,2})?)?$"

#: The feed's other shapes, one rewrite each.
_SLASHED = r"^(?!0000)\d{4}/\d{1,2}/\d{1,2}(?: \d{1,2}:\d{1,2}(?::\d{1,2})?)?$"
_MONTH_FIRST = r"^(0?[1-9]|1[0-2])([-/])(\d{1,2})\2(?!0000)(\d{4})( \d{1,2}:\d{1,2})?$"

#: Rewrites towards ``y-m-d h:m:s``, applied in order; one that does not match leaves the text alone.
_NUMERIC = (
    (r"^(0?[1-9]|1[0-2])([-/.])(\d{1,2})\2(\d{4})(?!\d)", "$4-$1-$3"),
    (r"^(1[3-9]|[23]\d)([-/.])(\d{1,2})\2(\d{4})(?!\d)", "$4-$3-$1"),
    (r"^(\d{4})([/.])(\d{1,2})\2(\d{1,2})(?!\d)", "$1-$3-$4"),
    (r"(?i)^(\d{4})(\d{2})(\d{2})(?=$|T\d{4}|\d{4}$|\d{6}$)", "$1-$2-$3 "),
    (r"(?i)^(\S+) T?(\d{2})(\d{2})$", "$1 $2:$3"),
    (r"(?i)^(\S+) T?(\d{2})(\d{2})(\d{2})$", "$1 $2:$3:$4"),
    (rf"(?i)^({_DATE})(?:T|,?\s+)(?=\d)", "$1 "),
)

# Month names, long and short.
_MONTHS = (
    "jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?", "aug(?:ust)?",
    "sep(?:t|tember)?", "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?",
)
_WORDS = (
    (r"(?i)\s*(?:UTC|GMT)$", ""),
    *((rf"(?i)^{name}\.?\s+(\d{{1,2}}),?\s+(\d{{4}})(?!\d)", f"$2-{i}-$1") for i, name in enumerate(_MONTHS, 1)),
    *((rf"(?i)^(\d{{1,2}})[\s-]{name}\.?,?[\s-](\d{{4}})(?!\d)", f"$2-{i}-$1") for i, name in enumerate(_MONTHS, 1)),
    # Twelve-hour clock: the hour is rewritten, an hour outside 1 to 12 keeps its AM or PM and fails below.
    (r"(?i)([\sT])12(:[\d:.]+)\s*AM$", "$1 0$2"),
    (r"(?i)([\sT]0?[1-9]|[\sT]1[01])(:[\d:.]+)\s*AM$", "$1$2"),
    (r"(?i)([\sT]12)(:[\d:.]+)\s*PM$", "$1$2"),
    *((rf"(?i)([\sT])0?{h}(:[\d:.]+)\s*PM$", f"$1{h + 12}$2") for h in range(1, 12)),
)

#: Only values of these kinds are worth rewriting; plain junk is given up at once.
_HAS_WORDS = rf"(?i)^(?=.*\d{{4}})(?:{'|'.join(_MONTHS)})\b|(?i)^\d+[\s-](?:{'|'.join(_MONTHS)})\b|(?i)^\d.*(?:[AP]M|UTC|GMT)$"
_HAS_NUMBERS = r"(?i)^\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}(?!\d)|^\d{8}(?:T?\d{4,6})?$"

#: What must be left after the rewrites; the offset is not part of the value.
_RESULT = rf"(?i)^((?!0000){_DATE}(?: {_CLOCK}(?=\s*(?:Z|[+-]\d{{2}}:?\d{{2}})?$))?)(?:\s*$|\s*Z$|\s*[+-][\d:]+$)"


# Weekday names, words without meaning in a date, marks between its parts.
_WEEKDAYS = (
    "mon", "monday", "tue", "tuesday", "wed", "wednesday", "thu", "thursday", "fri", "friday", "sat", "saturday", "sun", "sunday",
)
_FILLERS = ("st", "nd", "rd", "th", "of", "on", "at", "and", "t", "utc", "gmt", "z")
_BETWEEN = (",", ".", "/", "-", ";")

#: Texts that the fold is tried on, what it leaves out at the end, and its words.
_FREE = r"(?i)^(?=.*\d).*(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)|^\d{1,2}([-/.])\d{1,2}\1\d{1,4}(?!\d)"
_OFFSET = r"(:\d{2}(?:\.\d{1,9})?(?:\s*[ap]m)?)\s*(?:z|utc|gmt)?\s*[+-]\d{2}:?\d{2}$"
_WORD = r"(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?|\d+|[a-z]+|[^\s])"

_STATE = "struct<month:int,numbers:array<string>,clock:string,half:string,wrong:boolean>"
#: From which a year of two digits is in the last century.
_PIVOT = 69


def _any(words: tuple[str, ...]) -> str:
    return ", ".join(map(sql_text, words))


#: The month whose name or common abbreviation the word ``w`` is.
_MONTH = "case " + " ".join(f"when w rlike '^{name}$' then {i}" for i, name in enumerate(_MONTHS, 1)) + " end"

# An hour alone is a number until its AM or PM comes.
_HOUR_ALONE = "(w in ('am', 'pm') and s.clock is null and size(s.numbers) > 0)"

#: The state ``s`` after one more word ``w``, whose month is ``m``.
_STEP = rf"""(s, w) -> get(transform(array({_MONTH}), m -> named_struct(
  'month', coalesce(s.month, m),
  'numbers', case when w rlike r'^\d+$' then concat(s.numbers, array(w))
    when {_HOUR_ALONE} then slice(s.numbers, 1, size(s.numbers) - 1) else s.numbers end,
  'clock', case when {_HOUR_ALONE} then concat(element_at(s.numbers, -1), ':00') when contains(w, ':') then w else s.clock end,
  'half', if(w in ('am', 'pm'), w, s.half),
  'wrong', s.wrong or (m is not null and s.month is not null) or (contains(w, ':') and s.clock is not null)
    or (w in ('am', 'pm') and (s.half is not null or (s.clock is null and not {_HOUR_ALONE})))
    or not (w rlike r'^\d+$' or contains(w, ':') or w in ('am', 'pm') or m is not null
      or w in ({_any(_WEEKDAYS)}) or w in ({_any(_FILLERS)}) or w in ({_any(_BETWEEN)})))), 0)"""

#: The numbers ``a``, ``b``, ``c`` of a state as year, month and day.
_ORDERED = """s -> transform(array(named_struct('named', s.month is not null, 'a', get(s.numbers, 0), 'b', get(s.numbers, 1), 'c', get(s.numbers, 2))),
  n -> if(n.named,
    if(length(n.a) > 2 or cast(n.a as int) > 31, struct(n.a as year, cast(s.month as string) as month, n.b as day),
      struct(n.b as year, cast(s.month as string) as month, n.a as day)),
    case when length(n.a) > 2 or cast(n.a as int) > 31 then struct(n.a as year, n.b as month, n.c as day)
      when cast(n.a as int) > 12 then struct(n.c as year, n.b as month, n.a as day)
      else struct(n.c as year, n.a as month, n.b as day) end))"""

#: ``y-m-d h:m:s`` out of a state, or NULL.
_FOLDED = f"""s -> get(transform(({{ordered}}), d -> if(
    not s.wrong and size(s.numbers) = if(s.month is null, 3, 2) and length(d.day) <= 2 and length(d.month) <= 2
      and (length(d.year) <= 2 or length(d.year) = 4 and d.year <> '0000'),
    concat(
      if(length(d.year) = 4, d.year, cast(cast(d.year as int) + if(cast(d.year as int) < {_PIVOT}, 2000, 1900) as string)),
      '-', d.month, '-', d.day,
      if(s.clock is null, '', concat(' ', get(transform(array(cast(substring_index(s.clock, ':', 1) as int)), h -> cast(
        case when s.half is null then h when h between 1 and 12 then h % 12 + if(s.half = 'pm', 12, 0) end as string)), 0),
        regexp_extract(s.clock, '(:.*)$', 1)))),
    null)), 0)""".format(ordered=_ORDERED.removeprefix("s -> "))


def _from_words(s: Column) -> Column:
    """A date out of words and numbers in any usual order."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(s), _OFFSET, "$1"), r"\b([ap])\.m\.", "$1m")
    start = F.expr(f"cast(struct(null, cast(array() as array<string>), null, null, false) as {_STATE})")
    words = F.regexp_extract_all(plain, F.lit(_WORD), F.lit(1))
    return F.call_function("aggregate", words, start, F.expr(_STEP), F.expr(_FOLDED))


def _rewrite(s: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """Apply the rules in order. Folding over them as data keeps the generated code of a query small."""
    table = ", ".join(f"named_struct('pattern', {sql_text(p)}, 'text', {sql_text(t)})" for p, t in rules)
    return F.aggregate(
        F.expr(f"array({table})"), s, lambda text, rule: F.regexp_replace(text, rule["pattern"], rule["text"])
    )


def parse_timestamp(c: Column) -> Column:
    """Timestamp without zone, NULL when the value is missing or does not parse."""
    s = strip(c)
    unusual = F.when(s.rlike(_HAS_WORDS), _rewrite(s, _WORDS + _NUMERIC)).when(
        s.rlike(_HAS_NUMBERS), _rewrite(s, _NUMERIC)
    )
    ready = (
        F.when(s.rlike(_READY), s)
        .when(s.rlike(_SLASHED), F.translate(s, "/", "-"))
        .when(s.rlike(_MONTH_FIRST), F.regexp_replace(s, _MONTH_FIRST, "$4-$1-$3$5"))
        .otherwise(F.regexp_extract(unusual, _RESULT, 1))
    )
    return F.coalesce(ready.try_cast("timestamp_ntz"), F.when(s.rlike(_FREE), _from_words(s)).try_cast("timestamp_ntz"))


def parse_date(c: Column) -> Column:
    return parse_timestamp(c).cast("date")


def is_blank(c: Column) -> Column:
    """True for NULL and whitespace: tells a missing timestamp from an unparseable one."""
    return F.coalesce(strip(c) == "", F.lit(True))
