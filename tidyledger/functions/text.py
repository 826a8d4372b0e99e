"""Text helpers shared by every cleaning rule."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as whitespace at the ends of a raw value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

#: What a message shows in place of a missing value.
MISSING = "<missing>"


def strip(c: Column) -> Column:
    """Remove whitespace of any kind from both ends (Spark's own trim removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def sql_strip(name: str) -> str:
    """``strip`` as SQL text."""
    return f"btrim({name}, {sql_text(WHITESPACE)})"


def stripped_or_null(c: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def same_word(c: Column, word: str) -> Column:
    """Status test of the rules: stripped, any case, NULL is no match."""
    return F.coalesce(F.lower(strip(c)) == word, F.lit(False))


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def message(template: str, **fields: str) -> Column:
    """Fill a ``{name}`` template from named columns; a missing value shows as ``<missing>``."""
    parts: list[str] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(sql_text(literal))
        if name is not None:
            parts.append(f"cast({fields[name]} AS string)")
    return F.expr(f"array_join(array({', '.join(parts)}), '', {sql_text(MISSING)})")


def full_name(first: Column, last: Column) -> Column:
    """First and last name with one space; NULL if either is NULL."""
    return F.concat(strip(first), F.lit(" "), strip(last))


def table_cell(c: Column, width: int = 120) -> Column:
    """Escape pipes for a report table, then shorten to ``width`` characters with an ellipsis."""
    escaped = F.replace(c, F.lit("|"), F.lit("\\|"))
    return F.when(F.length(escaped) > width, F.concat(F.substring(escaped, 1, width - 3), F.lit("..."))).otherwise(
        escaped
    )


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def dollars(c: Column) -> Column:
    """``$1,234.56``."""
    return F.concat(F.lit("$"), F.format_number(c, 2))
