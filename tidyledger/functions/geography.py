"""Country and state standardisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.functions.text import stripped_or_null

# Country spellings that mean USA, lower case.
USA_SPELLINGS = ("usa", "us", "u.s.", "u.s.a.", "united states", "united states of america")

# USPS codes of the 50 states and DC by name.
STATE_CODES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO",
    "connecticut": "CT", "delaware": "DE", "district of columbia": "DC", "florida": "FL", "georgia": "GA",
    "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS",
    "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI",
    "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV",
    "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY", "north carolina": "NC",
    "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA",
    "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX",
    "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV", "wisconsin": "WI",
    "wyoming": "WY",
}


def standardize_country(c: Column) -> Column:
    """Known spellings become USA; anything else passes through stripped; blank is NULL."""
    s = stripped_or_null(c)
    return F.when(F.lower(s).isin(*USA_SPELLINGS), F.lit("USA")).otherwise(s)


_CODE_OF = "map({})".format(
    ", ".join(f"'{text}', '{code}'" for name, code in STATE_CODES.items() for text in (name, code.lower()))
)


def standardize_state(c: Column) -> Column:
    """Codes in any case and full names become USPS codes; anything else passes through stripped."""
    s = stripped_or_null(c)
    return F.coalesce(F.try_element_at(F.expr(_CODE_OF), F.lower(s)), s)


def standardize_geo_columns(
    df: DataFrame, country_col: str | None = None, state_col: str | None = None
) -> DataFrame:
    """Standardise in place and keep the original values as ``<col>_raw``; either side may be left out."""
    columns: dict[str, Column] = {}
    for name, rule in ((country_col, standardize_country), (state_col, standardize_state)):
        if name is not None:
            columns[f"{name}_raw"] = F.col(name)
            columns[name] = rule(F.col(name))
    return df.withColumns(columns)
