"""Cleaning expressions: names, phones, zips, dates, shapes. All JVM-side but NFKD of non-ASCII text."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed value: the white space that Python's strip removes, as a Java class.
_WS = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"


@F.pandas_udf(StringType())
def _nfkd(values: pd.Series) -> pd.Series:
    return values.map(
        lambda v: None if v is None else unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode()
    )


def strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"^{_WS}+", ""), f"{_WS}+$", "")


def clean_string(c: Column) -> Column:
    """ASCII by compatibility decomposition, stripped, upper case; null stays null. ASCII values never leave the JVM
    as text: the UDF gets null for them."""
    ascii_ = c.rlike(r"^[\x00-\x7F]*$")
    return F.upper(strip(F.when(ascii_, c).otherwise(_nfkd(F.when(~ascii_, c)))))


def clean_phone(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def clean_zip(c: Column) -> Column:
    return strip(c)


def clean_sex(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


#: Date directives and how Spark spells them (one letter reads one or two digits).
_DIRECTIVES = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "M",
    "%d": "d",
    "%b": "MMM",
    "%B": "MMMM",
    "%j": "D",
    "%H": "H",
    "%M": "m",
    "%S": "s",
}


def java_format(date_format: str) -> str:
    def one(m: re.Match) -> str:
        if m[0] in _DIRECTIVES:
            return _DIRECTIVES[m[0]]
        if m[0][0] == "%":
            raise ValueError(f"date directive {m[0]} is not supported")
        return f"'{m[0]}'" if m[0].isalpha() else m[0]

    return re.sub(r"%.|[^%]", one, date_format)


def clean_dob(c: Column, date_format: str, strict: bool = True) -> Column:
    """ISO text of a date text; blank or null to blank. A bad value is an error if strict, else null."""
    value = strip(c)
    parse = F.to_date if strict else F.try_to_date
    blank = F.coalesce(value, F.lit("")) == ""
    return F.when(blank, "").otherwise(
        F.date_format(parse(F.when(~blank, value), java_format(date_format)), "yyyy-MM-dd")
    )


def iso_date(c: Column) -> Column:
    """A date column as ISO text, null as blank."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))


def century_date(c: Column) -> Column:
    """YYMMDD: years whose first digit is 0, 1 or 2 are 20xx, others 19xx; what is no date is null."""
    return F.try_to_date(
        F.concat(F.when(F.substring(c, 1, 1).isin("0", "1", "2"), "20").otherwise("19"), c), "yyyyMMdd"
    )


def shape(c: Column) -> Column:
    """Digits as #, letters as X; null as blank."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(c, r"\p{Nd}", "#"), r"\p{L}", "X"), F.lit(""))


def is_ascii(c: Column) -> Column:
    return c.rlike(r"^[\x00-\x7F]*$")


def is_printable(c: Column) -> Column:
    return ~c.rlike(r"[\p{C}\p{Z}&&[^ ]]")


def is_blank_text(c: Column) -> Column:
    """White space only and at least one character of it."""
    return c.rlike(f"^{_WS}+$")


def joined(*parts: Column) -> Column:
    """Parts with a space between, null as blank."""
    out = F.coalesce(parts[0], F.lit(""))
    for p in parts[1:]:
        out = F.concat(out, F.lit(" "), F.coalesce(p, F.lit("")))
    return out
