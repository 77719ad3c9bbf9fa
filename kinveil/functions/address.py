"""Address parsing by rule, as column expressions: number, street, suffix, unit type and unit.

Of a tag that several words have, the last word counts, as a tagger's dictionary would leave it. With
the usaddress package installed, parse_with_tagger() uses its model instead.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Street types and unit types, upper case.
STREET_TYPES = "ALLEY ALY AVE AVENUE AV BLVD BOULEVARD BND BEND CIR CIRCLE CT COURT CV COVE DR DRIVE EXPY EXPRESSWAY FWY HWY HIGHWAY LN LANE LOOP PARK PKWY PARKWAY PIKE PL PLACE PLAZA PT POINT RD ROAD ROW RUN SQ SQUARE ST STREET TER TERRACE TPKE TRL TRAIL WALK WAY".split()
UNIT_TYPES = "APARTMENT APT BLDG BUILDING FL FLOOR LOT RM ROOM SPACE STE SUITE TRLR UNIT".split()


def parse(address: Column) -> Column:
    """struct(number, street, suffix, prefix, value, raw), blanks for what is absent; null reads as blank."""
    raw = F.coalesce(address, F.lit(""))
    words = F.filter(F.split(F.regexp_replace(F.upper(raw), r"[,]", " "), r"\s+"), lambda w: w != "")
    unit = F.array_position(
        F.transform(words, lambda w: F.regexp_replace(w, r"\.$", "").isin(*UNIT_TYPES) | w.startswith("#")), True
    ).cast("int")
    size = F.size(words)
    cut = F.when(unit > 1, unit - 1).otherwise(size)
    main = F.slice(words, 1, F.greatest(cut, F.lit(0)))
    rest = F.slice(words, F.least(cut + 1, size + 1), F.greatest(size - cut, F.lit(0)))
    numbered = F.coalesce(F.get(main, F.lit(0)).rlike("^[0-9]"), F.lit(False))
    number = F.when(numbered, main[0]).otherwise("")
    middle = F.slice(
        main, F.when(numbered, 2).otherwise(1), F.greatest(F.size(main) - F.when(numbered, 1).otherwise(0), F.lit(0))
    )
    last = F.regexp_replace(F.coalesce(F.get(middle, F.size(middle) - 1), F.lit("")), r"\.$", "")
    typed = (F.size(middle) > 1) & last.isin(*STREET_TYPES)
    suffix = F.when(typed, last).otherwise("")
    street = F.coalesce(F.get(middle, F.size(middle) - F.when(typed, 2).otherwise(1)), F.lit(""))
    head = F.coalesce(F.get(rest, F.lit(0)), F.lit(""))
    bare = head.startswith("#")
    prefix = F.when(bare, "").otherwise(F.regexp_replace(head, r"\.$", ""))
    tail = F.coalesce(F.get(rest, F.size(rest) - 1), F.lit(""))
    value = F.when((F.size(rest) > 1) | bare, F.regexp_replace(tail, "^#", "")).otherwise("")
    return F.struct(
        number.alias("number"),
        street.alias("street"),
        suffix.alias("suffix"),
        prefix.alias("prefix"),
        value.alias("value"),
        raw.alias("raw"),
    )


def parse_with_tagger(address: Column) -> Column:
    """The same struct by the usaddress model; an error at run time where that package is missing."""

    @F.pandas_udf("number string, street string, suffix string, prefix string, value string, raw string")
    def tag(values: pd.Series) -> pd.DataFrame:
        import usaddress

        tags = {
            "AddressNumber": "number",
            "StreetName": "street",
            "StreetNamePostType": "suffix",
            "OccupancyType": "prefix",
            "OccupancyIdentifier": "value",
        }
        out = []
        for v in values:
            row = dict.fromkeys(tags.values(), "") | {"raw": v or ""}
            try:
                row |= {tags[t]: w for w, t in usaddress.parse(v or "") if t in tags}
            except Exception:  # what can't be tagged has no parts
                pass
            out.append(row)
        return pd.DataFrame(out, columns=[*tags.values(), "raw"])

    return tag(address)
