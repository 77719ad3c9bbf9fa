"""String and address similarity, as plain functions and as Arrow-batched columns."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Winkler's weight of a common prefix of up to 4 characters, given above 0.7 only.
PREFIX_WEIGHT, PREFIX_MOST, BOOST_ABOVE = 0.1, 4, 0.7


@lru_cache(1 << 16)
def jaro_winkler(a: str, b: str) -> float:
    """0 when either is empty."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, mine = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    m = len(mine)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(mine, (c for c, t in zip(b, taken, strict=True) if t), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro <= BOOST_ABOVE:
        return jaro
    prefix = 0
    for x, y in zip(a[:PREFIX_MOST], b, strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * PREFIX_WEIGHT * (1 - jaro)


def hamming(a: str, b: str) -> float:
    """Share of positions of the longer string that agree."""
    longest = max(len(a), len(b))
    return sum(x == y for x, y in zip(a, b, strict=False)) / longest if longest else 1.0


class Parts(NamedTuple):
    number: str = ""
    street: str = ""
    suffix: str = ""
    prefix: str = ""
    value: str = ""
    raw: str = ""


def _street(a: Parts, b: Parts) -> float:
    jw = jaro_winkler
    if a.street and b.street:
        names = jw(a.street, b.street)
        tries = [names * (0.7 if a.suffix or b.suffix else 1.0)]
        if a.suffix:
            tries.append(jw(f"{a.street} {a.suffix}", b.street))
        if b.suffix:
            tries.append(jw(f"{b.street} {b.suffix}", a.street))
        if a.suffix and b.suffix:
            tries.append(0.8 * names + (0.2 * jw(a.suffix, b.suffix) if names else 0.0))
        return max(tries)
    # A street on one side against the suffix that the other side's only street word was taken for.
    best = 0.0
    for x, y in ((a, b), (b, a)):
        if x.street and y.suffix:
            best = max(
                best, 0.7 * max(jw(f"{x.street} {x.suffix}", y.suffix) if x.suffix else 0.0, jw(x.street, y.suffix))
            )
    return best


def _unit(a: Parts, b: Parts) -> float:
    jw = jaro_winkler
    if not ((a.prefix and b.prefix) or (a.value and b.value)):
        return 0.0
    tries = [0.8 * jw(a.prefix + a.value, b.prefix + b.value)]
    if a.value and b.value:
        values = jw(a.value, b.value)
        tries.append(values * (0.7 if a.prefix or b.prefix else 1.0))
        if a.prefix:
            tries.append(jw(f"{a.prefix} {a.value}", b.value))
        if b.prefix:
            tries.append(jw(f"{b.prefix} {b.value}", a.value))
        if a.prefix and b.prefix:
            tries.append(0.8 * values + 0.2 * jw(a.prefix, b.prefix))
    else:
        for x, y in ((a, b), (b, a)):
            if x.value:
                tries.append(0.6 * max(jw(x.prefix + x.value, y.prefix), jw(x.value, y.prefix)))
    return max(tries)


def address_similarity(a: Parts, b: Parts) -> float:
    """0 to 1: 0 if either raw text is blank, 1 if they are equal; else house number by Hamming, street
    and unit by Jaro-Winkler, weighted by whether either address has a unit, and at least 0.6 of the
    number and street weights times the similarity of the raw texts."""
    if not a.raw or not b.raw:
        return 0.0
    if a.raw == b.raw:
        return 1.0
    units = a.prefix or b.prefix or a.value or b.value
    w_number, w_street, w_unit = (0.3, 0.5, 0.2) if units else (0.5, 0.5, 0.0)
    score = w_number * hamming(a.number, b.number) if a.number and b.number else 0.0
    score += w_street * _street(a, b)
    return max(score, jaro_winkler(a.raw, b.raw) * (w_number + w_street) * 0.6) + w_unit * _unit(a, b)


@lru_cache(1 << 16)
def _between(a: tuple, b: tuple) -> float:
    return address_similarity(Parts(*a), Parts(*b))


@F.pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [None if x is None or y is None else jaro_winkler(x, y) for x, y in zip(a, b, strict=True)], dtype="float64"
    )


@F.pandas_udf(DoubleType())
def _address(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
    order = list(Parts._fields)
    rows = zip(a[order].itertuples(index=False, name=None), b[order].itertuples(index=False, name=None), strict=True)
    return pd.Series([None if x[-1] is None or y[-1] is None else _between(x, y) for x, y in rows], dtype="float64")


def jaro_winkler_column(a: Column, b: Column, empty_similarity: float = 0.0) -> Column:
    """Equal values are settled in the JVM; empty_similarity is what two empty values score."""
    both = (a == "") & (b == "")
    return F.when(both, F.lit(empty_similarity)).when(a == b, 1.0).otherwise(_jaro_winkler(F.when(a != b, a), b))


def address_column(a: Column, b: Column) -> Column:
    """a, b: structs of Parts."""
    return F.when(a["raw"] == b["raw"], F.when(a["raw"] == "", 0.0).otherwise(1.0)).otherwise(_address(a, b))
