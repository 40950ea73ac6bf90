"""Inline XBRL value transformations as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions.text import literal_map, local_name, strip

NUMERIC_FORMATS = (
    fv.DOT_DECIMAL_FORMATS + fv.COMMA_DECIMAL_FORMATS + fv.ZERO_FORMATS + fv.EMPTY_FORMATS)
TEXT_FORMATS = (
    fv.EMPTY_FORMATS + fv.TRUE_FORMATS + fv.FALSE_FORMATS + fv.DAY_MONTH_YEAR_FORMATS
    + fv.MONTH_DAY_YEAR_FORMATS + fv.YEAR_MONTH_DAY_FORMATS + fv.DAY_MONTHNAME_YEAR_FORMATS)
KNOWN_FORMATS = frozenset(NUMERIC_FORMATS + TEXT_FORMATS)


def number(text: Column, fmt: Column, scale: Column, sign: Column) -> Column:
    """Numeric fact value: format, then scale and sign. NULL if not a number."""
    name = F.lower(local_name(fmt))
    body = F.regexp_replace(text, r"(?U)\s+", "")
    dot = F.replace(body, F.lit(","), F.lit(""))
    comma = F.replace(F.replace(body, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    as_number = lambda c: F.when(c.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)$"), c.try_cast("double"))  # noqa: E731  not NaN, 1d
    plain = (
        F.when(fmt.isNull() | name.isin(*fv.DOT_DECIMAL_FORMATS),
               F.when(dot.isin("-", "–", "—"), F.lit(0.0))
               .otherwise(as_number(dot)))
        .when(name.isin(*fv.COMMA_DECIMAL_FORMATS), as_number(comma))
        .when(name.isin(*fv.ZERO_FORMATS), F.lit(0.0))
    )
    scaled = F.when(F.coalesce(scale, F.lit(0)) == 0, plain).otherwise(
        plain * F.pow(F.lit(10.0), scale.cast("double")))
    # adding 0.0 turns a negative zero into zero
    return F.when(sign == "-", F.lit(0.0) - scaled).otherwise(scaled)


def _day(year: Column, month: Column, day: Column) -> Column:
    full_year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    iso = F.concat_ws("-", full_year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return iso.try_cast("date").cast("string")


def _numeric_day(text: Column, order: str) -> Column:
    digits = [F.regexp_extract(text, r"^\D*(\d+)\D+(\d+)\D+(\d+)\D*$", i) for i in (1, 2, 3)]
    part = dict(zip(order, digits))
    return _day(part["y"], part["m"], part["d"])


def _named_day(text: Column) -> Column:
    pattern = r"^(\d{1,2})(?:st|nd|rd|th)?\W+([A-Za-z]{3})[A-Za-z]*\W+(\d{2,4})$"
    day, name, year = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
    numbers = literal_map({full[:3].lower(): mm for mm, full in fv.MONTHS.items()})
    return _day(year, F.try_element_at(numbers, F.lower(name)), day)


def text(value: Column, fmt: Column) -> Column:
    """Text fact value. Known date formats become yyyy-mm-dd, flags true/false;
    an unknown format gives NULL (the reader reports it as a warning)."""
    name = F.lower(local_name(fmt))
    body = strip(value)
    return (
        F.when(fmt.isNull(), body)
        .when(name.isin(*fv.TRUE_FORMATS), F.lit("true"))
        .when(name.isin(*fv.FALSE_FORMATS), F.lit("false"))
        .when(name.isin(*fv.DAY_MONTH_YEAR_FORMATS), _numeric_day(body, "dmy"))
        .when(name.isin(*fv.MONTH_DAY_YEAR_FORMATS), _numeric_day(body, "mdy"))
        .when(name.isin(*fv.YEAR_MONTH_DAY_FORMATS), _numeric_day(body, "ymd"))
        .when(name.isin(*fv.DAY_MONTHNAME_YEAR_FORMATS), _named_day(body))
    )
