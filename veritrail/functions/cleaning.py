"""Text cleaning and parsing. Every function is ``Column -> Column``.

Parsing never raises: text that does not parse becomes NULL, so one bad row
cannot fail a job over billions of good ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritrail import vocabulary as v


def normalise_id(c: Column) -> Column:
    return F.upper(F.trim(c.cast("string")))


def title_case(c: Column) -> Column:
    return F.initcap(F.trim(c))


def upper_code(c: Column) -> Column:
    return F.upper(F.trim(c))


def family_code(control_id: Column) -> Column:
    """Letters before the first hyphen; '' where the id has another form."""
    return F.regexp_extract(control_id, v.FAMILY_PATTERN, 1)


def control_number(control_id: Column) -> Column:
    return F.regexp_extract(control_id, v.NUMBER_PATTERN, 1).try_cast("int")


def category_code(criterion_id: Column) -> Column:
    return F.regexp_extract(criterion_id, v.CATEGORY_PATTERN, 1)


def is_true_text(c: Column) -> Column:
    """Text in any case, with or without blanks, or an already typed boolean."""
    return F.upper(F.trim(c.cast("string"))) == F.lit("TRUE")


def parse_date(c: Column) -> Column:
    """``yyyy-MM-dd`` text to a date, anything else to NULL.

    Casting costs less than parsing with a format but also takes looser texts
    (one-digit months, trailing time), so a cast counts only when writing the
    date out again gives the same text. Columns that a reader has already typed
    are converted as they are.
    """
    day = c.try_cast("date")
    same_text = day.cast("string") == c.cast("string")
    return F.when((F.typeof(c) != "string") | same_text, day)


def parse_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c)
