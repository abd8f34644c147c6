"""Numbers inside text: rounding, spacing and place codes, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shape of a decimal, of a number or run of dots, and the place code of the unit digit.
DECIMAL = r"[0-9]*[.][0-9]+"
NUMBER_OR_DOTS = r"[0-9]+(?:[.][0-9]*)?|[.]+"
UNIT_PLACE = 5


def _rounded(number: Column, places: int) -> Column:
    """Half-up rounding on the decimal text; one digit beyond ``places`` decides, so the rest can go."""
    whole = F.substring_index(number, ".", 1)
    fraction = F.substring_index(number, ".", -1)
    cut = F.concat(F.when(whole == "", "0").otherwise(whole), F.lit("."), F.substring(fraction, 1, places + 1))
    exact = F.round(cut.try_cast(f"decimal(38,{places + 1})"), places).cast("string")
    # keep one digit after the dot; a number too long for the decimal type stays as it is
    return F.coalesce(F.regexp_replace(exact, r"([.][0-9]+?)0+$", "$1"), number)


def round_decimals(text: Column, places: int = 4) -> Column:
    """Round every decimal inside ``text`` to ``places`` and print it without trailing zeros."""
    around = F.split(text, DECIMAL, -1)
    found = F.regexp_extract_all(text, F.lit(DECIMAL), F.lit(0))
    pieces = F.zip_with(around, found, lambda a, n: F.concat(a, F.coalesce(_rounded(n, places), F.lit(""))))
    return F.when(F.contains(text, F.lit(".")), F.array_join(pieces, "")).otherwise(text)


def space_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"([0-9.])", " $1 ")


def number_places(number: Column) -> Column:
    """Place codes of one number or run of dots: 6 for the unit digit, 7 for the tens, 4 for the tenths; dots runs get 0."""
    dot = F.instr(number, ".")
    first = UNIT_PLACE + F.when(dot > 0, dot - 1).otherwise(F.length(number))
    codes = F.sequence(first, first - F.length(number) + 1, F.lit(-1))
    return F.when(F.startswith(number, F.lit(".")), F.array_repeat(F.lit(0), F.length(number))).otherwise(codes)


def digit_places(text: Column) -> Column:
    """Place code of every digit and dot of ``text``, in order."""
    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(NUMBER_OR_DOTS), F.lit(0)), number_places))
