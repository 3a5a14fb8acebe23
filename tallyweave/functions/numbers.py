"""Number, percent and period columns: parsing, rounding, ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyweave import constants as K

# Spaces, tabs, line ends, no-break space.
SPACES = " \t\r\n\f\u000b\u00a0"
# Digits kept beyond the last one before rounding; doubles carry 15 to 17 in all.
GUARD_DIGITS = 10
NUMBER_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(as_col(c), F.lit(SPACES))


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, NULL where nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def parse_number(c: Column | str, decimal_comma: bool = False) -> Column:
    """Text to DOUBLE; blank, ``nan`` and anything that is not a number give NULL."""
    text = strip(as_col(c).cast("string"))
    if decimal_comma:
        text = F.replace(text, F.lit(","), F.lit("."))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def parse_int(c: Column | str, decimal_comma: bool = False) -> Column:
    """Text to BIGINT by way of DOUBLE, cutting the fraction off."""
    return parse_number(c, decimal_comma).try_cast("bigint")


def parse_digits(c: Column | str) -> Column:
    """BIGINT only for text that is nothing but digits."""
    text = as_col(c).cast("string")
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def percent_value(c: Column | str) -> Column:
    """``"71,5%"`` to 71.5, NULL for anything else."""
    number = F.regexp_extract(strip(c), K.PERCENT_PATTERN, 1)
    return F.replace(F.nullif(number, F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def percent_suppressed(c: Column | str) -> Column:
    """True where the source prints a dash or nothing instead of a percent; NULL is nothing."""
    return F.coalesce(strip(c), F.lit("")).isin(K.SUPPRESSED_MARKS)


def percent_issue(c: Column | str) -> Column:
    """Message for text that is neither a percent nor a suppression mark."""
    text = strip(c)
    return F.when(
        ~text.rlike(K.PERCENT_PATTERN) & ~percent_suppressed(c),
        F.concat(F.lit("unexpected percent value: "), text),
    )


def stable_round(c: Column | str, digits: int = 2) -> Column:
    """Round a DOUBLE half up after clearing float noise at the end of its precision.

    Partial sums reach the final aggregate in any order, so the same average can
    differ in its last bits from run to run. A decimal with ``GUARD_DIGITS`` more
    digits keeps such noise from flipping a value that sits on a rounding tie, and
    is fine enough not to turn a value just under a tie into one. Values too great for
    that decimal are rounded as they are.
    """
    value = as_col(c).cast("double")
    exact = F.round(value.try_cast(f"decimal(38,{digits + GUARD_DIGITS})"), digits).cast("double")
    return F.coalesce(exact, F.round(value, digits))


def whole(c: Column | str) -> Column:
    """A measure rounded to whole units as BIGINT."""
    return F.round(as_col(c)).cast("bigint")


def safe_ratio(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    """Rounded quotient; NULL if either side is NULL or the denominator is 0."""
    top, bottom = as_col(numerator).cast("double"), as_col(denominator).cast("double")
    return stable_round(F.try_divide(top, bottom), digits)


def format_number(c: Column | str, digits: int = 2) -> Column:
    """Text for a CSV sink: rounded, at least one decimal, NULL to blank."""
    text = stable_round(c, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.coalesce(F.regexp_replace(text, r"(\.[0-9]+?)0+$", "$1"), F.lit(""))


def format_flag(c: Column | str) -> Column:
    """``true`` / ``false`` text for a CSV sink."""
    return F.coalesce(as_col(c), F.lit(False)).cast("string")


def school_year(year: Column | str) -> Column:
    """2024 to ``2024-2025``."""
    start = as_col(year).cast("int")
    return F.concat_ws("-", start, start + 1)


def school_year_from_label(c: Column | str) -> Column:
    """``2024–2025`` with either dash, text after it allowed, to ``2024-2025``."""
    text = strip(c)
    first = F.nullif(F.regexp_extract(text, K.SCHOOL_YEAR_PATTERN, 1), F.lit(""))
    second = F.regexp_extract(text, K.SCHOOL_YEAR_PATTERN, 2)
    return F.concat(first, F.lit("-"), second)


def ordinal_from_label(c: Column | str) -> Column:
    """Leading number of a label such as ``10. bekkur``, for sorting."""
    return F.regexp_extract(as_col(c), "^([0-9]+)", 1).try_cast("int")


def strip_code_prefix(c: Column | str) -> Column:
    """Drop a leading four-digit code."""
    return strip(F.regexp_replace(as_col(c), r"^[0-9]{4}\s+", ""))


def map_codes(c: Column | str, codes: dict[str, str], default: Column | None = None) -> Column:
    """Label to code; NULL or ``default`` for an unknown label."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), as_col(c))
    return found if default is None else F.coalesce(found, default)
