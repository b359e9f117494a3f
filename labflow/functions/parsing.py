"""Lax text-to-value coercion as column expressions.

A bare cast is too loose for dates and too strict for integers, so every form is admitted by a pattern first and only
then converted with ``try_cast``. Patterns end in ``\\z`` because ``$`` also matches before a final newline. Each
expression names its input as few times as possible: the planner copies it into filters, and generated code that grows
past the limit of a method is not compiled.
"""

from pyspark.sql import functions as F

# The text forms the contract admits.
DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
ZONE = r"([Zz]|[+\x{2212}-]([01][0-9]|2[0-3]):?[0-5][0-9])?"
ISO_DATE = rf"^{DAY}\z"
ISO_DATETIME = rf"^{DAY}[Tt _]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.,][0-9]+)?)?{ZONE}\z"
MIDNIGHT = rf"^{DAY}([Tt _]00:00(:00([.,](0{{1,6}}|0{{6}}[0-9]+))?)?{ZONE})?\z"
EPOCH = r"^[+-]?([0-9]+|([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)\z"
INTEGER = r"^\p{IsWhite_Space}*[+-]?[0-9]+(_[0-9]+)*(\.0+)?\p{IsWhite_Space}*\z"

# Numeric dates above this size count milliseconds, not seconds; the calendar runs from 0001-01-01 to
# 9999-12-31, here in milliseconds since 1970.
SECONDS_LIMIT = 20_000_000_000
FIRST_MILLIS = -62_135_596_800_000
LAST_MILLIS = 253_402_300_799_999
DAY_MICROS = 86_400_000_000


def _epoch(c):
    """Number in epoch text; null for text too long to be a date."""
    return c.try_cast("decimal(30,12)")


def _micros(number):
    unit = F.when(F.abs(number) <= SECONDS_LIMIT, F.lit(1_000_000)).otherwise(F.lit(1_000))
    return F.round(number * unit).try_cast("bigint")


def _written_day(c):
    return F.substring(c, 1, 10).try_cast("date")


def lax_date(c):
    """Date of ISO text, of an ISO datetime at midnight, or of an epoch number that is an exact day."""
    number = _epoch(c)
    micros = _micros(number)
    exact_day = F.when(
        F.pmod(micros, F.lit(DAY_MICROS)) == 0, F.date_from_unix_date(F.round(micros / DAY_MICROS).cast("int"))
    )
    return F.when(c.rlike(MIDNIGHT), F.when(~c.startswith("0000"), _written_day(c))).when(
        c.rlike(EPOCH) & number.between(FIRST_MILLIS, LAST_MILLIS), exact_day
    )


def date_error(c):
    """Why ``lax_date`` rejected non-null text."""
    dated = c.rlike(ISO_DATETIME) | c.rlike(ISO_DATE)
    return (
        F.when(
            dated & _written_day(c).isNotNull(),
            F.when(c.rlike(MIDNIGHT), "date_parsing").otherwise("date_from_datetime_inexact"),
        )
        .when(c.rlike(EPOCH) & _epoch(c).between(FIRST_MILLIS, LAST_MILLIS), "date_from_datetime_inexact")
        .otherwise("date_from_datetime_parsing")
    )


def strict_date(c):
    """``YYYY-MM-DD`` only."""
    return F.when(c.rlike(ISO_DATE), c.try_cast("date"))


def looks_integer(c):
    return c.rlike(INTEGER)


def lax_int(c):
    """64-bit integer of admitted text; null for other text and for larger values."""
    digits = F.regexp_replace(c, r"\.0+\p{IsWhite_Space}*\z|[\p{IsWhite_Space}_]", "")
    return F.when(looks_integer(c), digits.try_cast("bigint"))
