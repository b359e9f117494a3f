"""Text forms shown to people: error messages, timestamps, log details."""

from pyspark.sql import functions as F

DETAIL_SEPARATOR = " | "


def show_timestamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def run_label(c):
    return F.concat(F.lit("Run at "), show_timestamp(c))


def date_text(c):
    return F.date_format(c, "yyyy-MM-dd")


def _render_error(e):
    shown = F.coalesce(F.concat(F.lit("'"), e["input"], F.lit("'")), F.lit("None"))
    return F.concat(
        e["field"], F.lit(": "), e["msg"], F.lit(" [type="), e["type"], F.lit(", input="), shown, F.lit("]")
    )


def render_errors(errors):
    """One line per row: every failing field with message, type and input.

    Errors are joined by ``; `` and not by a newline, so that quarantine CSVs stay splittable. The lambda keeps the
    generated method below the size the JVM compiles; spelled out per element it would be past it and slower.
    """
    return F.array_join(F.transform(errors, _render_error), "; ")


def join_details(details):
    return F.array_join(details, DETAIL_SEPARATOR)


def split_details(c):
    """Joined details back to an array; the pattern is a literal pipe between spaces."""
    return F.split(c, r" [|] ")
