"""Row contract: check every field, collect every error, route rows."""

from pyspark.sql import functions as F

from labflow.functions import parsing
from labflow.functions.text import render_errors
from labflow.schema import FIELDS, RESULT_CODES

ERROR = "struct<field:string,type:string,msg:string,input:string>"

# The message of every error type.
MESSAGES = {
    "missing": "Field required",
    "string_type": "Input should be a valid string",
    "date_type": "Input should be a valid date",
    "date_parsing": "Input should be a valid date in the format YYYY-MM-DD, year 0 is out of range",
    "date_from_datetime_parsing": "Input should be a valid date or datetime",
    "date_from_datetime_inexact": "Datetimes provided to dates should have zero time - e.g. be exact dates",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_overflow": "Input should be a valid integer that fits in 64 bits",
}


def _absent(field, has_missing, present):
    """Whether the file of the row lacks the column."""
    if has_missing:
        return F.coalesce(F.array_contains("missing", field), F.lit(False))
    return F.lit(field not in present)


def _error_types(absent):
    """Why each field fails, or null. Per field the first condition that holds decides."""
    date, code, load = F.col("test_date"), F.col("result"), F.col("viral_load")
    int_error = F.when(parsing.looks_integer(load), "int_overflow").otherwise("int_parsing")
    checks = {
        "sample_id": ("string_type", None, None),
        "test_date": ("date_type", F.col("valid_date").isNull(), parsing.date_error(date)),
        "result": ("string_type", ~code.isin(RESULT_CODES), F.lit("value_error")),
        "viral_load": ("int_type", F.col("valid_load").isNull(), int_error),
    }
    types = {}
    for field, (null_type, failed, error_type) in checks.items():
        found = F.when(absent[field], "missing").when(F.col(field).isNull(), null_type)
        types[field] = found if failed is None else found.when(failed, error_type)
    return types


def _message(field, error_type):
    messages = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])
    known = F.element_at(messages, error_type)
    if field != "result":
        return known
    return F.coalesce(
        known, F.concat(F.lit("Value error, Invalid result code: '"), field, F.lit("'. Must be POS, NEG, or N/A"))
    )


def _error(field, error_type):
    """A list of at most one error."""
    error = F.struct(
        F.lit(field).alias("field"),
        error_type.alias("type"),
        _message(field, error_type).alias("msg"),
        F.col(field).alias("input"),
    )
    return F.when(error_type.isNotNull(), F.array(error)).otherwise(F.array().cast(f"array<{ERROR}>"))


def validate(feed):
    """Add ``valid_date``, ``valid_load``, ``ok`` and ``errors`` to a feed of text columns.

    A contract column the feed lacks is added as null and reported as ``missing``; a column ``missing`` names absent
    columns per row, for feeds united from files with different headers. All other columns pass through. The whole
    check is a chain of projections without a shuffle, short enough each to be compiled; ``errors`` is only computed
    where it is read.
    """
    present = set(feed.columns)
    has_missing = "missing" in present
    absent = {f: _absent(f, has_missing, present) for f in FIELDS}
    for field in FIELDS:
        if field not in present:
            feed = feed.withColumn(field, F.lit(None).cast("string"))
    columns = feed.columns
    parsed = feed.withColumns(
        {
            "valid_date": parsing.lax_date(F.col("test_date")),
            "valid_load": parsing.lax_int(F.col("viral_load")),
        }
    )
    typed = parsed.withColumns({f"{f}_error": t for f, t in _error_types(absent).items()})
    ok = (
        F.col("sample_id").isNotNull()
        & F.col("valid_date").isNotNull()
        & F.coalesce(F.col("result").isin(RESULT_CODES), F.lit(False))
        & F.col("valid_load").isNotNull()
    )
    errors = F.concat(*[_error(f, F.col(f"{f}_error")) for f in FIELDS])
    return typed.select(*columns, "valid_date", "valid_load", ok.alias("ok"), errors.alias("errors"))


def valid_rows(validated, keep=()):
    """Rows that meet the contract, typed; extra feed columns are dropped unless named in ``keep``.

    The columns are declared not null, as the contract has them. Without that the planner would add null checks for
    later join and partition keys, and each would parse the text once more.
    """
    return validated.filter("ok").select(
        F.coalesce("sample_id", F.lit("")).alias("sample_id"),
        F.coalesce("valid_date", F.lit("1970-01-01").cast("date")).alias("test_date"),
        F.coalesce("result", F.lit("")).alias("result"),
        F.coalesce("valid_load", F.lit(0)).alias("viral_load"),
        *keep,
    )


def invalid_rows(validated):
    """Rows that fail the contract: every feed column as it came, the errors, and their text."""
    return (
        validated.filter(~F.col("ok"))
        .withColumn("pipeline_error", render_errors(F.col("errors")))
        .drop("ok", "valid_date", "valid_load")
    )


def file_counts(validated):
    """Valid and failing rows per file."""
    return validated.groupBy("source_file").agg(
        F.count_if("ok").alias("valid_rows"),
        F.count_if(~F.col("ok")).alias("error_rows"),
    )


def file_gate(validated):
    """Verdict per file: it passes only if every row is valid."""
    return validated.groupBy("source_file").agg(
        F.bool_and("ok").alias("passed"),
        F.count(F.lit(1)).alias("row_count"),
    )
