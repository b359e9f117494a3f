"""Column contracts shared by every operator."""

from pyspark.sql import types as T

# The row contract, in field order, and the accepted result codes.
FIELDS = ["sample_id", "test_date", "result", "viral_load"]
RESULT_CODES = ["POS", "NEG", "N/A"]

# Columns the pipeline itself adds to quarantined rows.
TECHNICAL = ["pipeline_error", "source_file"]

RECORD = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("test_date", T.DateType()),
        T.StructField("result", T.StringType()),
        T.StructField("viral_load", T.LongType()),
    ]
)

LAKE = T.StructType(
    RECORD.fields
    + [
        T.StructField("year", T.IntegerType()),
        T.StructField("week", T.IntegerType()),
    ]
)

# Position of a row in a text feed; comparing two of them gives file order.
ROW_POSITION = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)


def text_feed(fields):
    """Schema of a CSV feed after files with different headers were aligned."""
    return T.StructType(
        [T.StructField(f, T.StringType()) for f in fields]
        + [
            T.StructField("missing", T.ArrayType(T.StringType(), False)),
            T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
            T.StructField("source_file", T.StringType()),
            T.StructField("row_pos", ROW_POSITION),
        ]
    )


# A file of a zone; uploaded again under its name, it is another file.
LISTING = "path string, length bigint, modificationTime timestamp"

# Counters of one run, by kind of run.
COUNTERS = {
    "execution": [
        "files_processed",
        "rows_quarantined",
        "rows_inserted",
        "rows_updated",
    ],
    "deletion": ["files_processed", "rows_deleted", "partitions_updated"],
}


def run_log(kind):
    """Schema of the audit table for ``kind`` ('execution' or 'deletion')."""
    return T.StructType(
        [T.StructField("execution_timestamp", T.TimestampType())]
        + [T.StructField(c, T.LongType()) for c in COUNTERS[kind]]
        + [T.StructField("details", T.ArrayType(T.StringType()))]
    )


def run_lines():
    """Schema of the table of all lines of runs."""
    return "line_order struct<section:int,key:string>, line string, run_id string"
