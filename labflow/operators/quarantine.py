"""Work on quarantined rows: what is wrong, what is pending, applying corrections, the gate back."""

from pyspark.sql import functions as F

from labflow.schema import FIELDS, TECHNICAL

ROW = ["source_file", "row_pos"]


def drop_technical(df):
    return df.drop(*TECHNICAL)


def distinct_errors(quarantine):
    """Different error texts per file."""
    return quarantine.select("source_file", "pipeline_error").distinct()


def error_counts(quarantine):
    """Rows per file, field and error type."""
    return (
        quarantine.select("source_file", F.explode("errors").alias("e"))
        .groupBy("source_file", F.col("e.field").alias("field"), F.col("e.type").alias("error_type"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def pending_files(quarantined, staged):
    """Quarantined file names that are not staged yet."""
    return quarantined.join(staged.select("source_file"), "source_file", "left_anti")


def file_names(df):
    return df.select("source_file").distinct()


def rows_per_file(df):
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))


def last_edits(edits):
    """One map of new cells per edited row: of several edits of a cell that with the highest ``edit_no`` counts.

    ``edits``: source_file, row_pos, field, value (null empties the cell), edit_no. A row has no more cells than its
    file has columns.
    """
    last = edits.groupBy(*ROW, "field").agg(F.max_by(F.struct("value"), "edit_no").alias("cell"))
    pairs = F.collect_list(F.struct("field", F.col("cell.value").alias("value")))
    return last.groupBy(*ROW).agg(F.map_from_entries(pairs).alias("cells"))


def apply_corrections(quarantine, edits=None, removals=None, additions=None):
    """Quarantined rows after cell edits, row removals and row additions.

    ``edits`` holds one row per edited cell (see ``last_edits``); any column of the feed can be edited, those outside
    the contract in the map ``extra``. ``removals`` holds keys only; ``additions`` whole rows.
    """
    rows = quarantine
    if removals is not None:
        rows = rows.join(removals.select(*ROW).distinct(), ROW, "left_anti")
    if edits is not None:
        edited = rows.join(last_edits(edits), ROW, "left")
        has = F.col("cells").isNotNull()
        new = {
            f: F.when(has & F.map_contains_key("cells", F.lit(f)), F.col("cells")[f]).otherwise(F.col(f)) for f in FIELDS
        }
        if "extra" in rows.columns:
            others = F.map_filter("cells", lambda k, _: ~k.isin(FIELDS))
            untouched = F.map_filter(
                F.coalesce("extra", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))),
                lambda k, _: ~F.map_contains_key(F.col("cells"), k),
            )
            new["extra"] = F.when(has & (F.size(others) > 0), F.map_concat(untouched, others)).otherwise(F.col("extra"))
        rows = edited.withColumns(new).select(*rows.columns)
    if additions is not None:
        rows = rows.unionByName(additions, allowMissingColumns=True)
    return rows


def gated_rows(validated, verdicts):
    """Rows of the files in which every row is valid; ``verdicts`` is the result of ``file_gate``.

    Verdicts read from a written table are broadcast if their size allows it, and the rows are then not shuffled.
    """
    passed = verdicts.filter("passed").select("source_file")
    return validated.join(passed, "source_file", "left_semi")
