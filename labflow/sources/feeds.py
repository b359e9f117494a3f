"""CSV feeds read as text, with columns bound by header name.

Spark binds CSV columns by position, so files whose headers differ in order would be mixed up silently. Here every file is
read once, as lines: a line's fields become an array, the first line of a file is its header, and a join on the path gives
each row its header, from which names find their positions. However many different headers there are, it is one scan.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labflow.functions.text import split_details
from labflow.operators.delete import REQUEST_FIELDS
from labflow.schema import COUNTERS, FIELDS, LISTING, TECHNICAL, run_log, run_lines
from labflow.session import written
from labflow.sources.storage import Folder, has_files

SOURCE_PARTITION = "source_file="
# A field in quotes, or whatever stands up to the next comma; quotes inside quotes are doubled.
FIELD = r',("(?:[^"]++|"")*+"(?=,|\z)|[^,]*+)'
# A line, or several if a quoted field has line breaks.
RECORD = r'(?:[^"\r\n]++|"(?:[^"]++|"")*+(?:"|\z))++'


@dataclass
class Feed:
    """Rows of all readable files, and frames of the feed files' names (``source_file``): all, and those without a header.

    ``extra_columns`` are the names of columns outside the contract, over all headers.
    """

    rows: DataFrame
    all_files: DataFrame
    unreadable_files: DataFrame
    extra_columns: list

    @property
    def files(self):
        """Names of all files on the driver, for a look at a small folder."""
        return _names(self.all_files)

    @property
    def unreadable(self):
        return _names(self.unreadable_files)


def _names(files):
    return [r.source_file for r in files.orderBy("source_file").collect()]


def _url_text(c):
    """Undo percent escapes where there are any; a plus sign is a plus sign in a path."""
    return F.when(c.contains("%"), F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))).otherwise(c)


def entry_name(path, root):
    """First part of a path below a root: a file or folder there."""
    return F.substring_index(F.substring(path, len(root) + 2, 1 << 30), "/", 1)


def logical_name(path, root):
    """Name of the feed file a path belongs to: the first path part under the root.

    A file in the root is its own feed file; a folder written by Spark is one feed file made of its parts, and a
    ``source_file=`` partition is the feed file it is named after.
    """
    top = entry_name(path, root)
    named = F.substring(top, len(SOURCE_PARTITION) + 1, 1 << 30)
    return F.when(top.startswith(SOURCE_PARTITION), _url_text(named)).otherwise(top)


def _local_path(c):
    """A path as listings have it: one slash after the scheme of local files."""
    return F.regexp_replace(_url_text(c), "^file:///", "file:/")


def list_files(spark, root, pattern="*"):
    """Logical name, path, size and time of all files under a root, empty ones included; no content is read.

    Tasks list sizes and times. They pass empty files over, whose names Spark's own listing hands on as a frame; their
    size is 0 and their time is not known (null).
    """
    root = str(Folder(spark, root))
    if not has_files(spark, root):
        listing = spark.createDataFrame([], LISTING)
    else:
        found = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .load(root)
        )
        listing = found.select("path", "length", "modificationTime")
        # The names stay in the JVM: this is one call, however many files there are.
        names = Column(spark._jvm.org.apache.spark.sql.functions.lit(found._jdf.inputFiles()))
        names = spark.range(1).select(F.explode(names).alias("value")).select(_local_path(F.col("value")).alias("path"))
        empty = names.join(listing.select("path"), "path", "left_anti").select(
            "path", F.lit(0).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modificationTime")
        )
        listing = listing.unionByName(empty)
    return listing.withColumn("source_file", logical_name(F.col("path"), root))


def shown_files(listing):
    """Listing per logical file as shown to people: size in MB and time of the last change."""
    return listing.groupBy("source_file").agg(
        F.sum("length").alias("length"),
        F.round(F.sum("length") / F.lit(1024 * 1024), 2).alias("size_mb"),
        F.date_format(F.max("modificationTime"), "yyyy-MM-dd HH:mm:ss").alias("last_modified"),
    )


def _lines(spark, root, pattern, since, multi_line):
    """Every line of the files under a root that are not older than ``since``, with its place; blank lines are left out."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    lines = reader.text(root, wholetext=multi_line)
    if since is not None:
        # Older files are passed over when the folder is listed.
        lines = lines.filter(F.col("_metadata.file_modification_time") >= F.lit(since))
    place = [
        _local_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    ]
    if multi_line:
        lines = lines.select(*place, F.posexplode(F.regexp_extract_all("value", F.lit(RECORD), F.lit(0))).alias("seq", "value"))
        lines = lines.withColumn("seq", F.col("seq").cast("bigint"))
    else:
        lines = lines.select(*place, F.monotonically_increasing_id().alias("seq"), "value")
    return lines.filter(F.col("value").rlike(r"[^\x00-\x20]"))


def _fields(line):
    """The fields of a line; an empty field, in quotes or not, is null."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(FIELD), F.lit(1))

    def value(x):
        quoted = (F.length(x) >= 2) & x.startswith('"') & x.endswith('"')
        inner = F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(quoted, inner).otherwise(x), F.lit(""))

    return F.transform(raw, value)


def _header(fields):
    """Column names of a header; a repeated name is numbered so that none is lost."""
    names = F.transform(fields, lambda n: F.coalesce(n, F.lit("")))
    names = F.transform(names, lambda n, i: F.when(i == 0, F.regexp_replace(n, "^\ufeff", "")).otherwise(n))

    def numbered(name, i):
        before = F.size(F.filter(F.slice(names, F.lit(1), i), lambda n: n == name))
        return F.when(before > 0, F.concat(name, F.lit("_duplicated_"), before - 1)).otherwise(name)

    return F.transform(names, numbered)


def read_feed(spark, root, fields, pattern="*.csv", only=None, multi_line=False):
    """All CSV files under a root as text rows with the same columns, whatever their headers.

    ``missing`` names the wanted columns a row's file lacks, ``extra`` holds its other columns, ``row_pos`` orders the
    rows of a file and ``ragged`` marks rows with more fields than their header. ``only``, a frame of paths and
    modification times from ``list_files``, restricts the scan to these files. ``multi_line`` admits line breaks inside
    quoted fields, at the price of files that cannot be split. The lines are parsed once, into a table in the scratch
    folder, from which headers and rows are read.
    """
    root = str(Folder(spark, root))
    listing = list_files(spark, root, pattern) if only is None else only
    since = None if only is None else only.agg(F.min("modificationTime")).first()[0]
    if not has_files(spark, root) or (only is not None and since is None):
        lines = spark.createDataFrame([], "path string, block bigint, seq bigint, value string")
    else:
        lines = _lines(spark, root, pattern, since, multi_line)
    parsed = lines.select("path", "block", "seq", _fields(F.col("value")).alias("cells"))
    if only is not None:
        parsed = parsed.join(only.select("path"), "path", "left_semi")
    parsed = written(spark, parsed, "lines")
    first = parsed.filter("block = 0").groupBy("path").agg(F.min_by("cells", "seq").alias("header"), F.min("seq").alias("first"))
    headers = written(spark, first.withColumn("header", _header(F.col("header"))), "headers")
    named = parsed.join(headers, "path").filter("block > 0 OR seq <> first")

    header, cells = F.col("header"), F.col("cells")
    known = [*fields, *TECHNICAL]
    others = F.filter(
        F.transform(header, lambda n, i: F.struct(n.alias("name"), F.get(cells, i).alias("value"), i.alias("at"))),
        # Of names that are equal in spite of their numbers the first counts.
        lambda x: ~x["name"].isin(known) & (F.array_position(header, x["name"]) == x["at"] + 1),
    )
    extra = F.map_from_entries(F.transform(others, lambda x: F.struct(x["name"], x["value"])))
    absent = F.filter(F.array(*[F.lit(f) for f in fields]), lambda f: ~F.array_contains(header, f))
    at = {f: F.array_position(header, F.lit(f)).cast("int") for f in fields}
    rows = named.select(
        *[F.when(at[f] > 0, F.get(cells, at[f] - 1)).alias(f) for f in fields],
        absent.cast("array<string>").alias("missing"),
        F.when(F.size(others) > 0, extra).alias("extra"),
        logical_name(F.col("path"), root).alias("source_file"),
        F.struct("path", "block", "seq").alias("row_pos"),
        (F.size(cells) > F.size(header)).alias("ragged"),
    )
    outside = headers.select(F.explode("header").alias("name")).filter(~F.col("name").isin(known)).distinct()
    files = listing.select("path", "source_file").join(headers.select("path", "first"), "path", "left")
    return Feed(
        rows=rows,
        all_files=files.select("source_file").distinct(),
        unreadable_files=files.filter("first IS NULL").select("source_file").distinct(),
        extra_columns=sorted(r.name for r in outside.collect()),  # as many as there are different columns
    )


def read_landing(spark, root, only=None, multi_line=False):
    return read_feed(spark, root, FIELDS, only=only, multi_line=multi_line)


def read_deletion_requests(spark, root, only=None):
    """Requests as text: an id of digits only keeps its leading zeros."""
    return read_feed(spark, root, REQUEST_FIELDS, only=only)


def read_quarantine(spark, root, only=None):
    """Quarantined rows as text, their errors included; ``N/A`` stays text."""
    feed = read_feed(spark, root, [*FIELDS, "pipeline_error"], only=only)
    # Files without an error column are corrected files; that column is not part of the contract.
    feed.rows = feed.rows.withColumn("missing", F.array_remove("missing", "pipeline_error"))
    return feed


def read_logs(spark, root, kind="execution"):
    """Runs from ``execution_*`` or ``deletion_*`` CSV logs, details as joined text; unreadable files are skipped."""
    counters = COUNTERS[kind]
    names = ["execution_timestamp", *counters, "processing_details"]
    listing = list_files(spark, root, "*.csv").filter(F.col("source_file").startswith(f"{kind}_"))
    rows = read_feed(spark, root, names, only=written(spark, listing, "logs")).rows
    # A file with a row longer than its header is unreadable.
    rows = rows.join(rows.filter("ragged").select("source_file").distinct(), "source_file", "left_anti")
    return rows.select(
        F.col("execution_timestamp").try_cast("timestamp").alias("execution_timestamp"),
        *[F.col(c).try_cast("bigint").alias(c) for c in counters],
        "processing_details",
    )


def read_runs(spark, root, kind="execution"):
    """Runs from the audit table this package writes, details as an array."""
    folder = f"{root}/{kind}"
    if not has_files(spark, folder):
        return spark.createDataFrame([], run_log(kind))
    return spark.read.schema(run_log(kind)).option("recursiveFileLookup", "true").parquet(folder)


def read_run_lines(spark, root, kind="execution"):
    """All lines of all runs, as rows with the run's id."""
    folder = f"{root}/{kind}_lines"
    if not has_files(spark, folder):
        return spark.createDataFrame([], run_lines())
    return spark.read.schema(run_lines()).option("recursiveFileLookup", "true").parquet(folder)


def read_all_runs(spark, root, kind="execution"):
    """One history over the CSV logs and the audit table, details as an array."""
    old = read_logs(spark, root, kind)
    details = F.when(F.coalesce("processing_details", F.lit("")) != "", split_details(F.col("processing_details")))
    old = old.withColumn("details", details).drop("processing_details")
    return old.unionByName(read_runs(spark, root, kind).select(*old.columns))
