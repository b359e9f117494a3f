"""Export the whole lake, or a part of it, as one sorted report."""

from labflow.operators.report import report_facts
from labflow.sinks.files import write_report, written_report_facts
from labflow.sources.lake import read_lake


def export(spark, zones, prefixes=("",), name="report.csv", single_file=False):
    """Write the report next to, never inside, the lake; returns its rows, size in MB and time, or None if empty."""
    lake = read_lake(spark, zones.lake, prefixes=list(prefixes))
    rows = report_facts(lake).first().row_count
    if rows == 0:
        return None
    path = f"{zones.reports}/{name}"
    write_report(lake, path, single_file)
    return {"row_count": rows, **written_report_facts(spark, path).first().asDict()}
