"""Text outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakewright.sources.loads import CSV_OPTIONS, escaped


def write_csv(df: DataFrame, path: str, line_breaks: str = "escaped") -> None:
    """CSV files with a header line each, columns in frame order; an empty frame gives the header only.

    Any text survives the way to ``load_csv`` and back. With ``line_breaks="quoted"`` line breaks stand in the file as
    they are, for readers that take values over several lines.
    """
    rows = escaped(df) if line_breaks == "escaped" else df
    rows.write.options(**CSV_OPTIONS).mode("overwrite").csv(path)


def write_manifest(manifest: DataFrame, path: str, column: str = "file_path") -> None:
    """One file path per line."""
    manifest.select(column).write.mode("overwrite").text(path)
