"""Load-time audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_audit(df: DataFrame, *, source: str | None = None, file: bool = False) -> DataFrame:
    """Add ``_ingestion_timestamp`` and, on request, ``_source`` (a fixed tag)
    and ``_source_file`` (path of the file each row was read from). Works on
    batch and streaming file reads alike."""
    extra = {"_ingestion_timestamp": F.current_timestamp()}
    if source is not None:
        extra["_source"] = F.lit(source)
    if file:
        extra["_source_file"] = F.col("_metadata.file_path")
    return df.withColumns(extra)
