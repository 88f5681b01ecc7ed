"""Columns that say where and when a row was made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


INGESTED = ("ingestion_timestamp", "source_file", "data_layer")


def stamp_ingested(df: DataFrame, source_file: str | None = None) -> DataFrame:
    """Bronze provenance; without a name, each row gets the file it came from (a column
    ``source_file`` that is there already says so)."""
    known = "source_file" if "source_file" in df.columns else "_metadata.file_name"
    origin = F.lit(source_file) if source_file else F.col(known)
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": origin,
            "data_layer": F.lit("bronze"),
        }
    )


def stamp_processed(df: DataFrame, layer: str) -> DataFrame:
    return df.withColumns(
        {"processing_timestamp": F.current_timestamp(), "data_layer": F.lit(layer)}
    )


def stamp_loaded(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: F.current_timestamp() for c in columns})
