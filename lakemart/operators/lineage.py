"""Lineage columns stamped on every bronze row."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed column names of the lineage stamp.
EDITION_COL = "_ano_pesquisa"
SOURCE_COL = "_arquivo_origem"
INGESTED_COL = "_data_ingestao"
LINEAGE_COLS = (EDITION_COL, SOURCE_COL, INGESTED_COL)


def ingestion_instant() -> str:
    """One UTC ISO-8601 instant per run, taken on the driver and shared by all rows."""
    return datetime.now(timezone.utc).isoformat()


def source_file_name() -> Column:
    """Base name of the file each row was read from (file-source metadata)."""
    return F.col("_metadata.file_name")


def add_lineage(df: DataFrame, edition: int | Column, source_file: str | Column | None = None,
                ingested_at: str | None = None) -> DataFrame:
    """Append ``_ano_pesquisa`` (int), ``_arquivo_origem`` and ``_data_ingestao``
    (ISO string, one value per run)."""
    edition_col = edition if isinstance(edition, Column) else F.lit(edition)
    if source_file is None:
        source_col = source_file_name()
    elif isinstance(source_file, Column):
        source_col = source_file
    else:
        source_col = F.lit(source_file)
    return df.withColumns({
        EDITION_COL: edition_col.cast("int"),
        SOURCE_COL: source_col.cast("string"),
        INGESTED_COL: F.lit(ingested_at or ingestion_instant()),
    })
