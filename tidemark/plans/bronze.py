"""Bronze: source rows with provenance and a record check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.columns import normalize_columns
from tidemark.sources.datasets import DATASETS

# --- fixed values -----------------------------------------------------------
NO_RECORD_ID = "NOT FOUND"
NULL_RECORD = "NULL RECORD ID"
EMPTY_RECORD = "EMPTY RECORD ID"
# Of one value for a key, given that the record is valid, or for a delivery.
RECORD_COLUMNS = ("record_id", "record_id_source", "error", "is_valid_record_id", "ingest_date")
BRONZE_METADATA = (*RECORD_COLUMNS, "ingestion_timestamp", "source_file")
# ----------------------------------------------------------------------------


def add_record_id(df: DataFrame, name: str) -> DataFrame:
    """Add ``record_id`` (the business key as text) and ``record_id_source``.

    Parts of a composite key are joined by ``_`` and NULL parts are skipped. When a
    key column is missing altogether there is no record id.
    """
    keys = DATASETS[name].keys if name in DATASETS else ()
    if not keys or any(k not in df.columns for k in keys):
        found, origin = F.lit(None).cast("string"), NO_RECORD_ID
    elif len(keys) == 1:
        found, origin = F.col(keys[0]).cast("string"), keys[0]
    else:
        found, origin = F.concat_ws("_", *[F.col(k).cast("string") for k in keys]), "_".join(keys)
    return df.withColumns({"record_id": found, "record_id_source": F.lit(origin)})


def add_quality_flags(df: DataFrame) -> DataFrame:
    """Add ``error`` (why the record id is unusable) and ``is_valid_record_id``."""
    error = F.when(F.isnull("record_id"), NULL_RECORD).when(
        F.trim("record_id") == "", EMPTY_RECORD
    )
    return df.withColumns({"error": error, "is_valid_record_id": error.isNull()})


def valid_records(df: DataFrame) -> DataFrame:
    """Rows whose record id is usable."""
    return df.where("is_valid_record_id")


def to_bronze(
    df: DataFrame, name: str, ingest_date: str, ingested_at: Column | None = None
) -> DataFrame:
    """Source rows of one data set as Bronze rows of one ingest date."""
    flagged = add_quality_flags(add_record_id(normalize_columns(df), name))
    provenance = {
        "ingest_date": F.lit(ingest_date).cast("date"),
        "ingestion_timestamp": F.current_timestamp() if ingested_at is None else ingested_at,
    }
    if "source_file" not in df.columns:
        provenance["source_file"] = F.lit(None).cast("string")
    return flagged.withColumns(provenance)
