"""Where rows come from: files, catalog tables, and the discovery of their schemas."""

from tillroll.sources.infer import infer_text_schemas, scan_csv_once
from tillroll.sources.scan import (
    CORRUPT_COLUMN,
    header_schema,
    scan_catalog,
    scan_csv,
    scan_format,
    scan_parquet,
    scan_versioned,
)
from tillroll.sources.schemas import GOLD, RAW, SILVER

__all__ = [
    "CORRUPT_COLUMN",
    "GOLD",
    "RAW",
    "SILVER",
    "header_schema",
    "infer_text_schemas",
    "scan_catalog",
    "scan_csv",
    "scan_csv_once",
    "scan_format",
    "scan_parquet",
    "scan_versioned",
]
