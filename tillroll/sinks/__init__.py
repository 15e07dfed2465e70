"""Where rows go: catalog tables, plain paths, report snapshots; and the DDL for them."""

from tillroll.sinks.ddl import (
    REPORT_TABLES,
    SNAPSHOT_COLUMN,
    create_report_tables,
    ensure_database,
    register_table,
)
from tillroll.sinks.publish import finish_publications, publish_snapshots
from tillroll.sinks.tables import bind_table, write_catalog, write_overwrite, write_snapshot

__all__ = [
    "REPORT_TABLES",
    "SNAPSHOT_COLUMN",
    "bind_table",
    "create_report_tables",
    "ensure_database",
    "finish_publications",
    "publish_snapshots",
    "register_table",
    "write_catalog",
    "write_overwrite",
    "write_snapshot",
]
