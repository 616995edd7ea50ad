"""Sinks: partitioned Parquet tables, their registration and upkeep."""

from feedlake.sinks.parquet import (
    OVERWRITE_MODES,
    add_table_partitions,
    drop_table_partitions,
    folders_of,
    path_exists,
    read_feed_table,
    register_table,
    remove_folders,
    rewrite_touched,
    write_combined,
    write_feed,
    write_source_folders,
    write_sources,
)

__all__ = [
    "OVERWRITE_MODES", "add_table_partitions", "drop_table_partitions", "folders_of", "path_exists",
    "read_feed_table", "register_table", "remove_folders", "rewrite_touched", "write_combined",
    "write_feed", "write_source_folders", "write_sources",
]
