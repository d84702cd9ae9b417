"""Sources and sinks: parquet / CSV / TSV / JDBC readers and writers."""

from .parts import create_parts, upsert_parts
from .readers import (batch_bounds, read_batches, jdbc_options, malformed, order_key, read_files, read_jdbc,
                      read_key_map, read_table, stage_files, with_batches, ingest_files)
from .versions import (ConcurrentCommit, NoSuchTable, Run, Version, commit, current, read_version,
                       recover, vacuum, version_numbers)
from .writers import (Layout, count_null_markers, path_exists, publish, read_copy, read_tsv,
                      swap_in, with_load_ts, write_copy, write_table, write_tsv)

__all__ = [
    "ConcurrentCommit", "Layout", "NoSuchTable", "Run", "Version", "commit", "current",
    "create_parts", "upsert_parts", "batch_bounds", "read_batches", "read_copy", "write_copy", "read_version", "recover", "vacuum", "version_numbers",
    "count_null_markers", "ingest_files", "jdbc_options", "malformed", "order_key", "path_exists", "publish",
    "read_files", "read_jdbc", "read_key_map", "read_table", "read_tsv", "stage_files",
    "swap_in",
    "with_batches", "with_load_ts", "write_table", "write_tsv",
]
