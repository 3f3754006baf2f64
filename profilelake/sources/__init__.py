"""Readers and writers."""

from profilelake.sources.files import decode_files, file_inventory, staged_and_failed
from profilelake.sources.index import enrich_index, index_rejects, read_index, split_rejects
from profilelake.sources.tables import (
    DEFAULT_FILE_BYTES,
    read_levels,
    read_metadata,
    read_staged,
    write_levels,
    write_metadata,
)
from profilelake.sources.versions import add_batch, file_list, read_version

__all__ = [
    "DEFAULT_FILE_BYTES",
    "add_batch",
    "decode_files",
    "enrich_index",
    "file_inventory",
    "file_list",
    "index_rejects",
    "read_index",
    "read_levels",
    "read_metadata",
    "read_staged",
    "read_version",
    "split_rejects",
    "staged_and_failed",
    "write_levels",
    "write_metadata",
]
