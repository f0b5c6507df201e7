"""Scans, sinks and the fixed schemas of the known datasets."""

from millrace.sources.files import (
    materialise,
    read_csv,
    read_lines,
    read_parquet,
    write_parquet,
)
from millrace.sources.scratch import ensure_checkpoint_dir, persisted, release, scratch_path

__all__ = [
    "ensure_checkpoint_dir",
    "materialise",
    "persisted",
    "read_csv",
    "read_lines",
    "read_parquet",
    "release",
    "scratch_path",
    "write_parquet",
]
