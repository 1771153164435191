"""Writers."""

from hearthline.sinks.parquet import Staged, shared_folder, stage, staging, unstage, write_table

__all__ = ["Staged", "shared_folder", "stage", "staging", "unstage", "write_table"]
