from stratakeep.sources.landing import null_keys, read_landing, split_landing
from stratakeep.sources.tables import append_load, read_loads, read_table, replace_table, scratch_path, scratch_scope, stage

__all__ = [
    "append_load",
    "null_keys",
    "read_landing",
    "read_loads",
    "read_table",
    "replace_table",
    "scratch_path",
    "scratch_scope",
    "split_landing",
    "stage",
]
