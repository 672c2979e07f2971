from stratakeep.functions.hashing import joined_hash, joined_key, key_hash, row_hash
from stratakeep.functions.times import convert_unix_time, epoch_ms_to_date_legacy, epoch_ms_to_timestamp

__all__ = [
    "convert_unix_time",
    "epoch_ms_to_date_legacy",
    "epoch_ms_to_timestamp",
    "joined_hash",
    "joined_key",
    "key_hash",
    "row_hash",
]
