from stratamart.sources.delimited import land, path_exists, read_feed, resolve_delimiter
from stratamart.sources.shared_folder import shared_folder
from stratamart.sources.warehouse import Snapshot, Warehouse, bucket_count_for, empty_frame

__all__ = [
    "Snapshot",
    "Warehouse",
    "bucket_count_for",
    "empty_frame",
    "land",
    "path_exists",
    "read_feed",
    "resolve_delimiter",
    "shared_folder",
]
