"""Reading update batches and dimensions, and writing new states."""

from dimkeeper.sources.changelog import append_version, compact_log, open_log, read_commits, read_log
from dimkeeper.sources.inline import rows, values
from dimkeeper.sources.json import load_json
from dimkeeper.sources.publish import clustered, publish, publish_touched, touched_partitions, upsert_touched
from dimkeeper.sources.setup import top_keys, type1_table, type2_table, type3_table
from dimkeeper.sources.tables import create_database, create_table, drop_table, drop_view, read_table

__all__ = [
    "append_version",
    "clustered",
    "compact_log",
    "create_database",
    "create_table",
    "drop_table",
    "drop_view",
    "load_json",
    "open_log",
    "publish",
    "publish_touched",
    "read_commits",
    "read_log",
    "read_table",
    "rows",
    "top_keys",
    "touched_partitions",
    "type1_table",
    "type2_table",
    "type3_table",
    "upsert_touched",
    "values",
]
