from riskframe.sources.tables import read_table, loans, events_frame
from riskframe.sources.io import (
    load_data, load_or_create_clean, save_table, save_json_table, load_json_table,
)

__all__ = [
    "read_table", "loans", "events_frame", "load_data", "load_or_create_clean",
    "save_table", "save_json_table", "load_json_table",
]
