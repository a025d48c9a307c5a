"""Reading and writing of behaviour logs and result tables."""

from footfall.sources.logs import RAW_SCHEMA, load_clean, read_log
from footfall.sources.sinks import save, write_clean, write_rfm
from footfall.sources.tables import events_log, orders_log, part_categories, table
from footfall.sources.workspace import fresh_folder

__all__ = [
    "RAW_SCHEMA",
    "events_log",
    "fresh_folder",
    "load_clean",
    "orders_log",
    "part_categories",
    "read_log",
    "save",
    "table",
    "write_clean",
    "write_rfm",
]
