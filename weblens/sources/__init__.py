from weblens.sources.heads import file_heads
from weblens.sources.inventory import list_entries, log_file_inventory
from weblens.sources.keyed import keyed_lookup, open_keyed_table, write_keyed_table
from weblens.sources.profile import log_profile
from weblens.sources.tables import table_key_lookup, table_scan_filter
from weblens.sources.text import index_bounds, line_index, number_lines, scan_log_text

__all__ = [
    "file_heads",
    "index_bounds",
    "keyed_lookup",
    "line_index",
    "list_entries",
    "log_file_inventory",
    "log_profile",
    "number_lines",
    "open_keyed_table",
    "scan_log_text",
    "table_key_lookup",
    "table_scan_filter",
    "write_keyed_table",
]
