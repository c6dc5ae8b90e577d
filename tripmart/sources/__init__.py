from .files import (concat_tables, read_csv, read_csv_folder, read_master, read_nested_json, read_trip_json,
                    read_weather_json, write_csv, write_dated_facts, write_master_version,
                    write_raw_json)
from .html import html_list_links, html_table_rows
from .literal import literal_rows

__all__ = [
    "concat_tables", "literal_rows",
    "read_csv", "read_csv_folder", "read_master", "read_nested_json", "read_trip_json",
    "read_weather_json", "write_csv", "write_dated_facts", "write_master_version",
    "write_raw_json", "html_list_links", "html_table_rows",
]
