"""Writers for exports and tables."""

from .files import write_json, write_json_array, write_table, write_tsv
from .versions import pointer, publish, read_table

__all__ = ["pointer", "publish", "read_table", "write_json", "write_json_array", "write_table", "write_tsv"]
