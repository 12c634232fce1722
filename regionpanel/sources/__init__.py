"""Readers that turn delivered files into all-text tables, and the calendar."""

from .calendar import calendar
from .contracts import CONTRACTS, Contract, source
from .daily_files import dated_files, ingest_daily_files, read_daily_files
from .delimited import good_rows, ingest_delimited, read_by_name, reject_reason, reject_summary, rejects, reload_table
from .fingerprint import fingerprint, row_hash, same_content
from .json_rows import ingest_json_rows, read_features
from .manifest import differences, list_files
from .seeds import state_abbreviations

__all__ = [
    "CONTRACTS",
    "Contract",
    "calendar",
    "dated_files",
    "differences",
    "fingerprint",
    "good_rows",
    "ingest_daily_files",
    "ingest_delimited",
    "ingest_json_rows",
    "list_files",
    "read_by_name",
    "read_features",
    "read_daily_files",
    "reject_reason",
    "reject_summary",
    "rejects",
    "reload_table",
    "row_hash",
    "same_content",
    "source",
    "state_abbreviations",
]
