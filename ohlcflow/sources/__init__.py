"""Inputs: price CSVs, JSON bar messages, layer tables, derived test bars."""

from .csv import scan_csv  # noqa: F401
from .messages import decode_messages, encode_messages, message_rejects  # noqa: F401
from .tables import read_table, register_tables, write_table  # noqa: F401
