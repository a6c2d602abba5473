"""Readers and writers with explicit schemas."""

from marquee.sources import schemas
from marquee.sources.tables import (
    land,
    load_model,
    preview,
    read_csv,
    read_json,
    read_records,
    read_table,
    read_tsv,
    save_model,
    write_csv,
    write_json,
    write_table,
    write_tsv,
)

__all__ = [
    "land",
    "load_model",
    "preview",
    "read_csv",
    "read_json",
    "read_records",
    "read_table",
    "read_tsv",
    "save_model",
    "schemas",
    "write_csv",
    "write_json",
    "write_table",
    "write_tsv",
]
