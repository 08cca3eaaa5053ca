"""Sinks for batches and for streaming micro-batches."""

from .base import FanOut, PageSink, Retrying, SinkError, save
from .files import CsvSink, JsonLinesSink, PrettyJsonSink, read_csv_records, read_jsonl_records
from .snapshot import SnapshotSink

__all__ = [
    "CsvSink", "FanOut", "JsonLinesSink", "PageSink", "PrettyJsonSink", "Retrying", "SinkError", "SnapshotSink",
    "read_csv_records", "read_jsonl_records", "save",
]
