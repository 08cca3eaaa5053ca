"""Run statistics, reports and error listings as files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sinks.files import JsonLinesSink, PrettyJsonSink
from .report import html_report
from .summary import run_summary


def export_summary(log: DataFrame, path: str) -> None:
    """The run summary as one indented JSON document."""
    PrettyJsonSink(path).write(run_summary(log), 0)


def export_report(log: DataFrame, path: str) -> None:
    """The run summary as one HTML page."""
    html_report(run_summary(log)).coalesce(1).write.mode("overwrite").text(path)


def export_errors(parts: dict[str, DataFrame], path: str) -> None:
    """The parts of ``error_report``, one JSON-lines folder each; URL listings are
    written by all tasks, however long they are."""
    for name, part in parts.items():
        JsonLinesSink(f"{path}/{name}").write(part, 0)
