"""Parsers: lines (source_file, line_no, line) to events (source_file, line_no, timestamp, sample_rate, data).

Rows that don't parse go; ``rejects`` gives them. REGISTRY has the parsers by name; add an entry to add one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .database import parse_arangodb, parse_mongodb, parse_mysql, parse_postgresql
from .plain import parse_csv, parse_json, parse_keyval, parse_nginx, parse_regex, parse_syslog

REGISTRY = {
    "arangodb": parse_arangodb,
    "csv": parse_csv,
    "json": parse_json,
    "keyval": parse_keyval,
    "mongo": parse_mongodb,
    "mongodb": parse_mongodb,
    "mysql": parse_mysql,
    "nginx": parse_nginx,
    "postgresql": parse_postgresql,
    "regex": parse_regex,
    "syslog": parse_syslog,
}



def rejects(lines: DataFrame, events: DataFrame) -> DataFrame:
    """The lines that gave no event, for parsers of one line an event."""
    return lines.join(events.select("source_file", "line_no"), ["source_file", "line_no"], "left_anti")


__all__ = ["rejects", "REGISTRY", *(f.__name__ for f in dict.fromkeys(REGISTRY.values()))]
