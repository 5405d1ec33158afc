"""Text sources: files, their pruning, standard input, lookups and configurations."""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import tempfile
from collections.abc import Iterable
from glob import glob

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ends the names of files that hold read positions.
STATE = ".tail.state"
LINES = "source_file string, line_no long, line string"


def _glob_regex(pattern: str) -> re.Pattern | None:
    """A path pattern whose * and ? stay inside a path segment; None if it is malformed."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "*":
            out += "[^/]*"
        elif c == "?":
            out += "[^/]"
        elif c == "[":
            end = pattern.find("]", i + 2)
            if end < 0:
                return None
            body = pattern[i + 1 : end]
            out += "[" + ("^" + body[1:] if body[0] in "^!" else body).replace("\\", "\\\\") + "]"
            i = end
        elif c == "\\":
            if i + 1 == len(pattern):
                return None
            i += 1
            out += re.escape(pattern[i])
        else:
            out += re.escape(c)
        i += 1
    return re.compile(out + r"\Z")


def excluded(path: str, patterns: Iterable[str]) -> bool:
    """Whether any pattern matches the whole path; a malformed one excludes everything."""
    return any((p := _glob_regex(x)) is None or p.match(path) for x in patterns)


def state_path(log: str, statefile: str = "", several: bool = False, hash_paths: bool = False) -> str:
    """Where a log's read position is kept: the given file, or in the given (or the temporary) folder the log's name without .log, ending in STATE."""
    folder = tempfile.gettempdir()
    if statefile:
        if not several and not os.path.isdir(statefile):
            return statefile
        folder = statefile if os.path.isdir(statefile) else folder
    name = os.path.basename(log).removesuffix(".log") + STATE
    return os.path.join(folder, name + (f"-{hashlib.sha1(log.encode()).hexdigest()}" if hash_paths else ""))


def prune(files: Iterable[str], filters: Iterable[str] = (), statefile: str = "") -> list[str]:
    """Paths that are neither excluded nor state files. None left is an error."""
    kept = [f for f in files if not f.endswith(STATE) and f != statefile and not excluded(f, filters)]
    if not kept:
        raise ValueError("no files left to read")
    return kept


def expand(patterns: Iterable[str]) -> list[str]:
    """Local files that patterns name, each once; a path with a scheme stays, for Spark to list."""
    out: dict[str, None] = {}
    for p in patterns:
        for f in [p] if "://" in p or p == "-" else sorted(glob(p)) or [p]:
            out[f] = None
    return list(out)


def read_lines(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """(source_file, line_no, line) for formats of one line an event. Files split over tasks; line_no rises inside a file but has gaps:
    its high part is where the line's split starts."""
    df = spark.read.text([files] if isinstance(files, str) else files)
    place = F.col("_metadata.file_block_start") * F.lit(1 << 20) + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.select(F.col("_metadata.file_path").alias("source_file"), place.alias("line_no"), F.col("value").alias("line"))


def numbered(files: DataFrame) -> DataFrame:
    """files (source_file, value): (source_file, line_no, line) with line_no from 0 without gaps; a line end at the end of a file ends its last line."""
    lines = files.select("source_file", F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n", -1)).alias("line_no", "line"))
    return lines.withColumn("line_no", F.col("line_no").cast("long"))


def read_ordered(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """(source_file, line_no, line) for formats whose events span lines, or whose values carry on: the order in a file counts. Files split over tasks
    as in read_lines; what follows puts a file's lines together where it must."""
    return read_lines(spark, files)


def from_lines(spark: SparkSession, lines: Iterable[str], source: str = "-") -> DataFrame:
    return spark.createDataFrame([(source, i, x.rstrip("\r\n")) for i, x in enumerate(lines)], LINES)


def read_stdin(spark: SparkSession) -> DataFrame:
    """Standard input to its end."""
    return from_lines(spark, sys.stdin)


def read_lookup(path: str) -> dict[str, dict[str, dict[str, object]]]:
    """A lookup file: {source field: {value: {new field: value}}}."""
    with open(path, encoding="utf-8") as f:
        table = json.load(f)
    if not isinstance(table, dict) or not all(isinstance(v, dict) and all(isinstance(x, dict) for x in v.values()) for v in table.values()):
        raise ValueError("a lookup maps source fields to values to new fields")
    return table
