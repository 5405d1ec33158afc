"""Streaming forms of the operators that keep state: values carried forward, and groups of lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.grouping import SERVER_LINES


def carry_forward(df: DataFrame, name: str, value: str = "value", by: str = "source_file", order: str = "line_no") -> DataFrame:
    """df (source_file, line_no, value string, ...): (source_file, line_no, <name>), the last non-null value up to each row, across batches."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get[0] if state.exists else None
        rows = pd.concat(list(frames)).sort_values(order)
        out = []
        for v in rows[value]:
            held = v if v is not None and not pd.isna(v) else held
            out.append(held)
        state.update((held,))
        yield pd.DataFrame({by: key[0], order: rows[order].to_numpy(), name: out})

    return df.groupBy(by).applyInPandasWithState(run, f"{by} string, {order} long, {name} string", "held string", "append", GroupStateTimeout.NoTimeout)


def line_groups(df: DataFrame, kind: str, flush_ms: int = 10_000) -> DataFrame:
    """df (source_file, line_no, line): (source_file, line_no, lines) per finished group, across batches.

    kind: slow_log (a comment after a statement starts a group) or tabs (a tab continues one). A group ends where
    the next starts, or after ``flush_ms`` without new lines; a slow-log group without a statement goes.
    """
    import re

    server = re.compile("|".join(".*".join(map(re.escape, x.split("%"))) for x in SERVER_LINES), re.S)
    head = lambda x: x.startswith("# ") or bool(server.match(x))

    def starts(before: str | None, line: str) -> bool:
        if kind == "tabs":
            return not line.startswith("\t")
        return before is not None and head(line) and not head(before)

    def good(lines: list[str]) -> bool:
        return bool(lines) and (kind == "tabs" or not head(lines[-1]))

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, held = (state.get[0], list(state.get[1])) if state.exists else (-1, [])
        out = []
        if state.hasTimedOut:
            if good(held):
                out.append((key[0], first, held))
            state.remove()
        else:
            rows = pd.concat(list(frames)).sort_values("line_no")
            for n, line in zip(rows["line_no"], rows["line"], strict=True):
                if held and starts(held[-1], line):
                    if good(held):
                        out.append((key[0], first, held))
                    held = []
                if not held:
                    first = int(n)
                held = [*held, line]
            state.update((first, held))
            state.setTimeoutDuration(flush_ms)
        if out:
            yield pd.DataFrame(out, columns=["source_file", "line_no", "lines"])

    return df.groupBy("source_file").applyInPandasWithState(run, "source_file string, line_no long, lines array<string>", "first long, held array<string>", "append", GroupStateTimeout.ProcessingTimeTimeout)
