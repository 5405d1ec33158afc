"""A streaming source that follows files: bytes appended since the last batch, across rotation."""

from __future__ import annotations

import json
import os

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from .text import expand, prune, state_path

STARTS = ("beginning", "start", "end", "last")


class Span(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def start_offset(path: str, read_from: str, state: str | None) -> int:
    """Where reading starts: last is the saved offset, the end if none is usable, the beginning of a file that replaced the saved one."""
    if read_from not in STARTS:
        raise ValueError(f"read_from must be one of {', '.join(STARTS)}")
    if read_from in ("beginning", "start"):
        return 0
    stat = os.stat(path)
    if read_from == "end":
        return stat.st_size
    try:
        with open(state or state_path(path), encoding="utf-8") as f:
            saved = json.load(f)
        inode, offset = int(saved["INode"]), int(saved["Offset"])
    except (OSError, ValueError, KeyError, TypeError):
        return stat.st_size
    return offset if inode == stat.st_ino else 0


def whole_lines(path: str, start: int, end: int) -> int:
    """The end of the last whole line between two offsets."""
    if end <= start:
        return start
    with open(path, "rb") as f:
        at = end
        while at > start:
            size = min(1 << 16, at - start)
            f.seek(at - size)
            hit = f.read(size).rfind(b"\n")
            if hit >= 0:
                return at - size + hit + 1
            at -= size
    return start


class Lines:
    """Lines of spans, with the offset where each begins."""

    def read(self, partition: Span | None):
        if partition is None:  # nothing to read
            return
        with open(partition.path, "rb") as f:
            f.seek(partition.start)
            at = partition.start
            while at < partition.end:
                line = f.readline()
                if not line:
                    return
                yield partition.path, at, line.decode("utf-8", "replace").rstrip("\r\n")
                at += len(line)


class TailBatch(Lines, DataSourceReader):
    """What the files hold now, from where reading starts to their end, the last line too if nothing ends it; in spans of whole lines."""

    def __init__(self, options: dict[str, str]):
        self.reader = TailReader(options)

    def partitions(self) -> list[InputPartition]:
        out = []
        for f, start in self.reader.initialOffset().items():
            at, size = start["off"], os.stat(f).st_size
            while at < size:
                end, most = at, self.reader.most
                while end == at and at + most < size:
                    end, most = whole_lines(f, at, at + most), 2 * most
                end = end if end > at else size
                out.append(Span(f, at, end))
                at = end
        return out


class TailReader(Lines, DataSourceStreamReader):
    """Offsets are JSON: {path: {"ino": inode, "off": bytes}}. Files must be visible to all executors."""

    def __init__(self, options: dict[str, str]):
        self.patterns = options["path"].split(",")
        self.filters = [x for x in options.get("filter", "").split(",") if x]
        self.read_from = options.get("read_from", "last")
        self.statefile = options.get("statefile", "")
        self.hash_paths = options.get("hash_statefile_paths", "false").lower() == "true"
        self.most = int(options.get("max_bytes_per_file", str(64 << 20)))
        self.seen: dict[str, dict[str, int]] = {}

    def _files(self) -> list[str]:
        return [f for f in prune(expand(self.patterns), self.filters, self.statefile) if os.path.exists(f)]

    def _state(self, path: str, several: bool) -> str:
        return state_path(path, self.statefile, several, self.hash_paths)

    def initialOffset(self) -> dict:
        files = self._files()
        out = {}
        for f in files:
            out[f] = {"ino": os.stat(f).st_ino, "off": start_offset(f, self.read_from, self._state(f, len(files) > 1))}
        self.seen = out
        return out

    def latestOffset(self) -> dict:
        out = {}
        for f in self._files():
            stat = os.stat(f)
            was = self.seen.get(f)
            off = was["off"] if was and was["ino"] == stat.st_ino and was["off"] <= stat.st_size else 0
            most = self.most
            end = whole_lines(f, off, min(stat.st_size, off + most))
            while end == off and off + most < stat.st_size:  # a line longer than the window: look farther
                most *= 2
                end = whole_lines(f, off, min(stat.st_size, off + most))
            out[f] = {"ino": stat.st_ino, "off": end}
        self.seen = self.seen | out
        return self.seen

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for f, e in end.items():
            s = start.get(f)
            at = s["off"] if s and s["ino"] == e["ino"] and s["off"] <= e["off"] else 0
            if e["off"] > at:
                out.append(Span(f, at, e["off"]))
        return out

    def commit(self, end: dict) -> None:
        """Saves offsets where other readers look for them, once the batch is done."""
        if not self.statefile:
            return
        for f, e in end.items():
            path = self._state(f, len(end) > 1)
            with open(path + ".tmp", "w", encoding="utf-8") as out:
                json.dump({"INode": e["ino"], "Offset": e["off"]}, out)
            os.replace(path + ".tmp", path)


class TailSource(DataSource):
    """spark.dataSource.register(TailSource); spark.readStream.format("tail").option("path", "/var/log/*.log"), or spark.read for what is there now."""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return "source_file string, line_no long, line string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return TailBatch(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TailReader(dict(self.options))
