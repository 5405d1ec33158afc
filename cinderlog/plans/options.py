"""Options: one dataclass, from keyword arguments, INI or YAML-like text, with the checks that hold across them."""

from __future__ import annotations

import configparser
from dataclasses import asdict, dataclass, field, fields
from typing import Any

from ..functions.regexes import translate
from ..operators.transforms import parse_pairs
from ..sources.parsers import REGISTRY


@dataclass
class Options:
    parser: str = ""
    files: list[str] = field(default_factory=list)
    filter_files: list[str] = field(default_factory=list)
    dataset: str = ""
    # reading
    read_from: str = "last"
    stop: bool = False
    poll: bool = False
    statefile: str = ""
    hash_statefile_paths: bool = False
    backfill: bool = False
    # time
    localtime: str = ""  # the local zone's name, if times are local
    timezone: str = ""
    rebase_time: bool = False
    # sampling
    samplerate: int = 1
    tail_sample: bool = True
    deterministic_sampling: str = ""
    dynsampling: list[str] = field(default_factory=list)
    dynsample_window: int = 30
    dynsample_minimum: int = 1
    goal_samplerate: int = 1
    presampled: str = ""
    seed: int | None = None
    # events
    log_prefix: str = ""
    scrub_fields: list[str] = field(default_factory=list)
    drop_fields: list[str] = field(default_factory=list)
    add_fields: list[str] = field(default_factory=list)
    da_map_file: str = ""
    request_shape: list[str] = field(default_factory=list)
    shape_prefix: str = ""
    request_patterns: list[str] = field(default_factory=list)
    request_parse_query: str = "whitelist"
    request_query_keys: list[str] = field(default_factory=list)
    json_fields: list[str] = field(default_factory=list)
    rename_fields: list[str] = field(default_factory=list)
    # sending
    api_host: str = ""
    writekey: str = ""
    debug_stdout: bool = False
    backoff: bool = False
    send_batch_size: int = 50
    status_interval: int = 60
    # the parser's own, by name
    parser_options: dict[str, Any] = field(default_factory=dict)

    @property
    def zone(self) -> str:
        return self.timezone or self.localtime or "UTC"


def prepared(o: Options) -> Options:
    """Defaults that follow from others; raises ValueError where options contradict each other."""
    o = Options(**asdict(o))
    if o.backfill:
        o.backoff, o.read_from, o.stop = True, "beginning", True
    if o.parser not in REGISTRY:
        raise ValueError(f"parser must be one of {', '.join(REGISTRY)}")
    if not o.files:
        raise ValueError("no files to read")
    if o.samplerate < 1:
        raise ValueError("samplerate must be at least 1")
    if o.deterministic_sampling and o.dynsampling:
        raise ValueError("deterministic and dynamic sampling exclude each other")
    if (o.deterministic_sampling or o.dynsampling) and o.samplerate < 2:
        raise ValueError("deterministic and dynamic sampling need a samplerate of at least 2")
    if o.presampled and (o.samplerate != 1 and not o.dynsampling or o.deterministic_sampling):
        raise ValueError("presampled excludes samplerate and deterministic sampling")
    if o.request_parse_query not in ("whitelist", "all"):
        raise ValueError("request_parse_query must be whitelist or all")
    if o.read_from not in ("beginning", "start", "end", "last"):
        raise ValueError("read_from must be beginning, end or last")
    if o.read_from == "end" and o.stop:
        raise ValueError("reading from the end and stopping there reads nothing")
    if o.log_prefix:
        o.log_prefix = o.log_prefix if o.log_prefix.startswith("^") else "^" + o.log_prefix
        translate(o.log_prefix)
    parse_pairs(o.add_fields, "add_fields")
    parse_pairs(o.rename_fields, "rename_fields", exactly_one=True)
    if o.parser == "nginx" and "request" not in o.request_shape:
        o.request_shape = [*o.request_shape, "request"]
    # groups and adaptive or deterministic samplers see all lines
    o.tail_sample = not (o.parser in ("mysql", "postgresql") or o.deterministic_sampling or o.dynsampling)
    if o.dynsampling:
        o.goal_samplerate, o.samplerate = o.samplerate, 1
    return o


def _value(text: str, kind: type, default: Any) -> Any:
    if isinstance(default, bool):
        return text.strip().lower() in ("1", "true", "yes", "on", "")
    if isinstance(default, int) or kind is int:
        return int(text)
    if isinstance(default, list):
        return [x.strip() for x in text.split(",") if x.strip()]
    return text.strip().strip("\"'")


def from_ini(text: str) -> Options:
    """Sections [options] and one named like the parser for its own options; lists are comma-separated."""
    c = configparser.ConfigParser(interpolation=None, strict=False)
    c.optionxform = str
    c.read_string(text if text.lstrip().startswith("[") else "[options]\n" + text)
    base, got = Options(), {}
    known = {f.name: getattr(base, f.name) for f in fields(Options)}
    for name in c.sections():
        for k, v in c[name].items():
            key = k.replace("-", "_")
            if key in known and key != "parser_options":
                got[key] = _value(v, str, known[key])
            else:
                got.setdefault("parser_options", {})[key] = v
    return Options(**got)


def from_yaml(text: str) -> Options:
    """A flat mapping with lists ("- x" or [x, y]) and one nested mapping, parser_options."""
    got: dict[str, Any] = {}
    key, nested = "", None
    base = Options()
    for raw in text.splitlines():
        line = raw.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#") or line.strip() == "---":
            continue
        if line.lstrip().startswith("- "):
            got.setdefault(key, [])
            got[key] = [*(got[key] or []), line.lstrip()[2:].strip().strip("\"'")]
            continue
        k, _, v = line.strip().partition(":")
        v = v.strip()
        if line[0] == " " and nested is not None:
            nested[k] = v.strip("\"'")
            continue
        key, nested = k, None
        if k == "parser_options":
            nested = got.setdefault(k, {})
        elif v.startswith("["):
            got[k] = [x.strip().strip("\"'") for x in v.strip("[]").split(",") if x.strip()]
        elif v:
            got[k] = _value(v, str, getattr(base, k, ""))
        else:
            got[k] = []
    return Options(**got)


def to_ini(o: Options) -> str:
    """Text that from_ini reads back; defaults as comments."""
    out, base = ["[options]"], Options()
    for f in fields(Options):
        v = getattr(o, f.name)
        if f.name == "parser_options":
            continue
        text = ",".join(map(str, v)) if isinstance(v, list) else "" if v is None else str(v).lower() if isinstance(v, bool) else str(v)
        out.append(f"{'# ' if v == getattr(base, f.name) else ''}{f.name} = {text}")
    out += [f"{k} = {v}" for k, v in o.parser_options.items()]
    return "\n".join(out) + "\n"


def to_yaml(o: Options) -> str:
    out = []
    for f in fields(Options):
        v = getattr(o, f.name)
        if isinstance(v, dict):
            out += [f"{f.name}:", *(f"  {k}: {x}" for k, x in v.items())] if v else []
        elif isinstance(v, list):
            out += [f"{f.name}:", *(f"  - {x}" for x in v)] if v else []
        elif v is not None and v != "":
            out.append(f"{f.name}: {str(v).lower() if isinstance(v, bool) else v}")
    return "\n".join(out) + "\n"
