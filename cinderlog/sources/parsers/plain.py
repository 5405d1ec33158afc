"""Single-line formats, as expressions only."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import times
from ...functions.compat import DATA, doubles, get, keep, kind, merge, no_data, record, string_of, trim_space, typed, variant
from ...functions.regexes import group, matched, translate
from ...operators.filters import allow_processes, any_value, line_filter, strip_prefix

ENVELOPE = ("source_file", "line_no", "timestamp", "sample_rate", "data")


def finish(df: DataFrame, ts: Column, data: Column) -> DataFrame:
    out = df.withColumn("timestamp", ts).withColumn("data", data.cast(DATA)).withColumn("sample_rate", F.lit(1))
    return out.select(*ENVELOPE)


def timed(df: DataFrame, field: str | None, fmt: str | None, zone: str, now: datetime | None) -> DataFrame:
    return finish(times.resolve(df, field, fmt, zone, now, "_ts"), F.col("_ts"), F.col("data"))


def json_object(line: Column) -> Column:
    """A line's JSON object as a data map, its numbers as doubles; null for anything else."""
    v = F.try_parse_json(line)
    ok = line.rlike(r"^\s*\{[\s\S]*\}\s*\z") & kind(v).startswith("OBJECT")
    return doubles(F.when(ok, v).cast(DATA))


def parse_json(lines: DataFrame, *, prefix: str | None = None, timefield: str | None = None, fmt: str | None = None, zone: str = "UTC", now: datetime | None = None) -> DataFrame:
    """One object a line. Time comes from the object; prefix fields are merged after it, and win."""
    df = strip_prefix(lines.withColumn("line", trim_space("line")), prefix)
    df = keep(df, "data", json_object(F.col("line")), lambda x: x.isNotNull())
    df = times.resolve(df, timefield, fmt, zone, now, "_ts")
    return finish(df, F.col("_ts"), merge(F.col("data"), F.col("prefix")) if prefix else F.col("data"))


_PAIR = r'([^\s="\x00-\x20]+)(?:=("(?:[^"\\]|\\.)*+"|[^\s"]*))?'


def keyval(line: Column) -> Column:
    """k=v pairs, quoted values unescaped; words without = are empty strings; later pairs win."""
    items = F.regexp_extract_all(line, F.lit(f"(?:{_PAIR})"), F.lit(0))

    def pair(x: Column) -> Column:
        key, value = F.regexp_extract(x, "^([^=]*)", 1), F.regexp_replace(x, "^[^=]*=?", "")
        quoted = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, '^"|"$', ""), r"\\n", "\n"), r"\\t", "\t"), r"\\(.)", "$1")
        return F.struct(key.alias("key"), F.when(value.startswith('"'), variant(quoted)).otherwise(typed(value, boolean=True)).alias("value"))

    return F.map_from_entries(F.transform(items, pair))


def parse_keyval(lines: DataFrame, *, prefix: str | None = None, timefield: str | None = None, fmt: str | None = None, filter_regex: str | None = None, invert: bool = False, zone: str = "UTC", now: datetime | None = None) -> DataFrame:
    """Values are booleans (1 and 0 are), whole numbers, decimals or strings, in this order of trial. Lines without any value go."""
    df = lines.withColumn("line", trim_space("line")).where("line <> ''")
    df = line_filter(df, filter_regex, invert) if filter_regex else df
    df = strip_prefix(df, prefix)
    bad = F.col("line").rlike(r'^[^"]*"(?:[^"\\]|\\.|"[^"]*")*+$') & (F.length(F.regexp_replace("line", r'\\.|[^"]', "")) % 2 == 1)
    df = keep(df.where(~bad), "data", keyval(F.col("line")), any_value)
    return timed(df.withColumn("data", merge(F.col("data"), F.col("prefix"))), timefield, fmt, zone, now)


def _csv(line: Column, trim: bool) -> tuple[Column, Callable[[Column], Column]]:
    """(fields as they are written, null for a line that isn't valid; what gives a field's value)."""
    ws = r"[ \t]*+" if trim else ""
    bare = rf'{ws}(?:"[^",]*+"|[^,"]*+)'
    one = rf'{ws}(?:"(?:[^"]|"")*+"|[^,"]*+)'
    led = F.concat(F.lit(","), line)
    raw = F.regexp_extract_all(led, F.lit(f",({one})"), F.lit(1))

    def clean(x: Column) -> Column:
        x = F.regexp_replace(x, r"^[ \t]+", "") if trim else x
        return F.when(x.startswith('"'), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)

    # most lines have no quotes, or none around commas and quotes: their commas part them
    plain = ~F.contains(line, F.lit('"')) | line.rlike(rf"^{bare}(?:,{bare})*+\z")
    return F.when(plain, F.split(line, ",", -1)).when(led.rlike(rf"^(?:,{one})++\z"), raw), clean


def parse_csv(lines: DataFrame, *, fields: list[str] | str, prefix: str | None = None, timefield: str | None = None, fmt: str | None = None, trim_leading_space: bool = False, zone: str = "UTC", now: datetime | None = None) -> DataFrame:
    """Comma-separated values under the given names; the number must be the same. Values are whole numbers, decimals or strings."""
    import csv

    names = next(csv.reader([fields], skipinitialspace=True), []) if isinstance(fields, str) else list(fields)
    if not names or names == [""]:
        raise ValueError("csv needs field names")
    df = strip_prefix(lines, prefix)
    cut, value = _csv(F.col("line"), trim_leading_space)
    df = keep(df.where(F.col("line") != ""), "_f", cut, lambda x: x.isNotNull() & (F.size(x) == len(names)))
    # for a usual number of fields typed one by one, which compiles; a lambda would be interpreted
    if len(names) <= 64:
        df = df.withColumns({f"_{i}": value(F.col("_f")[i]) for i in range(len(names))})
        values = F.array(*(typed(f"_{i}") for i in range(len(names))))
    else:
        values = F.transform(F.transform("_f", value), lambda x: typed(x))
    data = F.map_from_arrays(F.array(*map(F.lit, names)), values)
    return timed(df.withColumn("data", merge(data, F.col("prefix")) if prefix else data), timefield, fmt, zone, now)


def compile_log_format(fmt: str) -> tuple[str, list[str]]:
    """(regex, names) of an access-log format: $name or ${name} takes all up to the next literal character. Other text stands for itself; dots match any character."""
    names, out = [], []
    parts = re.split(r"\$\{?([A-Za-z0-9_]+)\}?", fmt)
    for i, p in enumerate(parts):
        if i % 2:
            names.append(p)
            nxt = parts[i + 1]
            out.append(rf"([^{re.escape(nxt[0])}]*)" if nxt else r"([\s\S]*)")
        else:
            out.append(re.escape(p).replace(r"\.", "."))
    return "^" + "".join(out) + r"\z", names


def read_log_format(text: str, name: str) -> str:
    """A log_format's text from an nginx configuration."""
    m = re.search(rf"log_format\s+{re.escape(name)}\s+((?:'[^']*'|\"[^\"]*\"|[^;'\"])*);", text)
    if not m:
        raise ValueError(f"no log_format {name}")
    quoted = re.findall(r"'([^']*)'|\"([^\"]*)\"", m[1])
    return "".join(a or b for a, b in quoted) if quoted else m[1].strip()


def typeify(c: Column) -> Column:
    """An access log's value: decimals only with a dot, whole numbers without; null for a dash."""
    from ...functions.compat import to_double, to_long

    number = F.when(F.contains(c, F.lit(".")), variant(to_double(c))).otherwise(variant(to_long(c)))
    return F.when(c != "-", F.coalesce(number, variant(c)))


def parse_nginx(lines: DataFrame, *, log_format: str, prefix: str | None = None, timefield: str | None = None, fmt: str | None = None, zone: str = "UTC", now: datetime | None = None) -> DataFrame:
    """Access logs by their log_format. Time: the given field and format (both), else time_local, time_iso8601, msec, else well-known names."""
    regex, names = compile_log_format(log_format)
    df = strip_prefix(lines.withColumn("line", trim_space("line")), prefix)
    df = df.where(F.col("line").rlike(regex))
    fields = record({n: typeify(F.regexp_extract("line", regex, i)) for i, n in enumerate(names, 1)})
    own = F.when(F.col("prefix").isNotNull(), F.map_filter(F.transform_values("prefix", lambda _, v: typeify(string_of(v))), lambda _, v: v.isNotNull()))
    df = df.withColumn("data", merge(fields, own))
    if timefield and fmt:
        return timed(df, timefield, fmt, zone, now)
    if timefield or fmt:
        return finish(df, times.moment(now), F.col("data"))
    local, iso, msec = (get("data", k) for k in ("time_local", "time_iso8601", "msec"))
    msec_text = F.when(kind(msec).rlike("^(DOUBLE|DECIMAL|STRING)"), F.when(kind(msec) == "STRING", string_of(msec)).otherwise(F.format_string("%.3f", F.try_variant_get(msec, "$", "double"))))
    has = [F.map_contains_key("data", F.lit(k)) for k in ("time_local", "time_iso8601", "msec")]
    own = has[0] | has[1] | has[2]
    tried = (
        F.when(has[0], F.struct(F.lit("time_local").alias("k"), times.try_formats(string_of(local), "02/Jan/2006:15:04:05 -0700", zone).alias("t")))
        .when(has[1], F.struct(F.lit("time_iso8601").alias("k"), times.try_formats(string_of(iso), "2006-01-02T15:04:05Z07:00", zone).alias("t")))
        .when(has[2], F.struct(F.lit("msec").alias("k"), times.epoch(msec_text).alias("t")))
    )
    df = df.withColumn("_hit", F.when(own, tried).otherwise(times.found(F.when(~own, F.col("data")), None, None, zone)))
    rest = F.map_filter("data", lambda k, _: F.coalesce(k != F.col("_hit.k"), F.lit(True)))
    return finish(df.withColumn("_ts", F.coalesce(F.col("_hit.t"), times.moment(now))), F.col("_ts"), rest)


_RFC3164 = r"^<([0-9]{1,3})>([A-Z][a-z]{2} [ 0-9][0-9] [0-9:]{8}) (\S+) (?:([^\s\[:]+)(?:\[[^\]]*\])?: ?)?([\s\S]*)\z"
_RFC5424 = r"^<([0-9]{1,3})>([0-9]{1,2}) (\S+) (\S+) (\S+) (\S+) (\S+) (-|(?:\[(?:[^\]\\]|\\.)*+\])++)(?: ([\s\S]*))?\z"


def parse_syslog(lines: DataFrame, *, mode: str, processes: list[str] | None = None, prefix: str | None = None, year: int | None = None, zone: str = "UTC", now: datetime | None = None) -> DataFrame:
    """rfc3164 (in the current year) or rfc5424. The timestamp stays among the fields; without one it is null, never now."""
    if mode not in ("rfc3164", "rfc5424"):
        raise ValueError("mode must be rfc3164 or rfc5424")
    df = strip_prefix(lines, prefix)
    regex = _RFC3164 if mode == "rfc3164" else _RFC5424
    df = df.where(F.col("line").rlike(regex))
    g = lambda i: F.regexp_extract("line", regex, i)
    priority = g(1).cast("long")
    df = df.where(priority <= 191)
    common = {"priority": priority, "facility": F.floor(priority / 8), "severity": priority % 8}
    if mode == "rfc3164":
        of = F.lit(str(year)) if year else F.year(times.moment(now)).cast("string")
        ts = F.try_to_timestamp(F.regexp_replace(F.concat_ws(" ", of, g(2)), r"\s+", " "), F.lit("yyyy MMM d HH:mm:ss"))
        ts = F.to_utc_timestamp(ts, zone) if zone != "UTC" else ts
        fields = common | {"timestamp": ts, "hostname": g(3), "process": F.nullif(g(4), F.lit("")), "content": F.trim(g(5))}
    else:
        ts = F.try_to_timestamp(g(3))
        fields = common | {"version": g(2).cast("long"), "timestamp": ts, "hostname": g(4), "process": g(5), "proc_id": g(6), "msg_id": g(7), "structured_data": g(8), "message": F.trim(g(9))}
    data = merge(record({k: variant(c) for k, c in fields.items()}), F.col("prefix"))
    out = finish(df.withColumn("data", data), F.try_variant_get(F.when(kind(F.try_element_at(data, F.lit("timestamp"))).startswith("TIMESTAMP"), F.try_element_at(data, F.lit("timestamp"))), "$", "timestamp"), F.col("data"))
    return allow_processes(out, processes)


def parse_regex(lines: DataFrame, *, patterns: list[str] | str, prefix: str | None = None, timefield: str | None = None, fmt: str | None = None, zone: str = "UTC", now: datetime | None = None) -> DataFrame:
    """The first pattern that matches anywhere gives its named groups as strings. A line that only has prefix fields stays."""
    ps = [translate(p) for p in ([patterns] if isinstance(patterns, str) else patterns) if p] or None
    if not ps or not all(p.named() for p in ps) or not isinstance(patterns, str) and not all(patterns):
        raise ValueError("each pattern needs a named group")
    df = strip_prefix(lines, prefix)
    data, line = None, F.col("line")
    for p in ps:
        own = record({n: variant(group(line, p, i)) for n, i in p.named().items()})
        data = F.when(matched(line, p), own) if data is None else data.when(matched(line, p), own)
    df = keep(df, "data", data, lambda x: x.isNotNull() | F.col("prefix").isNotNull())
    return timed(df.withColumn("data", merge(F.coalesce(F.col("data"), no_data()), F.col("prefix"))), timefield, fmt, zone, now)
