"""Timestamps: formats, parsing in a zone, and the rules that find an event's time."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .compat import DATA, col, get, kind, string_of

#: Names tried for an event's time, in this order; formats that mean seconds since 1970.
FIELDS = ("time", "Time", "timestamp", "Timestamp", "TimeStamp", "date", "Date", "datetime", "Datetime", "DateTime", "msec")
EPOCH_FORMATS = ("%s(%L)?", "%s(.%L)?", "unixepoch")

#: Strftime directives by the pattern letters they mean here; None for those without support, which stand for nothing.
STRFTIME = {
    "%a": "<weekday>", "%A": "<weekday>", "%b": "MMM", "%B": "MMMM", "%c": None, "%C": "yy", "%d": "dd", "%D": "MM/dd/yy", "%e": "d", "%E": None,
    "%f": "<fraction>", "%F": "yyyy-MM-dd", "%G": None, "%g": None, "%h": "MMM", "%H": "H", "%I": "h", "%j": None, "%k": "H", "%l": "h",
    "%L": "<fraction>", "%m": "M", "%M": "m", "%n": " ", "%O": None, "%p": "a", "%P": "a", "%r": "h:m:<seconds> a", "%R": "H:m", "%S": "<seconds>",
    "%t": " ", "%T": "H:m:<seconds>", "%u": None, "%U": None, "%V": None, "%w": None, "%W": None, "%x": None, "%X": None, "%y": "yy", "%Y": "yyyy",
    "%z": "<offset>", "%Z": "<zone>", "%+": "<weekday> MMM d H:m:<seconds> <zone> yyyy",
}
#: Elements of example-style layouts, longest first.
LAYOUT = (
    ("January", "MMMM"), ("Jan", "MMM"), ("Monday", "<weekday>"), ("Mon", "<weekday>"), ("MST", "<zone>"), ("2006", "yyyy"), ("-07:00", "<offset>"), ("-0700", "<offset>"), ("Z07:00", "<offset>"), ("Z0700", "<offset>"),
    ("01", "MM"), ("02", "dd"), ("03", "h"), ("04", "m"), ("05", "<seconds>"), ("06", "yy"), ("15", "H"), ("_2", "d"), ("PM", "a"), ("pm", "a"), ("1", "M"), ("2", "d"), ("3", "h"), ("4", "m"), ("5", "<seconds>"),
)
WEEKDAY = r"(?i)\b(?:mon|tue|wed|thu|fri|sat|sun)(?:day|sday|nesday|rsday|urday)?\b,?"
#: Formats tried after the event's own.
CASCADE = ("2006-01-02 15:04:05.999999999 -0700 MST", "2006-01-02T15:04:05.999999999Z07:00", "Mon Jan 02 15:04:05 -0700 2006", "Mon Jan _2 15:04:05 MST 2006")


#: How texts begin that a format of CASCADE can read: a parser that fails costs far more than the look.
SHAPES = dict(zip(CASCADE, (r"^[0-9]{4}-[0-9]{2}-[0-9]{2} ", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt]", r"^\s*[A-Za-z]{3},? [A-Za-z]{3} [0-9]{1,2} [0-9:., ]+[+-]", r"^\s*[A-Za-z]{3},? [A-Za-z]{3} +[0-9]{1,2} [0-9:., ]+[A-Z]"), strict=True))


def compile_format(fmt: str) -> tuple[str, bool]:
    """(Java pattern, whether weekdays are to be cut from the text first) of a strftime or example-style format.

    Seconds take a fraction whether the format has one or not. Zone names are cut where an offset stands
    beside them.
    """
    parts: list[str] = []
    if "%" in fmt:
        for m in re.finditer(r"%.|[^%]+", fmt):
            parts.append((STRFTIME.get(m[0], "") or "") if m[0].startswith("%") else "'" + m[0] + "'")
    else:
        i = 0
        while i < len(fmt):
            if m := re.match(r"[.,](?:9+|0+)(?![0-9])", fmt[i:]):
                parts.append("<fraction>")
                i += len(m[0])
                continue
            hit = next((x for x in LAYOUT if fmt.startswith(x[0], i)), None)
            parts.append(hit[1] if hit else "'" + fmt[i] + "'")
            i += len(hit[0]) if hit else 1
    text = "".join(parts)
    text = re.sub(r"'([^']*)'", lambda m: "".join("'" + x + "'" if x.isalpha() else "''" if x == "'" else x for x in m[1]), text)
    text = text.replace("''", "")
    weekday = "<weekday>" in text
    text = text.replace("<weekday>", "")
    if "<offset>" in text:
        text = re.sub(r"\s*<zone>", "", text)
    text = re.sub(r"(?<=<seconds>)\.?<fraction>", "", text)
    text = text.replace("<fraction>", "[SSSSSSSSS]")
    text = text.replace("<seconds>", "s[.SSSSSSSSS][.SSSSSS][.SSS][.SS][.S]".replace("[.SSSSSS][.SSS][.SS][.S]", ""))
    text = text.replace("<offset>", "[XXX][XX][X]").replace("<zone>", "z")
    # one digit may stand for two where the format allows it
    text = re.sub(r"(?<![A-Za-z])(M{2}|d{2})(?![A-Za-z])", lambda m: m[0][0], text) if re.search(r"[^A-Za-z]", text) else text
    return re.sub(r"\s+", " ", text).strip(), weekday


def epoch(text: Column) -> Column:
    """Seconds since 1970 with a fraction; exactly ten digits are seconds, more are milli-, micro- or nanoseconds."""
    digits = F.when(text.rlike(r"^[0-9]{10,19}\z"), F.timestamp_micros(F.rpad(F.substring(text, 1, 16), 16, "0").cast("long")))
    number = F.regexp_extract(text, r"^([0-9]{1,12})\.([0-9]+)\z", 1)
    fraction = F.rpad(F.substring(F.regexp_extract(text, r"^([0-9]{1,12})\.([0-9]+)\z", 2), 1, 6), 6, "0")
    return F.coalesce(digits, F.when(text.rlike(r"^[0-9]{1,12}\.[0-9]+\z"), F.timestamp_micros(F.concat(number, fraction).cast("long"))))


def parse(text: Column | str, fmt: str, zone: str = "UTC") -> Column:
    """A time in the given format, null where the text has another; times without offset are in ``zone``."""
    c = F.regexp_replace(F.regexp_replace(col(text), ",", "."), r"\s+", " ")
    if fmt in EPOCH_FORMATS:
        return epoch(c)
    pattern, weekday = compile_format(fmt)
    if weekday:
        c = F.trim(F.regexp_replace(F.regexp_replace(c, WEEKDAY, ""), r"\s+", " "))
    own_zone = "X" in pattern or re.search(r"(?<!')z", pattern)
    if "X" in pattern:
        c = F.regexp_replace(c, r"\s+(?:[A-Z]{3,5}|[+-][0-9]{2,4})$(?<=[0-9] [A-Z]{3,5})", "") if "yyyy" not in pattern.split("X")[-1] else c
        c = F.regexp_replace(c, r"([+-][0-9]{4}|[+-][0-9]{2}:[0-9]{2}|Z) [A-Z]{2,5}$", "$1")
    # Java takes as many fraction digits as the pattern names, so they are filled up
    c = F.when(c.rlike(r":[0-9]{1,2}\.[0-9]+"), F.regexp_replace(F.regexp_replace(c, r"(:[0-9]{1,2}\.[0-9]+)", "$1000000000"), r"(:[0-9]{1,2}\.[0-9]{9})[0-9]*", "$1")).otherwise(c)
    t = F.try_to_timestamp(c, F.lit(pattern))
    return t if own_zone or zone == "UTC" else F.to_utc_timestamp(t, zone)


def try_formats(text: Column, fmt: str | None, zone: str = "UTC") -> Column:
    """The given format, then well-known ones, then digits as seconds since 1970."""
    clean = F.regexp_replace(text, ",", ".")
    known = [F.when(text.rlike(SHAPES[f]), parse(text, f, zone)) for f in CASCADE]
    return F.coalesce(*([parse(text, fmt, zone)] if fmt else []), *known, F.when(clean.rlike(r"^[0-9][0-9.]*\z"), epoch(clean)))


def moment(now: datetime | Column | None) -> Column:
    return F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def found(data: Column | str, field: str | None = None, fmt: str | None = None, zone: str = "UTC") -> Column:
    """struct<k, t>: the time field to remove and its time, null where it has none; itself null where nothing is found.

    A named field is used, and removed whatever it holds; strings, doubles (and digits) parse, other types don't.
    Otherwise the well-known names are tried in order, strings only, and the first that parses is taken. Only strings that are there are looked at.
    """
    data = col(data)
    if field:
        v = get(data, field)
        d = F.when(kind(v).rlike("^(DOUBLE|DECIMAL|FLOAT|BIGINT|INT)"), F.try_variant_get(v, "$", "decimal(28,9)"))
        number = F.timestamp_micros(F.floor(d * 1_000_000).cast("long"))
        long_digits = F.when(kind(v).rlike("^(BIGINT|INT)"), epoch(F.try_variant_get(v, "$", "string")))
        return F.struct(F.lit(field).alias("k"), F.coalesce(try_formats(string_of(v), fmt, zone), long_digits, number).alias("t"))
    names = F.array(*map(F.lit, FIELDS))
    there = F.filter(F.map_entries(data), lambda x: x["key"].isin(*FIELDS))
    texts = F.transform(there, lambda x: F.struct(F.array_position(names, x["key"]).alias("o"), x["key"].alias("k"), string_of(x["value"]).alias("s")))
    tried = F.transform(F.array_sort(F.filter(texts, lambda x: x["s"].isNotNull())), lambda x: F.struct(x["k"].alias("k"), try_formats(x["s"], fmt, zone).alias("t")))
    return F.try_element_at(F.filter(tried, lambda x: x["t"].isNotNull()), F.lit(1))


def resolve(df: DataFrame, field: str | None = None, fmt: str | None = None, zone: str = "UTC", now: datetime | Column | None = None, ts: str = "timestamp") -> DataFrame:
    """df (data, ...) with ``ts``, the time that found() finds or now, and data without its field."""
    # the struct is a column of its own, so that it is made once for each row, not once for each key of data
    hit = df.withColumn("_hit", found("data", field, fmt, zone))
    rest = F.map_filter("data", lambda k, _: F.coalesce(k != F.col("_hit.k"), F.lit(True))).cast(DATA)
    return hit.withColumns({ts: F.coalesce(F.col("_hit.t"), moment(now)), "data": F.when(F.col("_hit.k").isNull(), F.col("data")).otherwise(rest)}).drop("_hit")


def rebase(ts: Column | str, base: Column, start: Column) -> Column:
    """start - (base - ts), to the microsecond."""
    return F.timestamp_micros(F.unix_micros(start) - (F.unix_micros(base) - F.unix_micros(col(ts))))
