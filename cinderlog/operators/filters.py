"""Line filters and prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.compat import DATA, no_data, record, string_of, trim_space, variant
from ..functions.regexes import Pattern, group, matched, translate


def line_filter(df: DataFrame, pattern: str, invert: bool = False) -> DataFrame:
    """Keeps lines that match (invert: that don't), by their trimmed text and before any prefix is cut."""
    hit = matched(trim_space("line"), translate(pattern))
    return df.where(~hit if invert else hit)


def strip_prefix(df: DataFrame, pattern: str | None) -> DataFrame:
    """Adds ``prefix`` (data map of its named groups, null without a match); a match at the line's start is cut off."""
    if not pattern:
        return df.withColumn("prefix", F.lit(None).cast(DATA))
    p: Pattern = translate(pattern)
    line = F.col("line")
    fields = record({n: variant(group(line, p, i)) for n, i in p.named().items()}) if p.named() else no_data()
    whole = group(line, p, 0)
    rest = F.when(line.startswith(whole), F.expr("substr(line, length(_w) + 1)")).otherwise(line)
    df = df.withColumn("prefix", F.when(matched(line, p), fields)).withColumn("_w", whole)
    return df.withColumn("line", F.when(F.col("prefix").isNotNull(), rest).otherwise(line)).drop("_w")


def allow_processes(df: DataFrame, processes: list[str] | None) -> DataFrame:
    """Keeps events of these processes, and those without one."""
    if not processes:
        return df
    name = string_of(F.try_element_at("data", F.lit("process")))
    return df.where(name.isNull() | name.isin(*processes))


def any_value(data: Column | str) -> Column:
    """Whether any value is other than an empty string."""
    return F.exists(F.map_values(data), lambda v: ~F.coalesce(string_of(v) == "", F.lit(False)))
