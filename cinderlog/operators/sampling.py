"""Samplers of lines, groups and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.compat import get, kind, string_of


#: Rows of a rate table that may be broadcast.
RATES = 200_000


def draw(seed: int | None, by: list[str]) -> Column:
    """A number in [0, 1) for each row: with a seed by a hash of the columns ``by``, so that reruns agree however rows are dealt; else at random."""
    if seed is None or not by:
        return F.rand() if seed is None else F.rand(seed)
    text = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def place_of(df: DataFrame) -> list[str]:
    """Columns that tell where a row came from."""
    return [c for c in ("source_file", "line_no") if c in df.columns]


def random_sample(df: DataFrame, rate: int, seed: int | None = None, by: list[str] | None = None) -> DataFrame:
    """Keeps about one row in ``rate``. Place it before parsing. With a seed the draw is a hash of ``by`` (by default source_file and line_no)."""
    return df if rate <= 1 else df.where(draw(seed, by or place_of(df)) < 1 / rate)


def keeps(key: Column, rate: int) -> Column:
    """Whether a deterministic sampler of this rate keeps a key: the first four bytes of its SHA-1 are in the lowest 1/rate of their range."""
    if rate < 1:
        raise ValueError("sample rate must be at least 1")
    return F.conv(F.substring(F.sha1(key), 1, 8), 16, 10).cast("long") <= F.lit(0xFFFFFFFF // rate)


def deterministic_sample(df: DataFrame, field: str, rate: int, seed: int | None = None) -> DataFrame:
    """Events whose key is kept weigh ``rate``, others -1; events without a string key are sampled at random."""
    key = string_of(get("data", field))
    keep = F.when(key.isNotNull(), keeps(key, rate)).otherwise(draw(seed, place_of(df)) < 1 / rate)
    return df.withColumn("sample_rate", F.when(keep, rate).otherwise(-1))


def fixed_rate(df: DataFrame, rate: int) -> DataFrame:
    return df.withColumn("sample_rate", F.lit(rate))


def key_of(fields: list[str]) -> Column:
    """An event's sampling key: its values as text, joined by "_"; absent ones and nested ones are empty."""
    def part(f: str) -> Column:
        v = get("data", f)
        k = kind(v)
        number = F.when(k.rlike("^(DOUBLE|FLOAT|DECIMAL)"), F.upper(F.regexp_replace(F.format_string("%.0e", F.try_variant_get(v, "$", "double")), r"e\+?", "E+")))
        return F.coalesce(string_of(v), F.when(k.rlike("^(BIGINT|INT|SMALLINT|TINYINT|BOOLEAN)"), F.try_variant_get(v, "$", "string")), number, F.lit(""))

    return F.concat_ws("_", *(part(f) for f in fields))


def window_counts(df: DataFrame, key: Column, seconds: int, ts: str = "timestamp") -> DataFrame:
    """(w, key, n): events per key and tumbling window, w in windows since 1970."""
    w = F.floor(F.unix_micros(F.col(ts)) / (seconds * 1_000_000))
    return df.groupBy(w.alias("w"), key.alias("key")).agg(F.count("*").alias("n"))


def dynamic_rates(counts: DataFrame, goal: int, seconds: int, minimum: float = 1.0) -> DataFrame:
    """counts (w, key, n): (w, key, rate) that holds in window w, from the counts of the one before.

    The window's goal, its events over ``goal``, is dealt to keys in proportion to log10 of their counts; a key's
    rate is its count over its share, one at least. Below ``minimum`` events a second nothing is sampled.
    """
    share = F.log10(F.col("n").cast("double"))
    totals = counts.groupBy("w").agg(F.sum("n").alias("total"), F.sum(F.round(share, 9)).alias("logs"))
    j = counts.join(totals, "w")
    per = F.col("total") / F.lit(float(goal)) / F.col("logs")
    allotted = F.greatest(F.lit(1.0), F.ceil(share * per))
    quiet = (F.col("total") / F.lit(float(seconds)) < minimum) | (F.col("logs") == 0)
    rate = F.when(quiet, 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("n") / allotted)))
    return j.select((F.col("w") + 1).alias("w"), "key", rate.cast("int").alias("rate"))


def dynamic_sample(df: DataFrame, fields: list[str], goal: int, seconds: int = 30, minimum: float = 1.0, seed: int | None = None) -> DataFrame:
    """Adaptive sampling by the key's rate from the window before; keys not seen there, and all in the first window, have rate 1. Kept events weigh the rate, others -1.

    Only rates above 1 are joined (a row for each key and window), by broadcast if they are few; otherwise by shuffle, and adaptive execution splits hot keys.
    """
    base = df.withColumn("_key", key_of(fields)).withColumn("_w", F.floor(F.unix_micros(F.col("timestamp")) / (seconds * 1_000_000)))
    rates = dynamic_rates(window_counts(base, F.col("_key"), seconds), goal, seconds, minimum).where("rate > 1").withColumnRenamed("w", "_w").withColumnRenamed("key", "_key")
    rates = F.broadcast(rates) if rates.limit(RATES + 1).count() <= RATES else rates
    j = base.join(rates, ["_w", "_key"], "left").withColumn("rate", F.coalesce("rate", F.lit(1)))
    out = j.withColumn("sample_rate", F.when(draw(seed, place_of(df)) < 1 / F.col("rate"), F.col("rate")).otherwise(-1))
    return out.select(*df.columns, *(["sample_rate"] if "sample_rate" not in df.columns else []))
