"""Delivery statistics over responses (at TIMESTAMP, status INT, body STRING, err STRING, duration_ns BIGINT, event)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def response_stats(df: DataFrame, interval: int = 60) -> DataFrame:
    """One row per tumbling interval (seconds): count, lifetime_count, min, max and avg duration, and counts by status, body and error, last_event.

    The shortest duration passes over zeros, which stand for unset; the average is whole nanoseconds; bodies are trimmed.
    Responses are counted once, by interval, status, body and error; all else is made from these counts.
    """
    t = df.withColumn("w", F.floor(F.unix_seconds("at") / interval)).withColumn("body", F.nullif(F.trim("body"), F.lit(""))).withColumn("err", F.nullif(F.col("err"), F.lit("")))
    last = F.max(F.struct(F.col("at"), F.col("event")))
    per = t.groupBy("w", "status", "body", "err").agg(
        F.count("*").alias("n"), F.min(F.when(F.col("duration_ns") > 0, F.col("duration_ns"))).alias("low"), F.max("duration_ns").alias("high"), F.sum("duration_ns").alias("total"), last.alias("last"),
    )
    kinds = F.array(*(F.struct(F.lit(by).alias("by"), F.col(by).cast("string").alias("key")) for by in ("status", "body", "err")))
    # a row for each interval and value; the interval's own row has no kind
    per = per.withColumn("x", F.explode(F.concat(F.array(F.struct(F.lit("").alias("by"), F.lit("").alias("key"))), kinds))).where("x.key is not null")
    per = per.groupBy("w", "x").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.max("last").alias("last"))
    own = lambda c: F.max(F.when(F.col("x.by") == "", F.col(c)))
    tally = lambda by: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("x.by") == by, F.struct(F.col("x.key").alias("key"), F.col("n").alias("value"))))))
    full = lambda by: F.when(F.max((F.col("x.by") == by).cast("int")) > 0, tally(by))
    out = per.groupBy("w").agg(
        own("n").alias("count"), F.coalesce(own("low"), F.lit(0)).alias("min_ns"), own("high").alias("max_ns"), F.floor(own("total") / own("n")).alias("avg_ns"), own("last")["event"].alias("last_event"),
        *(full(by).alias(f"by_{by}") for by in ("status", "body", "err")),
    )
    return out.withColumn("lifetime_count", F.sum("count").over(Window.orderBy("w")))  # a row per interval, not per response


def lifetime_stats(df: DataFrame) -> DataFrame:
    """Totals by status over all time."""
    return df.groupBy("status").agg(F.count("*").alias("count"))
