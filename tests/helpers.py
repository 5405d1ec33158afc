import json
from datetime import UTC, datetime

from pyspark.sql import functions as F

from cinderlog.sources.text import from_lines

NOW = datetime(2010, 6, 21, 15, 4, 5, tzinfo=UTC)


def lines(spark, *text):
    return from_lines(spark, text, "f")


def events(df, order="line_no"):
    """[(time in microseconds or None, data as a dict)] in order."""
    rows = df.select(order, F.unix_micros("timestamp").alias("t"), F.to_json("data").alias("d"), "sample_rate").orderBy(order).collect()
    return [(r["t"], json.loads(r["d"])) for r in rows]


def data(df):
    return [d for _, d in events(df)]


def envelope(spark, *rows):
    """Events from dicts: their JSON numbers as doubles."""
    from cinderlog.sources.parsers.plain import json_object

    df = lines(spark, *map(json.dumps, rows))
    return df.select("source_file", "line_no", F.lit(NOW).cast("timestamp").alias("timestamp"), F.lit(1).alias("sample_rate"), json_object(F.col("line")).alias("data"))


def micros(*a):
    return int(datetime(*a, tzinfo=UTC).timestamp() * 1_000_000)
