"""The whole plan: lines to outgoing events, in the fixed order of steps."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.compat import configure, trim_space
from ..functions.times import moment, rebase
from ..operators import sampling, transforms
from ..operators.grouping import last_lines
from ..operators.stats import response_stats
from ..sources.parsers import REGISTRY
from ..sources.parsers.database import mysql_host
from ..sources.parsers.plain import read_log_format
from ..sources.sinks import batch_url, outgoing, send
from ..sources.tail import TailSource
from ..sources.text import expand, prune, read_lines, read_lookup, read_ordered, read_stdin
from ..streaming.state import line_groups
from .options import Options, prepared

MULTI_LINE = ("mysql", "postgresql")
#: Parsers that take a zone and a fixed now.
ZONED = ("csv", "json", "keyval", "mongo", "mongodb", "mysql", "nginx", "regex")
PREFIXED = ("arangodb", "csv", "json", "keyval", "mongo", "mongodb", "nginx", "regex", "syslog")


def named_files(o: Options) -> list[str]:
    """The files to read; none is an error."""
    return prune(expand(o.files), o.filter_files, o.statefile)


def tail_options(o: Options) -> dict[str, str]:
    return {"path": ",".join(o.files), "filter": ",".join(o.filter_files), "read_from": o.read_from, "statefile": o.statefile, "hash_statefile_paths": str(o.hash_statefile_paths).lower()}


def scan(spark: SparkSession, o: Options, sample: bool = True) -> DataFrame:
    """The lines that the files hold now, from where reading starts, sampled here where the options allow it.

    From the beginning Spark's own readers read, in splits; from the end or the last saved position, the tail source.
    """
    if o.files == ["-"]:
        lines = read_stdin(spark)
    elif o.read_from in ("beginning", "start"):
        lines = (read_ordered if o.parser in (*MULTI_LINE, "mongo", "mongodb") else read_lines)(spark, named_files(o))
    else:
        named_files(o)
        spark.dataSource.register(TailSource)
        lines = spark.read.format("tail").options(**tail_options(o)).load()
    return sampled(lines, o) if sample else lines


def sampled(lines: DataFrame, o: Options) -> DataFrame:
    return sampling.random_sample(lines, o.samplerate, o.seed) if o.tail_sample and o.samplerate > 1 else lines


def parse(lines: DataFrame, o: Options, now: datetime | None = None, host: DataFrame | None = None) -> DataFrame:
    kw = dict(o.parser_options)
    if o.parser in PREFIXED and o.log_prefix:
        kw["prefix"] = o.log_prefix
    if o.parser in ZONED or o.parser == "syslog":
        kw |= {"zone": o.zone, "now": now}
    elif o.parser == "arangodb":
        kw["zone"] = o.zone
    if o.parser in MULTI_LINE and not o.deterministic_sampling and o.samplerate > 1:
        kw |= {"samplerate": o.samplerate, "seed": o.seed}
    if o.parser == "nginx" and "conf" in kw:  # the format by its name in a configuration
        conf, name = kw.pop("conf"), kw.pop("format", "combined")
        with open(conf, encoding="utf-8") as f:
            kw["log_format"] = read_log_format(f.read(), name)
    if o.parser == "mysql":
        server = {k: kw.pop(k, None) for k in ("host", "user", "pass", "interval", "driver")}
        host = host if host is not None else mysql_server(lines.sparkSession, server) if server["host"] else None
        kw["host"] = host
    return REGISTRY[o.parser](lines, **kw)


def mysql_server(spark: SparkSession, server: dict[str, str | None]) -> DataFrame:
    """The host context of a running server, asked over JDBC (its driver must be on the class path) as the plan runs."""
    base = {"url": f"jdbc:mysql://{server['host']}", "user": server["user"] or "", "password": server["pass"] or ""} | ({"driver": server["driver"]} if server["driver"] else {})
    ask = lambda sql: spark.read.format("jdbc").options(**base, query=sql).load()
    variables = ask("select variable_name as name, variable_value as value from performance_schema.global_variables where variable_name in ('basedir', 'read_only')")
    status = ask("select timestampdiff(second, min(last_applied_transaction_original_commit_timestamp), now()) as seconds_behind from performance_schema.replication_applier_status_by_worker having count(*) > 0")
    return mysql_host(variables, status)


def base_time(lines: DataFrame, o: Options, now: datetime | None = None) -> DataFrame:
    """One row, ``base``: the latest time among the last lines of the files (which are taken to be in order)."""
    last = last_lines(lines).withColumn("line_no", F.lit(0).cast("long"))
    return parse(last, o, now).agg(F.max("timestamp").alias("base"))


def modify(events: DataFrame, o: Options, base: DataFrame | None = None, start: datetime | None = None) -> DataFrame:
    """Shape, augment, drop, scrub, add, sample, rebase, unnest, rename: always in this order."""
    e = events
    if o.request_shape:
        e = transforms.request_shape(e, o.request_shape, o.shape_prefix, o.request_patterns, o.request_parse_query, o.request_query_keys)
    if o.da_map_file:
        e = transforms.augment(e, read_lookup(o.da_map_file))
    if o.drop_fields:
        e = transforms.drop_fields(e, o.drop_fields)
    if o.scrub_fields:
        e = transforms.scrub_fields(e, o.scrub_fields)
    if o.add_fields:
        e = transforms.add_fields(e, transforms.parse_pairs(o.add_fields, "add_fields"))
    if o.presampled:
        e = transforms.presampled(e, o.presampled)
    elif o.dynsampling:
        e = sampling.dynamic_sample(e, o.dynsampling, o.goal_samplerate, o.dynsample_window, o.dynsample_minimum, o.seed)
    elif o.deterministic_sampling:
        e = sampling.deterministic_sample(e, o.deterministic_sampling, o.samplerate, o.seed)
    else:
        e = sampling.fixed_rate(e, o.samplerate)
    if base is not None:
        e = e.crossJoin(F.broadcast(base)).withColumn("timestamp", rebase("timestamp", F.col("base"), moment(start))).drop("base")  # one row
    if o.json_fields:
        e = transforms.json_fields(e, o.json_fields)
    if o.rename_fields:
        e = transforms.rename_fields(e, list(transforms.parse_pairs(o.rename_fields, "rename_fields", True).items()))
    return e


def build(spark: SparkSession, o: Options, lines: DataFrame | None = None, now: datetime | None = None, host: DataFrame | None = None) -> DataFrame:
    """Lazily: (time, samplerate, data). Lines that are given are taken as they are; those of files are sampled first, but for the base of a rebase."""
    configure(spark)
    o = prepared(o)
    base = None
    if o.rebase_time:
        if lines is None and not any(os.path.exists(f) or "://" in f for f in named_files(o)):
            raise ValueError("no files to take the base time from")
        base = base_time(lines if lines is not None else scan(spark, replace(o, read_from="beginning"), sample=False), o, now)
    lines = lines if lines is not None else scan(spark, o)
    return outgoing(modify(parse(lines, o, now, host), o, base, now))


def follow(spark: SparkSession, o: Options, sink: Callable[[DataFrame], None], checkpoint: str, now: datetime | None = None) -> StreamingQuery:
    """Follows the files: each micro-batch of new lines goes through the plan to ``sink``, with the saved positions as starts.

    Groups of lines are put together across batches first. With ``stop`` the query ends with what is there now; formats of several lines refuse it,
    as a last group is only known to be whole by waiting, for which batches go on: build() reads these to their end. Adaptive rates start anew with each batch; rebasing needs build().
    """
    configure(spark)
    o = prepared(o)
    if o.rebase_time:
        raise ValueError("rebasing reads files to their end: use build()")
    if o.stop and o.parser in MULTI_LINE:
        raise ValueError(f"with stop, {o.parser} logs are read by build(), without a checkpoint: groups of lines wait for more, so that a stream of them does not end")
    spark.dataSource.register(TailSource)
    stream = spark.readStream.format("tail").options(**tail_options(o)).load()
    if o.parser in MULTI_LINE:
        stream = line_groups(stream.withColumn("line", trim_space("line")) if o.parser == "mysql" else stream, "slow_log" if o.parser == "mysql" else "tabs")

    def each(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        try:
            lines = batch
            if o.parser in MULTI_LINE:  # groups are told apart by where they begin
                place = F.concat_ws(":", "source_file", F.col("line_no").cast("string"))
                lines = batch.select(place.alias("source_file"), F.posexplode("lines").alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))
            sink(outgoing(modify(parse(sampled(lines, o), o, now), o)))
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if o.stop else writer).start()


def deliver(events: DataFrame, o: Options, headers: dict[str, str] | None = None, poster: Callable | None = None) -> DataFrame:
    """Outgoing rows posted to the options' dataset: a response for each, as an action runs."""
    e = events.select(F.col("time").alias("timestamp"), F.col("samplerate").alias("sample_rate"), "data")
    return send(e, batch_url(o.api_host, o.dataset), headers or ({"X-Write-Key": o.writekey} if o.writekey else {}), o.send_batch_size, o.backoff, poster=poster)


def status(responses: DataFrame, o: Options) -> DataFrame:
    """Delivery statistics for each status interval; 0 is none."""
    return response_stats(responses, o.status_interval) if o.status_interval > 0 else response_stats(responses.limit(0))
