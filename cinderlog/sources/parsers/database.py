"""Logs of database servers: slow queries of MySQL and PostgreSQL, ArangoDB requests, MongoDB operations."""

from __future__ import annotations

import json
import re
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import times
from ...functions.compat import doubles, get, keep, merge, record, to_double, to_long, trim_space, variant
from ...functions.sqltext import normalize_column
from ...operators.filters import strip_prefix
from ...operators.grouping import carry_forward, is_server_line, slow_log_groups, tab_groups
from ...operators.sampling import random_sample
from .mongo import parse_line
from .plain import finish

# --- ArangoDB


def parse_arangodb(lines: DataFrame, *, prefix: str | None = None, zone: str = "UTC") -> DataFrame:
    """ts [pid] LEVEL {requests} "x","id",...: DEBUG lines have six comma-separated fields, others ten; other topics go. Bad numbers are 0."""
    df = strip_prefix(lines.withColumn("line", trim_space("line")), prefix)
    head = r"^(\S+) \[([^\]\s]*)\] (\S+) (\{requests\}) ([\s\S]*)\z"
    df = df.where(F.col("line").rlike(head))
    g = lambda i: F.regexp_extract("line", head, i)
    debug = g(3) == "DEBUG"
    df = df.withColumn("_debug", debug).withColumn("_f", F.transform(F.split(g(5), ",", -1), lambda x: F.regexp_replace(x, '^"|"$', "")))
    df = df.where(F.size("_f") == F.when(F.col("_debug"), 6).otherwise(10))
    at = lambda i: F.try_element_at("_f", F.lit(i + 1))
    more = lambda c: F.when(~F.col("_debug"), c)
    whole = lambda i: more(F.coalesce(to_long(at(i)), F.lit(0)))
    fields = {
        "pid": g(2), "logLevel": g(3), "logTopic": g(4), "id": at(1), "sourceIP": at(2), "method": at(3), "protocol": at(4), "fullURL": F.when(F.col("_debug"), at(5)).otherwise(at(8)),
        "responseCode": whole(5), "reqBodyLen": whole(6), "resBodyLen": whole(7), "totalTime": more(F.coalesce(to_double(at(9)), F.lit(0.0))),
    }
    df = df.withColumn("_ts", F.coalesce(times.parse(g(1), "2006-01-02T15:04:05Z07:00", zone), times.parse(g(1), "2006-01-02T15:04:05", zone)))
    return finish(df, F.col("_ts"), merge(record({k: variant(c) for k, c in fields.items()}), F.col("prefix")))


# --- PostgreSQL

#: The default log_line_prefix and its specifiers (field, pattern).
PREFIX = "%t [%p-%l] %u@%d"
_TIME = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}[.0-9]* [A-Z]+"
SPECIFIERS = {
    "%a": ("application", r"\S+"), "%u": ("user", r"\S+"), "%d": ("database", r"\S+"), "%r": ("host_port", r"\S+"), "%h": ("host", r"\S+"), "%p": ("pid", r"\d+"),
    "%t": ("timestamp", _TIME), "%m": ("timestamp_millis", _TIME), "%n": ("timestamp_unix", r"\d+"), "%i": ("command_tag", r"\S+"), "%e": ("sql_state", r"\S+"), "%c": ("session_id", r"\d+"),
    "%l": ("session_line_number", r"\d+"), "%s": ("session_start", _TIME), "%v": ("virtual_transaction_id", r"\S+"), "%x": ("transaction_id", r"\S+"),
}


def slow_statement(rest: Column) -> dict[str, Column]:
    """What follows a line's prefix, cut at its first three colons: a level, the word duration, a time in ms with what was run, and the text.

    ``ok`` says whether these are what a slow query has: "LEVEL:  duration: N ms  statement: ..." or "... execute NAME: ...".
    """
    part = F.split(rest, ":", 4)
    at = lambda i: F.trim(F.coalesce(F.try_element_at(part, F.lit(i + 1)), F.lit("")))
    said = F.split(at(2), r"\s+")
    word = lambda i: F.coalesce(F.try_element_at(said, F.lit(i + 1)), F.lit(""))
    verb = (word(2) == "statement") & (F.size(said) == 3) | (word(2) == "execute") & (F.size(said) == 4)
    ok = (F.size(part) == 4) & at(0).rlike("^[A-Z][A-Z0-9]*$") & (at(1) == "duration") & word(0).rlike(r"^[0-9][0-9.]*$") & (word(1) == "ms") & verb
    return {"ok": F.coalesce(ok, F.lit(False)), "duration": word(0), "text": F.regexp_replace(F.try_element_at(part, F.lit(4)), "^ ", "")}


def comment_pairs(query: Column) -> Column:
    """Pairs key='value' (or "value") inside a query's comments, as a map; later ones win."""
    inside = F.array_join(F.regexp_extract_all(query, F.lit(r"(?s)/\*(.*?)\*/"), F.lit(1)), " ")
    pairs = F.regexp_extract_all(inside, F.lit(r"""[A-Za-z_]\w*=(?:'[^']+'|"[^"]+")"""), F.lit(0))
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.substring_index(x, "=", 1).alias("key"), F.regexp_extract(x, r"=.(.*).$", 1).alias("value"))))


def trace_ids(query: Column, pairs: Column | None = None) -> dict[str, Column]:
    """trace.trace_id and trace.parent_id of a query (pairs: its comment_pairs, where a column has them): both of the pairs of these names, else the middle parts of a traceparent (version-trace-parent-flags)."""
    pairs = comment_pairs(query) if pairs is None else pairs
    named = {k: get(pairs, k) for k in ("trace_id", "parent_id")}
    parts = F.split(get(pairs, "traceparent"), "-")
    edge = lambda i: F.try_element_at(parts, F.lit(i)).rlike("^[0-9]{2}$")
    whole = (F.size(parts) == 4) & edge(1) & edge(4)
    both = named["trace_id"].isNotNull() & named["parent_id"].isNotNull()
    return {f"trace.{k}": F.when(both, c).when(whole, F.try_element_at(parts, F.lit(2 + i))) for i, (k, c) in enumerate(named.items())}


def compile_line_prefix(fmt: str) -> tuple[str, list[str]]:
    """(regex from the line's start, names) of a log_line_prefix; %% is a percent sign, %q nothing."""
    fmt = fmt.replace("%%", "%").replace("%q", "")
    names, out = [], []
    for p in re.split(r"(%[a-z])", fmt):
        if p in SPECIFIERS:
            names.append(SPECIFIERS[p][0])
            out.append(f"({SPECIFIERS[p][1]})")
        else:
            out.append(re.escape(p))
    return "^" + "".join(out), names


def parse_postgresql(lines: DataFrame, *, log_line_prefix: str = PREFIX, samplerate: int = 1, seed: int | None = None) -> DataFrame:
    """Slow queries; tabs continue a statement. Times are UTC, null if the prefix has none. Sampling takes whole groups, not lines."""
    prefix, names = compile_line_prefix(log_line_prefix or PREFIX)
    groups = random_sample(tab_groups(lines), samplerate, seed)
    first = F.col("lines")[0]
    slow = slow_statement(F.regexp_replace(first, prefix, ""))
    df = groups.where(first.rlike(prefix) & slow["ok"])
    g = {n: F.regexp_extract(first, prefix, i) for i, n in enumerate(names, 1)}
    tail = F.transform(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))), lambda x: F.regexp_replace(x, r"^[ \t]+", ""))
    df = df.withColumn("query", F.regexp_replace(F.concat_ws(" ", F.concat(F.array(slow["text"]), tail)), r"[\s]+\z", "")).withColumn("_n", normalize_column(F.col("query")))
    numbers = ("pid", "session_id", "session_line_number")
    timestamps = [F.try_to_timestamp(F.regexp_replace(g[n], r" [A-Z]+$", "")) for n in ("timestamp", "timestamp_millis") if n in g]
    if "timestamp_unix" in g:
        timestamps.append(F.timestamp_millis(to_long(g["timestamp_unix"])))
    ts = F.coalesce(*timestamps) if timestamps else F.lit(None).cast("timestamp")
    duration = variant(to_double(slow["duration"]))
    fields = {n: F.coalesce(variant(to_long(c)), variant(c)) if n in numbers else variant(c) for n, c in g.items() if n not in ("timestamp", "timestamp_millis", "timestamp_unix")}
    fields |= {"duration": duration, "duration_ms": duration, "query": variant("query"), "normalized_query": variant(F.col("_n.query")), "tables": variant(F.col("_n.tables")), "comments": variant(F.col("_n.comments"))}
    df = df.withColumn("_pairs", comment_pairs(F.col("query"))).withColumn("_ts", ts)
    return finish(df, F.col("_ts"), record(fields | {k: variant(c) for k, c in trace_ids(F.col("query"), F.col("_pairs")).items()}))


# --- MySQL

#: Names in a slow log's comments ("# Name: value  Name: value") and the fields they give, by type.
DOUBLES = {"Query_time": "query_time", "Lock_time": "lock_time", "InnoDB_IO_r_wait": "IO_r_wait_sec", "InnoDB_rec_lock_wait": "rec_lock_wait_sec", "InnoDB_queue_wait": "queue_wait_sec"}
LONGS = {
    "Rows_sent": "rows_sent", "Rows_examined": "rows_examined", "Rows_affected": "rows_affected", "Bytes_sent": "bytes_sent", "Tmp_tables": "tmp_tables", "Tmp_disk_tables": "tmp_disk_tables",
    "Tmp_table_sizes": "tmp_table_sizes", "Merge_passes": "merge_passes", "InnoDB_IO_r_ops": "IO_r_ops", "InnoDB_IO_r_bytes": "IO_r_bytes", "InnoDB_pages_distinct": "pages_distinct",
}
BOOLS = {"QC_Hit": "query_cache_hit", "Full_scan": "full_scan", "Full_join": "full_join", "Tmp_table": "tmp_table", "Tmp_table_on_disk": "tmp_table_on_disk", "Filesort": "filesort", "Filesort_on_disk": "filesort_on_disk"}
TEXTS = {"InnoDB_trx_id": "transaction_id"}
STRINGS = ("user", "client", "database", "query", "normalized_query", "statement", "tables", "comments", "transaction_id")
#: Comments that begin with these drop a statement that has not ended.
BREAKS = ("User@Host:", "Query_time:", "Bytes_sent:")
_STATE = "struct<pending:string,query:string,used:boolean>"


def last_statement(lines: Column) -> Column:
    """struct<pending, query, used>: the last statement of a group that ends in a semicolon, or its last USE (used), without the semicolon."""

    def step(state: Column, line: Column) -> Column:
        joined = F.trim(F.concat_ws(" ", F.nullif(state["pending"], F.lit("")), line))
        ended = joined.endswith(";")
        bare = F.regexp_replace(joined, r"[;]+$", "")
        to = lambda pending, query, used: F.struct(pending.alias("pending"), query.alias("query"), used.alias("used")).cast(_STATE)
        none = F.lit("")
        return (
            F.when(line.startswith("# "), F.when(line.rlike(f"^# (?:{'|'.join(BREAKS)})"), to(none, state["query"], state["used"])).otherwise(state))
            .when(F.lower(F.substring(line, 1, 4)) == "use ", to(none, F.regexp_replace(line, r"[; ]+$", ""), F.lit(True)))
            .when(line.rlike("^SET timestamp=[0-9]+;$"), to(none, state["query"], state["used"]))
            .when(is_server_line(line), state)
            .when(ended, to(none, F.rtrim(bare), F.lit(False)))
            .otherwise(to(joined, state["query"], state["used"]))
        )

    start = F.struct(F.lit("").alias("pending"), F.lit(None).cast("string").alias("query"), F.lit(False).alias("used")).cast(_STATE)
    return F.aggregate(lines, start, step)


def mysql_fields(groups: DataFrame) -> DataFrame:
    """groups (lines, ...) without those that only ping, and ``f``: a struct of each group's fields, with the raw times iso, old and unix."""
    df = keep(groups, "_c", F.concat_ws("\n", F.filter("lines", lambda x: x.startswith("# "))), lambda c: ~c.rlike("(?m)^# administrator command: Ping; *$"))
    said = F.regexp_extract_all("_c", F.lit(r"(\w+): *([^\s#]+)"), F.lit(0))
    pairs = F.map_from_entries(F.transform(said, lambda x: F.struct(F.substring_index(x, ":", 1).alias("key"), F.regexp_extract(x, ": *(.*)$", 1).alias("value"))))
    df = keep(df.withColumn("_m", pairs), "_s", last_statement(F.col("lines")), lambda x: F.coalesce(x["query"], F.lit("")) != "")
    query, used = F.col("_s.query"), F.col("_s.used")
    df = df.withColumn("_n", normalize_column(F.when(~used, query)))
    last = lambda c, p, i=1: F.try_element_at(F.regexp_extract_all(c, F.lit(p), F.lit(i)), F.lit(-1))
    other = F.concat_ws("\n", "lines")
    who = last("_c", "(?m)^# User@Host: ([^#\\n]+ @ [^#\\n]+)$")
    fields = {f: to_double(get("_m", k)) for k, f in DOUBLES.items()} | {f: F.coalesce(to_long(get("_m", k)), F.floor(to_double(get("_m", k)))) for k, f in LONGS.items()}
    fields |= {f: get("_m", k) == "Yes" for k, f in BOOLS.items()} | {f: get("_m", k) for k, f in TEXTS.items()}
    fields |= {
        "user": F.regexp_extract(who, r"^([^\[@]*?)(?:\[[^@]*)? @ ", 1), "client": F.trim(F.regexp_replace(F.regexp_extract(who, "^[^@]* @ (.*)$", 1), r"\s+Id:.*$", "")),
        "database": F.regexp_replace(last(other, "(?m)^[uU][sS][eE] (.*)$"), r"[; ]+$", ""), "query": query, "normalized_query": F.when(used, query).otherwise(F.col("_n.query")),
        "statement": F.col("_n.statement"), "tables": F.col("_n.tables"), "comments": F.col("_n.comments"),
        "iso": last("_c", "(?m)^# Time: ([^ \\n]+)Z *$"), "old": last("_c", "(?m)^# Time: ([0-9]+ +[0-9:.]+)"), "unix": to_long(last(other, "(?m)^SET timestamp=([0-9]+);$")),
    }
    return df.withColumn("f", F.struct(*(c.alias(k) for k, c in fields.items()))).drop("_c", "_m", "_s", "_n")


def mysql_time(zone: str = "UTC", now: datetime | None = None) -> Column:
    """The comment's time; with SET timestamp its fraction is added to these seconds; either alone; else now."""
    comment = F.coalesce(times.parse(F.col("f.iso"), "2006-01-02T15:04:05", "UTC"), times.parse(F.col("f.old"), "010206 15:04:05", zone))
    base = F.timestamp_seconds(F.col("f.unix"))
    both = F.timestamp_micros(F.col("f.unix") * 1_000_000 + F.unix_micros(comment) % 1_000_000)
    return F.coalesce(both, base, comment, times.moment(now))


def parse_mysql(lines: DataFrame, *, samplerate: int = 1, host: DataFrame | None = None, zone: str = "UTC", now: datetime | None = None, seed: int | None = None) -> DataFrame:
    """Slow log. host: one row of hosted_on, role, read_only, replica_lag (see mysql_host), added to each event."""
    groups = random_sample(slow_log_groups(lines.withColumn("line", trim_space("line"))), samplerate, seed)
    df = mysql_fields(groups)
    fields = {n: variant(F.col(f"f.{n}")) for n in (*DOUBLES.values(), *LONGS.values(), *BOOLS.values(), *STRINGS)}
    if host is not None:
        names = [c for c in ("hosted_on", "role", "read_only", "replica_lag") if c in host.columns]
        df = df.crossJoin(F.broadcast(host.select(*(F.col(c).alias(f"_{c}") for c in names)).limit(1)))  # one row
        fields |= {c: variant(F.col(f"_{c}")) for c in names}
    return finish(df.withColumn("_ts", mysql_time(zone, now)), F.col("_ts"), record(fields))


def mysql_host(variables: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """One row of host context from SHOW VARIABLES (name, value) and SHOW REPLICA STATUS, read over JDBC: hosted_on is rds where
    basedir says so, replica_lag is null outside a replica, role is primary or secondary."""
    lag = F.lit(None).cast("long") if status is None or not status.columns else None
    one = variables.agg(
        F.when(F.max(F.when(F.col("name") == "basedir", F.lower("value"))).contains("rds"), "rds").alias("hosted_on"),
        (F.max(F.when(F.col("name") == "read_only", F.upper("value"))) == "ON").alias("read_only"),
    )
    if lag is not None:
        return one.withColumn("replica_lag", lag).withColumn("role", F.lit("primary"))
    name = next(c for c in status.columns if c.lower().startswith("seconds_behind"))
    got = status.agg(F.max(F.col(name).cast("long")).alias("replica_lag"), F.count("*").alias("n"))
    return one.crossJoin(got).withColumn("role", F.when(F.col("n") > 0, "secondary").otherwise("primary")).drop("n")  # one row each


# --- MongoDB


def parse_mongodb(lines: DataFrame, *, prefix: str | None = None, log_partials: bool = False, zone: str = "UTC", now: datetime | None = None) -> DataFrame:
    """Server logs from 2.4 to 3.6. replica_set comes from heartbeats and holds for all later lines of a file."""

    @F.pandas_udf("fields string, ts string, replica_set string, complete boolean")
    def run(s: pd.Series) -> pd.DataFrame:
        rows = []
        for x in s:
            fields, complete = parse_line(x)
            ts = fields.pop("timestamp", None)
            rows.append((json.dumps(fields) if fields else None, ts, fields.get("replica_set"), complete))
        return pd.DataFrame(rows, columns=["fields", "ts", "replica_set", "complete"])

    df = strip_prefix(lines.withColumn("line", trim_space("line")), prefix)
    df = keep(df.withColumn("_l", run("line")), "_p", F.col("_l"), lambda p: p["fields"].isNotNull() & (p["complete"] | F.lit(log_partials))).drop("_l")
    df = carry_forward(df, F.col("_p.replica_set"), "_rs")
    data = doubles(F.try_parse_json(F.col("_p.fields")).cast("map<string,variant>"), whole="_lock_held_us")
    raw, instant = F.col("_p.ts"), times.moment(now)
    iso = F.coalesce(times.parse(raw, "2006-01-02T15:04:05.000-0700", zone), times.parse(raw, "2006-01-02T15:04:05.000Z07:00", zone))
    year = lambda y: times.parse(F.concat_ws(" ", y.cast("string"), F.regexp_replace(raw, "^[A-Z][a-z]{2} ", "")), "2006 Jan _2 15:04:05.000", zone)
    this = year(F.year(instant))
    ctime = F.when(this < instant, this).otherwise(year(F.year(instant) - 1))
    df = df.withColumn("_ts", F.coalesce(iso, ctime, instant))
    rs = record({"replica_set": variant("_rs")})
    return finish(df, F.col("_ts"), merge(data, rs, F.col("prefix")))
