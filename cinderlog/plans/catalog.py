"""Queries over the driver's tables, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times, urls
from ..functions.compat import configure, get, record, string_of, text_of, variant
from ..functions.sqltext import normalize_column, scan_column
from ..operators import filters, grouping, sampling, stats, transforms
from ..sources import parsers
from ..sources.parsers.mongo import shape_column
from ..sources.sinks import as_json, outgoing
from ..sources.text import numbered
from .options import Options
from .pipeline import build

Query = Callable[[SparkSession, str], DataFrame]
NOW = datetime(2024, 6, 1, tzinfo=UTC)
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def wrap(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(configure(spark), sf_dir)
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(df: DataFrame, line: Column, order: str, source: Column | None = None) -> DataFrame:
    return df.select((source if source is not None else F.lit("t")).alias("source_file"), F.col(order).cast("long").alias("line_no"), line.alias("line"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in the envelope: user_id, kind, value and props (JSON text) as data."""
    e = table(spark, sf_dir, "events")
    data = record({"user": variant(F.concat(F.lit("u"), F.col("user_id").cast("string"))), "kind": variant("event_type"), "value": variant("value"), "props": variant("props")})
    return e.select(F.lit("events").alias("source_file"), F.col("event_id").alias("line_no"), F.col("ts").cast("timestamp").alias("timestamp"), F.lit(1).alias("sample_rate"), data.alias("data"))


def s(c: str) -> Column:
    return F.try_variant_get(get("data", c), "$", "string")


# --- samplers

_KEEP = "cast('0x' || substr(sha1('u' || user_id), 1, 8) as bigint) <= 4294967295 // {n}"


@query(f"select event_id, case when {_KEEP.format(n=4)} then 4 else -1 end::int as sample_rate from events")
def deterministic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.deterministic_sample(_events(spark, sf_dir), "user", 4).select(F.col("line_no").alias("event_id"), "sample_rate")


@query(f"select event_id, 'u' || user_id as user_key from events where {_KEEP.format(n=3)}")
def drop_unsampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.drop_unsampled(sampling.deterministic_sample(_events(spark, sf_dir), "user", 3)).select(F.col("line_no").alias("event_id"), s("user").alias("user_key"))


_DRAW = "(('0x' || substr(md5({text}), 1, 8))::bigint)::double / 4294967296.0::double"


@query(f"select l_orderkey, l_linenumber from lineitem where {_DRAW.format(text="l_orderkey || ':' || l_linenumber || ':7'")} < 0.1::double")
def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_sample(table(spark, sf_dir, "lineitem"), 10, 7, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


@query("select time_bucket(interval 30 seconds, ts)::timestamp as w_start, event_type as key, count(*) as n from events group by all")
def key_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = sampling.window_counts(_events(spark, sf_dir), s("kind"), 30)
    return c.select(F.timestamp_seconds(F.col("w") * 30).cast("timestamp_ntz").alias("w_start"), "key", "n")


_RATES = """
with counts as (select floor(epoch_us(ts) / 3600e6)::bigint as w, event_type || '_' || (user_id % 7) as key, count(*) as n from events group by all),
totals as (select w, sum(n) as total, sum(round(log10(n::double), 9)) as logs from counts group by w)
select w + 1 as w, key, (case when total / 3600.0::double < {least} or logs = 0 then 1 else greatest(1, ceil(n / greatest(1.0::double, ceil(log10(n::double) * (total / 4.0::double / logs))))) end)::int as rate from counts join totals using (w)"""


@query(_RATES.format(least="0.001"))
def dynamic_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("timestamp", F.col("ts").cast("timestamp"))
    key = F.concat_ws("_", "event_type", (F.col("user_id") % 7).cast("string"))
    return sampling.dynamic_rates(sampling.window_counts(e, key, 3600), 4, 3600, 0.001)


@query(f"""
with e as (select event_id, floor(epoch_us(ts) / 3600e6)::bigint as w, event_type as key from events),
counts as (select w, key, count(*) as n from e group by all),
totals as (select w, sum(n) as total, sum(round(log10(n::double), 9)) as logs from counts group by w),
rates as (select w + 1 as w, key, (case when total / 3600.0::double < 0.001 or logs = 0 then 1 else greatest(1, ceil(n / greatest(1.0::double, ceil(log10(n::double) * (total / 4.0::double / logs))))) end)::int as rate from counts join totals using (w))
select event_id, case when {_DRAW.format(text="'events:' || event_id || ':3'")} < 1 / coalesce(rate, 1)::double then coalesce(rate, 1) else -1 end::int as sample_rate from e left join rates using (w, key)""")
def dynamic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.dynamic_sample(_events(spark, sf_dir), ["kind"], 4, 3600, 0.001, seed=3).select(F.col("line_no").alias("event_id"), "sample_rate")


@query("select event_id, case when value::int <> 0 then value::int else 1 end as sample_rate from (select event_id, trunc(value) as value from events)")
def presampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.presampled(_events(spark, sf_dir), "value").select(F.col("line_no").alias("event_id"), "sample_rate")


@query("select event_id, 5::int as sample_rate from events")
def fixed_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.fixed_rate(_events(spark, sf_dir), 5).select(F.col("line_no").alias("event_id"), "sample_rate")


# --- transforms


@query("select event_id, sha256('u' || user_id) as user_hash from events")
def scrub_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.scrub_fields(_events(spark, sf_dir), ["user"]).select(F.col("line_no").alias("event_id"), s("user").alias("user_hash"))


@query("select event_id, (props->>'k')::bigint as k from events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = transforms.json_fields(_events(spark, sf_dir), ["props", "kind"])
    return e.select(F.col("line_no").alias("event_id"), F.try_variant_get(get("data", "props"), "$.k", "long").alias("k"))


@query("select event_id, 'east' as region, event_type as type, false as has_value, list_sort(['props', 'region', 'type', 'user'])::varchar as keys from events")
def drop_add_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = transforms.drop_fields(_events(spark, sf_dir), ["value"])
    e = transforms.rename_fields(transforms.add_fields(e, {"region": "east"}), [("kind", "type"), ("absent", "x")])
    keys = F.concat(F.lit("["), F.array_join(F.array_sort(F.map_keys("data")), ", "), F.lit("]"))
    return e.select(F.col("line_no").alias("event_id"), s("region").alias("region"), s("type").alias("type"), F.map_contains_key("data", F.lit("value")).alias("has_value"), keys.alias("keys"))


@query("select o_orderkey, c_name, c_mktsegment, n_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey")
def lookup_augment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders take their customer's fields, and these its nation's, from lookups joined by equality."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    e = o.select(F.col("o_orderkey").alias("line_no"), record({"cust": variant(F.col("o_custkey").cast("string"))}).alias("data"))
    by_cust = c.select(F.lit("cust").alias("src_field"), F.col("c_custkey").cast("string").alias("val"), record({"c_name": variant("c_name"), "c_mktsegment": variant("c_mktsegment"), "nation": variant(F.col("c_nationkey").cast("string"))}).alias("add"))
    by_nation = n.select(F.lit("nation").alias("src_field"), F.col("n_nationkey").cast("string").alias("val"), record({"n_name": variant("n_name")}).alias("add"))
    e = transforms.augment(transforms.augment(e, by_cust, ["cust"]), by_nation, ["nation"])
    return e.select(F.col("line_no").alias("o_orderkey"), s("c_name").alias("c_name"), s("c_mktsegment").alias("c_mktsegment"), s("n_name").alias("n_name"))


@query("select event_id, event_type as kind, {'click': 'pointer', 'view': 'pointer', 'purchase': 'money'}[event_type] as family from events")
def lookup_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    families = {"kind": {"click": {"family": "pointer"}, "view": {"family": "pointer"}, "purchase": {"family": "money"}}}
    return transforms.augment(_events(spark, sf_dir), families).select(F.col("line_no").alias("event_id"), s("kind").alias("kind"), s("family").alias("family"))


ORACLES["lookup_file"] = "select event_id, event_type as kind, case event_type when 'click' then 'pointer' when 'view' then 'pointer' when 'purchase' then 'money' end as family from events"

_URL = "regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '')"


@query(f"select page_id, split_part({_URL}, '?', 1) as path, nullif(regexp_extract({_URL}, '[?](.*)$', 1), '') as query from pages")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    u = urls.shape(F.col("url"))
    return p.select("page_id", u["path"].alias("path"), u["query"].alias("query"))


@query(f"""
with q as (select page_id, split_part({_URL}, '?', 1) as path, nullif(regexp_extract({_URL}, '[?](.*)$', 1), '') as query from pages),
k as (select *, nullif(array_to_string(list_sort(list_transform(list_filter(string_split(coalesce(query, ''), '&'), lambda x: x <> ''), lambda x: split_part(x, '=', 1) || '=?')), '&'), '') as queryshape from q)
select page_id, queryshape, path || coalesce('?' || queryshape, '') as shape from k""")
def query_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    u = urls.shape(F.col("url"))
    return p.select("page_id", u["queryshape"].alias("queryshape"), u["shape"].alias("shape"))


@query(f"""
with q as (select page_id, split_part({_URL}, '?', 1) as path from pages)
select page_id, 'GET' as method, 'HTTP/1.1' as version, path, regexp_extract(path, '^/([^/]+)', 1) as first,
  case when regexp_full_match(path, '/[^/]+/[^/]+') then '/:top/:leaf' when regexp_full_match(path, '/[^/]+') then '/:top' else path end as pathshape from q""")
def request_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    e = p.select(F.col("page_id").alias("line_no"), record({"request": variant(F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1")))}).alias("data"))
    e = transforms.request_shape(e, ["request"], patterns=["/:top/:leaf", "/:top"], parse_query="all")
    return e.select(F.col("line_no").alias("page_id"), *(s(f"request_{k}").alias(a) for k, a in (("method", "method"), ("protocol_version", "version"), ("path", "path"))), F.regexp_extract(s("request_path"), "^/([^/]+)", 1).alias("first"), s("request_pathshape").alias("pathshape"))


# --- time


@query("select event_id, epoch_us(ts) - (select max(epoch_us(ts)) from events) + 1717200000000000 as us from events")
def rebase_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    base = e.agg(F.max("timestamp").alias("base"))
    return e.crossJoin(F.broadcast(base)).select(F.col("line_no").alias("event_id"), F.unix_micros(times.rebase("timestamp", F.col("base"), F.lit(NOW).cast("timestamp"))).alias("us"))  # one row


_FORMATS = ("%Y-%m-%d %H:%M:%S.%f", "%d/%b/%Y:%H:%M:%S %z", "%s(%L)?", "2006-01-02T15:04:05Z07:00")


@query("select event_id, epoch_us(ts) as us from events")
def resolve_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's time written in one of four formats, and read again."""
    e = table(spark, sf_dir, "events")
    t = F.col("ts").cast("timestamp")
    us = F.lpad((F.unix_micros(t) % 1_000_000).cast("string"), 6, "0")
    seconds = F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    forms = (F.concat(seconds, F.lit(","), us), F.concat(F.date_format(t, "dd/MMM/yyyy:HH:mm:ss"), F.lit("."), us, F.lit(" +0000")), F.concat(F.unix_seconds(t).cast("string"), F.lit("."), us), F.concat(F.translate(seconds, " ", "T"), F.lit("."), us, F.lit("Z")))
    which = F.col("event_id") % 4
    out = None
    for i, (form, fmt) in enumerate(zip(forms, _FORMATS, strict=True)):
        got = times.parse(form, fmt)
        out = F.when(which == i, got) if out is None else out.when(which == i, got)
    return e.select("event_id", F.unix_micros(out).alias("us"))


# --- groups and order


@query("""
with b as (select conv_id, turn, case when role = 'user' then 1 else 0 end as starts from conversations)
select conv_id, turn, (sum(starts) over (partition by conv_id order by turn))::bigint as group_id from b""")
def line_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return grouping.islands(c, F.col("role") == "user", by="conv_id", order="turn").select("conv_id", "turn", F.col("group_id").cast("long").alias("group_id"))


@query("select user_id, event_id, coalesce(last_value(case when event_type = 'purchase' then event_id end ignore nulls) over (partition by user_id order by event_id), -1) as last_purchase from events")
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return grouping.carry_forward(e, F.when(F.col("event_type") == "purchase", F.col("event_id")), "last_purchase", by="user_id", order="event_id").select("user_id", "event_id", F.coalesce("last_purchase", F.lit(-1).cast("long")).alias("last_purchase"))


@query("select o_custkey::varchar as source_file, arg_max(o_orderstatus || ' ' || o_totalprice, o_orderkey) as line from orders group by o_custkey")
def last_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return grouping.last_lines(_lines(o, F.concat_ws(" ", "o_orderstatus", F.col("o_totalprice").cast("string")), "o_orderkey", F.col("o_custkey").cast("string")))


# --- statistics


@query("""
select floor(epoch(o_orderdate) / 86400 / 30)::bigint as w, count(*) as count, min(case when o_custkey > 0 then o_custkey end) as min_ns, max(o_custkey) as max_ns, floor(sum(o_custkey) / count(*))::bigint as avg_ns,
  (count(*) filter (where o_orderstatus = 'F')) as finished, sum(count(*)) over (order by floor(epoch(o_orderdate) / 86400 / 30)::bigint)::bigint as lifetime_count, arg_max(o_orderkey::varchar, (o_orderdate, o_orderkey::varchar)) as last_event from orders group by floor(epoch(o_orderdate) / 86400 / 30)::bigint""")
def response_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand in for responses."""
    o = table(spark, sf_dir, "orders")
    r = o.select(F.col("o_orderdate").cast("timestamp").alias("at"), F.when(F.col("o_orderstatus") == "F", 200).otherwise(429).alias("status"), F.col("o_orderpriority").alias("body"), F.lit("").alias("err"), F.col("o_custkey").alias("duration_ns"), F.col("o_orderkey").cast("string").alias("event"))
    out = stats.response_stats(r, 86400 * 30)
    return out.select("w", "count", "min_ns", "max_ns", "avg_ns", F.coalesce(F.col("by_status")["200"], F.lit(0)).alias("finished"), "lifetime_count", "last_event")


@query("select case o_orderstatus when 'F' then 200 else 429 end::int as status, count(*) as count from orders group by 1")
def lifetime_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return stats.lifetime_stats(o.select(F.when(F.col("o_orderstatus") == "F", 200).otherwise(429).alias("status")))


# --- lines and prefixes


@query("select p_partkey, p_name from part where regexp_matches(p_name, '[aeiou]{2}')")
def line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(table(spark, sf_dir, "part"), F.col("p_name"), "p_partkey")
    return filters.line_filter(lines, "[aeiou]{2}").select(F.col("line_no").alias("p_partkey"), F.col("line").alias("p_name"))


@query("select p_partkey, p_brand as brand, p_size::varchar as size, p_name as line from part")
def prefix_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(table(spark, sf_dir, "part"), F.concat(F.col("p_brand"), F.lit(" ["), F.col("p_size").cast("string"), F.lit("]: "), F.col("p_name")), "p_partkey")
    got = filters.strip_prefix(lines, r"^(?P<brand>\S+) \[(?P<size_of>[[:digit:]]+)\]: ")
    return got.select(F.col("line_no").alias("p_partkey"), string_of(F.col("prefix")["brand"]).alias("brand"), string_of(F.col("prefix")["size_of"]).alias("size"), "line")


@query("""
select doc_id, line_no, coalesce(nullif(regexp_extract(line, '^(\\w)\\w* (\\w+)', 1), ''), nullif(regexp_extract(line, '(\\w+)', 1), '')) as first
from (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as line_no from documents) where regexp_matches(line, '\\w')""")
def first_match_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document."""
    d = table(spark, sf_dir, "documents")
    lines = d.select(F.col("doc_id").cast("string").alias("source_file"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))
    return _first_match(lines).select(F.col("source_file").cast("long").alias("doc_id"), "line_no", s("first").alias("first"))


def _first_match(lines: DataFrame) -> DataFrame:
    return parsers.parse_regex(lines, patterns=[r"^(?P<first>\w)\w* (?P<second>\w+)", r"(?P<first>\w+)"], now=NOW)


# --- parsers: lines made from table columns, read back


@query("select event_id, event_type, user_id::double as user_id, epoch_us(ts) as us from events")
def parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_type", "user_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time")))
    got = parsers.parse_json(_lines(e, line, "event_id"), now=NOW)
    return got.select(F.col("line_no").alias("event_id"), s("event_type").alias("event_type"), F.try_variant_get(get("data", "user_id"), "$", "double").alias("user_id"), F.unix_micros("timestamp").alias("us"))


@query("select p_partkey, p_name, p_size::bigint as p_size, p_retailprice, (p_size = 1) as flag from part")
def parse_keyval(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    line = F.concat(F.lit('name="'), F.col("p_name"), F.lit('" size=0'), F.col("p_size").cast("string"), F.lit(" price="), F.format_string("%.2f", "p_retailprice"), F.lit(" flag="), F.when(F.col("p_size") == 1, "t").otherwise("F"))
    d = parsers.parse_keyval(_lines(p, line, "p_partkey"), now=NOW)
    return d.select(F.col("line_no").alias("p_partkey"), s("name").alias("p_name"), F.try_variant_get(get("data", "size"), "$", "long").alias("p_size"), F.try_variant_get(get("data", "price"), "$", "double").alias("p_retailprice"), F.try_variant_get(get("data", "flag"), "$", "boolean").alias("flag"))


@query("select l_orderkey, l_linenumber::bigint as l_linenumber, l_quantity, l_returnflag, l_shipdate from lineitem")
def parse_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    line = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.format_string("%.3f", "l_quantity"), F.concat(F.lit('"'), F.col("l_returnflag"), F.lit('"')), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    d = parsers.parse_csv(_lines(li, line, "l_orderkey"), fields="order,n,quantity,flag,time", timefield="time", fmt="%Y-%m-%d %H:%M:%S", now=NOW)
    v = lambda k, t: F.try_variant_get(get("data", k), "$", t)
    return d.select(v("order", "long").alias("l_orderkey"), v("n", "long").alias("l_linenumber"), v("quantity", "double").alias("l_quantity"), s("flag").alias("l_returnflag"), F.col("timestamp").cast("timestamp_ntz").alias("l_shipdate"))


@query("select page_id, '10.0.0.' || (page_id % 200) as remote_addr, 200 + page_id % 7 as status, url, strlen(html)::bigint as bytes, epoch_us(timestamp '2024-01-01') + page_id * 1000000 as us from pages")
def parse_nginx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _access_log(table(spark, sf_dir, "pages"), F.col("url"))


def _access_log(p: DataFrame, url: Column) -> DataFrame:
    t = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("page_id")), "dd/MMM/yyyy:HH:mm:ss +0000")
    line = F.concat(F.lit("10.0.0."), (F.col("page_id") % 200).cast("string"), F.lit(" - - ["), t, F.lit('] "'), url, F.lit('" '), (200 + F.col("page_id") % 7).cast("string"), F.lit(" "), F.octet_length("html").cast("string"))
    d = parsers.parse_nginx(_lines(p, line, "page_id"), log_format='$remote_addr - $remote_user [$time_local] "$request" $status $bytes', now=NOW)
    v = lambda k: F.try_variant_get(get("data", k), "$", "long")
    return d.select(F.col("line_no").alias("page_id"), s("remote_addr").alias("remote_addr"), v("status").alias("status"), s("request").alias("url"), v("bytes").alias("bytes"), F.unix_micros("timestamp").alias("us"))


@query("select c_custkey, c_custkey % 192 as priority, c_custkey % 192 // 8 as facility, c_custkey % 8 as severity, lower(c_mktsegment) as process, c_name as content from customer")
def parse_syslog(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    line = F.concat(F.lit("<"), (F.col("c_custkey") % 192).cast("string"), F.lit(">Oct 11 22:14:15 host "), F.lower("c_mktsegment"), F.lit(": "), F.col("c_name"))
    d = parsers.parse_syslog(_lines(c, line, "c_custkey"), mode="rfc3164", year=2024)
    v = lambda k: F.try_variant_get(get("data", k), "$", "long").alias(k)
    return d.select(F.col("line_no").alias("c_custkey"), v("priority"), v("facility"), v("severity"), s("process").alias("process"), s("content").alias("content"))


@query("select c_custkey, c_custkey % 192 // 8 as facility, c_custkey % 8 as severity, 1::bigint as version, 'app' || c_nationkey as process, 'M' || c_custkey as msg_id, '[x@1 k=\"' || c_custkey || '\"]' as structured, c_name as message, epoch_us(timestamp '2024-03-01') + c_custkey * 1000 as us from customer")
def parse_syslog_rfc5424(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    at = F.date_format(F.timestamp_millis(F.lit(1709251200000) + F.col("c_custkey")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    line = F.concat(F.lit("<"), (F.col("c_custkey") % 192).cast("string"), F.lit(">1 "), at, F.lit(" host app"), F.col("c_nationkey").cast("string"), F.lit(" - M"), key, F.lit(' [x@1 k="'), key, F.lit('"] '), F.col("c_name"))
    d = parsers.parse_syslog(_lines(c, line, "c_custkey"), mode="rfc5424")
    v = lambda k: F.try_variant_get(get("data", k), "$", "long").alias(k)
    return d.select(F.col("line_no").alias("c_custkey"), v("facility"), v("severity"), v("version"), s("process").alias("process"), s("msg_id").alias("msg_id"), s("structured_data").alias("structured"), s("message").alias("message"), F.unix_micros("timestamp").alias("us"))


@query("select o_orderkey, 'DEBUG' as level, 'p' || o_custkey as pid, 'id' || o_orderkey as id, '/o/' || o_orderstatus as url, epoch_us(o_orderdate) as us from orders")
def parse_arangodb_debug(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    line = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(" [p"), F.col("o_custkey").cast("string"), F.lit('] DEBUG {requests} "begin","id'), F.col("o_orderkey").cast("string"), F.lit('","10.1.1.1","PUT","HTTP/1.1",/o/'), F.col("o_orderstatus"))
    d = parsers.parse_arangodb(_lines(o, line, "o_orderkey"))
    return d.select(F.col("line_no").alias("o_orderkey"), s("logLevel").alias("level"), s("pid").alias("pid"), s("id").alias("id"), s("fullURL").alias("url"), F.unix_micros("timestamp").alias("us"))


@query("select o_orderkey, 'c' || o_custkey as id, 200 + o_orderkey % 5 as code, round(o_totalprice / 1000, 5) as total_time, epoch_us(o_orderdate) as us from orders")
def parse_arangodb(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    line = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(' [1] INFO {requests} "end","c'), F.col("o_custkey").cast("string"), F.lit('","127.0.0.1","GET","HTTP/1.1",'), (200 + F.col("o_orderkey") % 5).cast("string"), F.lit(',0,64,"/x",'), F.round(F.col("o_totalprice") / 1000, 5).cast("decimal(20,5)").cast("string"))
    d = parsers.parse_arangodb(_lines(o, line, "o_orderkey"))
    return d.select(F.col("line_no").alias("o_orderkey"), s("id").alias("id"), F.try_variant_get(get("data", "responseCode"), "$", "long").alias("code"), F.try_variant_get(get("data", "totalTime"), "$", "double").alias("total_time"), F.unix_micros("timestamp").alias("us"))


@query("select o_orderkey, 'u' || o_custkey as user_name, o_totalprice as duration, 'select * from orders where o_orderkey = ?' as normalized, epoch_us(date_trunc('second', o_orderdate)) as us, case when o_orderkey % 3 <> 0 then 't' || o_custkey end as trace_id, case o_orderkey % 3 when 1 then 'p1' when 2 then 'p2' end as parent_id from orders")
def parse_postgresql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a slow query of two lines, read back in groups."""
    o = table(spark, sf_dir, "orders")
    head = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC [1-2] u"), F.col("o_custkey").cast("string"), F.lit("@db LOG:  duration: "), F.col("o_totalprice").cast("decimal(20,2)").cast("string"), F.lit(" ms  statement: SELECT * FROM orders"))
    trace = F.concat(F.lit("t"), F.col("o_custkey").cast("string"))
    pairs = F.concat(F.lit(" /* parent_id='p1',trace_id='"), trace, F.lit("' */"))
    comment = F.when(F.col("o_orderkey") % 3 == 1, pairs).when(F.col("o_orderkey") % 3 == 2, F.concat(F.lit(" /* traceparent=\"00-"), trace, F.lit("-p2-01\" */"))).otherwise("")
    tail = F.concat(F.lit("\t  WHERE o_orderkey = "), F.col("o_orderkey").cast("string"), comment)
    file = F.concat(F.lit("f"), F.col("o_orderkey").cast("string"))
    lines = o.select(file.alias("source_file"), F.posexplode(F.array(head, tail)).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))
    d = parsers.parse_postgresql(lines)
    return d.select(F.substring("source_file", 2, 30).cast("long").alias("o_orderkey"), s("user").alias("user_name"), F.try_variant_get(get("data", "duration"), "$", "double").alias("duration"), s("normalized_query").alias("normalized"), F.unix_micros("timestamp").alias("us"), s("trace.trace_id").alias("trace_id"), s("trace.parent_id").alias("parent_id"))


@query("select o_orderkey, 'u' || o_custkey as user_name, round(o_totalprice / 1000, 5) as query_time, o_custkey as rows_sent, 'select * from orders where o_orderkey = ?' as normalized, 'orders' as tables, epoch(o_orderdate)::bigint as unix from orders")
def parse_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a slow query of five lines, read back in groups."""
    o = table(spark, sf_dir, "orders")
    rows = F.array(
        F.concat(F.lit("# User@Host: u"), F.col("o_custkey").cast("string"), F.lit("[u] @ h [10.0.0.1]  Id: 1")),
        F.concat(F.lit("# Query_time: "), F.round(F.col("o_totalprice") / 1000, 5).cast("decimal(20,5)").cast("string"), F.lit("  Lock_time: 0.1 Rows_sent: "), F.col("o_custkey").cast("string"), F.lit("  Rows_examined: 3")),
        F.concat(F.lit("SET timestamp="), F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string"), F.lit(";")), F.lit("SELECT * FROM orders"), F.concat(F.lit("WHERE o_orderkey = "), F.col("o_orderkey").cast("string"), F.lit(";")),
    )
    lines = o.select(F.col("o_orderkey").cast("string").alias("source_file"), F.posexplode(rows).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))
    d = parsers.parse_mysql(lines, now=NOW)
    return d.select(F.col("source_file").cast("long").alias("o_orderkey"), s("user").alias("user_name"), F.try_variant_get(get("data", "query_time"), "$", "double").alias("query_time"), F.try_variant_get(get("data", "rows_sent"), "$", "long").alias("rows_sent"), s("normalized_query").alias("normalized"), s("tables").alias("tables"), F.unix_seconds("timestamp").alias("unix"))


@query("select o_orderkey, 'db' as database, 'c' || o_custkey % 10 as collection, o_custkey::double as nscanned, (o_orderkey % 1000)::double as duration_ms, '{ \"a\": { \"$in\": 1 }, \"k\": 1 }' as shape, epoch_us(date_trunc('second', o_orderdate)) as us from orders")
def parse_mongodb(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    line = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.000+0000"), F.lit(" I COMMAND  [conn1] query db.c"), (F.col("o_custkey") % 10).cast("string"), F.lit(" query: { k: "), F.col("o_orderkey").cast("string"), F.lit(', a: { $in: [ "x", "y" ] } } planSummary: IXSCAN { k: 1 } nscanned:'), F.col("o_custkey").cast("string"), F.lit(" locks:{ Global: { acquireCount: { r: 2 } } } "), (F.col("o_orderkey") % 1000).cast("string"), F.lit("ms"))
    d = parsers.parse_mongodb(_lines(o, line, "o_orderkey", F.col("o_orderkey").cast("string")), now=NOW)
    v = lambda k: F.try_variant_get(get("data", k), "$", "double").alias(k)
    return d.select(F.col("line_no").alias("o_orderkey"), s("database").alias("database"), s("collection").alias("collection"), v("nscanned"), v("duration_ms"), s("normalized_query").alias("shape"), F.unix_micros("timestamp").alias("us"))


@query("""
select event_id, '{ ' || array_to_string(list_transform(list_sort(['_id', event_type, 'user_id']), lambda k: '"' || k || '": ' || case when k = event_type then '{ "a": 1, "b": { "$gt": 1 } }' else '1' end), ', ') || ' }' as shape from events""")
def mongo_query_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each event, with keys that come in different orders."""
    e = table(spark, sf_dir, "events")
    doc = F.concat(F.lit("{ user_id: "), F.col("user_id").cast("string"), F.lit(", "), F.col("event_type"), F.lit(": { b: { $gt: "), F.col("event_id").cast("string"), F.lit(' }, a: [ 1, "x" ] }, _id: "'), F.col("event_type"), F.lit('" }'))
    return e.select("event_id", shape_column(doc).alias("shape"))


@query("""
select o_orderkey, 2.0::double as read_lock, o_custkey::double as wait, (o_orderkey % 7)::bigint as held_us from orders""")
def parse_mongodb_locks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locks of both forms, as fields of their own."""
    o = table(spark, sf_dir, "orders")
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.000+0000")
    new = F.concat(F.lit(" I COMMAND  [conn1] query db.c query: { k: 1 } locks:{ Global: { acquireCount: { r: 2 }, timeAcquiringMicros: { r: "), F.col("o_custkey").cast("string"), F.lit(" } } } 5ms"))
    old = F.concat(F.lit(" [conn1] query db.c query: { k: 1 } locks(micros) r:"), (F.col("o_orderkey") % 7).cast("string"), F.lit(" 5ms"))
    lines = o.select(F.col("o_orderkey").cast("string").alias("source_file"), F.posexplode(F.array(F.concat(at, new), F.concat(at, old))).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))
    d = parsers.parse_mongodb(lines, now=NOW)
    v = lambda k, t: F.max(F.try_variant_get(get("data", k), "$", t))
    return d.groupBy(F.col("source_file").cast("long").alias("o_orderkey")).agg(v("global_read_lock", "double").alias("read_lock"), v("global_read_lock_wait_us", "double").alias("wait"), v("read_lock_held_us", "long").alias("held_us"))


# --- SQL text


@query("select o_orderkey, 'update orders set o_totalprice = ? where o_orderkey in (?, ?)' as normalized, 'orders' as tables, 'update' as statement, '/* why ' || o_custkey || ' */' as comments from orders")
def normalize_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    q = F.concat(F.lit("UPDATE /* why "), F.col("o_custkey").cast("string"), F.lit(" */ orders  SET o_totalprice="), F.col("o_totalprice").cast("decimal(20,2)").cast("string"), F.lit(" WHERE o_orderkey IN ("), F.col("o_orderkey").cast("string"), F.lit(",'x') /* not this */"))
    n = o.select("o_orderkey", normalize_column(q).alias("n"))
    return n.select("o_orderkey", F.col("n.query").alias("normalized"), F.col("n.tables").alias("tables"), F.col("n.statement").alias("statement"), F.col("n.comments").alias("comments"))


@query("select c_custkey, 'show x like ? and n=?' as normalized from customer")
def scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", scan_column(F.concat(F.lit("SHOW  x LIKE '"), F.regexp_replace("c_name", "'", ""), F.lit("' AND n="), F.col("c_custkey").cast("string"))).alias("normalized"))


# --- the chain


@query(f"select (props->>'k')::bigint % 10 as bucket, sha256('u' || user_id) as user_key, 'prod' as env, count(*) as n from events where {_KEEP.format(n=2)} group by all")
def event_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines parsed, sampled by user, scrubbed, added to, unnested, renamed and counted."""
    e = table(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"), "props", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time")))
    got = parsers.parse_json(_lines(e, line, "event_id"), now=NOW)
    got = sampling.deterministic_sample(got, "user", 2)
    got = transforms.add_fields(transforms.scrub_fields(got, ["user"]), {"env": "prod"})
    got = transforms.drop_unsampled(transforms.rename_fields(transforms.json_fields(got, ["props"]), [("user", "user_key")]))
    return got.groupBy((F.try_variant_get(get("data", "props"), "$.k", "long") % 10).alias("bucket"), s("user_key").alias("user_key"), s("env").alias("env")).agg(F.count("*").alias("n"))


@query("select event_id, epoch_us(ts) as us, 1::int as samplerate, sha256('u' || user_id) as who, 'x' as added from events")
def pipeline_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from options, as a user gives them."""
    e = table(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time")))
    o = Options(parser="json", files=["-"], read_from="beginning", scrub_fields=["user"], add_fields=["added=x"], rename_fields=["user=who"])
    out = build(spark, o, _lines(e, line, "event_id"), NOW)
    return out.select(s("id").cast("long").alias("event_id"), F.unix_micros("time").alias("us"), "samplerate", s("who").alias("who"), s("added").alias("added"))


@query("select event_id, 'u' || user_id as user_name from events")
def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outgoing rows as JSON text, read back."""
    e = _events(spark, sf_dir)
    e = e.withColumn("data", record({"id": variant("line_no"), "user": get("data", "user")}))
    v = F.parse_json("value")
    return as_json(e).select(F.try_variant_get(v, "$.data.id", "long").alias("event_id"), F.try_variant_get(v, "$.data.user", "string").alias("user_name"))


@query("select event_id, sha256(event_type) as kind, case when value = floor(value) then null else value end as fraction from events")
def scrub_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that scrubs hash: strings as they are, fractions in shortest form."""
    e = _events(spark, sf_dir)
    value = F.try_variant_get(get("data", "value"), "$", "double")
    return e.select(F.col("line_no").alias("event_id"), F.sha2(text_of(get("data", "kind")), 256).alias("kind"), F.when(value != F.floor(value), text_of(get("data", "value")).cast("double")).alias("fraction"))


@query("select event_id, epoch_us(ts) as us from events where event_type <> 'error'")
def outgoing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).withColumn("sample_rate", F.when(s("kind") == "error", -1).otherwise(0)).withColumn("data", record({"id": variant("line_no")}))
    return outgoing(e).where("samplerate = 1").select(F.try_variant_get(get("data", "id"), "$", "long").alias("event_id"), F.unix_micros("time").alias("us"))


@query(r"""
select doc_id::varchar as source_file, unnest(range(len(x)))::bigint as line_no, unnest(x) as line from (select doc_id, string_split_regex(regexp_replace(text, '\r?\n\z', ''), '\r?\n') as x from documents)""")
def lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: their numbered lines."""
    return numbered(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_file"), F.col("text").alias("value")))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
