"""Event transforms: each takes and returns a DataFrame with (timestamp, sample_rate, data)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.compat import DATA, double_of, get, kind, merge, record, string_of, text_of, to_double, variant, without

#: Rows of a lookup's dimension that may be broadcast.
LOOKUP_ROWS = 200_000
#: Source fields that a lookup DataFrame may name without ``fields`` being given; each is a join.
LOOKUP_FIELDS = 1000


def _with(df: DataFrame, data: Column) -> DataFrame:
    return df.withColumn("data", data.cast(DATA))


def request_shape(df: DataFrame, fields: list[str], prefix: str = "", patterns: list[str] | None = None, parse_query: str = "whitelist", query_keys: list[str] | None = None) -> DataFrame:
    """Adds <prefix_><field>_method, _uri, _path, _query, _query_<key>, _path_<name>, _shape, ... of request fields."""
    for field in fields:
        method, uri, version = urls.split_request(string_of(get("data", field)))
        s = urls.shape(uri, patterns)
        base = (f"{prefix}_" if prefix else "") + field
        parts = {"method": method, "protocol_version": version, "uri": F.when(s["path"].isNotNull(), uri), **{k: v for k, v in s.items() if k != "pairs"}}
        extra = record({f"{base}_{k}": variant(c) for k, c in parts.items()})
        if parse_query == "all":
            keys = F.array_distinct(F.transform(s["pairs"], lambda x: x["key"]))
            of = lambda k: urls.query_values(s["pairs"], k)
            found = F.map_from_entries(F.transform(keys, lambda k: F.struct(F.concat(F.lit(f"{base}_query_"), k).alias("key"), of(k).cast("variant").alias("value"))))
            extra = merge(extra, found)
        elif query_keys:
            extra = merge(extra, record({f"{base}_query_{k}": variant(urls.query_values(s["pairs"], k)) for k in query_keys}))
        df = _with(df, F.when(string_of(get("data", field)).isNotNull(), merge(F.col("data"), extra)).otherwise(F.col("data")))
    return df


def lookup_table(df: DataFrame) -> DataFrame:
    """Checks a lookup dimension (src_field STRING, val STRING, add MAP<STRING, VARIANT>)."""
    return df.select("src_field", "val", F.col("add").cast(DATA).alias("add"))


def augment(df: DataFrame, lookup: dict[str, dict[str, dict[str, object]]] | DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Adds the fields that a lookup holds for string values of its source fields.

    A dict is a file's content; a DataFrame is (src_field, val, add), joined by equality: broadcast if it has at most
    LOOKUP_ROWS rows, else shuffled. All lookups see the row as it was; later source fields win.
    Source fields not given are read from the DataFrame; more than LOOKUP_FIELDS of them are an error.
    """
    if isinstance(lookup, dict):
        import json

        rows = [(f, v, json.dumps(add)) for f, by in lookup.items() for v, add in by.items()]
        fields = list(lookup)
        table = df.sparkSession.createDataFrame(rows, "src_field string, val string, j string").select("src_field", "val", F.parse_json("j").cast(DATA).alias("add"))
        small = len(rows) <= LOOKUP_ROWS
    else:
        table = lookup_table(lookup)
        if not fields:
            fields = [r[0] for r in table.select("src_field").distinct().limit(LOOKUP_FIELDS + 1).collect()]
            if len(fields) > LOOKUP_FIELDS:
                raise ValueError(f"the lookup names more than {LOOKUP_FIELDS} source fields")
        small = table.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS
    added = []
    for i, f in enumerate(fields):
        own = table.where(F.col("src_field") == f).select(F.col("val").alias(f"_v{i}"), F.col("add").alias(f"_a{i}"))
        df = df.withColumn(f"_k{i}", string_of(get("data", f))).join(F.broadcast(own) if small else own, F.col(f"_k{i}") == F.col(f"_v{i}"), "left").drop(f"_k{i}", f"_v{i}")
        added.append(F.col(f"_a{i}"))
    return _with(df, merge(F.col("data"), *added)).drop(*(f"_a{i}" for i in range(len(fields))))


def drop_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    return _with(df, without("data", *fields))


def scrub_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Values of these fields become the SHA-256, in hex, of their text."""
    return _with(df, F.transform_values("data", lambda k, v: F.when(k.isin(*fields), F.sha2(text_of(v), 256).cast("variant")).otherwise(v)))


def add_fields(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    return _with(df, merge(F.col("data"), record({k: variant(F.lit(v)) for k, v in fields.items()})))


def parse_pairs(items: list[str], what: str, exactly_one: bool = False) -> dict[str, str]:
    """Options of the form a=b."""
    out = {}
    for x in items:
        if "=" not in x or exactly_one and x.count("=") != 1:
            raise ValueError(f"{what} must look like name=value, got {x!r}")
        k, v = x.split("=", 1)
        out[k] = v
    return out


def presampled(df: DataFrame, field: str) -> DataFrame:
    """The event's rate is what the field holds: a number, or its text; whole numbers of any parser count. 0 or none is 1."""
    v = get("data", field)
    rate = F.coalesce(double_of(v), to_double(string_of(v))).try_cast("int")
    return df.withColumn("sample_rate", F.when(rate != 0, rate).otherwise(1))


def json_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Strings that hold a JSON object become that object; others stay."""
    def parsed(k: Column, v: Column) -> Column:
        o = F.try_parse_json(string_of(v))
        return F.when(k.isin(*fields) & string_of(v).rlike(r"^\s*\{[\s\S]*\}\s*\z") & kind(o).startswith("OBJECT"), o).otherwise(v)

    return _with(df, F.transform_values("data", parsed))


def rename_fields(df: DataFrame, renames: list[tuple[str, str]]) -> DataFrame:
    """One after the other: a field takes another's name and place; a missing one is passed over."""
    for a, b in renames:
        v = get("data", a)
        has = F.map_contains_key("data", F.lit(a))
        df = _with(df, F.when(has, merge(without("data", a), F.map_from_arrays(F.array(F.lit(b)), F.array(v)))).otherwise(F.col("data")))
    return df


def drop_unsampled(df: DataFrame) -> DataFrame:
    return df.where("sample_rate is null or sample_rate <> -1")
