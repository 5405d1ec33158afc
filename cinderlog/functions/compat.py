"""Values as the log formats' senders write them: numbers, booleans, text forms and the event envelope.

An event is (timestamp TIMESTAMP, sample_rate INT, data MAP<STRING, VARIANT>), beside source_file and line_no where it came
from a file. An absent key differs from a null value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATA = "map<string,variant>"
TRUE = ("1", "t", "T", "TRUE", "true", "True")
FALSE = ("0", "f", "F", "FALSE", "false", "False")


def configure(spark: SparkSession) -> SparkSession:
    """Session settings that events need: UTC, later keys win in maps and in JSON objects."""
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.mapKeyDedupPolicy": "LAST_WIN", "spark.sql.variant.allowDuplicateKeys": "true"}.items():
        spark.conf.set(k, v)
    return spark


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep(df: DataFrame, name: str, value: Column, test: Callable[[Column], Column]) -> DataFrame:
    """df with ``name``, without the rows whose value fails the test (a null one is tested too).

    A filter on a computed column is moved below the projection that computes it, so that the value is made once for the filter and once again
    for its use. No filter is moved below this generator: dear values, such as parsed lines, are made once.
    """
    return df.withColumn(name, F.explode(F.filter(F.array(value), test)))


def trim_space(c: Column | str) -> Column:
    """All white space at both ends, not only blanks."""
    return F.regexp_replace(col(c), r"^[\s\u0085 ]+|[\s\u0085 ]+$", "")


def to_long(c: Column | str) -> Column:
    """Decimal digits with an optional sign and nothing else, within 64 bits; else null."""
    c = col(c)
    return F.when(c.rlike(r"^[+-]?[0-9]+\z"), c.try_cast("long"))


def to_double(c: Column | str) -> Column:
    """A decimal number, inf or nan, without surrounding white space or suffix; else null."""
    c = col(c)
    plain = F.when(c.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"), c.try_cast("double"))
    return F.coalesce(plain, F.when(c.rlike(r"^(?i:[+-]?inf(?:inity)?|nan)\z"), F.regexp_replace(F.lower(c), r"^\+", "").try_cast("double")))


def to_bool(c: Column | str) -> Column:
    c = col(c)
    return F.when(c.isin(*TRUE), True).when(c.isin(*FALSE), False)


def variant(c: Column | str) -> Column:
    return col(c).cast("variant")


def typed(c: Column | str, *, boolean: bool = False) -> Column:
    """A string as a variant: boolean (if asked for, before numbers, so that 1 is true), long, double, else the string."""
    c = col(c)
    steps = ([to_bool(c)] if boolean else []) + [to_long(c), to_double(c)]
    return F.coalesce(*(variant(x) for x in steps), variant(c))


def kind(v: Column) -> Column:
    """A variant's type by name, such as BIGINT, STRING or OBJECT<...>."""
    return F.schema_of_variant(v)


def string_of(v: Column) -> Column:
    """A variant's string, null where it holds anything else."""
    return F.when(kind(v) == "STRING", F.variant_get(v, "$", "string"))


def double_of(v: Column) -> Column:
    return F.when(kind(v).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(v, "$", "double"))


def number_text(d: Column) -> Column:
    """Shortest text of a double: plain digits below a million, else (and below 1e-4) with an exponent of two digits or more."""
    raw, size = d.cast("string"), F.abs(d)
    plain = F.regexp_replace(raw, r"\.0$", "")
    small = F.regexp_replace(d.cast("decimal(38,20)").cast("string"), r"\.?0+$", "")  # from 1e-4 to 1e-3 the engine writes an exponent
    seven = F.regexp_replace(F.regexp_replace(plain, r"^(-?[0-9])([0-9]{6})\.?([0-9]*)$", "$1.$2$3"), r"\.?0*$", "")
    mantissa = F.regexp_replace(F.regexp_extract(raw, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(raw, r"E(-?[0-9]+)$", 1).try_cast("int")
    ten = F.abs(power).cast("string")
    sci = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.when(F.length(ten) < 2, F.concat(F.lit("0"), ten)).otherwise(ten))
    return (
        F.when(F.isnan(d), "NaN").when(size == float("inf"), F.when(d > 0, "+Inf").otherwise("-Inf")).when(d == 0, "0")
        .when((size >= 1e7) | (size < 1e-4), sci).when(size >= 1e6, F.concat(seven, F.lit("e+06"))).when(size < 1e-3, small).otherwise(plain)
    )


def text_of(v: Column) -> Column:
    """Text that a scrub hashes: strings as they are, whole numbers in decimal, doubles in shortest form, null as <nil>, the rest as JSON."""
    k = kind(v)
    return (
        F.when(k == "STRING", F.variant_get(v, "$", "string"))
        .when(k.rlike("^(BIGINT|INT|SMALLINT|TINYINT)$"), F.try_variant_get(v, "$", "long").cast("string"))
        .when(k.rlike("^(DOUBLE|FLOAT|DECIMAL)"), number_text(F.try_variant_get(v, "$", "double")))
        .when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("string"))
        .when(k == "VOID", "<nil>")
        .otherwise(F.to_json(v))
    )


def no_data() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))


def record(fields: dict[str, Column]) -> Column:
    """A data map of the given variants; a null Column is an absent key."""
    entries = F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in fields.items()))
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def merge(*maps: Column) -> Column:
    """Later maps win; a null map counts as empty."""
    return F.map_concat(*(F.coalesce(m, no_data()) for m in maps))


def get(data: Column | str, key: str) -> Column:
    """A key's value, null if absent."""
    return F.try_element_at(col(data), F.lit(key))


def without(data: Column | str, *keys: str) -> Column:
    return F.map_filter(col(data), lambda k, _: ~k.isin(*keys)) if keys else col(data)


def doubles(data: Column, whole: str | None = None) -> Column:
    """All JSON numbers at the top level as doubles; as longs those whose key ends in ``whole``."""

    def one(k: Column, v: Column) -> Column:
        number = F.when(kind(v).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|FLOAT)"), variant(F.try_variant_get(v, "$", "double"))).otherwise(v)
        return F.when(k.endswith(whole), variant(F.try_variant_get(v, "$", "long"))).otherwise(number) if whole else number

    return F.transform_values(data, one)
