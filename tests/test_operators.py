import hashlib
import json

import duckdb
import pytest
from helpers import NOW, data, envelope, events, lines, micros
from pyspark.sql import functions as F

from cinderlog.functions import compat, regexes, sqltext, times
from cinderlog.operators import filters, grouping, sampling, stats, transforms
from cinderlog.plans import catalog

SHAPES = {
    "PUT /shop/7/items HTTP/2.0": {"method": "PUT", "protocol_version": "HTTP/2.0", "uri": "/shop/7/items", "path": "/shop/7/items", "path_id": "7", "shape": "/shop/:id/items", "pathshape": "/shop/:id/items"},
    "HEAD /shop?page=2 HTTP/1.1": {"method": "HEAD", "protocol_version": "HTTP/1.1", "uri": "/shop?page=2", "path": "/shop", "query": "page=2", "query_page": "2", "shape": "/shop?page=?", "pathshape": "/shop", "queryshape": "page=?"},
    "/shop/9?sort=up&page=4": {"uri": "/shop/9?sort=up&page=4", "path": "/shop/9", "query": "sort=up&page=4", "query_page": "4", "query_sort": "up", "path_id": "9", "shape": "/shop/:id?page=?&sort=?", "pathshape": "/shop/:id", "queryshape": "page=?&sort=?"},
    "/shop/9?page=b&page=a&sort&other=1": {"uri": "/shop/9?page=b&page=a&sort&other=1", "path": "/shop/9", "query": "page=b&page=a&sort&other=1", "query_page": "a, b", "query_sort": "", "path_id": "9", "shape": "/shop/:id?other=?&page=?&page=?&sort=?", "pathshape": "/shop/:id", "queryshape": "other=?&page=?&page=?&sort=?"},
}


def test_request_shape(spark):
    e = envelope(spark, *({"request": x} for x in SHAPES), {"request": 5})
    got = data(transforms.request_shape(e, ["request"], patterns=["/shop", "/shop/:id", "/shop/:id/items"], query_keys=["page", "sort"]))
    want = [{"request": x} | {f"request_{k}": v for k, v in y.items()} for x, y in SHAPES.items()]
    assert got == [*want, {"request": 5.0}]
    e = envelope(spark, {"r": "/shop/9?sort=up&page=4"})
    got = data(transforms.request_shape(e, ["r"], prefix="p", parse_query="all"))[0]
    assert got["p_r_query_sort"] == "up" and got["p_r_query_page"] == "4" and got["p_r_pathshape"] == "/shop/9"


def test_augment_drop_scrub_add_rename(spark):
    e = envelope(spark, {"color": "red", "n": 1, "name": "Ann"}, {"color": "blue"})
    e = transforms.augment(e, {"color": {"red": {"color": "RED", "hex": "f00", "w": 3}}})
    assert data(e) == [{"color": "RED", "hex": "f00", "w": 3, "n": 1.0, "name": "Ann"}, {"color": "blue"}]
    e = transforms.scrub_fields(transforms.drop_fields(e, ["hex", "zz"]), ["name", "n"])
    got = data(e)[0]
    assert got["name"] == hashlib.sha256(b"Ann").hexdigest() and got["n"] == hashlib.sha256(b"1").hexdigest() and "hex" not in got
    e = transforms.rename_fields(transforms.add_fields(e, {"env": "a=b", "color": "x"}), [("env", "w"), ("none", "y")])
    assert data(e)[1] == {"color": "x", "w": "a=b"}
    with pytest.raises(ValueError):
        transforms.parse_pairs(["x"], "add")
    with pytest.raises(ValueError):
        transforms.parse_pairs(["a=b=c"], "rename", exactly_one=True)


def test_json_fields_and_presampled(spark):
    e = envelope(spark, {"j": '{"a":[1]}', "r": 5}, {"j": "[1]", "r": "7"}, {"j": 3, "r": "x"})
    assert [d["j"] for d in data(transforms.json_fields(e, ["j"]))] == [{"a": [1]}, "[1]", 3.0]
    assert [r["sample_rate"] for r in transforms.presampled(e, "r").orderBy("line_no").collect()] == [5, 7, 1]


def test_deterministic_sampler(spark):
    e = envelope(spark, {"k": "hello"}, {"k": "world"}, {"k": "this5"}, {"k": 1})  # fixed values: keys that a sampler of rate 17 drops, drops and keeps
    got = sampling.deterministic_sample(e, "k", 17, seed=1).orderBy("line_no")
    assert [r["sample_rate"] for r in got.collect()][:3] == [-1, -1, 17]
    ids = spark.range(200_000).select(F.sha1(F.col("id").cast("string")).alias("k"))
    for rate in (1, 2, 10, 50, 100):
        n = ids.where(sampling.keeps(F.col("k"), rate)).count()
        assert abs(n - 200_000 / rate) <= 0.05 * 200_000 / rate
    with pytest.raises(ValueError):
        sampling.keeps(F.lit("x"), 0)


def test_dynamic_sampler(spark):
    rows = [{"k": "hot", "n": 1}] * 200 + [{"k": "rare", "n": 1}] * 4
    e = envelope(spark, *rows).withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_010) + (F.col("line_no") % 2) * 30))
    assert e.select(sampling.key_of(["k", "n", "zz"])).first()[0] == "hot_1E+00_"
    got = sampling.dynamic_sample(e, ["k"], 10, 30, 0.001, seed=1).collect()
    assert got[0].asDict().keys() == e.first().asDict().keys()
    again = sampling.dynamic_sample(e.repartition(7), ["k"], 10, 30, 0.001, seed=1).collect()
    assert sorted((r["line_no"], r["sample_rate"]) for r in again) == sorted((r["line_no"], r["sample_rate"]) for r in got)
    first = [r for r in got if r["timestamp"].timestamp() == 1_700_000_010]
    later = [r for r in got if r["timestamp"].timestamp() != 1_700_000_010]
    assert {r["sample_rate"] for r in first} == {1}  # nothing is known before the first window
    assert max(r["sample_rate"] for r in later) > 5 and -1 in {r["sample_rate"] for r in later}


def test_number_text(spark):
    want = {5.0: "5", 1e6: "1e+06", 1234567.25: "1.23456725e+06", 123456789.0: "1.23456789e+08", 0.1: "0.1", 0.0005: "0.0005", 1e-5: "1e-05", 1.5e300: "1.5e+300", 100000.0: "100000", -2.5: "-2.5", 0.0: "0"}
    got = spark.createDataFrame([(x,) for x in want], "d double").select("d", compat.number_text(F.col("d")).alias("t")).collect()
    assert {r["d"]: r["t"] for r in got} == want


def test_strict_numbers(spark):
    texts = ["5", " 5", "5d", "+7", "1.5", "1e3", "inf", "0x10", "", "9223372036854775808", ".5", "5."]
    got = spark.createDataFrame([(x,) for x in texts], "s string").select(compat.to_long("s"), compat.to_double("s")).collect()
    assert [r[0] for r in got] == [5, None, None, 7, None, None, None, None, None, None, None, None]
    assert [r[1] for r in got] == [5.0, None, None, 7.0, 1.5, 1000.0, float("inf"), None, None, 9223372036854775808.0, 0.5, 5.0]


AT = micros(2021, 3, 4, 5, 6, 7)
TIMES = [
    ("2006-01-02 15:04:05.999999999 -0700 MST", "2021-03-04 06:06:07.500000250 +0100 CET", "UTC", AT + 500000), ("", "2021-03-04T07:06:07.25+02:00", "UTC", AT + 250000), ("", "2021-03-04T05:06:07Z", "UTC", AT), ("", "2021-03-04 05:06:07 +0000 UTC", "UTC", AT),
    ("", "Thu Mar 04 06:06:07 +0100 2021", "UTC", AT), ("", "Thu Mar  4 05:06:07 UTC 2021", "UTC", AT), ("%Y-%m-%d %H:%M", "2021-03-04 05:06", "UTC", AT - 7_000_000), ("%Y-%m-%d %H:%M", "2021-03-04 06:06", "Europe/Berlin", AT - 7_000_000),
    ("%Y-%m-%d %k:%M", "2021-03-04  5:06", "UTC", AT - 7_000_000), ("%s(%L)?", "1614834367", "UTC", AT), ("unixepoch", "1614834367.0625", "UTC", AT + 62500), ("%Y/%m/%d %z", "2021/03/04 +0100", "UTC", micros(2021, 3, 3, 23)),
    ("", "1614834367125", "UTC", AT + 125000), ("%d.%m.%Y %H:%M:%S", "04.03.2021 05:06:07,5", "UTC", AT + 500000), ("", "4 March", "UTC", None), ("", "2021-03-04T", "UTC", None), ("", "12", "UTC", None),
]


@pytest.mark.parametrize(("fmt", "text", "zone", "want"), TIMES)
def test_times(spark, fmt, text, zone, want):
    got = spark.createDataFrame([(text,)], "s string").select(F.unix_micros(times.try_formats(F.col("s"), fmt or None, zone))).first()[0]
    assert got == want


def test_resolve(spark):
    e = envelope(spark, {"time": "x", "Date": "2021-03-04T05:06:07Z", "a": 1}, {"ts": 1614834367.5, "time": 3}, {"ts": "bad"}, {"msec": "1614834367", "date": "2021-03-04T05:06:08Z", "b": None}, {})
    got = events(times.resolve(e, now=NOW))
    now = micros(2010, 6, 21, 15, 4, 5)
    assert got == [(AT, {"time": "x", "a": 1.0}), (now, {"ts": 1614834367.5, "time": 3.0}), (now, {"ts": "bad"}), (AT + 1_000_000, {"msec": "1614834367", "b": None}), (now, {})]
    assert events(times.resolve(e, "ts", now=NOW))[1:3] == [(AT + 500000, {"time": 3.0}), (now, {})]


def test_regex_translation():
    p = regexes.translate(r"^(?P<a_b>\d+)(x)?(?:y)[[:alpha:]_]+$")
    assert p.names == ["a_b", None] and p.java == r"^(\d+)(x)?(?:y)[\p{Alpha}_]+\z"
    for bad in (r"(?=x)", r"(a)\1", "(x", r"(?P<a-b>x)"):
        with pytest.raises(ValueError):
            regexes.translate(bad)


def test_prefix(spark):
    got = filters.strip_prefix(lines(spark, 'Nov 13 app23 proc[1]: {"a":1}', "none"), r"^(?P<when>\w+ \d+) (?P<host>\S+) \S+: ").orderBy("line_no").collect()
    assert [r["line"] for r in got] == ['{"a":1}', "none"] and json.loads(spark.createDataFrame([("x",)], "s string").select(F.lit("1")).first()[0]) == 1
    assert got[1]["prefix"] is None and set(got[0]["prefix"]) == {"when", "host"}


def test_groups(spark):
    df = lines(spark, "a", "\tb", "c", "\td", "\te")
    assert [r["lines"] for r in grouping.tab_groups(df).orderBy("line_no").collect()] == [["a", "\tb"], ["c", "\td", "\te"]]
    assert grouping.last_lines(lines(spark, "", "x", "y", " ")).collect()[0]["line"] == "y"


def test_groups_do_not_depend_on_pieces(spark, monkeypatch):
    import random

    rng = random.Random(3)
    text = [rng.choice(["# Time: x", "# User@Host: u @ h [1]", "SELECT 1", "FROM t;", "\tmore", ""]) for _ in range(300)]
    df = lines(spark, *text).unionByName(lines(spark, *text[::-1]).withColumn("source_file", F.lit("g"))).repartition(5)
    run = lambda f: sorted((r["source_file"], r["line_no"], r["lines"]) for r in f(df).collect())
    want = [run(f) for f in (grouping.slow_log_groups, grouping.tab_groups)]
    for n in (1, 7, 50):
        monkeypatch.setattr(grouping, "PIECE", n)
        assert [run(f) for f in (grouping.slow_log_groups, grouping.tab_groups)] == want
    head = lambda x: x.startswith("# ")
    starts = [i for i in range(300) if i == 0 or head(text[i]) and not head(text[i - 1])]
    groups = [text[i:j] for i, j in zip(starts, [*starts[1:], 300], strict=True)]
    assert [x for f, _, x in want[0] if f == "f"] == [g for g in groups if not head(g[-1])]


def test_response_stats(spark):
    rows = [(0, 200, "ok ", "", 5, "a"), (10, 200, "ok", "", 0, "b"), (20, 429, "slow", "", 8, "c"), (70, 500, "", "boom", 2, "d")]
    df = spark.createDataFrame(rows, "s long, status int, body string, err string, duration_ns long, event string").withColumn("at", F.timestamp_seconds("s"))
    a, b = stats.response_stats(df, 60).orderBy("w").collect()
    assert (a["count"], a["min_ns"], a["max_ns"], a["avg_ns"], a["by_status"], a["by_body"], a["last_event"], b["lifetime_count"], b["by_err"]) == (3, 5, 8, 4, {"200": 2, "429": 1}, {"ok": 2, "slow": 1}, "c", 4, {"boom": 1})
    assert {r["status"]: r["count"] for r in stats.lifetime_stats(df).collect()} == {200: 2, 429: 1, 500: 1}


def test_sql_text(spark):
    n = sqltext.normalize("SELECT * FROM users WHERE id='#'")
    assert n == ("select * from users where id = ?", "users", None, "select")
    assert sqltext.normalize("SELECT c FROM sbtest1 WHERE id=$1")[0] == "select c from sbtest1 where id=$?"
    assert sqltext.normalize("select @@session.tx_read_only")[:2] == ("select @@session.tx_read_only", "@@session")
    got = spark.createDataFrame([("SHOW x LIKE 'a'",), (None,)], "q string").select(sqltext.scan_column(F.col("q")), sqltext.normalize_column(F.col("q"))["query"]).collect()
    assert [tuple(r) for r in got] == [("show x like ?", "show x like ?"), (None, None)]


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_catalog(spark, duck, name):
    got = catalog.queries()[name](spark, "/root/testdata/sf0.001")
    if name not in catalog.oracle_sql():
        assert got.count() > 0
        return
    a, b = got.toPandas(), duck.execute(catalog.oracle_sql()[name]).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    f = lambda x: sorted(map(str, x[cols].astype(object).where(x[cols].notna(), None).itertuples(index=False)))
    assert f(a) == f(b)


def test_whole_texts_and_urls(spark, tmp_path):
    spark.createDataFrame([(1, "one two\n\n7"), (2, "\nlast"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "http://a/b?c=d&e=f?g", "<p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = catalog.queries()["first_match_regex"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, "o"), (1, 2, "7"), (2, 1, "last")]
    assert [r["url"] for r in catalog.queries()["parse_nginx"](spark, str(tmp_path)).collect()] == ["http://a/b?c=d&e=f?g"]


def test_augment_refuses_too_many_fields(spark):
    rows = spark.range(1001).select(F.concat(F.lit("f"), "id").alias("src_field"), F.lit("x").alias("val"), F.expr("cast(map() as map<string, variant>)").alias("add"))
    with pytest.raises(ValueError, match="source fields"):
        transforms.augment(envelope(spark, {"f1": "x"}), rows)
