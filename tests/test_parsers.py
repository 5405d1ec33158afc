import pytest
from helpers import NOW, data, events, lines, micros

from cinderlog.sources import parsers as P
from cinderlog.sources.parsers.database import compile_line_prefix, mysql_fields, trace_ids
from cinderlog.sources.parsers.mongo import parse_document, shape, shape_column
from cinderlog.sources.parsers.plain import compile_log_format, read_log_format
from pyspark.sql import functions as F


def test_json(spark):
    got = events(P.parse_json(lines(spark, '{"app":"shop","took":7,"fine":false,"ids":[4,"b"],"time":"2021-03-04T05:06:07Z"}', " ", "[1]", "null", '{"a":1} x', '{"n":null}'), now=NOW))
    assert got[0] == (micros(2021, 3, 4, 5, 6, 7), {"app": "shop", "took": 7.0, "fine": False, "ids": [4, "b"]})
    assert got[1] == (micros(2010, 6, 21, 15, 4, 5), {"n": None}) and len(got) == 2


def test_json_number_type(spark):
    df = P.parse_json(lines(spark, '{"whole":12,"part":0.75}'), now=NOW)
    assert df.select(F.schema_of_variant(F.col("data")["whole"]), F.schema_of_variant(F.col("data")["part"])).first()[:] == ("DOUBLE", "DOUBLE")


def test_keyval(spark):
    got = data(P.parse_keyval(lines(spark, 'level=info n=3 ratio=0.5 flag=1 msg="hi there"', "alpha beta", "key=", 'q="a \\"b\\"" z'), now=NOW))
    assert got == [{"level": "info", "n": 3, "ratio": 0.5, "flag": True, "msg": "hi there"}, {"q": 'a "b"', "z": ""}]
    kept = data(P.parse_keyval(lines(spark, "a=1x", "b=2x"), filter_regex="a=", now=NOW))
    assert kept == [{"a": "1x"}]
    assert data(P.parse_keyval(lines(spark, "a=1x", "b=2x"), filter_regex="a=", invert=True, now=NOW)) == [{"b": "2x"}]


def test_keyval_prefix_gives_time(spark):
    got = events(P.parse_keyval(lines(spark, "2019-12-31 23:58:01 cart k=v"), prefix=r"^(?P<time>[0-9-]+ [0-9:]+) (?P<unit_name>\w+) ", timefield="time", fmt="%Y-%m-%d %H:%M:%S", now=NOW))
    assert got == [(micros(2019, 12, 31, 23, 58, 1), {"k": "v", "unit_name": "cart"})]


def test_csv(spark):
    run = lambda *x, **k: data(P.parse_csv(lines(spark, *x), now=NOW, **k))
    assert run("7,1.5, x", "7,1.5", "", "7,1.5,x,y", '"a ""b"", c",,3', fields="a,b,c") == [{"a": 7, "b": 1.5, "c": " x"}, {"a": 'a "b", c', "b": "", "c": 3}]
    assert run("one, two, 3", fields=["a", "b", "c"], trim_leading_space=True) == [{"a": "one", "b": "two", "c": 3}]
    assert run(" 1,  x,", fields=["a", "b", "c"], trim_leading_space=True) == [{"a": 1, "b": "x", "c": ""}]
    many = ",".join(map(str, range(70)))
    assert run(many, fields=[f"c{i}" for i in range(70)]) == [{f"c{i}": i for i in range(70)}]
    with pytest.raises(ValueError):
        run("a", fields="")


def test_rejects(spark):
    df = lines(spark, '{"a":1}', "junk", "", '{"b":2}')
    assert [r["line"] for r in P.rejects(df, P.parse_json(df, now=NOW)).orderBy("line_no").collect()] == ["junk", ""]


FORMAT = '$remote_addr - $remote_user [$time_local] "$request" $status $body_bytes_sent $request_time'


def test_nginx(spark):
    line = '192.0.2.44 - ann [05/Feb/2022:03:04:05 +0200] "PUT /cart?id=9 HTTP/2.0" 404 77 1.250'
    got = events(P.parse_nginx(lines(spark, line, "other"), log_format=FORMAT, now=NOW))
    assert got == [(micros(2022, 2, 5, 1, 4, 5), {"remote_addr": "192.0.2.44", "remote_user": "ann", "request": "PUT /cart?id=9 HTTP/2.0", "status": 404, "body_bytes_sent": 77, "request_time": 1.25})]
    msec = events(P.parse_nginx(lines(spark, "x 1600000000.250", "x 1600000000", "- 1600000000.250"), log_format="$a $msec", now=NOW))
    assert msec[0] == (1600000000250000, {"a": "x"}) and msec[1][0] == micros(2010, 6, 21, 15, 4, 5) and msec[2][1] == {}
    iso = events(P.parse_nginx(lines(spark, "2022-02-05T03:04:05+02:00 7"), log_format="$time_iso8601 $n", now=NOW))
    assert iso == [(micros(2022, 2, 5, 1, 4, 5), {"n": 7})]
    auto = events(P.parse_nginx(lines(spark, "2022-02-05T03:04:05Z 7"), log_format="$timestamp $n", now=NOW))
    assert auto == [(micros(2022, 2, 5, 3, 4, 5), {"n": 7})]


def test_log_format_from_configuration():
    conf = "http { log_format main '$remote_addr '\n   '\"$request\"'; }"
    assert read_log_format(conf, "main") == '$remote_addr "$request"'
    assert compile_log_format("$a [$b]")[1] == ["a", "b"]
    with pytest.raises(ValueError):
        read_log_format(conf, "other")


def test_syslog(spark):
    old = "<86>Jul  4 09:08:07 gate7 cron[21]: (ann) CMD (backup --all)"
    (t, d), = events(P.parse_syslog(lines(spark, old), mode="rfc3164", year=2018))
    assert t == micros(2018, 7, 4, 9, 8, 7)
    assert {k: d[k] for k in d if k != "timestamp"} == {"hostname": "gate7", "process": "cron", "content": "(ann) CMD (backup --all)", "priority": 86, "facility": 10, "severity": 6}
    assert events(P.parse_syslog(lines(spark, old), mode="rfc3164", year=2018, processes=["sshd"])) == []
    new = '<189>1 2018-07-04T09:08:07.5Z gate7.example.org pay 812 T9 [meta@9 shop="3" till="b"] Order "9" paid'
    (t, d), = events(P.parse_syslog(lines(spark, new), mode="rfc5424"))
    assert t == micros(2018, 7, 4, 9, 8, 7, 500000) and d["version"] == 1 and d["proc_id"] == "812" and d["msg_id"] == "T9" and d["severity"] == 5 and d["facility"] == 23
    assert d["structured_data"] == '[meta@9 shop="3" till="b"]' and d["message"] == 'Order "9" paid' and "timestamp" in d
    with pytest.raises(ValueError):
        P.parse_syslog(lines(spark, old), mode="x")


def test_arangodb(spark):
    debug = '2020-02-03T04:05:06Z [77] DEBUG {requests} "begin","0xab12","198.51.100.7","POST","HTTP/1.1",/_db/shop/_api/cursor'
    info = '2020-02-03T04:05:07Z [77] INFO {requests} "end","0xab12","198.51.100.7","POST","HTTP/1.1",201,35,x,"/_db/shop/_api/cursor",0.25'
    got = events(P.parse_arangodb(lines(spark, debug, info, "2020-02-03T04:05:06Z [77] INFO {cluster} x", "2020-02-03T04:05:06Z [77] DEBUG {requests} 1,2,3")))
    first, second = got
    assert first[0] == micros(2020, 2, 3, 4, 5, 6) and second[0] == micros(2020, 2, 3, 4, 5, 7) and len(got) == 2
    assert {k: first[1][k] for k in ("pid", "logLevel", "logTopic")} == {"pid": "77", "logLevel": "DEBUG", "logTopic": "{requests}"}
    assert (second[1]["responseCode"], second[1]["reqBodyLen"], second[1]["resBodyLen"], second[1]["totalTime"]) == (201, 35, 0, 0.25)


def test_regex(spark):
    got = data(P.parse_regex(lines(spark, "k=9", "zzz", "abc 7"), patterns=[r"(\w)=(?P<v>\d+)", r"(?P<word_1>[[:alpha:]]+) (?P<n>\d)$"], now=NOW))
    assert got == [{"v": "9"}, {"word_1": "abc", "n": "7"}]
    for bad in ([], [""], ["(x"], ["a(b)"]):
        with pytest.raises(ValueError):
            P.parse_regex(lines(spark, "x"), patterns=bad)


def test_postgresql(spark):
    text = ["2020-05-06 07:08:09 UTC [41-7] ann@shop LOG:  duration: 12.5 ms  statement: SELECT i.name,", "\t       i.price", "\tFROM items i", "\tWHERE i.id = 12;", "2020-05-06 07:08:10 UTC [41-8] ann@shop LOG:  checkpoint: done", "2020-05-06 07:08:10 UTC [41-9] ann@shop LOG:  duration: 3 ms"]
    (t, d), = events(P.parse_postgresql(lines(spark, *text)))
    assert t == micros(2020, 5, 6, 7, 8, 9)
    assert d == {"user": "ann", "database": "shop", "duration": 12.5, "duration_ms": 12.5, "pid": 41, "session_line_number": 7,
                 "query": "SELECT i.name, i.price FROM items i WHERE i.id = 12;", "normalized_query": "select i.name, i.price from items i where i.id = ?;"}
    line = "1588748889250 [41-7] ann@shop LOG:  duration: 0.5 ms  execute get_1: select * from items /* trace_id='ab1', parent_id=\"cd2\" */"
    (t, d), = events(P.parse_postgresql(lines(spark, line), log_line_prefix="%n [%p-%l] %u@%d"))
    assert t == 1588748889250000 and d["trace.trace_id"] == "ab1" and d["trace.parent_id"] == "cd2" and d["tables"] == "items" and d["normalized_query"] == "select * from items"
    line = '[web] [9-1]  code = 00000 LOG:  duration: 88.125 ms  execute <unnamed>: DELETE FROM "old" WHERE "n" = 5'
    assert events(P.parse_postgresql(lines(spark, line), log_line_prefix="[%p-%l]  code = %e")) == []
    (t, d), = events(P.parse_postgresql(lines(spark, line), log_line_prefix="[web] [%p-%l]  code = %e"))
    assert t is None and d["sql_state"] == "00000" and d["normalized_query"] == "delete from ? where ? = ?"
    full = "2020-05-06 07:08:09.125 UTC [9-1] ann@shop (4/2) (77) (00000) (2020-05-06 07:00:00 UTC) (till)LOG:  duration: 1.0 ms  statement: select 1;"
    (t, d), = events(P.parse_postgresql(lines(spark, full), log_line_prefix="%m [%p-%l] %q%u@%d (%v) (%x) (%e) (%s) (%a)"))
    assert t == micros(2020, 5, 6, 7, 8, 9, 125000) and d["session_start"] == "2020-05-06 07:00:00 UTC" and d["application"] == "till" and d["transaction_id"] == "77"
    assert compile_line_prefix("%%t")[1] == ["timestamp"]


@pytest.mark.parametrize(("comment", "trace", "parent"), [
    ("/* parent_id='p' trace_id='t' */", "t", "p"), ("/* traceparent='00-aa-bb-01' */", "aa", "bb"), ("/* traceparent='0-aa-bb-01' */", None, None), ("/* trace_id='t' */", None, None), ("-- trace_id='t' parent_id='p'", None, None),
])
def test_trace_ids(spark, comment, trace, parent):
    got = trace_ids(F.lit(f"select 1 {comment}"))
    assert spark.range(1).select(got["trace.trace_id"], got["trace.parent_id"]).first()[:] == (trace, parent)


T1 = micros(2020, 5, 6, 7, 8, 9, 250000)


@pytest.mark.parametrize(("raw", "want", "t"), [
    (["# Time: 2020-05-06T07:08:09.250000Z", "# Query_time: 1.25  Lock_time: 0.5 Rows_sent: 3  Rows_examined: 40 Rows_affected: 2", "SELECT 7;"], {"query_time": 1.25, "lock_time": 0.5, "rows_sent": 3, "rows_examined": 40, "rows_affected": 2, "query": "SELECT 7", "normalized_query": "select ?", "statement": "select"}, T1),
    (["# Time: never Z", "# User@Host: ann[ann] @ till9 [203.0.113.5]  Id: 12", "SET timestamp=1588748889;", "show engines like 'x%';"], {"user": "ann", "client": "till9 [203.0.113.5]", "query": "show engines like 'x%'", "normalized_query": "show engines like ?", "statement": ""}, 1588748889000000),
    (["# Time: neverZ", "SET timestamp=1588748889;", "use shop;"], {"database": "shop", "query": "use shop", "normalized_query": "use shop"}, 1588748889000000),
    (["SET timestamp=1588748889;", "SELECT lost", "use shop;", "SELECT *", "FROM items WHERE", "price < 12;"], {"database": "shop", "query": "SELECT * FROM items WHERE price < 12", "normalized_query": "select * from items where price < ?", "tables": "items", "statement": "select"}, 1588748889000000),
    (["# Time: 2020-05-06T07:08:09.250000Z", "# User@Host: till @ shop-2 [203.0.113.6]  Id:   9", "SELECT /* a */ /* b */ * FROM items WHERE price < 12;"], {"user": "till", "client": "shop-2 [203.0.113.6]", "query": "SELECT /* a */ /* b */ * FROM items WHERE price < 12", "normalized_query": "select * from items where price < ?", "tables": "items", "comments": "/* a */ /* b */", "statement": "select"}, T1),
    (["# Time: 050620 07:08:09", "SELECT MAX(price) FROM items;"], {"query": "SELECT MAX(price) FROM items", "normalized_query": "select max(price) from items", "tables": "items", "statement": "select"}, micros(2020, 5, 6, 7, 8, 9)),
    (["# Time: x", "# QC_Hit: No  Full_scan: Yes  Full_join: No  Tmp_table: Yes  Tmp_table_on_disk: No", "# Filesort: Yes  Filesort_on_disk: No  Merge_passes: 4", "#   InnoDB_IO_r_ops: 5  InnoDB_IO_r_bytes: 6  InnoDB_IO_r_wait: 0.25", "#   InnoDB_rec_lock_wait: 0.5  InnoDB_queue_wait: 0.75", "#   InnoDB_pages_distinct: 8", "# InnoDB_trx_id: 1F2E", "# Bytes_sent: 9  Tmp_tables: 1  Tmp_disk_tables: 2  Tmp_table_sizes: 3", "# Schema: shop", "SELECT * FROM items WHERE kind='#';"],
     {"query_cache_hit": False, "full_scan": True, "full_join": False, "tmp_table": True, "tmp_table_on_disk": False, "filesort": True, "filesort_on_disk": False, "merge_passes": 4, "IO_r_ops": 5, "IO_r_bytes": 6, "IO_r_wait_sec": 0.25, "rec_lock_wait_sec": 0.5, "queue_wait_sec": 0.75, "pages_distinct": 8, "transaction_id": "1F2E",
      "bytes_sent": 9, "tmp_tables": 1, "tmp_disk_tables": 2, "tmp_table_sizes": 3, "query": "SELECT * FROM items WHERE kind='#'", "normalized_query": "select * from items where kind = ?", "tables": "items", "statement": "select"}, micros(2010, 6, 21, 15, 4, 5)),
])
def test_mysql(spark, raw, want, t):
    assert events(P.parse_mysql(lines(spark, *raw), now=NOW)) == [(t, want)]


def test_mysql_statements(spark):
    groups = spark.createDataFrame([(["SELECT * FROM a WHERE", "# Query_time: 1.5", "SELECT 2;"],), (["SELECT 3;", "# Time: x", "SELECT 4"],), (["SELECT 5", "# Time: x", "+ 6;;"],), (["SELECT 7"],), (["# administrator command: Ping;", "SELECT 8;"],)], "lines array<string>")
    got = [r["f"]["query"] for r in mysql_fields(groups).collect()]
    assert got == ["SELECT 2", "SELECT 3", "SELECT 5 + 6"]


def test_mysql_groups(spark):
    raw = ["/opt/my/sbin/mysqld, Version: 8.0 (MySQL Community Server - GPL). started with:", "Tcp port: 3307  Unix socket: /run/my", "Time                 Id Command    Argument",
           "# Time: 2020-05-06T07:08:09.250000Z", "SELECT a FROM b;", "", "# User@Host: u @ h [1]", "SELECT c FROM d;", "# administrator command: Ping;", "SELECT 1;", "# User@Host: last @ h [1]"]
    assert [d["query"] for d in data(P.parse_mysql(lines(spark, *raw), now=NOW))] == ["SELECT a FROM b", "SELECT c FROM d"]


def test_mysql_host(spark):
    v = spark.createDataFrame([("basedir", "/rdsdbbin/mysql"), ("read_only", "ON")], "name string, value string")
    s = spark.createDataFrame([(7,)], "Seconds_Behind_Master int")
    from cinderlog.sources.parsers.database import mysql_host

    got = data(P.parse_mysql(lines(spark, "# User@Host: u @ h [1]", "SELECT 1;"), host=mysql_host(v, s), now=NOW))[0]
    assert (got["hosted_on"], got["read_only"], got["replica_lag"], got["role"]) == ("rds", True, 7, "secondary")


def test_mongodb(spark):
    beat = 'Tue May  5 06:07:08.250 [conn31] command admin.$cmd command: replSetHeartbeat { replSetHeartbeat: "shop-rs", from: "till:1" } ntoreturn:1 keyUpdates:0 numYields:0  reslen:88 0ms'
    query = '2020-05-06T07:08:09.250+0200 [conn32] query shop.items query: { $query: { kind: { $nin: [ "x" ] } }, $orderby: { price: -1 } } planSummary: IXSCAN { kind: 1 } ntoskip:0 locks(micros) r:4321 nreturned:2 reslen:64 17ms'
    free = "2020-05-06T07:08:09.250Z W STORAGE [initandlisten] disk is nearly full"
    part = "2020-05-06T07:08:09.250Z I QUERY [conn33] query shop.items query: { kind: 4 "
    got = events(P.parse_mongodb(lines(spark, free, beat, query, "junk", part), now=NOW))
    assert got[0] == (micros(2020, 5, 6, 7, 8, 9, 250000), {"severity": "warning", "component": "STORAGE", "context": "initandlisten", "message": "disk is nearly full"})
    assert got[1][0] == micros(2010, 5, 5, 6, 7, 8, 250000) and got[1][1]["replica_set"] == "shop-rs"
    d = got[2][1]
    assert got[2][0] == micros(2020, 5, 6, 5, 8, 9, 250000) and d["replica_set"] == "shop-rs" and d["read_lock_held_us"] == 4321 and d["database"] == "shop" and d["normalized_query"] == '{ "kind": { "$nin": 1 } }' and d["duration_ms"] == 17.0
    assert len(got) == 3 and len(events(P.parse_mongodb(lines(spark, part), log_partials=True, now=NOW))) == 1


def test_mongo_changelog(spark):
    line = '2020-05-06T07:08:09.250Z I SHARDING [conn1] about to log metadata event into changelog: { _id: "till-7", server: "till", clientAddr: "198.51.100.9:1", time: new Date(1588748889250), what: "moveChunk.start", ns: "shop.items", details: { primary: "s1" } }'
    (_, d), = events(P.parse_mongodb(lines(spark, line), now=NOW))
    want = {"changelog_changeid": "till-7", "changelog_server": "till", "changelog_client_addr": "198.51.100.9:1", "changelog_what": "moveChunk.start", "changelog_primary": "s1", "database": "shop", "collection": "items"}
    assert {k: d.get(k) for k in want} == want and d["changelog_details"] == {"primary": "s1"} and "sharding_changelog" not in d


def test_mongo_shapes(spark):
    assert shape(parse_document("{ z: 1, y: { $gt: 4 }, x: [ 3 ] }")) == '{ "x": 1, "y": { "$gt": 1 }, "z": 1 }'
    assert shape({}) == "{  }"
    assert parse_document('{ msg: "she said "yes, now" and went", n: NumberLong(8), d: new Date(0), r: /c\\/d/m }') == {"msg": 'she said "yes, now" and went', "n": "NumberLong(8)", "d": "1970-01-01T00:00:00.000Z", "r": "/c\\/d/m"}
    df = spark.createDataFrame([("{ b: 1, a: 2 }",), ("{ b: ",), (None,)], "t string")
    assert [r[0] for r in df.select(shape_column(F.col("t"))).collect()] == ['{ "a": 1, "b": 1 }', None, None]


def test_csv_quotes(spark):
    run = lambda *x, **k: data(P.parse_csv(lines(spark, *x), now=NOW, fields="a,b", **k))
    said = ['"",b', '"""",b', '"x,y",b', '"x""y","b"', ",", 'a"x,b', '"a"x,b', ' "a",b', '"a,b']
    assert run(*said) == [{"a": a, "b": b} for a, b in [("", "b"), ('"', "b"), ("x,y", "b"), ('x"y', "b"), ("", "")]]
    assert run(' "a", b', ' "a,c",\t"b"', trim_leading_space=True) == [{"a": "a", "b": "b"}, {"a": "a,c", "b": "b"}]


def test_values_are_made_once(spark):
    """A filter on what a parser makes must not make it a second time."""
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    df = lines(spark, "x")
    assert plan(P.parse_mongodb(df, now=NOW)).count("ArrowEvalPython") == 1
    assert plan(P.parse_csv(df, fields="a,b", now=NOW)).count("regexp_extract_all(") == 1
