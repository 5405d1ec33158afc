import hashlib
import json
import os
import tempfile
import threading
import time
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from helpers import NOW, data, envelope, lines, micros
from pyspark.sql import functions as F

from cinderlog.plans import options, pipeline
from cinderlog.plans.options import Options
from cinderlog.sources import sinks, tail, text
from cinderlog.streaming import state


def test_excluded_paths():
    paths = ["/var/log/a.log", "/var/log/b.log", "/var/log/x/a.log", "/tmp/c.txt"]
    keep = lambda *p: text.prune(paths, p)
    assert keep("/var/log/*.log") == ["/var/log/x/a.log", "/tmp/c.txt"]
    assert keep("/var/*/?.log", "*.txt") == ["/var/log/x/a.log", "/tmp/c.txt"]
    assert keep("/var/log/[ab].log", "/tmp/*") == ["/var/log/x/a.log"]
    with pytest.raises(ValueError):
        keep("[bad")
    assert text.prune([*paths, "/tmp/a.tail.state", "/s"], statefile="/s") == paths


def test_state_paths(tmp_path):
    t = tempfile.gettempdir()
    assert text.state_path("/var/log/foo.log") == f"{t}/foo.tail.state"
    assert text.state_path("/var/log/foo") == f"{t}/foo.tail.state"
    assert text.state_path("/a/foo.log", "/x/state") == "/x/state"
    assert text.state_path("/a/foo.log", str(tmp_path), several=True) == f"{tmp_path}/foo.tail.state"
    assert text.state_path("/a/foo.log", str(tmp_path), hash_paths=True) == f"{tmp_path}/foo.tail.state-{hashlib.sha1(b'/a/foo.log').hexdigest()}"


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\r\ntwo\nthree")
    (tmp_path / "b.log").write_text("four\n\tfive\n\n")
    got = text.read_lines(spark, f"{tmp_path}/*.log").orderBy("source_file", "line_no").collect()
    assert [r["line"] for r in got] == ["one", "two", "three", "four", "\tfive", ""]
    got = text.read_ordered(spark, f"{tmp_path}/*.log").orderBy("source_file", "line_no").collect()
    assert [(os.path.basename(r["source_file"]), r["line"]) for r in got] == [("a.log", "one"), ("a.log", "two"), ("a.log", "three"), ("b.log", "four"), ("b.log", "\tfive"), ("b.log", "")]
    got = text.numbered(spark.createDataFrame([("f", "a\r\nb\n"), ("g", "\n\nc"), ("h", "")], "source_file string, value string")).collect()
    assert [tuple(r) for r in got] == [("f", 0, "a"), ("f", 1, "b"), ("g", 0, ""), ("g", 1, ""), ("g", 2, "c"), ("h", 0, "")]


def test_groups_of_a_file_in_many_splits(spark, tmp_path):
    (tmp_path / "s.log").write_text("".join(f"# User@Host: u{i} @ h [1]\nSELECT {i}\nFROM t;\n" for i in range(400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = pipeline.build(spark, Options(parser="mysql", files=[f"{tmp_path}/s.log"], backfill=True), now=NOW).select(F.try_variant_get(F.col("data")["query"], "$", "string")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r[0] for r in got) == sorted(f"SELECT {i} FROM t" for i in range(400))


def test_lookup_file(tmp_path):
    (tmp_path / "m.json").write_text('{"a":{"b":{"c":1}}}')
    (tmp_path / "bad.json").write_text('{"a":1}')
    assert text.read_lookup(str(tmp_path / "m.json")) == {"a": {"b": {"c": 1}}}
    with pytest.raises(ValueError):
        text.read_lookup(str(tmp_path / "bad.json"))


def test_start_offsets(tmp_path):
    log, saved = tmp_path / "x.log", tmp_path / "s"
    log.write_text("0123456789")
    at = lambda how: tail.start_offset(str(log), how, str(saved))
    assert (at("beginning"), at("start"), at("end"), at("last")) == (0, 0, 10, 10)
    saved.write_text(json.dumps({"INode": os.stat(log).st_ino, "Offset": 4}))
    assert at("last") == 4
    saved.write_text(json.dumps({"INode": 1, "Offset": 4}))
    assert at("last") == 0
    saved.write_text("{")
    assert at("last") == 10
    with pytest.raises(ValueError):
        at("middle")


def test_tail_follows_and_rotates(spark, tmp_path):
    spark.dataSource.register(tail.TailSource)
    log = tmp_path / "x.log"
    log.write_text("a\nb\npart")
    df = spark.readStream.format("tail").option("path", str(log)).option("read_from", "beginning").option("statefile", str(tmp_path / "state")).load()
    q = df.writeStream.format("memory").queryName("tailed").option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        q.processAllAvailable()
        with log.open("a") as f:
            f.write("ial\nc\n")
        q.processAllAvailable()
        log.rename(tmp_path / "x.log.1")
        log.write_text("new\n")
        q.processAllAvailable()
        assert sorted(r["line"] for r in spark.sql("select line from tailed").collect()) == ["a", "b", "c", "new", "partial"]
    finally:
        q.stop()


def stream(spark, tmp_path, schema, batches):
    src = tmp_path / "in"
    src.mkdir()
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(str(src / f"p{i}"))
    for i in range(len(batches)):
        for f in (src / f"p{i}").glob("*.parquet"):
            f.rename(src / f"{i}.parquet")
            os.utime(src / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src) + "/*.parquet")


def test_streamed_carry_forward(spark, tmp_path):
    schema = "source_file string, line_no long, value string"
    df = stream(spark, tmp_path, schema, [[("f", 0, None), ("f", 1, "a")], [("f", 2, None), ("g", 0, None)], [("f", 3, "b"), ("f", 4, None)]])
    q = state.carry_forward(df, "rs").writeStream.format("memory").queryName("carried").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination(120)
    got = {(r["source_file"], r["line_no"]): r["rs"] for r in spark.sql("select * from carried").collect()}
    assert got == {("f", 0): None, ("f", 1): "a", ("f", 2): "a", ("g", 0): None, ("f", 3): "b", ("f", 4): "b"}


def test_streamed_groups(spark, tmp_path):
    schema = "source_file string, line_no long, line string"
    df = stream(spark, tmp_path, schema, [[("f", 0, "# Time: x"), ("f", 1, "SELECT")], [("f", 2, "1;"), ("f", 3, "# Time: y")], [("f", 4, "SELECT 2;"), ("f", 5, "# Time: z")]])
    q = state.line_groups(df, "slow_log", flush_ms=2_000).writeStream.format("memory").queryName("grouped").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        for _ in range(240):  # batches that look at timeouts go on until the query is stopped
            time.sleep(0.5)
            got = [(r["line_no"], r["lines"]) for r in spark.sql("select * from grouped").orderBy("line_no").collect()]
            if len(got) >= 2:
                time.sleep(4)  # the last group, a comment alone, times out and goes
                got = [(r["line_no"], r["lines"]) for r in spark.sql("select * from grouped").orderBy("line_no").collect()]
                break
        assert q.exception() is None
    finally:
        q.stop()
    assert got == [(0, ["# Time: x", "SELECT", "1;"]), (3, ["# Time: y", "SELECT 2;"])]


def test_options():
    o = options.prepared(Options(parser="nginx", files=["x"], backfill=True, log_prefix=r"(?P<a>x)"))
    assert (o.read_from, o.stop, o.backoff, o.request_shape, o.log_prefix, o.tail_sample) == ("beginning", True, True, ["request"], r"^(?P<a>x)", True)
    o = options.prepared(Options(parser="json", files=["x"], samplerate=9, dynsampling=["k"]))
    assert (o.samplerate, o.goal_samplerate, o.tail_sample) == (1, 9, False)
    assert not options.prepared(Options(parser="mysql", files=["x"])).tail_sample
    bad = [{"parser": "zz"}, {"files": []}, {"samplerate": 0}, {"deterministic_sampling": "k"}, {"dynsampling": ["a"], "deterministic_sampling": "b", "samplerate": 3}, {"presampled": "r", "samplerate": 2}, {"request_parse_query": "x"}, {"read_from": "end", "stop": True}, {"read_from": "x"}, {"log_prefix": "("}, {"add_fields": ["x"]}, {"rename_fields": ["a=b=c"]}]
    for kw in bad:
        with pytest.raises(ValueError):
            options.prepared(Options(**{"parser": "json", "files": ["x"], **kw}))


def test_option_files():
    o = Options(parser="csv", files=["a.log", "b.log"], samplerate=4, backfill=True, add_fields=["x=y"], parser_options={"fields": "a,b"})
    assert options.from_ini(options.to_ini(o)) == o
    assert options.from_yaml(options.to_yaml(o)) == o


def test_whole_plan(spark):
    raw = ['{"time":"2021-03-04T05:06:07Z","request":"GET /a?b=1 HTTP/1.1","user":"u1","j":"{\\"k\\":1}"}', "junk"]
    o = Options(parser="json", files=["-"], read_from="beginning", request_shape=["request"], request_query_keys=["b"], drop_fields=["request"], scrub_fields=["user"], add_fields=["env=p"], json_fields=["j"], rename_fields=["j=doc"], rebase_time=True)
    r = pipeline.build(spark, o, lines(spark, *raw[:1]), NOW).select(F.unix_micros("time").alias("t"), "samplerate", F.to_json("data").alias("d")).first()
    d = json.loads(r["d"])
    assert r["t"] == micros(2010, 6, 21, 15, 4, 5) and r["samplerate"] == 1
    assert d == {"request_method": "GET", "request_protocol_version": "HTTP/1.1", "request_uri": "/a?b=1", "request_path": "/a", "request_query": "b=1", "request_query_b": "1", "request_pathshape": "/a", "request_queryshape": "b=?", "request_shape": "/a?b=?", "user": hashlib.sha256(b"u1").hexdigest(), "env": "p", "doc": {"k": 1}}


def test_plan_over_files(spark, tmp_path):
    (tmp_path / "a.log").write_text("# Time: 2020-05-06T07:08:09.250000Z\nSELECT a FROM b;\n# User@Host: u @ h [1]\nSELECT c FROM d;\n")
    (tmp_path / "b.log").write_text("# User@Host: u @ h [1]\nSELECT e FROM f;\n# Time: x\n")
    got = pipeline.build(spark, Options(parser="mysql", files=[f"{tmp_path}/*.log"], backfill=True), now=NOW).select(F.try_variant_get(F.col("data")["query"], "$", "string")).collect()
    assert sorted(r[0] for r in got) == ["SELECT a FROM b", "SELECT c FROM d", "SELECT e FROM f"]


def plain(df):
    return sorted(r[0] for r in df.select(F.to_json("data")).collect())


def test_where_reading_starts(spark, tmp_path):
    log, saved = tmp_path / "x.log", tmp_path / "pos"
    log.write_text("".join(f'{{"n":{i}}}\n' for i in range(6)) + '{"n":6}')
    o = Options(parser="json", files=[str(log)], statefile=str(saved), stop=True)
    assert plain(pipeline.build(spark, o, now=NOW)) == []  # last, and nothing saved: the end
    saved.write_text(json.dumps({"INode": os.stat(log).st_ino, "Offset": 16}))
    assert plain(pipeline.build(spark, o, now=NOW)) == [f'{{"n":{i}.0}}' for i in range(2, 7)]
    saved.write_text(json.dumps({"INode": 1, "Offset": 16}))
    assert len(plain(pipeline.build(spark, o, now=NOW))) == 7  # another file took its place
    assert len(plain(pipeline.build(spark, Options(parser="json", files=[str(log)], read_from="beginning"), now=NOW))) == 7
    with pytest.raises(ValueError):
        pipeline.build(spark, Options(parser="json", files=[f"{tmp_path}/none.log"], filter_files=["*", "/*/*/*", str(tmp_path / "none.log")]), now=NOW)


def test_spans_of_a_batch(tmp_path):
    log = tmp_path / "x.log"
    log.write_text("ab\n" + "c" * 50 + "\nd\ne")
    reader = tail.TailBatch({"path": str(log), "read_from": "beginning", "max_bytes_per_file": "5"})
    spans = reader.partitions()
    assert [(s.start, s.end) for s in spans][0] == (0, 3) and spans[-1].end == log.stat().st_size
    assert [x for s in spans for _, _, x in reader.read(s)] == ["ab", "c" * 50, "d", "e"]
    r = tail.TailReader({"path": str(log), "read_from": "beginning", "max_bytes_per_file": "5"})
    r.initialOffset()
    ends = [r.latestOffset()[str(log)]["off"] for _ in range(3)]
    assert ends == [3, 56, 56]  # a line longer than the window does not stop it


@pytest.mark.parametrize(("parser", "first", "then", "want"), [
    ("json", '{"a":1}\n', '{"a":2}\n', ['{"a":1}', '{"a":2}']),
    ("mysql", "# User@Host: u @ h [1]\nSELECT 1\n", "FROM t;\n# User@Host: v @ h [1]\nSELECT 2;\n# User@Host: w @ h [1]\nSELECT 3;\n", ["SELECT 1 FROM t", "SELECT 2"]),
])
def test_follow(spark, tmp_path, parser, first, then, want):
    log, got = tmp_path / "x.log", []
    log.write_text(first)
    field = "query" if parser == "mysql" else None
    sink = lambda df: got.extend(r[0] for r in df.select(F.try_variant_get(F.col("data")["query"], "$", "string") if field else F.to_json("data")).collect())
    q = pipeline.follow(spark, Options(parser=parser, files=[str(log)], read_from="beginning"), sink, str(tmp_path / "ck"), NOW)
    try:
        for _ in range(60):  # batches that only look at timeouts never end, so that processAllAvailable() would wait for ever
            time.sleep(0.5)
            if then and q.lastProgress:
                with log.open("a") as f:
                    f.write(then)
                then = ""
            if len(got) >= len(want):
                break
        assert q.exception() is None and sorted(x.replace(".0", "") for x in got) == want
    finally:
        q.stop()


@pytest.mark.parametrize("parser", ["mysql", "postgresql"])
def test_follow_refuses_to_stop_in_groups(spark, tmp_path, parser):
    with pytest.raises(ValueError, match="build"):
        pipeline.follow(spark, Options(parser=parser, files=[str(tmp_path / "x.log")], backfill=True), print, str(tmp_path / "ck"), NOW)


def test_rebase_sees_unsampled_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text("".join(f'{{"time":"2021-03-04T05:06:{i:02d}Z","n":{i}}}\n' for i in range(50)))
    o = Options(parser="json", files=[f"{tmp_path}/a.log"], backfill=True, rebase_time=True, samplerate=10, seed=3)
    got = pipeline.build(spark, o, now=NOW).select(F.unix_micros("time"), F.try_variant_get(F.col("data")["n"], "$", "int")).collect()
    assert 0 < len(got) < 30 and all(t == micros(2010, 6, 21, 15, 4, 5) - (49 - n) * 1_000_000 for t, n in got)
    with pytest.raises(ValueError):
        pipeline.build(spark, Options(parser="json", files=[f"{tmp_path}/none.log"], backfill=True, rebase_time=True), now=NOW)


def test_parser_options_from_files_and_servers(spark, tmp_path):
    (tmp_path / "n.conf").write_text("log_format short '$a $b';")
    o = Options(parser="nginx", files=["-"], parser_options={"conf": str(tmp_path / "n.conf"), "format": "short"})
    assert plain(pipeline.build(spark, o, lines(spark, "x 5"), NOW)) == ['{"a":"x","b":5}']
    host = spark.createDataFrame([("rds", True)], "hosted_on string, read_only boolean")
    got = pipeline.build(spark, Options(parser="mysql", files=["-"]), lines(spark, "# User@Host: u @ h [1]", "SELECT 1;"), NOW, host)
    assert json.loads(plain(got)[0])["hosted_on"] == "rds"


def test_events_are_retried_one_by_one(spark):
    e = envelope(spark, *({"i": i} for i in range(4))).withColumn("sample_rate", F.lit(1)).coalesce(1)

    def poster(url, body, headers):
        import builtins

        seen = builtins.__dict__.setdefault("_cinderlog_seen", {})
        out = []
        for x in json.loads(body):
            n = seen[x["data"]["i"]] = seen.get(x["data"]["i"], 0) + 1
            out.append({"status": 202 if x["data"]["i"] != 2 or n > 12 else 429})
        return 200, json.dumps(out)

    got = sinks.send(e, sinks.batch_url("http://h/", "a b/c"), batch=4, backoff=True, delay=0.0001, poster=poster).collect()
    assert sorted(r["status"] for r in got) == [202] * 4 and sinks.batch_url("http://h/", "a b/c") == "http://h/1/batch/a%20b%2Fc"
    got = sinks.send(e, "u", batch=4, backoff=True, delay=0.0001, most_tries=2, poster=lambda u, b, h: (500, "")).collect()
    assert [r["status"] for r in got] == [500] * 4
    o = Options(parser="json", files=["-"], api_host="http://h", dataset="d", status_interval=60)
    rows = e.select(F.col("timestamp").alias("time"), F.col("sample_rate").alias("samplerate"), "data")
    total = pipeline.status(pipeline.deliver(rows, o, poster=lambda u, b, h: (200 if u == "http://h/1/batch/d" else 404, "")), o).collect()
    assert [(r["count"], r["by_status"]) for r in total] == [(4, {"200": 4})]


def test_command_line(spark, tmp_path, capsys):
    from cinderlog.__main__ import main, read

    assert main(["--list"]) == 0 and "mysql" in capsys.readouterr().out.split()
    (tmp_path / "c.ini").write_text("[options]\nparser = json\nsamplerate = 4\nfiles = a.log\n")
    o, _ = read(["-c", str(tmp_path / "c.ini"), "-r", "2", "--scrub_fields", "a", "--scrub_fields", "b", "--backfill", "-o", "timefield=t"])
    assert (o.parser, o.samplerate, o.files, o.scrub_fields, o.backfill, o.parser_options) == ("json", 2, ["a.log"], ["a", "b"], True, {"timefield": "t"})
    assert main(["-p", "json"]) == 2 and main(["-p", "json", "-f", "x"]) == 2
    capsys.readouterr()
    assert main(["-c", str(tmp_path / "c.ini"), "--write_current_yaml"]) == 0 and options.from_yaml(capsys.readouterr().out).samplerate == 4
    (tmp_path / "x.log").write_text('{"n":1}\n')
    assert main(["-p", "json", "-f", str(tmp_path / "x.log"), "--backfill", "--debug_stdout"]) == 0
    assert json.loads(capsys.readouterr().out)["data"] == {"n": 1.0}
    assert main(["-p", "json", "-f", str(tmp_path / "x.log"), "--backfill", "--output", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_http_sink(spark):
    bodies, answers = [], [429, 500]

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            status = answers.pop() if answers else 200
            if status == 200:
                bodies.append(body)
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps([{"status": 202}] * len(body) if status == 200 else {"error": "x"}).encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    e = envelope(spark, *({"i": i} for i in range(5))).withColumn("sample_rate", F.when(F.col("line_no") == 2, -1).otherwise(3)).coalesce(1)
    got = sinks.send(e, f"http://127.0.0.1:{server.server_port}/1/batch/d", {"X-Key": "k"}, batch=3, backoff=True, delay=0.001).collect()
    server.shutdown()
    assert [len(b) for b in bodies] == [3, 1] and {x["samplerate"] for b in bodies for x in b} == {3} and set(bodies[0][0]) == {"data", "samplerate", "time"}
    assert [r["status"] for r in got] == [202] * 4


def test_table_sink(spark, tmp_path):
    sinks.write_table(envelope(spark, {"a": 1}), str(tmp_path / "out"))
    r = spark.read.parquet(str(tmp_path / "out")).first()
    assert (r["samplerate"], json.loads(r["data"])) == (1, {"a": 1.0})
    assert data(envelope(spark, {"a": 1})) == [{"a": 1.0}]
