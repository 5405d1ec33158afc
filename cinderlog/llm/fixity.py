"""Operator 5: Merkle fixity audit of WARC replicas.

Each record is hashed; ordered ranges of byte offsets make a tree above the records: a leaf covers RANGE bytes of a file,
a node FAN children, a file's root all of it, and files are children of the archive's levels in turn. Two
replicas are compared from the root: only children of nodes that differ are looked at, down to the records.
Replicas are indexed each from its own records or stored files, so that a lost record moves those behind it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read

#: Bytes of a file that a leaf covers, children of a node, levels of nodes in a file above its leaves.
RANGE, FAN, LEVELS = 1 << 16, 16, 3
#: Records that a file holds, about.
PER_FILE = 2048
#: Files whose roots are broadcast.
ROOTS = 100_000


def record(url: Column, body: Column) -> Column:
    """A WARC resource record, as a string of its bytes."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:sha256:"), F.sha2(F.concat(F.coalesce(url, F.lit("")), F.lit("\n"), body), 256),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def files_for(rows: int) -> int:
    return max(1, -(-rows // PER_FILE))


def _placed(pages: DataFrame, files: int, copy: Column | None = None) -> DataFrame:
    """pages (page_id, url, html, ...): (page_id, file, offset, length, sha256), and the same of a replica whose records are ``copy`` (null: lost).

    A file takes records by the hash of their ids and bytes, in the order of id, then bytes' hash; only hashes and lengths move.
    """
    r = record(F.col("url"), F.col("html"))
    both = {"length": F.octet_length(r).cast("long"), "sha256": F.sha2(r, 256)}
    if copy is not None:
        both |= {"copy_length": F.octet_length(copy).cast("long"), "copy_sha256": F.sha2(copy, 256)}
    narrow = pages.select(F.col("page_id"), *(c.alias(k) for k, c in both.items()))
    file = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "sha256")), 1, 8), 16, 10).cast("long") % files
    before = Window.partitionBy("file").orderBy(F.col("page_id").isNull(), "page_id", "sha256").rowsBetween(Window.unboundedPreceding, -1)
    start = lambda length: F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long")
    out = narrow.withColumn("file", file).withColumn("offset", start("length"))
    return out if copy is None else out.withColumn("copy_offset", start("copy_length"))


def index(pages: DataFrame, files: int) -> DataFrame:
    """pages (page_id, url, html, ...): (page_id, file, offset, length, sha256): where each record lies in its file.

    Defined cases: null texts are empty; null, repeated and equal rows are records of their own; other columns are not read.
    """
    return _placed(pages, files).select("page_id", "file", "offset", "length", "sha256")


def write_archive(pages: DataFrame, files: int, path: str) -> None:
    """Writes the records as WARC files, path/file=<number>/, in the order that index() gives them."""
    r = record(F.col("url"), F.col("html"))
    file = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.sha2(r, 256))), 1, 8), 16, 10).cast("long") % files
    rows = pages.select("page_id", r.alias("r"), file.alias("file")).withColumn("h", F.sha2("r", 256))
    rows = rows.repartition(files, "file").sortWithinPartitions("file", F.col("page_id").isNull(), "page_id", "h")
    rows.select(F.expr("left(r, length(r) - 1)").alias("value"), "file").write.partitionBy("file").text(path)  # the writer ends each row with the line end that is cut here


def index_archive(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, sha256) of the records in the stored files path/file=<number>/*: what the bytes say.

    A file is read whole by one task, so that it must fit in its memory. Bytes that are no record are one, up to the next that begins like one or the end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, x in zip(b["file"].to_pylist(), b["content"].to_pylist(), strict=True):
                at, rows = 0, []
                while at < len(x):
                    end = _record_end(x, at)
                    rows.append((file, at, end - at, hashlib.sha256(x[at:end]).hexdigest()))
                    at = end
                yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["file", "offset", "length", "sha256"])

    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    number = F.regexp_extract("path", "file=([0-9]+)/", 1).try_cast("long")
    return stored.select(number.alias("file"), "content").mapInArrow(run, "file long, offset long, length long, sha256 string")


def _record_end(x: bytes, at: int) -> int:
    head = x.find(b"\r\n\r\n", at)
    if x.startswith(b"WARC/", at) and head >= 0:
        for line in x[at:head].split(b"\r\n"):
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                end = head + 4 + int(value) + 4
                if x[end - 4 : end] == b"\r\n\r\n":
                    return end
    following = x.find(b"\r\n\r\nWARC/", at)
    return following + 4 if following >= 0 else len(x)


def tree(records: DataFrame) -> list[DataFrame]:
    """records (replica, file, offset, length, sha256): levels from leaves to the archives' roots, each (replica, file, node, hash).

    Level 0 to LEVELS divide a file by offset; the last of them is its root, whatever the size. The levels
    above it divide the files by number until one node is left. A leaf covers RANGE bytes and a node FAN nodes, which bounds what a row gathers.
    """
    text = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "sha256")
    ordered = lambda key, x: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, x.alias("x")))), lambda y: y["x"]), ","), 256).alias("hash")
    level = records.groupBy("replica", "file", F.floor(F.col("offset") / RANGE).alias("node")).agg(ordered(F.col("offset"), text))
    out = [materialize(level, "leaves")]
    for k in range(1, LEVELS + 1):
        node = F.lit(0).cast("long") if k == LEVELS else F.floor(F.col("node") / FAN)
        out.append(out[-1].groupBy("replica", "file", node.alias("up")).agg(ordered(F.col("node"), F.concat_ws(":", F.col("node").cast("string"), "hash"))).withColumnRenamed("up", "node"))
    out[-1] = materialize(out[-1], "roots")
    files = out[-1].agg(F.max("file")).first()[0] or 0
    while files > 0:
        up = out[-1].groupBy("replica", F.floor(F.col("file") / FAN).alias("up")).agg(ordered(F.col("file"), F.concat_ws(":", F.col("file").cast("string"), "hash")))
        out.append(up.select("replica", F.col("up").alias("file"), F.lit(0).cast("long").alias("node"), "hash"))
        files //= FAN
    return out


def differing(level: DataFrame) -> DataFrame:
    """(file, node) that either replica lacks or that differ."""
    of = lambda n: F.min(F.when(F.col("replica") == n, F.col("hash")))
    return level.groupBy("file", "node").agg(of(0).alias("a"), of(1).alias("b")).where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node")


def audit(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """a, b (file, offset, length, sha256): a's file roots (file, root), and the damage: (file, offset, status).

    status of an offset where the replicas differ: moved (what a has there lies in b's file at an offset where a has other bytes), altered (b has
    other bytes there), missing (b has none, or a record of a's that moved), or extra (only b has a record there, and it isn't one of a's that moved). Defined
    cases: equal roots leave nothing to look at; a record given twice at an offset counts with all its hashes; two empty replicas agree.
    """
    every = a.select(F.lit(0).alias("replica"), "file", "offset", "length", "sha256").unionByName(b.select(F.lit(1).alias("replica"), "file", "offset", "length", "sha256"))
    levels = tree(every)
    roots = levels[LEVELS].where("replica = 0").select("file", F.col("hash").alias("root"))
    bad = differing(levels[-1])
    for k in range(len(levels) - 2, -1, -1):
        if k >= LEVELS:
            up = (F.floor(F.col("file") / FAN).alias("file"), F.lit(0).cast("long").alias("node"))
        else:
            up = (F.col("file"), F.lit(0).cast("long").alias("node") if k + 1 == LEVELS else F.floor(F.col("node") / FAN).alias("node"))
        parents = bad.select(F.struct("file", "node").alias("up"))
        below = levels[k].select("replica", "file", "node", "hash", F.struct(*up).alias("up")).join(parents, "up", "left_semi").drop("up")
        bad = differing(below)
    bad = materialize(bad, "bad")
    own = every.withColumn("node", F.floor(F.col("offset") / RANGE)).join(bad, ["file", "node"], "left_semi")
    held = lambda n: F.array_sort(F.collect_list(F.when(F.col("replica") == n, F.struct("length", "sha256"))))
    apart = own.groupBy("file", "offset").agg(held(0).alias("x"), held(1).alias("y")).where("x <> y")
    apart = materialize(apart.withColumn("i", F.monotonically_increasing_id()), "apart")
    found = lambda c: apart.select("i", "file", F.explode(c).alias("r"))
    of_a, of_b = found("x"), found("y")
    gone = of_a.join(of_b.select("file", "r").distinct(), ["file", "r"], "left_semi").select("i").distinct().withColumn("went", F.lit(True))
    came = of_b.join(of_a.select("file", "r").distinct(), ["file", "r"], "left_semi").select("i").distinct().withColumn("came", F.lit(True))
    j = apart.join(gone, "i", "left").join(came, "i", "left")
    status = F.when(F.size("x") == 0, F.when(F.col("came").isNull(), "extra")).when(F.col("went"), "moved").when((F.size("y") == 0) | F.col("came"), "missing").otherwise("altered")
    return roots, j.select("file", "offset", status.alias("status")).where("status is not null")


def damaged(url: Column, html: Column, page_id: Column) -> Column:
    """The query's second replica: by a hash of the id, about one record in a hundred has another first byte, and one in a thousand is lost (null)."""
    kind = F.conv(F.substring(F.md5(F.concat(F.lit("rot"), F.coalesce(page_id.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("long")
    r = record(url, html)
    return F.when(kind % 997 == 280, F.lit(None)).when(kind % 97 == 5, F.concat(F.lit("V"), F.substring(r, 2, 1 << 30))).otherwise(r)


def op5_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    both = materialize(_placed(pages, files_for(pages.count()), damaged(F.col("url"), F.col("html"), F.col("page_id"))), "index")
    a = both.select("file", "offset", "length", "sha256")
    b = both.where("copy_sha256 is not null").select("file", *(F.col(f"copy_{c}").alias(c) for c in ("offset", "length", "sha256")))
    roots, damage = audit(a, b)
    out = both.join(damage.where("status <> 'extra'"), ["file", "offset"], "left").join(F.broadcast(roots) if roots.count() <= ROOTS else roots, "file", "left")
    return out.select("page_id", "file", "offset", "length", "sha256", F.coalesce("status", F.lit("intact")).alias("status"), "root")


def sql() -> str:
    """DuckDB SQL: the same records, offsets, statuses and file roots."""
    body = "'WARC/1.1' || crlf || 'WARC-Type: resource' || crlf || 'WARC-Record-ID: <urn:sha256:' || sha256(coalesce(url, '') || chr(10) || coalesce(html, '')) || '>' || crlf || 'WARC-Target-URI: ' || coalesce(url, '') || crlf || 'Content-Type: text/html' || crlf || 'Content-Length: ' || strlen(coalesce(html, '')) || crlf || crlf || coalesce(html, '') || crlf || crlf"
    levels = "".join(
        f",\nl{k} as (select file, {'0' if k == LEVELS else f'node // {FAN}'} as node, sha256(string_agg(node || ':' || hash, ',' order by node)) as hash from l{k - 1} group by all)" for k in range(1, LEVELS + 1)
    )
    return f"""
with n as (select greatest(1, (count(*) + {PER_FILE} - 1) // {PER_FILE}) as files from pages),
bodies as (select page_id, {body} as r from pages, (select chr(13) || chr(10) as crlf)),
hashed as (select page_id, strlen(r)::bigint as length, sha256(r) as sha256, sha256('V' || substr(r, 2)) as rotten, ('0x' || substr(md5('rot' || coalesce(page_id::varchar, '')), 1, 8))::bigint as kind from bodies),
records as (select *, case when kind % 997 <> 280 then length end as copy_length, case when kind % 997 = 280 then null when kind % 97 = 5 then rotten else sha256 end as copy_sha256, (('0x' || substr(md5(coalesce(page_id::varchar, '') || ':' || sha256), 1, 8))::bigint % (select files from n))::bigint as file from hashed),
placed as (select *, coalesce(sum(length) over w, 0)::bigint as "offset", coalesce(sum(copy_length) over w, 0)::bigint as copy_offset from records
  window w as (partition by file order by page_id is null, page_id, sha256 rows between unbounded preceding and 1 preceding)),
l0 as (select file, "offset" // {RANGE} as node, sha256(string_agg("offset" || ':' || length || ':' || sha256, ',' order by "offset")) as hash from placed group by all){levels},
copies as (select file, copy_offset as "offset", copy_length as length, copy_sha256 as sha256 from placed where copy_sha256 is not null),
stays as (select p.file, p."offset" from placed p join copies c on p.file = c.file and p."offset" = c."offset" and p.length = c.length and p.sha256 = c.sha256),
elsewhere as (select distinct c.file, c.sha256 from copies c anti join stays s on c.file = s.file and c."offset" = s."offset"),
gone as (select distinct p.file, p.sha256 from placed p anti join stays s on p.file = s.file and p."offset" = s."offset"),
taken as (select distinct c.file, c."offset" from copies c anti join gone g on c.file = g.file and c.sha256 = g.sha256)
select p.page_id, p.file, p."offset", p.length, p.sha256, case when s.file is not null then 'intact' when e.file is not null then 'moved' when t.file is not null then 'altered' else 'missing' end as status, l.hash as root
from placed p join l{LEVELS} l on p.file = l.file left join stays s on p.file = s.file and p."offset" = s."offset" left join elsewhere e on p.file = e.file and p.sha256 = e.sha256 left join taken t on p.file = t.file and p."offset" = t."offset"
"""
