"""Operator 10: lines that repeat across documents stay in one document only.

Two Bloom filters (one hash, as bitmaps) hold the keys seen once and seen twice. Only lines that the
second one holds are suspects; only suspects shuffle, as 128-bit digests of their keys, for exact
confirmation and the choice of the smallest document. Confirmed keys, up to a bounded number, go back to the documents by
broadcast; where there are more, the documents that may lose a line, and only these, are joined with what they lose.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NO_ID, materialize, partitions, read, slices

#: Keys shorter than this many code points never go.
LEAST = 10
#: Bits of a segment of the filters.
SEGMENT = 1 << 20
#: Bits of a filter: 256 for each document, within these bounds (32 MB at most, in the driver and each worker). Beyond the
#: upper one more lines are suspects than need be; the result is the same.
BITS = (1 << 22, 1 << 28)
#: Confirmed keys that are broadcast, 24 bytes each.
KEYS = 1 << 20


def keys(text: bytes, least: int) -> list[bytes | None]:
    """The key of each line, None where it is too short."""
    out = []
    for line in text.split(b"\n"):
        k = line.strip().lower()
        out.append(k if len(k) >= 4 * least or len(k) >= least and len(k.decode("utf-8", "replace")) >= least else None)
    return out


def _digest(key: bytes) -> bytes:
    return hashlib.md5(key, usedforsecurity=False).digest()


def _texts(b: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in b["text"].to_pylist()]


def twice_seen(docs: DataFrame, least: int, bits: int) -> bytes:
    """The second filter's bits. docs (doc_id, text binary)."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            at = [np.fromiter({xxhash.xxh3_64_intdigest(k) % bits for k in keys(x, least) if k is not None}, np.int64) for x in _texts(b)]
            where, times = np.unique(np.concatenate(at), return_counts=True)
            cuts = np.searchsorted(where, np.arange(0, bits + 1, SEGMENT))
            full = np.nonzero(np.diff(cuts))[0]
            local = [((where[cuts[s] : cuts[s + 1]] - s * SEGMENT).astype("<u4"), times[cuts[s] : cuts[s + 1]] > 1) for s in full.tolist()]
            yield pa.record_batch({"segment": pa.array(full, pa.int32()), "once": pa.array([x.tobytes() for x, _ in local], pa.binary()), "twice": pa.array([x[t].tobytes() for x, t in local], pa.binary())})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for b in batches:
            for s, x, y in zip(*(b[c].to_pylist() for c in ("segment", "once", "twice")), strict=True):
                if s not in once:
                    once[s], twice[s] = np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
                at = np.frombuffer(x, "<u4")
                twice[s][at[once[s][at]]] = True
                once[s][at] = True
                twice[s][np.frombuffer(y, "<u4")] = True
        if once:
            yield pa.record_batch({"segment": pa.array(list(twice), pa.int32()), "bits": pa.array([np.packbits(x).tobytes() for x in twice.values()], pa.binary())})

    spread = docs.mapInArrow(seen, "segment int, once binary, twice binary").repartition(partitions(docs.sparkSession), "segment")
    table = bytearray(bits // 8)  # of bounded size, whatever the input
    for s, x in spread.mapInArrow(merged, "segment int, bits binary").toLocalIterator():
        table[s * SEGMENT // 8 : s * SEGMENT // 8 + len(x)] = x
    return bytes(table)


def _held(table: bytes, own: list[bytes], bits: int) -> list[bytes]:
    """Of own keys those whose bit is set."""
    if not own:
        return own
    at = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)) % np.uint64(bits)
    hit = np.frombuffer(table, np.uint8)[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1
    return [own[j] for j in np.nonzero(hit)[0].tolist()]


def dedup_lines(docs: DataFrame, least: int = LEAST, bits: int | None = None, most: int = KEYS) -> DataFrame:
    """docs (doc_id long, text string, ...): one row for each row of docs, all columns kept, text without the
    dropped lines, and two more columns: n_lines, n_dropped (long).

    Defined cases: null or empty text is one empty line and comes back as an empty text; rows that share a doc_id are one
    document, and so are all rows without one, which ranks after all others; extra columns pass through, whatever their names, but
    those named n_lines or n_dropped are replaced. No row gathers more than the lines of one text.
    """
    spark = docs.sparkSession
    if bits is None:
        bits = min(max(BITS[0], 1 << (256 * max(docs.count(), 1) - 1).bit_length()), BITS[1])
    if bits & (bits - 1) or bits < SEGMENT:
        raise ValueError(f"bits must be a power of two, {SEGMENT} at least")
    rest = [f for f in docs.schema.fields if f.name not in ("text", "n_lines", "n_dropped")]
    # everything but the text goes in one column, so that no name can clash
    packed = docs.select(F.struct(*(docs[f"`{f.name}`"] for f in rest)).alias("row"), F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc_id"), docs["text"].cast("binary").alias("text"))
    packed = packed.withColumn("key", F.xxhash64("doc_id", "text"))
    table = spark.sparkContext.broadcast(twice_seen(packed.select("doc_id", "text"), least, bits))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, of, found = [], [], []
            for i, k, x in zip(b["doc_id"].to_pylist(), b["key"].to_pylist(), _texts(b), strict=True):
                held = _held(table.value, list({k for k in keys(x, least) if k is not None}), bits)
                found += map(_digest, held)
                ids += [i] * len(held)
                of += [k] * len(held)
            yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "key": pa.array(of, pa.int64()), "digest": pa.array(found, pa.binary())})

    hits = materialize(packed.select("doc_id", "key", "text").mapInArrow(suspects, "doc_id long, key long, digest binary"), "suspects")
    repeats = hits.groupBy("digest").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last")).where("keeper < last").drop("last")
    repeats = materialize(repeats, "repeats")
    few = repeats.count() <= most
    kept_by = None
    if few:
        got = repeats.toArrow()  # at most ``most`` rows
        digest = np.array(got["digest"].to_pylist(), "S16")
        order = np.argsort(digest)
        kept_by = spark.sparkContext.broadcast((digest[order], got["keeper"].to_numpy()[order]))

    def lost(i: int, x: bytes) -> set[bytes]:
        """Digests of the lines that another document keeps."""
        known, keeper = kept_by.value
        own = list(map(_digest, _held(table.value, list({k for k in keys(x, least) if k is not None}), bits)))
        if not own or not len(known):
            return set()
        at = np.minimum(np.searchsorted(known, np.array(own, "S16")), len(known) - 1)
        return {d for d, s, k in zip(own, known[at].tolist(), keeper[at].tolist(), strict=True) if k != i and s == d.rstrip(b"\0")}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, lines, dropped = [], [], []
            told = b["lost"].to_pylist() if "lost" in b.schema.names else [None] * b.num_rows
            for i, x, gone in zip(b["doc_id"].to_pylist(), _texts(b), told, strict=True):
                own = x.split(b"\n")
                gone = set(gone or ()) if kept_by is None else lost(i, x)
                kept = [line for line, k in zip(own, keys(x, least), strict=True) if k is None or _digest(k) not in gone] if gone else own
                texts.append(b"\n".join(kept))
                lines.append(len(own))
                dropped.append(len(own) - len(kept))
            yield pa.record_batch({"row": b["row"], "text": pa.array(texts, pa.binary()), "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())})

    out = T.StructType([packed.schema["row"], T.StructField("text", T.BinaryType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    if few:
        done = packed.mapInArrow(cut, out)
    else:
        losers = materialize(hits.join(repeats, "digest").where("doc_id <> keeper").groupBy("key").agg(F.collect_set("digest").alias("lost")), "losers")
        marks = spark.sparkContext.broadcast(_marks(losers, bits))

        @F.pandas_udf("boolean")
        def may_lose(key: pd.Series) -> pd.Series:
            at = key.to_numpy().view(np.uint64) % np.uint64(bits)
            return pd.Series((np.frombuffer(marks.value, np.uint8)[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1).astype(bool))

        done = packed.where(~may_lose("key")).mapInArrow(cut, out).unionByName(packed.where(may_lose("key")).join(losers, "key", "left").mapInArrow(cut, out))
    own = {f.name: F.col("row").getField(f.name).alias(f.name) for f in rest} | {"text": F.col("text").cast("string").alias("text")}
    return done.select(*(own[c] for c in docs.columns if c in own), "n_lines", "n_dropped")


def _marks(losers: DataFrame, bits: int) -> bytes:
    """A bitmap of the losers' keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            at = (b["key"].to_numpy().view(np.uint64) % np.uint64(bits)).astype(np.int64)
            for s in np.unique(at // SEGMENT).tolist():
                found.setdefault(s, np.zeros(SEGMENT, bool))[at[at // SEGMENT == s] - s * SEGMENT] = True
        yield pa.record_batch({"segment": pa.array(list(found), pa.int32()), "bits": pa.array([np.packbits(x).tobytes() for x in found.values()], pa.binary())})

    segment = F.floor(F.col("key").bitwiseAND(F.lit(bits - 1)) / SEGMENT).cast("int")
    table = bytearray(bits // 8)
    for s, x in losers.select("key").repartition(partitions(losers.sparkSession), segment).mapInArrow(run, "segment int, bits binary").toLocalIterator():
        table[s * SEGMENT // 8 : s * SEGMENT // 8 + len(x)] = x
    return bytes(table)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def sql(table: str = "documents") -> str:
    """DuckDB SQL: doc_id, n_lines, n_dropped, kept (text)."""
    return f"""
with lines as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as pos from {table}),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
repeats as (select key, min(doc_id) as keeper from keyed where length(key) >= {LEAST} group by key having min(doc_id) < max(doc_id)),
marked as (select k.*, r.keeper is not null and r.keeper <> k.doc_id as gone from keyed k left join repeats r on k.key = r.key),
kept as (select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped, coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as kept from marked group by doc_id)
select doc_id, n_lines, n_dropped, kept from kept"""


def op_sql() -> str:
    return f"select doc_id, n_lines, n_dropped, sha256(kept) as kept_sha256 from ({sql()})"
