"""Operator 9: Jaccard self-join of documents on word shingles, by rare-first prefix filtering.

Documents are sets of 64-bit hashes of their shingles; equal sets are one entity. What follows is exact for
any threshold t, as two sets that reach it share at least ceil(t * n) of the n shingles of either one:

1. Sieve. Of the first 30 % of a set in hash order, two partners share so many that a document in which fewer are
   found in any other set links with nothing. Most documents leave here, before their whole sets move.
2. Prefixes. Among those left, shingles are ordered rare first. Partners share a shingle among their first
   n - ceil(t * n) + 1. Shingles found once only take up places and give no postings.
   Shingles that a bounded draw of sets shows to be very frequent come last, by hash, and their lists are never gathered.
3. Near groups. Each posting list has a centre, the set in which the shingle comes earliest: among near copies that is the one
   with the fewest shingles of its own. All others in the list are verified against the centre only, and connected.
4. The rest. Lists that still hold several components are joined with length and positional filters. Of two partners the
   smaller set shares a shingle even in its index prefix of n - ceil(2t / (1 + t) * n) + 1, so that lists pair index
   entries with larger sets only, size class by size class; pages of one template, too unlike to link, have no index entries in its shingles.
   Only pairs from different components are verified, once each: after the suffix filter, by their sets. Pairs
   inside a component could not change it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, partitions, read, slices
from .graph import connected_components

WORDS = 5
#: Similarity at least this, as an exact fraction.
THRESHOLD = Fraction(4, 5)
#: Part of a set, in hash order, that the sieve looks at.
DEPTH = Fraction(3, 10)
#: Ids of documents that may be broadcast (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 500_000
#: Shingles of the draw that shows which are very frequent, and their number, at most.
DRAWN, FREQUENT = 4_000_000, 20_000

_ODD = np.array([0x9E3779B97F4A7C15 + 2 * 0x1D8E4E27C47D124F * k & (1 << 64) - 1 | 1 for k in range(64)], np.uint64)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes. bytes.split and bytes.lower know ASCII only, as the definition wants."""
    w = text.lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    if not w:
        return h
    k = min(words, len(w))
    s = h[: len(w) - k + 1] * _ODD[0]
    for j in range(1, k):
        s = s + h[j : len(w) - k + 1 + j] * _ODD[j % 64]
    s ^= s >> np.uint64(31)
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s ^= s >> np.uint64(29)
    s.sort()
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


def least_shared(n: int, t: Fraction = THRESHOLD) -> int:
    return math.ceil(t * n)


def sieve_need(n: int, t: Fraction, depth: Fraction) -> int:
    """Shared shingles that the sieve part of a set of n holds at least if the set has a partner (of t * n or more)."""
    return max(1, math.ceil((depth - (1 - t)) * t * n))


def text_hash(text: str = "text") -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64(F.col(text).cast("binary"))


def signatures(docs: DataFrame, words: int, depth: Fraction) -> DataFrame:
    """(doc_id, h, n, digest, d, head): h is the text's hash; d is the start of the digest; head holds the first ``depth`` of the set in hash order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingles(x or b"", words) for x in b["text"].to_pylist()]
            digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            head = [s[: math.ceil(depth * len(s))].tobytes() if len(s) else None for s in sets]
            yield pa.record_batch({"doc_id": b["doc_id"], "h": b["h"], "n": pa.array(map(len, sets), pa.int64()), "digest": pa.array(digest, pa.binary()), "d": pa.array([x and int.from_bytes(x[:8], "little", signed=True) for x in digest], pa.int64()), "head": pa.array(head, pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), text_hash().alias("h")).mapInArrow(run, "doc_id long, h long, n long, digest binary, d long, head binary")


_SCATTER = "bucket int, ids binary, sizes binary, tokens binary"


def _deal(ids: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, extra: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows of _SCATTER: tokens by bucket; (ids, extra, how many) of those that have any there."""
    who = np.repeat(np.arange(len(ids)), sizes)
    bucket = ((tokens >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in np.nonzero(np.diff(cuts))[0].tolist():
        own = order[cuts[k] : cuts[k + 1]]
        has, times = np.unique(who[own], return_counts=True)
        yield k, np.stack([ids[has], extra[has]]).astype("<u8").tobytes(), times.astype("<u4").tobytes(), tokens[own].tobytes()


def _gather(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """tokens, and for each its id and extra; of one id and token only one."""
    tokens, ids, extra = [], [], []
    for b in batches:
        for i, s, t in zip(*(b[c].to_pylist() for c in ("ids", "sizes", "tokens")), strict=True):
            x, s = np.frombuffer(i, "<u8").reshape(2, -1), np.frombuffer(s, "<u4")
            ids.append(np.repeat(x[0], s))
            extra.append(np.repeat(x[1], s))
            tokens.append(np.frombuffer(t, np.uint64))
    if not tokens:
        return (np.zeros(0, np.uint64),) * 3
    tokens, ids, extra = map(np.concatenate, (tokens, ids, extra))
    order = np.lexsort((ids, tokens))
    tokens, ids, extra = tokens[order], ids[order], extra[order]
    new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1])])
    return tokens[new], ids[new], extra[new]


def _frequency(tokens: np.ndarray) -> np.ndarray:
    """How often each of sorted tokens occurs, at each."""
    first = np.nonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))[0] if len(tokens) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(tokens)))
    return np.repeat(n, n)


def _join(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(blobs), np.uint64), np.array([len(x) // 8 for x in blobs], np.int64)


def sieve(signed: DataFrame, t: Fraction, depth: Fraction, buckets: int) -> DataFrame:
    """Digests' first 8 bytes (long) of sets that may have a partner, with ``found`` shared shingles.

    A shingle that a batch holds in two sets is known to be shared: its sets are counted there, and one marker goes on
    for other batches, so that a hot shingle costs a row per batch.
    """

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "head", 4 << 20):
            own = {d: h for d, h in zip(b["digest"].to_pylist(), b["head"].to_pylist(), strict=True) if d is not None}
            if not own:
                continue
            ids = np.frombuffer(b"".join(d[:8] for d in own), "<u8")
            tokens, sizes = _join(list(own.values()))
            who = np.repeat(np.arange(len(ids)), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, who = tokens[order], who[order]
            often = _frequency(tokens) > 1
            shared = tokens[often]
            marks = np.unique(shared)
            counts = np.bincount(who[often], minlength=len(ids))
            back = np.argsort(who[~often], kind="stable")  # single ones, by set again
            single, of = tokens[~often][back], np.bincount(who[~often], minlength=len(ids))
            rows = list(_deal(ids, of, single, np.zeros(len(ids), np.uint64), buckets))
            rows += _deal(np.array([0], np.uint64), np.array([len(marks)]), marks, np.array([1], np.uint64), buckets)  # extra 1: shared already
            have = np.nonzero(counts)[0]
            to = (ids[have] % np.uint64(buckets)).astype(np.int64)
            for k in np.unique(to).tolist():
                rows.append((k, ids[have][to == k].tobytes(), counts[have][to == k].astype("<u4").tobytes(), None))
            yield pa.record_batch([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "ids", "sizes", "tokens"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list[tuple[np.ndarray, np.ndarray]] = []

        def rest():
            for b in batches:
                told = pc.is_null(b["tokens"])
                for i, s in zip(b["ids"].filter(told).to_pylist(), b["sizes"].filter(told).to_pylist(), strict=True):
                    totals.append((np.frombuffer(i, "<u8"), np.frombuffer(s, "<u4").astype(np.int64)))
                yield b.filter(pc.invert(told))

        tokens, ids, extra = _gather(rest())
        marked = np.zeros(len(tokens), bool)
        if len(tokens):
            first = np.concatenate([[True], tokens[1:] != tokens[:-1]])
            group = np.cumsum(first) - 1
            n = np.bincount(group)
            marked = ((n > 1) | (np.bincount(group, extra == 1) > 0))[group] & (extra == 0)
        who, times = np.unique(ids[marked], return_counts=True)
        totals.append((who, times))
        who, at = np.unique(np.concatenate([x for x, _ in totals]), return_inverse=True)
        yield pa.record_batch({"d": pa.array(who.view(np.int64), pa.int64()), "found": pa.array(np.bincount(at, np.concatenate([y for _, y in totals]), minlength=len(who)).astype(np.int64), pa.int64())})

    spread = signed.select("digest", "head").mapInArrow(scatter, _SCATTER).repartition(buckets, "bucket")
    return spread.mapInArrow(count, "d long, found long").groupBy("d").agg(F.sum("found").alias("found"))


def frequent_tokens(sets: DataFrame, volume: int, drawn: int = DRAWN, most: int = FREQUENT) -> np.ndarray:
    """Sorted shingles that are in many of a fixed draw of sets. Which ones these are changes the work, never the result."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "tokens", 4 << 20):
            tokens, n = np.unique(np.frombuffer(b"".join(b["tokens"].to_pylist()), np.uint64), return_counts=True)
            yield pa.record_batch({"token": pa.array(tokens.view(np.int64)), "n": pa.array(n)})

    every = max(1, math.ceil(volume / drawn))
    few = sets.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).select("tokens").mapInArrow(spread, "token long, n long")
    least = max(100, drawn // most)
    found = few.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "token").limit(most).collect()
    return np.sort(np.array([r["token"] for r in found], np.int64).view(np.uint64))


def index_prefix(n: int, t: Fraction) -> int:
    """In so many of its first shingles a set of n shares one with any partner of its size or more."""
    return n - math.ceil(2 * t / (1 + t) * n) + 1


def postings(sets: DataFrame, t: Fraction, buckets: int, hot: np.ndarray) -> DataFrame:
    """sets (id, n, tokens): (token, id, n, pos, idx) of the shared shingles in each set's prefix, rare first, those of ``hot``
    (sorted) last; idx: in the index prefix, too."""
    held = sets.sparkSession.sparkContext.broadcast(hot)

    def is_hot(tokens: np.ndarray) -> np.ndarray:
        return held.value[np.minimum(np.searchsorted(held.value, tokens), len(held.value) - 1)] == tokens if len(held.value) else np.zeros(len(tokens), bool)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shingles by bucket, but for the very frequent ones."""
        for b in slices(batches, "tokens", 4 << 20):
            tokens, sizes = _join(b["tokens"].to_pylist())
            ids, n = b["id"].to_numpy().view(np.uint64), b["n"].to_numpy().view(np.uint64)
            who, apart = np.repeat(np.arange(len(ids)), sizes), is_hot(tokens)
            rows = list(_deal(ids, np.bincount(who[~apart], minlength=len(ids)), tokens[~apart], n, buckets))
            if rows:
                yield pa.record_batch([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "ids", "sizes", "tokens"])

    def by_set(tokens: np.ndarray, ids: np.ndarray, n: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
        """Rows dealt by set: four arrays for each bucket of sets."""
        to = (ids % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[order], np.arange(buckets + 1))
        full = np.nonzero(np.diff(cuts))[0].tolist()
        rows = [np.stack([x[order[cuts[k] : cuts[k + 1]]] for x in (tokens, ids, n, df.astype(np.uint64))]).tobytes() for k in full]
        return pa.record_batch({"bucket": pa.array(full, pa.int32()), "part": pa.array(rows, pa.binary())})

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shared shingles with their frequency."""
        tokens, ids, n = _gather(batches)
        df = _frequency(tokens)
        yield by_set(*(x[df > 1] for x in (tokens, ids, n, df)))

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The very frequent shingles, as if each were the most frequent one."""
        for b in slices(batches, "tokens", 4 << 20):
            tokens, sizes = _join(b["tokens"].to_pylist())
            apart = is_hot(tokens)
            ids, n = (np.repeat(b[c].to_numpy().view(np.uint64), sizes)[apart] for c in ("id", "n"))
            yield by_set(tokens[apart], ids, n, np.full(len(ids), 1 << 62))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(x, np.uint64).reshape(4, -1) for b in batches for x in b["part"].to_pylist()]
        if not parts:
            return
        tokens, ids, n, df = np.concatenate(parts, 1)
        by = np.lexsort((tokens, df, ids))
        tokens, ids, n = tokens[by], ids[by], n[by].astype(np.int64)
        first = np.nonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))[0]
        many = np.diff(np.append(first, len(ids)))
        own = n[first]
        once = own - many  # shingles found in no other set come first
        room, index = (np.array([f(x) for x in own.tolist()], np.int64) for f in (lambda x: x - least_shared(x, t) + 1, lambda x: index_prefix(x, t)))
        pos = np.arange(len(ids)) - np.repeat(first, many) + np.repeat(once, many)
        held = pos < np.repeat(room, many)
        yield pa.record_batch({"token": pa.array(tokens[held].view(np.int64)), "id": pa.array(ids[held].view(np.int64)), "n": pa.array(n[held]), "pos": pa.array(pos[held]), "idx": pa.array((pos < np.repeat(index, many))[held])})

    narrow = sets.select("id", "n", "tokens")
    back = narrow.mapInArrow(scatter, _SCATTER).repartition(buckets, "bucket").mapInArrow(frequent, "bucket int, part binary")
    if len(hot):
        back = back.unionByName(narrow.mapInArrow(at_once, "bucket int, part binary"))
    return back.repartition(buckets, "bucket").mapInArrow(order, "token long, id long, n long, pos long, idx boolean")


def enough(na: int, nb: int, t: Fraction) -> int:
    """Shingles that two sets share at least if they reach t."""
    return math.ceil(t / (1 + t) * (na + nb))


def suffix_bound(x: np.ndarray, y: np.ndarray, parts: int = 8) -> int:
    """Upper bound of what two sorted sets share: both are cut at the same hashes, and the smaller parts summed."""
    pivots = x[np.arange(1, parts) * len(x) // parts]
    a = np.diff(np.concatenate([[0], np.searchsorted(x, pivots), [len(x)]]))
    b = np.diff(np.concatenate([[0], np.searchsorted(y, pivots), [len(y)]]))
    return int(np.minimum(a, b).sum())


def verify(pairs: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """Of distinct pairs (a, b) those that reach t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ta"):
            ok = []
            for ta, tb in zip(b["ta"].to_pylist(), b["tb"].to_pylist(), strict=True):
                x, y = np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64)
                need = enough(len(x), len(y), t)
                if min(len(x), len(y)) < need or suffix_bound(x, y) < need:
                    ok.append(False)
                    continue
                at = np.searchsorted(y, x)
                ok.append(int((y[np.minimum(at, len(y) - 1)] == x).sum()) >= need)
            yield pa.record_batch({"a": b["a"], "b": b["b"]}).filter(pa.array(ok, pa.bool_()))

    a = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, words: int = WORDS, t: Fraction = THRESHOLD, depth: Fraction = DEPTH) -> DataFrame:
    """docs (doc_id long, text, ...): (doc_id, n_shingles, component_id, text_hash), one row for each row of docs.

    component_id is the smallest doc_id that links reach. Defined cases: null, empty and blank texts
    have no shingles and link with nothing; texts of fewer words have one shingle, the whole sequence; rows with the same doc_id are
    compared row by row but share their id; a row without doc_id links as others do, and has a null component if links reach no other id;
    other columns are not read. Shingles are told apart by 64-bit hashes; as only those of two compared
    documents must differ, equal hashes of different shingles don't matter in practice.
    """
    spark = docs.sparkSession
    signed = materialize(signatures(docs, words, depth), "signed")
    entities = signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("d").alias("d"))
    entities = materialize(entities, "entities")
    volume = signed.agg(F.sum("n")).first()[0] or 0
    buckets = max(partitions(spark), math.ceil(volume * float(depth) / 2_000_000))
    need = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(int((depth - (1 - t)).numerator * t.numerator)) / F.lit(int((depth - (1 - t)).denominator * t.denominator)) - F.lit(1e-9)))
    kept = materialize(entities.join(sieve(signed, t, depth, buckets), "d").where(F.col("found") >= need).select("d", "id", "n"), "kept")
    rows, most = kept.agg(F.count("*"), F.sum("n")).first()
    near = lambda x: F.broadcast(x) if rows <= BROADCAST_IDS else x

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingles(x or b"", words) for x in b["text"].to_pylist()]
            blobs = [s.tobytes() for s in sets]
            yield pa.record_batch({"id": pa.array([int.from_bytes(xxhash.xxh3_128_digest(x)[:8], "little", signed=True) for x in blobs], pa.int64()), "n": pa.array(map(len, sets), pa.int64()), "tokens": pa.array(blobs, pa.binary())})

    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    named = chosen.where("id is not null").join(near(kept.select("id")), "id", "left_semi")
    chosen = named.unionByName(chosen.where("id is null")) if kept.where("id is null").limit(1).count() else named
    # a set goes by the start of its digest from here on; rows that share a doc_id, or have none, may have different sets
    sets = chosen.mapInArrow(whole, "id long, n long, tokens binary").join(near(kept.select(F.col("d").alias("id"))), "id", "left_semi")
    sets = materialize(sets.dropDuplicates(["id"]), "sets")
    lists = materialize(postings(sets, t, buckets, frequent_tokens(sets, most or 0)), "postings")
    p, q = t.numerator, t.denominator

    def passes(a: str, b: str) -> F.Column:  # length and positional filters; n of a is the smaller
        least = F.ceil((F.col(f"{a}.n") + F.col(f"{b}.n")) * F.lit(p) / F.lit(p + q) - F.lit(1e-9))
        room = F.lit(1) + F.least(F.col(f"{a}.n") - F.col(f"{a}.pos") - 1, F.col(f"{b}.n") - F.col(f"{b}.pos") - 1)
        return (F.col(f"{a}.n") * q >= F.col(f"{b}.n") * p) & (room >= least)

    def pairs(x: DataFrame, a: str, b: str) -> DataFrame:
        return x.select(F.least(f"{a}.id", f"{b}.id").alias("a"), F.greatest(f"{a}.id", f"{b}.id").alias("b")).distinct()

    row = F.struct("n", "id", "pos")
    centres = materialize(lists.groupBy("token").agg(F.min(F.struct("pos", "n", "id")).alias("x"), F.count("*").alias("m")).where("m > 1").drop("m"), "centres")
    first = lists.join(centres, "token").where("id <> x.id").select("x", row.alias("y"))
    first = first.where(F.when(F.col("x.n") <= F.col("y.n"), passes("x", "y")).otherwise(passes("y", "x")))
    links = materialize(verify(materialize(pairs(first, "x", "y"), "near"), sets, t), "links")
    comps = materialize(connected_components(links), "comps")

    placed = materialize(lists.join(comps, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component"), "placed")
    per = placed.groupBy("token", "c").agg(F.count("*").alias("m"), F.max("idx").alias("idx"))
    mixed = materialize(per.groupBy("token").agg(F.max(F.struct("m", "c"))["c"].alias("main"), F.count("*").alias("k"), F.max("idx").alias("idx")).where("k > 1 and idx").drop("k", "idx"), "mixed")
    left = materialize(placed.join(mixed, "token").withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(q / p)) + F.lit(1e-9))), "rest")
    # the smaller set of a pair is in the index prefix; the larger one's size class is its own or the next
    small = left.where("idx").withColumn("class", F.explode(F.array(F.col("class"), F.col("class") + 1)))

    def meet(x: DataFrame, y: DataFrame) -> DataFrame:
        x, y = x.alias("x"), y.alias("y")
        larger = (F.col("x.n") < F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id"))
        same = (F.col("x.token") == F.col("y.token")) & (F.col("x.class") == F.col("y.class"))
        return pairs(x.join(y, same & (F.col("x.c") != F.col("y.c")) & larger & passes("x", "y")), "x", "y")

    apart = meet(small.where("c <> main"), left).unionByName(meet(small.where("c = main"), left.where("c <> main"))).distinct()
    more = materialize(verify(materialize(apart, "apart"), sets, t), "links")
    of = comps
    if more.limit(1).count():  # components that further links join
        at = more.join(comps.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left").join(comps.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
        joined = materialize(connected_components(at.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))), "joined")
        ids = comps.unionByName(joined.select("id", F.col("id").alias("component"))).groupBy("id").agg(F.min("component").alias("component"))
        of = ids.join(joined.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        of = materialize(of, "comps")

    member = materialize(entities.join(of.withColumnRenamed("id", "d"), "d", "left").select("digest", F.coalesce("component", "d").alias("c"), "id"), "members")
    smallest = member.groupBy("c").agg(F.min("id").alias("component_id"))
    named = materialize(member.join(smallest, "c").select("digest", "component_id"), "named")
    out = signed.select("doc_id", "h", "n", "digest").join(named, "digest", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.col("h").alias("text_hash"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents")).drop("text_hash")


def op_sql() -> str:
    """DuckDB SQL: links by shared shingles, and components by repeated union. For tables small enough for that."""
    return f"""
with recursive numbered as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
worded as (select r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from numbered),
sets as (select r, doc_id, case when len(w) = 0 then [] when len(w) < {WORDS} then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) end as s from worded),
kinds as (select s, min(r) as k, min(doc_id) as low from (select r, doc_id, list_sort(s) as s from sets where len(s) > 0) group by s),
members as (select sets.r, kinds.k from sets join kinds on list_sort(sets.s) = kinds.s),
tokens as (select k, len(s) as n, unnest(s) as x from kinds),
often as (select a.k as a, b.k as b, a.n as na, b.n as nb, count(*) as shared from tokens a join tokens b on a.x = b.x and a.k < b.k and a.n * {THRESHOLD.denominator} >= b.n * {THRESHOLD.numerator} and b.n * {THRESHOLD.denominator} >= a.n * {THRESHOLD.numerator} group by all),
linked as (select a, b from often where {THRESHOLD.denominator} * shared >= {THRESHOLD.numerator} * (na + nb - shared)),
links as (select a, b from linked union all select b, a from linked),
reach(a, b) as (select k, k from kinds union select x.a, l.b from reach x join links l on x.b = l.a),
comps as (select reach.a as k, min(low) as component_id from reach join kinds on kinds.k = reach.b group by reach.a)
select doc_id, len(s)::bigint as n_shingles, coalesce(component_id, doc_id) as component_id from sets left join members using (r) left join comps using (k)"""
