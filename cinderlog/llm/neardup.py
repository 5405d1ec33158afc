"""Operator 1: embedding near-duplicates by an exact metric range join.

Vectors of unit length lie within distance r = sqrt(2 - 2c) exactly if their cosine is c or more. Equal vectors are one
entity. Each goes to the cell of its nearest pivot. Which other cells can hold a partner follows from the triangle inequality (a
partner is at most r farther from their pivot than the cell reaches) and from the plane between the two pivots (a partner behind it is
at least as far as the plane); a vector is replicated to those of lower rank, so that each pair meets once, and cells
join on their own. Vectors within r / 2 of their pivot (the core, such as a group of near copies) all link with each
other: they are counted and connected without comparing any pair, so that a hot group costs no more than its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read
from .graph import connected_components

COSINE = 0.95
#: Vectors for each pivot, and most bytes of all pivots (the broadcast's bound).
PER_PIVOT = 4096
PIVOT_BYTES = 16 << 20
#: Vectors in a unit: a cell is cut into units, by hash. Guests come in pieces of twice as many.
UNIT = 8192
#: Added to distances, for rounding.
SLACK = 1e-6
#: Rows of a matrix product in a unit, and entries of a distance matrix to pivots.
BLOCK = 512
ENTRIES = 4 << 20


def unit_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, k, v), a row for each row: a finite, non-zero vector in double precision, scaled to length 1, as bytes, and their digest; else nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, out = [], []
            for x in b["embedding"].to_pylist():
                v = None
                if x and None not in x:
                    a = np.array(x, float)
                    most = np.abs(a).max()
                    if np.isfinite(a).all() and most > 0:
                        a = a / most  # lest squares overflow
                        v = (a / np.linalg.norm(a) + 0.0).tobytes()  # no negative zeros
                out.append(v)
                key.append(v and xxhash.xxh3_128_digest(v))
            yield pa.record_batch({"vec_id": b["vec_id"], "k": pa.array(key, pa.binary()), "v": pa.array(out, pa.binary())})

    return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(run, "vec_id long, k binary, v binary")


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), float).reshape(len(blobs), width)


def _merge(lab: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """lab (the smallest member's place, for each place) after x[i] and y[i] are joined."""
    while True:
        a, b = lab[x], lab[y]
        apart = a != b
        if not apart.any():
            return lab
        pairs = np.unique(np.minimum(a, b)[apart] * len(lab) + np.maximum(a, b)[apart])
        low, high = np.divmod(pairs, len(lab))
        to = np.arange(len(lab))
        np.minimum.at(to, high, low)
        while (to[to] != to).any():
            to = to[to]
        lab = to[lab]


def near_duplicates(df: DataFrame, cosine: float = COSINE, per_pivot: int = PER_PIVOT, unit: int = UNIT) -> DataFrame:
    """df (vec_id, embedding array, ...): (vec_id, n_links, component_id, kept), a row for each row of df.

    n_links counts the other rows whose vectors link; component_id is the smallest vec_id that links reach, its own included.
    Defined cases: a null vector, a null, non-finite or all-zero one links with nothing; vectors of different length don't link
    with each other; rows are vectors of their own, also where they share a vec_id; a row without vec_id links as others do, and its component_id is
    null if links reach no other id; other columns are not read. cosine must be over 0.5, so that links inside half the radius are certain.
    """
    rows = materialize(unit_vectors(df), "vectors")
    entity = rows.where("v is not null").groupBy("k").agg(F.first("v").alias("v"), F.count("*").alias("m"), F.min("vec_id").alias("low"))
    entity = materialize(entity.withColumn("w", (F.length("v") / 8).cast("int")).withColumn("e", F.monotonically_increasing_id()), "entities")
    found = _join(entity, cosine, math.sqrt(2 - 2 * cosine), per_pivot, unit)
    comps = materialize(connected_components(found.where("to is not null").select(F.col("e").alias("a"), F.col("to").alias("b"))), "comps")
    links = found.groupBy("e").agg(F.sum("n").alias("n"))
    named = entity.select("e", "k", "m", "low").join(links, "e", "left").join(comps.withColumnRenamed("id", "e"), "e", "left").withColumn("c", F.coalesce("component", "e"))
    named = materialize(named.select("k", "c", "low", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n")), "named")
    smallest = named.groupBy("c").agg(F.min("low").alias("component_id"))
    of = named.join(smallest, "c").select("k", F.col("n").alias("links"), "component_id")
    out = rows.select("vec_id", "k").join(of, "k", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _join(entity: DataFrame, cosine: float, r: float, per_pivot: int, unit: int) -> DataFrame:
    """entity (e, v, w, m): rows (e, n, to): n rows linked with e that were found in a unit, and one of a spanning forest's links, if any."""
    spark = entity.sparkSession
    total, widest = entity.agg(F.count("*"), F.max("w")).first()
    k = max(1, min(math.ceil(total / per_pivot), PIVOT_BYTES // (8 * (widest or 1))))
    # the k smallest hashes: a fixed draw, of PIVOT_BYTES at most
    drawn: dict[int, list[bytes]] = {}
    for w, v in entity.orderBy(F.xxhash64("k"), "k").limit(k).select("w", "v").collect():
        drawn.setdefault(w, []).append(bytes(v))
    pivots = spark.sparkContext.broadcast({w: _matrix(v, w) for w, v in drawn.items()})

    def by_width(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        """Rows of one length, some at a time: their places in b, their vectors, and pivots of that length."""
        widths = b["w"].to_numpy()
        for w in np.unique(widths).tolist():
            own = np.nonzero(widths == w)[0]
            p = pivots.value.get(w)
            step = max(1, ENTRIES // (len(p) if p is not None else 1))
            for i in range(0, len(own), step):
                yield w, own[i : i + step], p

    def vectors(b: pa.RecordBatch, at: np.ndarray, w: int) -> np.ndarray:
        return _matrix(b["v"].take(pa.array(at)).to_pylist(), w)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, d = np.zeros(b.num_rows, np.int32), np.full(b.num_rows, 9.0)  # without a pivot: one cell, and no core
            for w, at, p in by_width(b):
                if p is not None:
                    x = vectors(b, at, w) @ p.T
                    cell[at] = x.argmax(1)
                    d[at] = np.sqrt(np.maximum(2 - 2 * x.max(1), 0))
            yield pa.record_batch({"e": b["e"], "v": b["v"], "w": b["w"], "m": b["m"], "cell": pa.array(cell), "d": pa.array(d)})

    at_home = entity.select("e", "v", "w", "m").mapInArrow(home, "e long, v binary, w int, m long, cell int, d double")
    at_home = materialize(at_home.withColumn("core", F.col("d") <= r / 2 - SLACK), "home")
    # a row for each cell and kind: two for each pivot, and one for each length of vectors without any
    cells = at_home.groupBy("w", "cell", "core").agg(F.count("*").alias("n"), F.max("d").alias("most")).orderBy("w", "cell", "core").collect()
    plan: dict[int, np.ndarray] = {}  # by length: first unit, number of units and radius, for each cell and kind
    at = 0
    for c in cells:
        own = plan.setdefault(c["w"], np.zeros((3, 2, len(drawn.get(c["w"], [0])))))
        own[:, int(c["core"]), c["cell"]] = at, math.ceil(c["n"] / unit), c["most"]
        at += math.ceil(c["n"] / unit)
    planned = spark.sparkContext.broadcast(plan)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector to its unit (home) and, as a guest, to units of lower rank that may hold a partner."""
        for b in batches:
            ids, own_d, cell, core = b["e"].to_numpy().view(np.uint64), b["d"].to_numpy(), b["cell"].to_numpy(), b["core"].to_numpy(zero_copy_only=False).astype(int)
            salt = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            for w, where, p in by_width(b):
                start, many, most = planned.value[w]
                mine = cell[where]
                n = many[core[where], mine].astype(np.uint64)
                rank = start[core[where], mine].astype(np.int64) + (salt[where] % n).astype(np.int64)
                rows, to = [], []
                for kind in (0, 1):
                    if p is None:
                        may = np.ones((len(where), 1), bool)
                    else:
                        d2 = np.maximum(2 - 2 * vectors(b, where, w) @ p.T, 0)
                        apart = np.sqrt(np.maximum(2 - 2 * p[mine] @ p.T, 0))
                        may = (np.sqrt(d2) <= most[kind] + r + SLACK) & (d2 - (own_d[where] ** 2)[:, None] <= 2 * r * apart + SLACK)
                    may &= (many[kind] > 0) & (start[kind] < rank[:, None])
                    if kind:
                        may[np.nonzero(core[where])[0], mine[core[where] > 0]] = False  # the core of one cell is linked already
                    i, c = np.nonzero(may)
                    times = np.minimum(many[kind, c].astype(np.int64), rank[i] - start[kind, c].astype(np.int64))
                    rows.append(np.repeat(i, times))
                    to.append(np.repeat(start[kind, c].astype(np.int64), times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
                guests = sum(map(len, rows))
                row, unit_of = np.concatenate([np.arange(len(where)), *rows]), np.concatenate([rank, *to])
                guest = np.arange(len(row)) >= len(where)
                for z in range(0, len(where) + guests, 1 << 15):
                    take = pa.array(where[row[z : z + (1 << 15)]])
                    yield pa.record_batch({"unit": pa.array(unit_of[z : z + (1 << 15)]), "guest": pa.array(guest[z : z + (1 << 15)]), **{x: b[x].take(take) for x in ("e", "v", "m", "core")}})

    dealt = materialize(at_home.mapInArrow(deal, "unit long, guest boolean, e long, v binary, m long, core boolean"), "dealt")
    # guests come in pieces of a bounded size, each beside a copy of the unit's own vectors
    per = dealt.where("guest").groupBy("unit").agg(F.ceil(F.count("*") / (2 * unit)).cast("int").alias("pieces"))
    split = dealt.join(F.broadcast(per), "unit", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))  # a row for each unit
    own = split.where("not guest").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    far = split.where("guest").withColumn("piece", F.pmod(F.xxhash64("e"), F.col("pieces")).cast("int"))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        guest, core = table["guest"].to_numpy(), table["core"].to_numpy()
        order = np.lexsort((~core, guest))  # own core, own others, guests
        ids, times = table["e"].to_numpy()[order], table["m"].to_numpy()[order].astype(float)
        blobs = table["v"].to_pylist()
        m = _matrix([blobs[i] for i in order.tolist()], len(blobs[0]) // 8)
        home_n, core_n = int((~guest).sum()), int((core & ~guest).sum())
        n, lab = np.zeros(len(ids)), np.arange(len(ids))
        inside = key[1].as_py() == 0  # pairs of the unit's own vectors are compared in its first piece only
        for i in range(0, home_n, BLOCK):
            j = min(i + BLOCK, home_n)
            for a in range(i if inside else home_n, len(ids), BLOCK * 4):
                z = min(a + BLOCK * 4, len(ids))
                hit = m[i:j] @ m[a:z].T >= cosine
                if not hit.any():
                    continue
                x, y = np.arange(i, j)[:, None], np.arange(a, z)[None, :]
                hit &= (x < y) & ((x >= core_n) | (y >= core_n))
                n[i:j] += hit @ times[a:z]
                n[a:z] += times[i:j] @ hit
                x, y = np.nonzero(hit)
                lab = _merge(lab, x + i, y + a)
        live = np.nonzero((n > 0) | (lab != np.arange(len(ids))))[0]
        return pa.table({"e": pa.array(ids[live], pa.int64()), "n": pa.array(n[live].astype(np.int64)), "to": pa.array(ids[lab[live]], pa.int64())})

    joined = own.unionByName(far).groupBy("unit", "piece").applyInArrow(compare, "e long, n long, to long")
    core = at_home.where("core")
    sizes = core.groupBy("w", "cell").agg(F.sum("m").alias("all"), F.min("e").alias("to"))
    star = core.select("e", "w", "cell", "m").join(F.broadcast(sizes), ["w", "cell"])  # a row for each pivot at most
    return materialize(joined.unionByName(star.select("e", (F.col("all") - F.col("m")).alias("n"), "to")), "found")


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


def op_sql() -> str:
    """DuckDB SQL: all pairs, and components by repeated union. For tables small enough for that."""
    return f"""
with recursive rows as (select row_number() over () as r, vec_id, embedding::double[] as v from embeddings),
good as (select * from rows where len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0),
links as (select a.r as a, b.r as b from good a join good b on a.r <> b.r and len(a.v) = len(b.v) where list_cosine_similarity(a.v, b.v) >= {COSINE}),
reach(a, b) as (select r, r from rows union select x.a, l.b from reach x join links l on x.b = l.a),
comps as (select a as r, min(vec_id) as component_id from reach join rows on rows.r = reach.b group by a),
counts as (select a as r, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id is not distinct from component_id as kept from rows join comps using (r) left join counts using (r)"""
