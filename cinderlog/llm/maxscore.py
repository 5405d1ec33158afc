"""Operator 3: exact top-k by integer inner product, MaxScore style.

Components are terms: the posting list of a term is its column in a shard of rows, with its largest and smallest value.
Scores may have negative parts, so each term counts from its lowest possible contribution to a query; what it can add
from there is its bound. For a query, terms are ordered by bound. Those whose bounds together
cannot lift a row to the k-th best score so far are non-essential: essential postings are added up for all rows, and only rows
that the rest could still lift are probed, a group of terms at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read

K = 5
SCALE = 256
EVERY = 50
#: Queries that are broadcast at a time, and their bytes, at most; a pass over all rows for each such chunk.
CHUNK, CHUNK_BYTES = 16384, 8 << 20
#: Rows of a shard.
SHARD = 8192
#: Rows whose scores give each query its first bound.
SEED_ROWS = 2048
#: Terms added at a time.
GROUP = 8
#: Sums of products of smaller size are exact in double precision.
EXACT = 1 << 53


def quantise(df: DataFrame, scale: int) -> DataFrame:
    """(vec_id, x array<long>): floor(scale * component), a row for each row; those that can't be compared take no part."""
    v = F.col("embedding").cast("array<double>")
    fine = df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    fine = fine.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return fine.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("x"))


def _rows(lists: list[list[int]], width: int) -> np.ndarray:
    m = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        m[i, : len(x)] = x
    return m


def search_shard(ids: np.ndarray, rows: np.ndarray, qids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its k best rows here (query id, row ids, scores). floor: scores that k other rows reach."""
    if max(1, int(np.abs(rows).max())) * max(1, int(np.abs(queries).max())) * rows.shape[1] >= EXACT:
        kind = object  # whole numbers of any size
    else:
        kind = float
    lists = np.ascontiguousarray(rows.T.astype(kind))  # postings by term
    high, low = lists.max(1), lists.min(1)
    for i, q in enumerate(queries.astype(kind)):
        bound = np.where(q > 0, q * (high - low), q * (low - high))
        least = np.where(q > 0, q * low, q * high).sum()  # what every row has at least
        order = np.argsort(-bound.astype(float), kind="stable")
        rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])  # what terms from here on can add
        alive = np.nonzero(ids != qids[i])[0]
        score = np.zeros(len(alive), kind)
        # without the terms' lowest contributions, as bounds count from there
        base = np.where(q > 0, low, high)
        at, need = 0, floor[i] - least
        essential = max(GROUP, int((rest > need).sum()))  # terms after these can't make a row competitive
        steps = [min(len(order), essential // GROUP * GROUP or GROUP)] if essential < len(order) else [min(len(order), 3 * GROUP)]
        steps += range(steps[0] + GROUP, len(order) + GROUP, GROUP)
        for step in steps:
            terms = order[at : min(step, len(order))]
            if len(terms):
                own = lists[np.ix_(terms, alive)] if len(alive) < lists.shape[1] else lists[terms]
                score = score + q[terms] @ own - (q[terms] * base[terms]).sum()
                at += len(terms)
            if len(score) > k:
                best = np.partition(score, len(score) - k)[len(score) - k] if kind is float else sorted(score)[-k]
                need = max(need, best)
            live = score + rest[at] >= need  # ties stay
            alive, score = alive[live], score[live]
        top = np.lexsort((ids[alive], -score))[:k]
        yield int(qids[i]), ids[alive[top]], (score[top] + least)


def top_k(df: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, chunk: int = CHUNK) -> DataFrame:
    """df, queries (vec_id, embedding array, ...): (query_id, rank, vec_id, score): for each query the k rows of df, other
    than that of its own vec_id, of highest inner product; ties to the smaller vec_id; all, if there are fewer.

    Queries go in chunks of a bounded size (the broadcast), each a pass over df whose hits are written. Defined cases: null vectors, empty ones and
    those holding null or non-finite components take no part, nor do null ids; every row is a candidate of its own, and a query of its own, also where
    rows share a vec_id, but for the rows of the query's vec_id, which are its own; a missing component counts as 0; other columns are not read.
    """
    spark = df.sparkSession
    rows = materialize(quantise(df, scale), "rows")
    asked = materialize(quantise(queries, scale).withColumn("q", F.monotonically_increasing_id()), "asked")
    # the only scores seen so far: a fixed draw, of bounded size
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEED_ROWS).collect()
    width = max((x or 0 for t in (rows, asked) for (x,) in [t.agg(F.max(F.size("x"))).first()]), default=0)
    kind = "query_id long, rank int, vec_id long, score long"
    if not drawn or not width:
        return spark.createDataFrame([], kind)
    sample = spark.sparkContext.broadcast((np.array([x[0] for x in drawn]), _rows([x[1] for x in drawn], width)))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the score that their k-th best among the drawn rows has."""
        sid, s = sample.value
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                b = whole.slice(i, 1024)
                qids, q = b["vec_id"].to_numpy(), _rows(b["x"].to_pylist(), width)
                floor = np.full(len(q), -np.inf)
                if len(q) and len(sid) > k and max(1, int(np.abs(s).max())) * max(1, int(np.abs(q).max())) * width < EXACT:
                    x = q.astype(float) @ s.astype(float).T
                    x[qids[:, None] == sid] = -np.inf
                    floor = np.partition(x, x.shape[1] - k, 1)[:, x.shape[1] - k]
                yield pa.record_batch({"q": b["q"], "vec_id": b["vec_id"], "x": b["x"], "floor": pa.array(floor)})

    asked = materialize(asked.select("q", "vec_id", "x").mapInArrow(bounded, "q long, vec_id long, x array<long>, floor double"), "bounded")
    parts = max(1, math.ceil(asked.count() / min(chunk, max(1, CHUNK_BYTES // (8 * width)))))
    found = None
    for part in range(parts):
        own = asked.where(F.pmod(F.xxhash64("q"), F.lit(parts)) == part).collect()
        told = spark.sparkContext.broadcast((np.array([x["q"] for x in own], np.int64), np.array([x["vec_id"] for x in own], np.int64), _rows([x["x"] for x in own], width), np.array([x["floor"] for x in own], float)))

        def run(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            number, qids, q, floor = told.value

            def shards() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                ids, lists = [], []
                for b in batches:
                    ids += b["vec_id"].to_pylist()
                    lists += b["x"].to_pylist()
                    while len(ids) >= SHARD:
                        yield np.array(ids[:SHARD]), _rows(lists[:SHARD], width)
                        ids, lists = ids[SHARD:], lists[SHARD:]
                if ids:
                    yield np.array(ids), _rows(lists, width)

            for ids, m in shards() if len(q) else ():
                out = [(i, a, x, y) for i, (a, x, y) in zip(number.tolist(), search_shard(ids, m, qids, q, floor, k), strict=True) if len(x)]
                if out:
                    times = [len(x) for _, _, x, _ in out]
                    yield pa.record_batch({"q": pa.array(np.repeat([i for i, *_ in out], times), pa.int64()), "query_id": pa.array(np.repeat([a for _, a, _, _ in out], times), pa.int64()), "vec_id": pa.array(np.concatenate([x for _, _, x, _ in out]), pa.int64()), "score": pa.array([int(s) for *_, y in out for s in y], pa.int64())})

        order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        hits = rows.mapInArrow(run, "q long, query_id long, vec_id long, score long")
        hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        hits = hits if parts == 1 else materialize(hits, "hits")
        found = hits if found is None else found.unionByName(hits)
    return found


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % EVERY == 0))


def op_sql() -> str:
    """DuckDB SQL."""
    return f"""
with fine as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as x from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select q.r, q.vec_id as query_id, r.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * r.x[i]))::bigint as score from fine q join fine r on q.vec_id <> r.vec_id where q.vec_id % {EVERY} = 0),
ranked as (select *, row_number() over (partition by r order by score desc, vec_id)::int as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= {K}"""
