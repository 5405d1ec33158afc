"""Operator 4: mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, hex_to_unit, materialize, partitions, read

#: Weights by rank of the source's name, repeating.
WEIGHTS = (3, 1, 2)
#: The mix holds this share of all words.
SHARE = 1.5
#: No source, and no document, is taken more often than this.
MOST = 2.0
#: Hash seeds tried for each source.
SEEDS = 16
#: Sources whose rates are broadcast; beyond it they are joined by shuffle.
SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fill_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """totals (source, source_size), a row for each source: adds ``target``.

    Targets share ``share`` of all sizes by weight; a source over ``most`` times its size stops
    there and the rest is shared anew, until none is over. That fixed point is min(most * size, level * weight), and a source
    that has stopped stays so, as the level only rises: each round is one aggregate over the sources. Ranks
    come from a range partitioning, its parts' sizes and places inside them, so that no task gathers all sources.
    """
    spark = totals.sparkSession
    part = totals.repartitionByRange(partitions(spark), F.col("source").isNull(), "source").withColumn("_part", F.spark_partition_id())
    part = materialize(part, "parts")
    sizes = {r["_part"]: r["n"] for r in part.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # a row for each partition
    first = {k: sum(n for j, n in sizes.items() if j < k) for k in sizes}
    before = spark.createDataFrame(list(first.items()), "_part int, _first long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").isNull(), "source")) - 1
    k = (F.col("_first") + place) % len(weights)
    t = part.join(F.broadcast(before), "_part").withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (k + 1).cast("int")).cast("double"))
    t = materialize(t.select("source", "source_size", "weight", (F.col("source_size") * F.lit(most)).alias("cap")), "weighed")
    budget, weight = t.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = (budget or 0) * share
    level, stopped = budget / weight if weight else 0.0, -1
    while True:
        n, caps, held = t.where(F.col("cap") <= F.lit(level) * F.col("weight")).agg(F.count("*"), F.sum("cap"), F.sum("weight")).first()
        if n == stopped or held == weight or not n:
            break
        level, stopped = (budget - caps) / (weight - held), n
    return t.select("source", "source_size", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def draw(doc_id: Column, seed: int) -> Column:
    return hex_to_unit(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))))


def plan_mix(docs: DataFrame, seeds: int = SEEDS, **how) -> DataFrame:
    """docs (doc_id, source, text): returns (doc_id, source, size, source_size, target, copies).

    A document comes floor(rate) times, rate being target over size of its source, plus once more if
    the hash of its id and a seed falls under the fraction. Of ``seeds`` seeds a source takes the
    one whose copies come nearest to its target (ties: the smallest), so that a source of few or very
    uneven documents meets its target too. For one seed the extra copy has the fraction as its probability; the choice among
    seeds changes that where a source has few documents. seeds=1 chooses nothing. Sums per source are the only thing gathered.
    Defined cases: null and blank texts have size 0 and no copies beyond the draw's (0 words);
    null ids draw as the empty id; rows with the same id draw alike; a null source is a source of its own,
    last; a source without words has rate 0.
    """
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    chosen = _chosen(sized, seeds, **how)
    out = sized.join(chosen, sized["source"].eqNullSafe(chosen["source"])).drop(chosen["source"])
    return out.select("doc_id", "source", "size", "source_size", "target", copies(F.col("doc_id"), F.struct("seed", "whole", "part")).alias("copies"))


def copies(doc_id: Column, chosen: Column) -> Column:
    u = hex_to_unit(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), chosen["seed"].cast("string"))))
    return chosen["whole"] + (u < chosen["part"]).cast("long")


def _chosen(sized: DataFrame, seeds: int, **how) -> DataFrame:
    """sized (doc_id, source, size): (source, source_size, target, whole, part, seed), broadcast if there are few sources."""
    totals = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    few = totals.count() <= SOURCES
    near = lambda t: F.broadcast(t) if few else t
    rates = fill_targets(totals, **how).withColumn("rate", F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    rates = near(materialize(rates.withColumn("whole", F.floor("rate")).withColumn("part", F.col("rate") - F.floor("rate")), "rates"))
    j = sized.join(rates, sized["source"].eqNullSafe(rates["source"])).drop(rates["source"])
    gained = [F.sum(F.when(draw(F.col("doc_id"), s) < F.col("part"), F.col("size")).otherwise(0)).alias(f"g{s}") for s in range(seeds)]
    sums = j.groupBy("source", "source_size", "target", "whole", "part").agg(*gained)
    errors = F.array(*(F.struct(F.abs(F.col("whole") * F.col("source_size") + F.col(f"g{s}") - F.col("target")).alias("e"), F.lit(s).alias("s")) for s in range(seeds)))
    return near(materialize(sums.select("source", "source_size", "target", "whole", "part", F.array_min(errors)["s"].alias("seed")), "chosen"))


def mix(docs: DataFrame, seeds: int = SEEDS, **how) -> DataFrame:
    """The mixed documents themselves: every row of ``docs`` as many times as plan_mix says, all columns kept, whatever their names.

    Only ids, sources and sizes are gathered; a document meets its source's rate and seed where it is read, and no text
    moves unless there are more than SOURCES sources.
    """
    chosen = _chosen(materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes"), seeds, **how)
    own = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))  # one column, so that no name can clash
    rate = F.struct("seed", "whole", "part")
    j = own.join(chosen.select(F.struct("source").alias("of"), rate.alias("rate")), F.col("row.source").eqNullSafe(F.col("of.source")))
    n = copies(F.col("row.doc_id"), F.col("rate")).cast("int")
    times = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return j.select("row", F.explode(times)).select("row.*")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_mix(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def sql(table: str = "documents", seeds: int = SEEDS) -> str:
    """DuckDB SQL for op4_mixing's rows (and source and copies, for the pipeline)."""
    u = "(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || cast({s} as varchar)), 1, 8))::bigint)::double / 4294967296.0"
    return f"""
with sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from {table}),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (select *, (case (row_number() over (order by source is null, source) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end)::double as weight, source_size * 2.0::double as cap from totals),
levels as (select *, (sum(source_size) over ()::double * 1.5::double - coalesce(sum(cap) over w, 0.0)) / (sum(weight) over () - coalesce(sum(weight) over w, 0.0)) as level
  from weighed window w as (order by cap / weight, source is null, source rows between unbounded preceding and 1 preceding)),
first_level as (select level from levels where not cap <= level * weight order by cap / weight, source is null, source limit 1),
rates as (select source, source_size, case when cap <= level * weight then cap else (select level from first_level) * weight end as target from levels),
parts as (select *, floor(coalesce(target / nullif(source_size, 0), 0)) as whole, coalesce(target / nullif(source_size, 0), 0) - floor(coalesce(target / nullif(source_size, 0), 0)) as part from rates),
joined as (select s.doc_id, s.size, p.* from sized s join parts p on s.source is not distinct from p.source),
tried as (select source, s as seed, abs(any_value(whole) * any_value(source_size) + sum(case when {u.format(s="s")} < part then size else 0 end) - any_value(target)) as e from joined, range({seeds}) r(s) group by source, s),
chosen as (select source, arg_min(seed, (e, seed)) as seed from tried group by source),
mixed as (select j.*, (whole + (case when {u.format(s="c.seed")} < part then 1 else 0 end))::bigint as copies from joined j join chosen c on j.source is not distinct from c.source)
select doc_id, size, source_size, target, copies * size as taken from mixed"""
