"""Helpers that every operator of this subpackage shares."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as all contracts of this subpackage define it.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null id while rows are grouped by id.
NO_ID = (1 << 63) - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Unset, a local session (tests) gets a new local one; a cluster is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="cinderlog-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Writes ``df`` as a Parquet table in the shared folder and reads it back.

    Cuts lineage: a lost executor costs the tasks that read the table, not those that made it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/cinderlog-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that ``column`` (binary or string) holds at most about ``most`` bytes, one row at least."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b[column]), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(size.tolist()):
            if total and total + n > most:
                yield b.slice(start, i - start)
                start, total = i, 0
            total += n
        yield b.slice(start)
        pa.default_memory_pool().release_unused()


def hex_to_unit(hex_text: Column) -> Column:
    """First 8 hex digits as a number in [0, 1)."""
    return F.conv(F.substring(hex_text, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
