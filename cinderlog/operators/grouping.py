"""Groups of lines, values carried forward, and last lines of files. Files are independent; order inside one is by line_no."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of the order (line numbers, or bytes as the tail source counts) that make a piece of a file. A large file's pieces go to many tasks.
PIECE = 1 << 20


def _pieces(df: DataFrame, order: str) -> DataFrame:
    return df.withColumn("_k", F.floor(F.col(order) / PIECE))


def _counted(df: DataFrame, per: DataFrame, by: str, order: str) -> DataFrame:
    """df (by, _k, _s, ...) with group_id: the starts up to each row. per (by, _k, _n, _edge), a row for each piece: its starts, and whether
    one at its first row, which _s does not have, is among them."""
    earlier = F.sum("_n").over(Window.partitionBy(by).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(F.col(by).alias("_b"), F.col("_k").alias("_p"), (F.coalesce(earlier, F.lit(0)) + F.col("_edge")).alias("_before"))
    inside = F.sum("_s").over(Window.partitionBy(by, "_k").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    j = df.withColumn("_inside", inside).alias("d").join(per.alias("p"), F.col(f"d.{by}").eqNullSafe(F.col("p._b")) & F.col("d._k").eqNullSafe(F.col("p._p")))
    return j.withColumn("group_id", F.col("_inside") + F.col("_before")).drop("_k", "_s", "_inside", "_b", "_p", "_before")


def islands(df: DataFrame, starts: Column, by: str = "source_file", order: str = "line_no") -> DataFrame:
    """Adds group_id: how many rows up to here start a group."""
    d = _pieces(df, order).withColumn("_s", starts.cast("int"))
    return _counted(d, d.groupBy(by, "_k").agg(F.sum("_s").alias("_n"), F.lit(0).alias("_edge")), by, order)


def gather(df: DataFrame, by: str = "source_file", order: str = "line_no") -> DataFrame:
    """One row per group: (source_file, group_id, line_no of its first line, lines in order)."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("n"), F.col("line").alias("l"))))
    g = df.groupBy(by, "group_id").agg(rows.alias("_rows"))
    return g.select(by, "group_id", F.col("_rows")[0]["n"].alias("line_no"), F.transform("_rows", lambda x: x["l"]).alias("lines"))


#: How lines look that a MySQL server writes when its log is flushed (% stands for anything).
SERVER_LINES = ("/%, Version: %MySQL Community Server%", "Tcp port:%Unix socket:%", "Time%Id%Command%Argument%")


def is_server_line(line: Column) -> Column:
    return line.like(SERVER_LINES[0]) | line.like(SERVER_LINES[1]) | line.like(SERVER_LINES[2])


def slow_log_groups(lines: DataFrame) -> DataFrame:
    """MySQL: a comment or server line after a statement line starts a group; a last group without a statement goes.

    Pieces of a file are counted on their own first, from flags alone; what starts a group at a piece's first line is known by the last line of the piece before.
    """
    by, order = "source_file", "line_no"
    d = _pieces(lines, order).withColumn("_h", F.col("line").startswith("# ") | is_server_line(F.col("line")))
    inner = (F.col("_h") & ~F.coalesce(F.lag("_h").over(Window.partitionBy(by, "_k").orderBy(order)), F.lit(True))).cast("int")
    per = d.select(by, "_k", order, "_h").withColumn("_s", inner).groupBy(by, "_k").agg(F.sum("_s").alias("_n"), F.min_by("_h", order).alias("_first"), F.max_by("_h", order).alias("_last"))
    edge = F.col("_first") & ~F.coalesce(F.lag("_last").over(Window.partitionBy(by).orderBy("_k")), F.lit(True))
    per = per.withColumn("_edge", edge.cast("int")).withColumn("_n", F.col("_n") + F.col("_edge"))
    df = _counted(d.withColumn("_s", inner), per, by, order).drop("_h")
    return gather(df).where(~(F.element_at("lines", -1).startswith("# ") | is_server_line(F.element_at("lines", -1))))


def tab_groups(lines: DataFrame) -> DataFrame:
    """PostgreSQL: lines that start with a tab continue the one before."""
    return gather(islands(lines, ~F.col("line").startswith("\t")))


def carry_forward(df: DataFrame, value: Column, name: str, by: str = "source_file", order: str = "line_no") -> DataFrame:
    """Adds the last non-null ``value`` up to each row."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def last_lines(lines: DataFrame, by: str = "source_file", order: str = "line_no") -> DataFrame:
    """(source_file, line): each file's last line that is not blank."""
    return lines.where(F.length(F.trim("line")) > 0).groupBy(by).agg(F.max_by("line", order).alias("line"))
