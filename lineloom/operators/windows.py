"""Ordered operators: numbering, context, modes and versions of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


WIDTH = 100_000


def running(df: DataFrame, by: list[str], order: str, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, width: int = WIDTH) -> DataFrame:
    """Adds to each row, within `by` and in order of a number that starts near 1: sums of all values up to it, and the last values at or
    before it that aren't null.

    No task holds a whole group: this is done within stretches of `width` of the order, and what the stretches before give, one row a
    stretch, is added. Rows of one order number are in no stated order among themselves.
    """
    sums, lasts = sums or {}, lasts or {}
    values = {f"_v_{k}": v for k, v in {**sums, **lasts}.items()}
    part = df.withColumns({**values, "_stretch": F.floor(F.col(order) / width)})
    last_of = lambda k: F.max_by(f"_v_{k}", F.when(F.col(f"_v_{k}").isNotNull(), F.col(order)))
    ends = part.groupBy(*by, "_stretch").agg(F.count("*").alias("_n"), *[F.sum(f"_v_{k}").alias(f"_b_{k}") for k in sums], *[last_of(k).alias(f"_b_{k}") for k in lasts])
    past = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_stretch").alias("_at"), *[F.coalesce(F.sum(f"_b_{k}").over(past), F.lit(0)).alias(f"_b_{k}") for k in sums], *[F.last(f"_b_{k}", ignorenulls=True).over(past).alias(f"_b_{k}") for k in lasts])
    own = Window.partitionBy(*by, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    part = part.withColumns({**{f"_o_{k}": F.coalesce(F.sum(f"_v_{k}").over(own), F.lit(0)) for k in sums}, **{f"_o_{k}": F.last(f"_v_{k}", ignorenulls=True).over(own) for k in lasts}})
    on = part["_stretch"].eqNullSafe(before["_at"])
    for i, c in enumerate(by):
        on &= part[c].eqNullSafe(before[f"_k{i}"])
    kept = [c for c in df.columns if c not in sums and c not in lasts]
    return part.join(before, on).select(*kept, *[(F.col(f"_o_{k}") + F.col(f"_b_{k}")).alias(k) for k in sums], *[F.coalesce(f"_o_{k}", f"_b_{k}").alias(k) for k in lasts])


def dense_index(df: DataFrame, by: list[str], order: str, out: str, width: int = WIDTH) -> DataFrame:
    """A dense index from 0 within `by`, in order of a number that starts near 1; no task holds a whole group."""
    got = running(df, by, order, sums={out: F.lit(1).cast("long")}, width=width)
    return got.withColumn(out, F.col(out) - 1)


def fill_line_numbers(df: DataFrame, by: list[str], order: str, line: str = "_line_no", width: int = WIDTH) -> DataFrame:
    """Line numbers that are 0 or null become the row's place in order."""
    got = running(df, by, order, sums={"_place": F.lit(1).cast("long")}, width=width)
    return got.withColumn(line, F.coalesce(F.nullif(F.col(line), F.lit(0)), F.col("_place")).cast("long")).drop("_place")


def newline_lines(df: DataFrame, by: list[str], offset: str, newlines: str, out: str = "line_no", width: int = WIDTH) -> DataFrame:
    """From the number of line ends in each stretch of bytes: the line at which a stretch starts."""
    got = running(df, by, offset, sums={"_ends": F.col(newlines)}, width=width)
    return got.withColumn(out, (F.col("_ends") - F.coalesce(newlines, F.lit(0)) + 1).cast("long")).drop("_ends")


def with_halo(df: DataFrame, by: list[str], order: str, n: int, width: int = WIDTH) -> DataFrame:
    """df in stretches of `width` rows, each with the n rows before it, so that a window over n rows needs no task with a whole group.

    Adds _place, the row's dense place within `by`, _in, the stretch, and _own: false for the rows that a stretch borrows. A row goes to
    its stretch and to those after it that look back on it, more than one if they are shorter than n.
    """
    placed = dense_index(df, by, order, "_place", width)
    at = lambda c: F.floor(c / width).cast("long")
    return placed.withColumn("_in", F.explode(F.sequence(at(F.col("_place")), at(F.col("_place") + n)))).withColumn("_own", F.col("_in") == at(F.col("_place")))


def over_last(df: DataFrame, by: list[str], order: str, out: dict[str, tuple[Column, int, int]], width: int = WIDTH) -> DataFrame:
    """df with columns {name: (aggregate, first, last)} over the rows from `first` to `last`, as in rowsBetween, none of them ahead."""
    n = max(-first for _, first, _ in out.values())
    halo = with_halo(df, by, order, n, width)
    own = Window.partitionBy(*by, "_in").orderBy("_place")
    return halo.withColumns({k: c.over(own.rowsBetween(first, last)) for k, (c, first, last) in out.items()}).where("_own").drop("_place", "_in", "_own")


def recent(df: DataFrame, by: list[str], order: str, value: str, n: int = 3, out: str = "recent", width: int = WIDTH) -> DataFrame:
    """The n values before each row, oldest first, in order of a number that starts near 1; nulls aren't among them."""
    return over_last(df, by, order, {out: (F.collect_list(value), -n, -1)}, width)


def latest(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Of an append-only log, the latest row of each key."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*by, "_r.*")


def in_block(starts: Column, ends: Column) -> Column:
    """A value for `running`'s lasts: whether a block is open behind this row."""
    return F.when(starts, True).when(ends, False)


def layout_epoch(lines: DataFrame, headers: DataFrame, by: list[str], order: str, layout_id: str = "layout_id", width: int = WIDTH) -> DataFrame:
    """Lines with the id of the last header line at or before them."""
    return running(lines.join(headers, [*by, order], "left"), by, order, lasts={layout_id: F.col(layout_id)}, width=width)
