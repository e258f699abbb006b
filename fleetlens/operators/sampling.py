"""Sampling (M1, M2). Both keep a sampling feature's own bound (``n``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.ordered_scan import IDX, SLOT_ROWS, ordered_scan

#: Equal ranges of the first order column that are counted.
BINS = 65_536


def _bin(df: DataFrame, c: str) -> Column:
    """A bin that rises with the column: equal ranges of a time, date or
    number, the first letters of anything else; null first."""
    kind = df.schema[c].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType, T.NumericType)):
        number = F.unix_micros(F.col(c).cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.unix_date(c) if isinstance(kind, T.DateType) else F.col(c)
        number = F.nanvl(number.cast("double"), F.lit(float("inf")))
        finite = F.when(F.abs(number) < float("inf"), number)
        ends = df.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi")).first()
        if ends.lo is None or ends.hi == ends.lo:
            return F.when(number.isNull(), F.lit(-1)).otherwise(F.when(finite.isNotNull(), F.lit(1)).otherwise(F.when(number < 0, F.lit(0)).otherwise(F.lit(2)))).cast("string")
        at = F.greatest(F.least(F.floor((number - F.lit(ends.lo)) / F.lit((ends.hi - ends.lo) / BINS)), F.lit(BINS)), F.lit(-1))
        return F.lpad((F.coalesce(at, F.lit(-2)) + 2).cast("string"), 8, "0")
    return F.coalesce(F.concat(F.lit("="), F.substring(F.col(c).cast("string"), 1, 2)), F.lit(""))


def sample_even(df: DataFrame, n: int, order_cols: list[str], slot_rows: int | None = SLOT_ROWS) -> DataFrame:
    """M1: ``n`` rows evenly spaced over the ordered rows: positions
    ``min(int(i * (len / n)), len - 1)`` for i in 0..n-1 (double arithmetic,
    as the reference computes them); all rows when ``n >= len``.

    A first pass counts the rows of each bin of the first order column (a
    bounded table); the counts say which bins hold wanted positions. Only the
    rows of those, n bins at most, are shuffled and ordered, bin by bin; a bin
    that holds more than a task should sort is cut by ``ordered_scan``."""
    binned = df.withColumn("_bin", _bin(df, order_cols[0]))
    counts = binned.groupBy("_bin").agg(F.count(F.lit(1)).alias("_rows"))
    past = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # a row per bin
    counts = counts.withColumns({"_before": F.coalesce(F.sum("_rows").over(past), F.lit(0)), "_len": F.sum("_rows").over(Window.partitionBy())})
    step = F.col("_len").cast("double") / F.lit(float(max(n, 1)))
    position = lambda i: F.least(F.floor(i.cast("double") * step), F.col("_len") - 1)
    # The first i at or behind the bin's start; one before it against rounding.
    inside = lambda i: (i >= 0) & (i < n) & (position(i) >= F.col("_before")) & (position(i) < F.col("_before") + F.col("_rows"))
    first = F.floor(F.col("_before") / step)
    holds = (F.col("_len") <= n) | inside(first - 1) | inside(first) | inside(first + 1) | inside(first + 2)
    counts = counts.where(holds & F.lit(n > 0)).drop("_rows")
    rows = binned.join(F.broadcast(counts), "_bin")  # at most BINS rows
    rows = ordered_scan(rows, key="_bin", order=list(order_cols), carry=[], slot_rows=slot_rows)
    rows = rows.withColumn("sample_pos", F.col("_before") + F.col(IDX))
    near = F.floor(F.col("sample_pos") / step)
    reach = lambda i: (i >= 0) & (i < n) & (position(i) == F.col("sample_pos"))
    wanted = (F.col("_len") <= n) | reach(near) | reach(near + 1) | reach(near - 1)
    return rows.where(wanted).drop("_bin", "_before", "_len", IDX)


def sample_uniform(df: DataFrame, n: int, key_cols: list[str], seed: str = "42", order_cols: list[str] | None = None) -> DataFrame:
    """M2: a repeatable uniform sample of ``n`` rows - the ``n`` smallest
    ``md5(seed || key)`` values (a top-k: per-partition heaps, no global
    sort) - returned in time order."""
    h = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in key_cols]))
    picked = df.withColumn("sample_hash", h).orderBy("sample_hash").limit(n)
    return picked.orderBy(*(order_cols or ["event_time"]))
