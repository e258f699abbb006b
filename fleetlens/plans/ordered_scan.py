"""Ordered scan per key: previous-row values, position in the key, and a
running count of segment starts, as window functions alone.

The plain way is ``Window.partitionBy(key).orderBy(...)`` with ``lag`` and a
running ``sum``. It shuffles the rows once and is what runs here for every key
of up to ``slot_rows`` rows. One vehicle that sends a third of all rows would
be one task over a third of the data, so keys with more rows are scanned on two
levels:

1. The rows of each key are counted (one narrow pass, combined map-side). A
   larger key is cut into slots of its first order column, as wide as its
   measured counts allow: the widest of a ladder of widths at which its
   fullest slot stays within ``slot_rows``. Where one instant alone holds more,
   its rows are cut by the next order column.
2. The windows run per (key, slot); other keys are one slot.
3. Each slot of a large key gives one row: its first and last row, its rows,
   its segment starts. ``lag`` and running sums over those, per key, give what
   came before a slot. They are joined back on (key, slot), which is how the
   rows already lie; a slot's first row takes its previous values from there.

No rows are stored, and none leave the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

IDX = "_scan_idx"
SEQ = "_scan_seq"
TOTAL = "_scan_total"
SLOT = "_scan_slot"
#: Rows of one key that one task sorts; larger keys are cut.
SLOT_ROWS = 1_000_000
#: Widths of slots, in steps (seconds where the order begins with a time).
WIDTHS = [4**i for i in range(13, -1, -1)]
BEFORE_ALL = -(1 << 63)


@dataclass(frozen=True)
class GapRule:
    """A new segment starts when there is no previous row, the previous time
    is NULL, the gap in whole seconds exceeds ``gap_seconds``, or
    ``change_col`` differs from the previous row (NULL never differs)."""

    time_col: str
    gap_seconds: float
    change_col: str | None = None

    def starts(self, now, before) -> Column:
        """``now`` and ``before`` give the column of a name."""
        t, pt = now(self.time_col), before(self.time_col)
        cond = pt.isNull() | ((F.unix_timestamp(t) - F.unix_timestamp(pt)) > F.lit(self.gap_seconds))
        if self.change_col is not None:
            cond = cond | (now(self.change_col) != before(self.change_col))
        return F.coalesce(cond, F.lit(False))


def prev_name(c: str) -> str:
    return f"prev_{c}"


def ordered_scan(
    df: DataFrame,
    key: str,
    order: list[str],
    carry: list[str],
    rule: GapRule | None = None,
    prev_names: dict[str, str] | None = None,
    slot_rows: int | None = SLOT_ROWS,
    total: bool = False,
) -> DataFrame:
    """Add ``prev_<c>`` for every ``c`` in ``carry``, ``_scan_idx`` (0-based
    position within ``key`` in ``order``), with a rule ``_scan_seq`` (the
    running count of segment starts, 1-based), and with ``total``
    ``_scan_total`` (the key's rows).

    ``order`` must be a total order within a key (append tie columns); to be
    cut, a key's order must begin with a time, a date or a whole number.
    ``slot_rows`` None means the plain window for all keys, uncounted."""
    names = {c: (prev_names or {}).get(c, prev_name(c)) for c in carry}
    if rule is not None:
        for c in (rule.time_col, rule.change_col):
            if c is not None and c not in carry:
                raise ValueError(f"rule column {c} must be carried")
    cuts = None if slot_rows is None else _cuts(df, key, order, slot_rows)
    if cuts is None:
        return _scan(df, [key], order, carry, rule, names, total)
    return _slot_scan(df, key, order, carry, rule, names, cuts, total)


def _scan(df, part, order, carry, rule, names, total):
    """The window functions over the groups ``part``. Their first rows have no
    previous row and start a segment."""
    w = Window.partitionBy(*part).orderBy(*order)
    out = df.withColumns({**{names[c]: F.lag(c).over(w) for c in carry}, IDX: (F.row_number().over(w) - 1).cast("long")})
    if total:
        out = out.withColumn(TOTAL, F.count(F.lit(1)).over(Window.partitionBy(*part)))
    if rule is not None:
        new = (F.col(IDX) == 0) | rule.starts(F.col, lambda c: F.col(names[c]))
        out = out.withColumn(SEQ, F.sum(F.when(new, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long"))
    return out


# ---------------------------------------------------------------- large keys


def _ticks(df: DataFrame, c: str) -> tuple[Column, int] | None:
    """A whole number that orders rows as the column does, and its step."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c), 1_000_000
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long"), 1
    return (F.col(c).cast("long"), 1) if isinstance(kind, T.IntegralType) else None


def _cuts(df: DataFrame, key: str, order: list[str], slot_rows: int) -> DataFrame | None:
    """The keys of more than ``slot_rows`` rows with the width of their slots
    (0: single instants, cut by the next order column from ``tie0`` on in
    steps of ``tie_width``); None without such keys."""
    large = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > slot_rows)
    if large.isEmpty():
        return None
    ticks = _ticks(df, order[0])
    if ticks is None:
        raise ValueError(f"a key has more than {slot_rows} rows, and {order[0]} can't be cut: order by a time, a date or a whole number first")
    tick, step = ticks
    tie = _ticks(df, order[1])[0] if len(order) > 1 and _ticks(df, order[1]) else F.lit(0).cast("long")
    large = materialize(large.select("_k"), "scan-keys")
    rows = df.select(F.col(key).alias("_key"), F.floor(tick / step).cast("long").alias("_at"), tie.alias("_tie"))
    rows = rows.join(large, F.col("_key").eqNullSafe(F.col("_k")))
    each = materialize(rows.groupBy("_key", "_at").agg(F.count(F.lit(1)).alias("n"), F.min("_tie").alias("lo"), F.max("_tie").alias("hi")), "scan-counts")
    wide = each.select("_key", F.explode(F.array(*(F.lit(x).cast("long") for x in WIDTHS))).alias("width"), "_at", "n")
    full = wide.groupBy("_key", "width", F.floor(F.col("_at") / F.col("width")).alias("s")).agg(F.sum("n").alias("n")).groupBy("_key", "width").agg(F.max("n").alias("n"))
    width = full.groupBy("_key").agg(F.coalesce(F.max(F.when(F.col("n") <= slot_rows, F.col("width"))), F.lit(0).cast("long")).alias("_width"))
    ties = each.groupBy("_key").agg(F.min("lo").alias("_tie0"), (F.max("hi") - F.min("lo") + 1).alias("span"), F.sum("n").alias("n"))
    ties = ties.select(F.col("_key").alias("_k"), "_tie0", F.greatest(F.ceil(F.col("span") / F.ceil(F.col("n") / slot_rows)), F.lit(1)).cast("long").alias("_tie_width"))
    return materialize(width.join(ties, F.col("_key").eqNullSafe(F.col("_k"))).drop("_key"), "scan-cuts")


def _with_slot(df: DataFrame, key: str, order: list[str], cuts: DataFrame) -> DataFrame:
    """Adds the slot: numbers that rise with the order within a key."""
    tick, step = _ticks(df, order[0])
    tie = _ticks(df, order[1])[0] if len(order) > 1 and _ticks(df, order[1]) else F.lit(0).cast("long")
    at, cut, single = F.floor(tick / step).cast("long"), F.col("_width").isNotNull(), F.col("_width") == 0
    first = F.coalesce(F.when(single, at).otherwise(F.floor(at / F.col("_width")).cast("long")), F.lit(BEFORE_ALL))
    zero = F.lit(0).cast("long")
    slot = F.struct(
        F.when(cut, first).otherwise(zero).alias("s"),
        F.when(cut & single, F.coalesce(tick, zero)).otherwise(zero).alias("u"),
        F.when(cut & single, F.coalesce(F.floor((tie - F.col("_tie0")) / F.col("_tie_width")).cast("long"), F.lit(-1).cast("long"))).otherwise(zero).alias("k"),
    )
    rows = df.join(cuts, F.col(key).eqNullSafe(F.col("_k")), "left").withColumn(SLOT, slot)
    return rows.withColumn("_cut", cut).drop("_k", "_width", "_tie0", "_tie_width")


def _slot_scan(df, key, order, carry, rule, names, cuts, total):
    rows = _with_slot(df, key, order, cuts)
    part = [key, SLOT]
    # One row for each slot of a large key, from the narrow columns alone.
    need = dict.fromkeys([key, SLOT, *order, *carry])
    inner = _scan(rows.where("_cut").select(*need), part, order, carry, rule, names, False)
    carried, place = F.struct(F.lit(0).alias("_"), *carry), F.struct(*order)
    starts = F.max(SEQ) if rule is not None else F.lit(0)
    slots = inner.groupBy(*part).agg(F.min_by(carried, place).alias("f"), F.max_by(carried, place).alias("l"), F.count(F.lit(1)).alias("n"), starts.alias("starts"))
    over = Window.partitionBy(key).orderBy(SLOT)
    past = over.rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("p", F.lag("l").over(over))
    # The scan took a slot's first row for a start; it is one only if the rule
    # says so of the row before the slot.
    lost = F.lit(0) if rule is None else F.when(F.col("p").isNull() | rule.starts(lambda c: F.col("f")[c], lambda c: F.col("p")[c]), 0).otherwise(1)
    slots = slots.withColumn("lost", lost).withColumn("own", F.col("starts") - F.col("lost"))
    slots = slots.select(
        F.col(key).alias("_fk"),
        F.col(SLOT).alias("_fs"),
        F.col("p").alias("_fp"),
        F.coalesce(F.sum("n").over(past), F.lit(0)).alias("_fn"),
        (F.coalesce(F.sum("own").over(past), F.lit(0)) - F.col("lost")).alias("_fg"),
        F.sum("n").over(Window.partitionBy(key)).alias("_ft"),
    )
    slots = materialize(slots, "scan-slots")
    out = _scan(rows, part, order, carry, rule, names, total)
    out = out.join(slots, F.col(key).eqNullSafe(F.col("_fk")) & (F.col(SLOT) == F.col("_fs")), "left")
    mend = {names[c]: F.when(F.col(IDX) == 0, F.col("_fp")[c]).otherwise(F.col(names[c])) for c in carry}
    mend[IDX] = (F.col(IDX) + F.coalesce("_fn", F.lit(0))).cast("long")
    if rule is not None:
        mend[SEQ] = (F.col(SEQ) + F.coalesce("_fg", F.lit(0))).cast("long")
    if total:
        mend[TOTAL] = F.coalesce("_ft", TOTAL)
    return out.withColumns(mend).drop("_fk", "_fs", "_fp", "_fn", "_fg", "_ft", SLOT, "_cut")
