"""Order-dependent operators written so that no key's rows have to meet in
one task.

The reference processes the feed row by row; in set form three questions
remain: which row is the first of its key (W1/W2), what is the last value of
a key (A5), and what was the value of the previous row of the same key (W3).

* ``first_per_key`` / ``last_per_key`` are aggregations (``min``/``max`` of a
  struct that leads with the order columns), so Spark combines partial
  results map-side before the shuffle: a key holding a third of all rows
  costs one partial row per task, not a third of the data in one task.
* ``previous_value`` is an exact lag over a key.  Rows are cut into blocks of
  the (long) order column; the lag inside a block is a window over
  ``(key, block)`` — at most ``block`` order values — and the first row of a
  block takes the last value of the key's nearest earlier block, found from a
  per-block summary (an aggregation, one row per key and block).  With sparse
  order values that summary is as long as the rows, so it is cut into blocks
  of blocks the same way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Three levels of 2**21 order values cover all 63 bits of a long, so no window
# sorts more than 2**21 rows, or summaries, of one key at any spread of ids.
DEFAULT_BLOCK = 1 << 21
LEVELS = 3


def first_per_key(df: DataFrame, keys, order, values, prefix: str = "first_",
                  count: str | None = None) -> DataFrame:
    """One row per key: the order columns and ``values`` of its first row
    (smallest ``order``), named ``prefix + column``, and with ``count`` the
    key's number of rows under that name."""
    packed = F.struct(*[F.col(c).alias(c) for c in list(order) + list(values)])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"), F.count(F.lit(1)).alias("_n"))
    return agg.select(*keys, *[F.col("_first." + c).alias(prefix + c) for c in list(order) + list(values)],
                      *([F.col("_n").alias(count)] if count else []))


def last_per_key(df: DataFrame, keys, order, values, prefix: str = "last_") -> DataFrame:
    """One row per key: the order columns and ``values`` of its last row."""
    packed = F.struct(*[F.col(c).alias(c) for c in list(order) + list(values)])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_last"))
    return agg.select(*keys, *[F.col("_last." + c).alias(prefix + c)
                               for c in list(order) + list(values)])


HEAVY_ROWS = 100_000    # rows that make a key heavy
HEAVY_KEYS = 10_000     # heavy keys that are broadcast at most


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` with one row per key, whatever a key's share of
    the rows.  ``count`` is a column of ``per_key``: the key's number of rows
    (dropped here).  The at most HEAVY_KEYS keys with the most rows above
    HEAVY_ROWS are broadcast and their rows stay where they are; of the others
    none has more than HEAVY_ROWS rows or a HEAVY_KEYS-th of all, so the
    shuffled join has no large key."""
    heavy = per_key.where(F.col(count) > HEAVY_ROWS).orderBy(F.col(count).desc(), key).limit(HEAVY_KEYS)
    names = F.broadcast(heavy.select(key))
    light = rows.join(names, key, "left_anti").join(per_key.drop(count), key)
    return light.unionByName(rows.join(F.broadcast(heavy.drop(count)), key))


def previous_value(df: DataFrame, keys, order_col: str, value_col: str,
                   tie_col: str | None = None, out_col: str | None = None,
                   block: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """Add ``out_col`` = struct(``value``) of the previous row of the same key
    in ``(order_col, tie_col)`` order, null for a key's first row.  (The
    struct tells "no previous row" apart from "previous value was null".)

    ``initial`` (keys + ``value``, one row per key) gives the value before a
    key's first row, e.g. the state of a snapshot.  It is joined to the small
    per-(key, block) summary, not to the rows, so it costs no extra shuffle
    of ``df``.

    ``order_col`` must be a long; the result is exact for any distribution of
    keys."""
    out_col = out_col or "prev_" + value_col
    return _previous(df, list(keys), order_col, value_col, tie_col, out_col,
                     block or DEFAULT_BLOCK, initial, LEVELS)


def _previous(df: DataFrame, keys: list, order_col: str, value_col: str, tie_col: str | None,
              out_col: str, block: int, initial: DataFrame | None, levels: int) -> DataFrame:
    """``previous_value`` with ``levels`` levels of blocks: the summary of one
    level's blocks (their last value each) is the next level's input."""
    order = [order_col] + ([tie_col] if tie_col else [])
    value = F.struct(F.col(value_col).alias("value"))
    if levels == 1:
        w = Window.partitionBy(*keys).orderBy(*order)
        lagged = df.select(*df.columns, F.lag(value).over(w).alias(out_col))
        return lagged if initial is None else _with_initial(lagged, keys, out_col, initial)

    blk = f"_blk{levels}"
    b = df.withColumn(blk, F.floor(F.col(order_col) / F.lit(block)))
    w_in = Window.partitionBy(*keys, blk).orderBy(*order)
    b = b.withColumn("_pl", F.lag(value).over(w_in))
    summary = (b.groupBy(*keys, blk)
               .agg(F.max(F.struct(*order, F.col(value_col).alias("value"))).alias("_last"))
               .select(*keys, blk, F.col("_last.value").alias("_value")))
    summary = _previous(summary, keys, blk, "_value", None, "_pb", block, initial, levels - 1)

    on = reduce(lambda x, y: x & y,
                [F.col("_b." + k).eqNullSafe(F.col("_s." + k)) for k in keys + [blk]])
    joined = b.alias("_b").join(summary.alias("_s"), on, "left")
    return joined.select(
        *[F.col("_b." + c) for c in df.columns],
        F.coalesce(F.col("_b._pl"), F.col("_s._pb")).alias(out_col))


def _with_initial(df: DataFrame, keys: list, out_col: str, initial: DataFrame) -> DataFrame:
    """``out_col`` filled from ``initial`` where it is null."""
    init = initial.select(*keys, F.struct(F.col("value").alias("value")).alias("_init"))
    on = reduce(lambda x, y: x & y, [df[k].eqNullSafe(init[k]) for k in keys])
    rest = [df[c] for c in df.columns if c != out_col]
    return df.join(init, on, "left").select(*rest, F.coalesce(df[out_col], F.col("_init")).alias(out_col))
