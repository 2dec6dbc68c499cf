"""Join helpers: key lookup with a not-found branch
(P16), update from a mapping (P17), conditional set (P18), delete where
(P19)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Joins carry no broadcast hint: the planner broadcasts a side whose estimated
# size is under spark.sql.autoBroadcastJoinThreshold and AQE re-plans from
# measured shuffle sizes, falling back to a sort-merge join.


def lookup(df: DataFrame, dim: DataFrame, left_on: str, right_on: str,
           found_col: str = "found") -> DataFrame:
    """Left join to a dimension with a ``found`` flag for the not-found
    branch.  The dimension must be unique on ``right_on`` (dedupe it first),
    or rows fan out."""
    d = dim.withColumn("_hit", F.lit(True))
    out = df.join(d, df[left_on] == d[right_on], "left")
    return out.withColumn(found_col, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def apply_mapping(base: DataFrame, mapping: DataFrame, on: str, sets: dict[str, str],
                  map_key: str | None = None) -> DataFrame:
    """Replace columns of ``base`` from a mapping keyed by ``on``:
    ``sets = {base_column: mapping_column}``.  Rows without a mapping (or with
    a null new value) keep their value.  Adds ``changed``."""
    map_key = map_key or on
    m = mapping.select(F.col(map_key).alias("_mk"),
                       *[F.col(src).alias("_new_" + dst) for dst, src in sets.items()])
    j = base.join(m, base[on] == m["_mk"], "left")
    changed = reduce(lambda a, b: a | b,
                     [F.coalesce(F.col("_new_" + d) != F.col(d), F.col(d).isNull() & F.col("_new_" + d).isNotNull())
                      for d in sets])
    out = j.select(*[F.coalesce(F.col("_new_" + c), F.col(c)).alias(c) if c in sets else F.col(c)
                     for c in base.columns],
                   (F.col("_mk").isNotNull() & F.coalesce(changed, F.lit(False))).alias("changed"))
    return out


def set_where(df: DataFrame, cond: Column, column: str, value) -> DataFrame:
    """Set ``column`` to ``value`` where ``cond`` holds; adds ``changed``."""
    v = value if isinstance(value, Column) else F.lit(value)
    hit = F.coalesce(cond, F.lit(False))
    return (df.withColumn("changed", hit & ~F.coalesce(F.col(column) == v, F.lit(False)))
              .withColumn(column, F.when(hit, v).otherwise(F.col(column))))


def delete_where(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) split of ``df`` by ``cond`` (null counts as false)."""
    hit = F.coalesce(cond, F.lit(False))
    return df.where(~hit), df.where(hit)
