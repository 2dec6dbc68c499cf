"""Set operators: union-all append (U1), symmetric difference (U2) and the
directed differences (U3) with set semantics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """Append by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _in_one_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """The distinct rows in exactly one of ``a`` and ``b``, with ``_in_a``:
    the tagged sides in one aggregation, so each is read once and combined
    map-side before a single shuffle.  Nulls equal nulls."""
    tagged = (a.select("*", F.lit(True).alias("_in_a"))
              .unionByName(b.select("*", F.lit(False).alias("_in_a"))))
    sides = tagged.groupBy(*a.columns).agg(F.bool_or("_in_a").alias("_in_a"),
                                           F.bool_or(~F.col("_in_a")).alias("_in_b"))
    return sides.where(F.col("_in_a") != F.col("_in_b")).drop("_in_b")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in exactly one of ``a`` and ``b`` (distinct)."""
    return _in_one_side(a, b).drop("_in_a")


def directed_difference(want: DataFrame, have: DataFrame,
                        add: str = "ADD", remove: str = "REMOVE",
                        op_col: str = "op") -> DataFrame:
    """What to change so that ``have`` becomes ``want``: rows of ``want``
    missing from ``have`` tagged ``add``, rows of ``have`` missing from
    ``want`` tagged ``remove`` (distinct rows)."""
    op = F.when(F.col("_in_a"), F.lit(add)).otherwise(F.lit(remove))
    return _in_one_side(want, have).select(*want.columns, op.alias(op_col))
