"""Change-set sinks (K4).

Change sets are appended keyed by event (idempotent per batch folder), and a
state table (e.g. a roster snapshot the jobs read next time) is brought up
to date by a full-outer-join rewrite: for every key the update wins, keys
without an update keep their row, and updates flagged as deletions remove
it.  Where the table format supports it, ``MERGE INTO`` is the in-place
equivalent; this form works on plain parquet.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_change_set(df: DataFrame, path: str, batch_id: int | str) -> None:
    """Write one batch's change set into its own folder with ``overwrite``:
    a re-run of the batch replaces, never duplicates, its rows."""
    df.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))


def upsert_state(state: DataFrame, updates: DataFrame, keys: list[str],
                 delete_col: str | None = None) -> DataFrame:
    """New state = state with ``updates`` applied by key (full outer join).
    ``updates`` must hold one row per key and the state's columns (plus
    ``delete_col`` when given: true removes the key)."""
    value_cols = [c for c in state.columns if c not in keys]
    u = updates.select(*keys, *[F.col(c).alias("_u_" + c) for c in value_cols],
                       *([F.col(delete_col).alias("_del")] if delete_col else []),
                       F.lit(True).alias("_hit"))
    j = state.join(u, keys, "full_outer")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = j.select(*keys, *[F.when(hit, F.col("_u_" + c)).otherwise(F.col(c)).alias(c) for c in value_cols],
                   *([F.coalesce(F.col("_del"), F.lit(False)).alias("_del")] if delete_col else []))
    return out.where(~F.col("_del")).drop("_del") if delete_col else out
