"""Shape operators: flatten nested structs (P1), explode a list beside its
parent (P2), keep-list (P3) and strict drop-list (P4) projections, and the
positional zip of two frames (J11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _flat_cols(path: list[str], name: list[str], dtype, sep: str,
               max_level: int | None, level: int, out: list) -> None:
    if isinstance(dtype, StructType) and (max_level is None or level < max_level):
        for f in dtype.fields:
            _flat_cols(path + [f.name], name + [f.name], f.dataType, sep, max_level, level + 1, out)
    else:
        out.append(F.col(".".join(_q(p) for p in path)).alias(sep.join(name)))


def flatten(df: DataFrame, sep: str = ".", max_level: int | None = None) -> DataFrame:
    """Expand struct columns into ``parent<sep>child`` columns, recursively
    (up to ``max_level`` struct levels).  Lists are left as they are.  This is
    a pure projection: nested schema pruning still reaches the scan."""
    cols: list = []
    for f in df.schema.fields:
        _flat_cols([f.name], [f.name], f.dataType, sep, max_level, 0, cols)
    return df.select(*cols)


def explode_records(df: DataFrame, field: str, pos_col: str = "pos",
                    sep: str = ".", max_level: int | None = None) -> DataFrame:
    """One row per element of list ``field`` beside the parent's columns,
    child struct fields flattened under their own names.  A record with an
    empty or missing list keeps one row with null child fields
    (``explode_outer``); ``pos_col`` is the element's position."""
    parent = [F.col(_q(c)) for c in df.columns if c != field]
    ex = df.select(*parent, F.posexplode_outer(F.col(_q(field))).alias(pos_col, "_elem"))
    elem_type = df.schema[field].dataType.elementType
    if not isinstance(elem_type, StructType):
        return ex.withColumnRenamed("_elem", field)
    child: list = []
    for f in elem_type.fields:
        _flat_cols(["_elem", f.name], [f.name], f.dataType, sep, max_level, 1, child)
    return ex.select(*parent, F.col(pos_col), *child)


def keep(df: DataFrame, names) -> DataFrame:
    """Keep only the listed columns that exist, in the frame's own order;
    names that are missing are ignored."""
    wanted = set(names)
    return df.select(*[F.col(_q(c)) for c in df.columns if c in wanted])


def drop_strict(df: DataFrame, names) -> DataFrame:
    """Drop the listed columns; fail if one is missing (plain ``drop`` is
    silent about unknown names)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    gone = set(names)
    return df.select(*[F.col(_q(c)) for c in df.columns if c not in gone])


def missing_columns(df: DataFrame, names) -> list[str]:
    """Names of ``df`` that are not in ``names`` (column-name difference, U4)."""
    wanted = set(names)
    return [c for c in df.columns if c not in wanted]


def row_index(df: DataFrame, order_cols, index_col: str = "row_no",
              partitions: int | None = None) -> DataFrame:
    """Consecutive 1-based index in ``order_cols`` order (``running_total``)."""
    return running_total(df, order_cols, index_col=index_col, partitions=partitions)


def running_total(df: DataFrame, order_cols, value_col: str | None = None, total_col: str = "total_before",
                  index_col: str = "row_no", partitions: int | None = None) -> DataFrame:
    """Consecutive 1-based index in ``order_cols`` order, and (with
    ``value_col``) the sum of that column over all rows before, without
    funnelling the data through one task: range-partition and sort, count and
    sum per partition, and add each partition's offsets (a table with one row
    per partition, so its broadcast has a fixed bound).  The order must be
    total (unique keys) for the result to be deterministic."""
    from rollcall.session import materialize
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    value = F.col(value_col) if value_col else F.lit(0)
    part = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_mid", F.monotonically_increasing_id()))
    part = materialize(part)  # the index must not change between its two uses
    counts = part.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_sum"))
    out = part.join(F.broadcast(offsets), "_pid").withColumn(
        index_col, F.col("_off") + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)) + 1)
    if value_col:
        inside = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(total_col, (F.col("_sum") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("long"))
    return out.drop("_pid", "_mid", "_off", "_sum")


def zip_rows(a: DataFrame, b: DataFrame, order_a, order_b, index_col: str = "row_no") -> DataFrame:
    """Pair the i-th row of ``a`` with the i-th row of ``b`` (full outer join
    on the row number).  Right only when both sides hold one row per record;
    kept for compatibility, ``explode_records`` is the correct form."""
    ia = row_index(a, order_a, index_col)
    ib = row_index(b, order_b, index_col)
    return ia.join(ib, index_col, "full_outer")


def zip_alignment(df: DataFrame, order_col: str, field: str) -> DataFrame:
    """Where the positional zip of records and list elements goes wrong (T1),
    without the zip: per record whose list hasn't exactly one element, or that
    the zip pairs with another record's element (or none), ``row_no``, its
    number of elements, the elements of all records before it and ``aligned``:
    whether the element at the record's position is one of its own."""
    size = F.coalesce(F.when(F.size(field) >= 0, F.size(field)), F.lit(0)).cast("long")
    rows = df.select(order_col, size.alias("n_elements"))
    t = running_total(rows, [order_col], "n_elements", "elements_before")
    at = F.col("row_no") - 1
    own = (F.col("elements_before") <= at) & (at < F.col("elements_before") + F.col("n_elements"))
    return t.withColumn("aligned", own).where((F.col("n_elements") != 1) | ~F.col("aligned"))
