"""Mixing sources to target weights by entropy balancing (operator 7).

Every document d gets a rate r_d = exp(sum of its groups' multipliers), the
rates closest to 1 in relative entropy (weighted by the documents' words)
under which each group's words times rates meet the group's token target.
The multipliers maximise the concave dual

    D(m) = sum_g m_g * target_g - sum_d size_d * (exp(sum_g m_g) - 1),

by Newton steps.  Documents enter the dual only through their cell (the
combination of their groups), so the documents are pre-aggregated to cells
once, and each iteration is an aggregation of the cell table per group and a
join back: within one family of groups (for example the sources) the Hessian
is diagonal, so a Newton step is exact per group; several families take turns.
Steps are capped at one in the exponent, where the dual is far from quadratic.

Rates are then rounded into whole copies, without a copy beyond ceil(rate).
Documents of a group are dealt by hash into blocks of about ``BLOCK_ROWS``
rows (salting a hot group; sizes are known from the counts), and within a
block, from the longest document to the shortest, each gets the number of
copies that leaves the smallest difference between wanted and taken words.
The difference left by a block is about half its shortest document.

Defined results: null and empty texts have size 0 and no copies beyond rate
rounding (they take no words); a null source is a source of its own, ordered
last; repeated rows are separate documents; an empty table gives no rows;
further columns are kept by ``mix``.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm import textvec as V
from rollcall.llm.common import free_name, map_batches, stash

# Fixed values of the mixing rule.
WEIGHTS = (5, 2, 1)       # of the sources in code-point order, repeating
SHARE = 1.5               # of all words that the mix takes
MOST = 2.0                # times a source's size
BLOCK_ROWS = 20_000
TOLERANCE = 1e-9
MAX_STEPS = 60


def sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(doc_id, source, size, tie): ``size`` counts words of the whole text,
    ``tie`` orders documents of equal size and id."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        import numpy as np
        n = np.zeros(batch.num_rows, np.int64)
        for lo, hi, data, offsets in V.chunks(batch.column(3)):
            n[lo:hi] = V.Words(data, offsets, V.NONSPACE).counts
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n)],
                                          names=["doc_id", "source", "tie", "size"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                      F.xxhash64(doc_id, text, source).alias("tie"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, source string, tie bigint, size bigint"
    return map_batches(src, run, schema)


def source_targets(totals: DataFrame) -> DataFrame:
    """(source, source_size, n, target) from (source, source_size, n).

    Weights go by the sources' order; targets are filled in rounds: sources
    above ``MOST`` times their size stop there and their excess is shared anew
    by weight.  The level at which filling ends is where the words given out,
    sum(min(MOST * size, level * weight)), reach the total; since each
    source's stop is MOST * size / weight, the level follows from running sums
    over sources in order of that stop.

    The one ordered window over all sources takes a row per source."""
    from pyspark.sql import Window

    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    t = totals.withColumn("weight", weights[(F.row_number().over(order) - 1) % len(WEIGHTS)])
    t = t.withColumn("stop", MOST * F.col("source_size") / F.col("weight"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_stop = Window.orderBy("stop", F.col("source").isNull(), "source").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    t = (t.withColumn("whole", F.sum("source_size").over(everything))
         .withColumn("all_weight", F.sum("weight").over(everything))
         .withColumn("stopped", F.sum(MOST * F.col("source_size")).over(by_stop) - MOST * F.col("source_size"))
         .withColumn("weight_left", F.col("all_weight") - F.sum("weight").over(by_stop) + F.col("weight")))
    # the level if exactly the sources before this one have stopped
    t = t.withColumn("level", (SHARE * F.col("whole") - F.col("stopped")) / F.col("weight_left"))
    # the first level, in order of the stops, that its source doesn't exceed
    level = F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "level"))).over(everything)["level"]
    t = t.withColumn("level", F.coalesce(level, F.lit(float("inf"))))
    return t.select("source", "source_size", "n",
                    F.least(MOST * F.col("source_size"), F.col("level") * F.col("weight")).alias("target"))


def entropy_balance(cells: DataFrame, size: str, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` (one row per combination of groups, with its total ``size``)
    and their ``rate``.  ``targets`` maps a group column of ``cells`` to a
    DataFrame (that column, target); groups with target 0 get rate 0."""
    state = stash(cells.withColumn("m", F.lit(0.0)), "dual")
    families = [(g, stash(t.select(F.col(g).alias("_g"), F.col("target").alias("_t")), "targets"))
                for g, t in targets.items()]
    for _ in range(MAX_STEPS):
        worst = 0.0
        for g, wanted in families:
            grad = state.groupBy(g).agg(F.sum(F.col(size) * F.exp("m")).alias("_got"))
            grad = grad.join(wanted, grad[g].eqNullSafe(wanted["_g"])).select(
                F.col(g).alias("_g"), "_t", "_got")
            # gradient target - got; Hessian -got (diagonal within a family)
            step = F.when(F.col("_got") > 0, F.greatest(F.lit(-1.0), F.least(
                F.lit(1.0), (F.col("_t") - F.col("_got")) / F.col("_got")))).otherwise(0.0)
            step = F.when(F.col("_t") <= 0, F.lit(float("-inf"))).otherwise(step)
            moves = grad.select("_g", step.alias("_step"), F.when(F.col("_t") > 0, F.abs(
                F.col("_got") - F.col("_t")) / F.col("_t")).otherwise(0.0).alias("_off"))
            state = stash(state.join(moves, state[g].eqNullSafe(moves["_g"])).select(
                *[state[c] for c in cells.columns], (state["m"] + moves["_step"]).alias("m"), "_off"), "dual")
            worst = max(worst, state.agg(F.max("_off")).first()[0] or 0.0)
            state = state.drop("_off")
        if worst < TOLERANCE:
            break
    return state.withColumn("rate", F.exp("m")).drop("m")


def _round_block(block: pa.Table) -> pa.Table:
    """Whole copies of one block's documents by error diffusion."""
    block = block.sort_by([("size", "descending"), ("doc_id", "ascending"), ("tie", "ascending")])
    carry, copies = 0.0, []
    for size, rate in zip(block["size"].to_pylist(), block["rate"].to_pylist()):
        low, high = int(rate + 1e-6), math.ceil(rate - 1e-6)
        owed = carry + rate * size
        k = low if size == 0 else min(high, max(low, int(owed / size + 0.5)))
        carry = owed - k * size
        copies.append(k)
    return block.drop_columns(["_block"]).append_column("copies", pa.array(copies, pa.int64()))


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            source: str = "source") -> DataFrame:
    """Per document: doc_id, source, tie, size, source_size, target, rate,
    copies and taken (copies * size)."""
    sized = stash(sizes(docs, doc_id, text, source), "sizes")
    totals = stash(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "totals")
    targets = stash(source_targets(totals), "source-targets")
    rates = entropy_balance(totals.select("source", "source_size"), "source_size",
                            {"source": targets.select("source", "target")})
    plan = targets.join(rates.select(F.col("source").alias("_s"), "rate"),
                        F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = plan.withColumnRenamed("source", "_s")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    blocks = F.ceil(F.col("n") / BLOCK_ROWS)
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("doc_id", "tie"), blocks))
    kind = docs.schema[doc_id].dataType.simpleString()
    done = (rows.select("doc_id", "source", "tie", "size", "rate", "_block").groupBy("source", "_block")
            .applyInArrow(_round_block, f"doc_id {kind}, source string, tie bigint, size bigint, "
                                        "rate double, copies bigint"))
    return done.join(plan.drop("rate"), F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", "tie", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs``, each row as often as the mixture has copies of it, with the
    number of the copy as ``copy`` (``_copy`` if there is such a column)."""
    from pyspark.sql import Window

    id_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    plan = mixture(docs, doc_id, text, source).select(F.col("tie").alias("_tie"), id_text.alias("_id"), "copies")
    # repeated rows are alike: their copies are pooled and dealt out evenly
    plan = plan.groupBy("_tie", "_id").agg(F.sum("copies").alias("_sum"), F.count("*").alias("_n"))
    same = Window.partitionBy("_tie", "_id").orderBy(F.lit(0))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64(doc_id, text, source).alias("_tie"),
                       id_text.alias("_id")).withColumn("_nth", F.row_number().over(same))
    copies = (F.floor(F.col("_sum") / F.col("_n")) + (F.col("_nth") <= F.col("_sum") % F.col("_n")).cast("int"))
    return (rows.join(plan, ["_tie", "_id"]).withColumn("_copies", copies.cast("int")).where("_copies > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
            .select("_row.*", F.col("_copy").alias(free_name(docs.columns, "copy"))))
