"""Packing by concatenation: a stream of token samples cut into chunks of fixed length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.dist import cut

SEQ_LEN = 4096


def with_eos(ids: Column, eos_id: int, add_eos: bool = True, ensure_eos: bool = True) -> Column:
    """Append the end mark: if it is missing (``ensure_eos``) or always; empty samples stay empty."""
    ids = F.coalesce(ids, F.array().cast("array<int>"))
    if not add_eos:
        return ids
    added = F.concat(ids, F.array(F.lit(eos_id).cast("int")))
    full = F.size(ids) > 0
    missing = F.coalesce(F.try_element_at(ids, F.lit(-1)) != eos_id, F.lit(True))
    return F.when(full & missing, added).otherwise(ids) if ensure_eos else F.when(full, added).otherwise(ids)


def positions(df: DataFrame, size: Column, order: list[str]) -> DataFrame:
    """Add ``_start``, the sum of ``size`` over all rows before in the order of ``order``, and ``_nth``, counted from 1.

    A global prefix sum without a global window: rows are ranged by ``order``, of
    any type, into as many parts as a shuffle has; sums run within a part, and the
    totals of the parts (one row each) are summed up. The rows are written once
    with their sums; to find the ranges they are read once before, so rows that are
    costly to make should come from a written table. Rows that tie in all of
    ``order`` may come in any order.
    """
    ranged = df.withColumn("_size", size.cast("long")).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut(ranged.withColumns({"_upto": F.sum("_size").over(inside), "_nth": F.row_number().over(inside).cast("long")}))
    totals = summed.groupBy("_range").agg(F.max("_upto").alias("_total"), F.max("_nth").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_ahead"))
    out = summed.join(F.broadcast(totals), "_range")  # one row for each part of a shuffle
    return out.withColumns({"_start": F.col("_before") + F.col("_upto") - F.col("_size"), "_nth": F.col("_ahead") + F.col("_nth")}).drop("_range", "_upto", "_before", "_ahead", "_size")


def pack(
    df: DataFrame,
    order: list[str],
    ids_col: str = "input_ids",
    seq_len: int = SEQ_LEN,
    eos_id: int = 2,
    add_eos: bool = True,
    ensure_eos: bool = True,
    drop_remainder: bool = True,
    emit_runs: bool = True,
    limit: int = 0,
) -> DataFrame:
    """(chunk_id, input_ids[, seq_id, seq_lens, offsets]): the samples' tokens in order, cut every ``seq_len``.

    Samples run on from chunk to chunk. ``seq_id`` numbers the samples within a
    chunk, ``seq_lens`` are their lengths there and ``offsets`` their starts and
    the end. The last, shorter chunk is dropped, or filled with end marks that
    form a sample of their own. ``limit`` takes the first rows in order.
    """
    samples = df.select(*order, with_eos(F.col(ids_col), eos_id, add_eos, ensure_eos).alias("_ids"))
    # the limit counts empty samples too
    placed = positions(samples if limit else samples.where(F.size("_ids") > 0), F.size("_ids"), order)
    if limit:
        placed = placed.where((F.col("_nth") <= limit) & (F.size("_ids") > 0))
    first, last = F.floor(F.col("_start") / seq_len), F.floor((F.col("_start") + F.size("_ids") - 1) / seq_len)
    parts = placed.select("_start", "_ids", F.explode(F.sequence(first, last)).alias("chunk_id"))
    begin = F.greatest(F.col("chunk_id") * seq_len, F.col("_start"))
    end = F.least((F.col("chunk_id") + 1) * seq_len, F.col("_start") + F.size("_ids"))
    parts = parts.select("chunk_id", (begin - F.col("chunk_id") * seq_len).cast("int").alias("at"), F.slice("_ids", (begin - F.col("_start") + 1).cast("int"), (end - begin).cast("int")).alias("ids"))
    # a chunk is at most seq_len tokens, so the list is bounded
    chunks = parts.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("_p"))
    have = F.aggregate("_p", F.lit(0), lambda a, x: a + F.size(x["ids"]))
    chunks = chunks.withColumn("_have", have)
    if drop_remainder:
        chunks = chunks.where(F.col("_have") == seq_len)
    else:
        fill = F.array(F.struct(F.col("_have").alias("at"), F.array_repeat(F.lit(eos_id).cast("int"), F.lit(seq_len) - F.col("_have")).alias("ids")))
        chunks = chunks.withColumn("_p", F.when(F.col("_have") < seq_len, F.concat("_p", fill)).otherwise(F.col("_p")))
    out = [F.col("chunk_id"), F.flatten(F.transform("_p", lambda x: x["ids"])).alias("input_ids")]
    if emit_runs:
        out += [
            F.flatten(F.transform("_p", lambda x, i: F.array_repeat(i, F.size(x["ids"])))).alias("seq_id"),
            F.transform("_p", lambda x: F.size(x["ids"])).alias("seq_lens"),
            F.concat(F.transform("_p", lambda x: x["at"]), F.array(F.lit(seq_len))).alias("offsets"),
        ]
    return chunks.select(*out)


def packing_summary(chunks: DataFrame) -> DataFrame:
    """One row: chunks, tokens and samples' parts."""
    chunks = cut(chunks.select(F.size("input_ids").alias("n"), F.size("seq_lens").alias("parts")))
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("parts"), F.lit(0)).alias("parts"))
