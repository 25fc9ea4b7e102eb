"""Problem 5: items of varying length into containers of fixed capacity.

Shortest-pack-first over the histogram of lengths: lengths are placed longest
first, each into the pack that is shortest so far and still has room, and what is
kept is not packs but how many packs have one pattern of lengths. The histogram
has at most ``capacity`` rows, so planning takes the same memory for any number
of items. The plan is joined back to the items by their rank within a length.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.dist import ROWS_PER_SLICE

CAPACITY = 4096


def plan_packs(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (number of packs, lengths in each, longest first) that use up the histogram.

    A pattern with ``c`` packs stands for ``c`` containers, so one step places
    as many items as the pattern has packs. A step splits at most one pattern:
    there are at most two patterns for each distinct length.
    """
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit 1..{capacity}")
        per_pack = capacity // length
        while left > 0:
            room = max((r for r, packs in by_room.items() if packs and r >= length), default=None)
            if room is None:
                # no pack has room: as many new packs as the rest will fill evenly
                fresh = -(-left // per_pack)
                full, rest = divmod(left, fresh)
                for packs, each in ((rest, full + 1), (fresh - rest, full)):
                    if packs and each:
                        by_room[capacity - each * length].append((packs, (length,) * each))
                break
            packs, pattern = by_room[room].pop()
            used = min(packs, left)
            if packs > used:
                by_room[room].append((packs - used, pattern))
            by_room[room - length].append((used, (*pattern, length)))
            left -= used
    return [x for room in sorted(by_room) for x in by_room[room]]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first pack, items of this length in a pack, offset in the pack)."""
    rank: dict[int, int] = defaultdict(int)
    out, pack = [], 0
    for packs, pattern in patterns:
        at, i = 0, 0
        while i < len(pattern):
            length, k = pattern[i], pattern.count(pattern[i])
            out.append((length, rank[length], rank[length] + packs * k, pack, k, at))
            rank[length] += packs * k
            at, i = at + k * length, i + k
        pack += packs
    return out


def pack_items(
    samples: DataFrame,
    capacity: int = CAPACITY,
    keys: tuple[str, ...] = ("sample_id", "doc_id"),
    ids: str = "input_ids",
    keep_tokens: bool = False,
) -> DataFrame:
    """(*keys, piece, n_tokens, pack_id, pack_offset[, tokens]): the container of every piece.

    The size of an item is that of ``ids``; any length column is ignored. An item
    longer than ``capacity`` is cut into full pieces and a rest; no other is cut.
    Every row is an item of its own, so repeated rows are all packed. An item
    with null or no ids takes no place: one row with ``n_tokens`` 0 and null
    ``pack_id``. Columns other than keys and ids are ignored; an empty table
    gives no rows.
    """
    spark = samples.sparkSession
    size = F.coalesce(F.size(F.col(ids)), F.lit(0))
    size = F.when(size < 0, 0).otherwise(size)
    # the true sizes come from the ids, once
    histogram = (
        samples.select(size.alias("n"))
        .select(F.explode(F.when(F.col("n") > capacity, F.array(F.struct(F.lit(capacity).alias("len"), F.floor(F.col("n") / capacity).alias("times")), F.struct((F.col("n") % capacity).alias("len"), F.lit(1).cast("long").alias("times")))).otherwise(F.array(F.struct(F.col("n").alias("len"), F.lit(1).cast("long").alias("times"))))).alias("e"))
        .groupBy("e.len")
        .agg(F.sum("e.times").alias("times"))
        .where("len > 0")
    )
    counts = {r["len"]: r["times"] for r in histogram.collect()}  # at most `capacity` rows
    plan = slots(plan_packs(counts, capacity))
    salts = max(1, -(-max(counts.values(), default=0) // ROWS_PER_SLICE))

    cut = F.transform(F.sequence(F.lit(0), F.ceil(F.col("_n") / capacity).cast("int") - 1), lambda i: F.struct(i.alias("piece"), F.least(F.lit(capacity), F.col("_n") - i * capacity).cast("int").alias("n_tokens")))
    pieces = samples.select(*keys, *([ids] if keep_tokens else []), size.alias("_n")).withColumn("_p", F.explode(F.when(F.col("_n") > 0, cut).otherwise(F.array(F.struct(F.lit(0).alias("piece"), F.lit(0).alias("n_tokens"))))))
    pieces = pieces.select(*keys, "_p.piece", "_p.n_tokens", *([F.slice(ids, F.col("_p.piece") * capacity + 1, F.greatest(F.col("_p.n_tokens"), F.lit(1))).alias("tokens")] if keep_tokens else []))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*keys, "piece"), F.lit(salts)).cast("int"))
    # the rank in a length: rank in a salt, plus what the salts before it hold
    placed = salted.where("n_tokens > 0")
    before = (
        placed.groupBy("n_tokens", "_salt")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_before", F.sum("_c").over(Window.partitionBy("n_tokens").orderBy("_salt")) - F.col("_c"))
        .drop("_c")
    )
    ranked = placed.withColumn("_rank", F.row_number().over(Window.partitionBy("n_tokens", "_salt").orderBy(*keys, "piece")) - 1)
    if salts > 1:
        ranked = ranked.join(before, ["n_tokens", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before")
    # the plan's rows: at most two patterns a length, each with under sqrt(2 * capacity) distinct lengths
    table = spark.createDataFrame(plan, "n_tokens int, _from long, _to long, _pack long, _k long, _at int")
    ranked = ranked.join(F.broadcast(table), "n_tokens").where("_rank >= _from and _rank < _to")
    out = ranked.withColumn("pack_id", F.col("_pack") + F.floor((F.col("_rank") - F.col("_from")) / F.col("_k"))).withColumn("pack_offset", (F.col("_at") + (F.col("_rank") - F.col("_from")) % F.col("_k") * F.col("n_tokens")).cast("int"))
    names = [*keys, "piece", "n_tokens", "pack_id", "pack_offset", *(["tokens"] if keep_tokens else [])]
    empty = salted.where("n_tokens = 0").withColumns({"pack_id": F.lit(None).cast("long"), "pack_offset": F.lit(None).cast("int")})
    return out.select(*names).unionByName(empty.select(*names))


def packed_sequences(samples: DataFrame, capacity: int = CAPACITY, **kw) -> DataFrame:
    """(pack_id, input_ids, n_items, n_tokens): the containers themselves, at most ``capacity`` tokens each."""
    items = pack_items(samples, capacity, keep_tokens=True, **kw).where("pack_id is not null")
    parts = F.array_sort(F.collect_list(F.struct("pack_offset", "tokens")))
    return items.groupBy("pack_id").agg(F.flatten(F.transform(parts, lambda x: x["tokens"])).alias("input_ids"), F.count(F.lit(1)).alias("n_items"), F.sum("n_tokens").alias("n_tokens"))


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens, unused places and the least number of containers possible."""
    used = packed.where("pack_id is not null")
    sums = used.agg(F.coalesce(F.max("pack_id") + 1, F.lit(0)).alias("packs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"))
    return sums.withColumn("unused", F.col("packs") * capacity - F.col("tokens")).withColumn("packs_at_least", F.ceil(F.col("tokens") / capacity))


def packing_checks(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: pieces, tokens, the fewest containers possible, containers that are too full or whose pieces overlap, and whether at most 1 % more (and one) are used."""
    used = packed.where("pack_id is not null")
    behind = F.coalesce(F.lag(F.col("pack_offset") + F.col("n_tokens")).over(Window.partitionBy("pack_id").orderBy("pack_offset")), F.lit(0))
    packs = used.withColumn("_gap", F.col("pack_offset") - behind).groupBy("pack_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("tokens"), F.max(F.abs("_gap")).alias("_gap"))
    sums = packs.agg(F.coalesce(F.sum("pieces"), F.lit(0)).alias("pieces"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("_packs"), F.count(F.when((F.col("tokens") > capacity) | (F.col("_gap") > 0), 1)).alias("bad_packs"))
    least = F.ceil(F.col("tokens") / capacity)
    return sums.select("pieces", "tokens", least.alias("packs_at_least"), "bad_packs", (F.col("_packs") <= least * 1.01 + 1).alias("close"))
