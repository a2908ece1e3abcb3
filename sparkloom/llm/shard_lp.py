"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts on the shard its
hash names; rounds of joins then move linked documents towards the shard that
already holds most of their group, under capacity quotas, and a last step
settles the exact row quota by moving loose documents only where it can.

Equal texts are never paired with each other: a group is a hub, and its
members are counted per *cell* (group, first shard, salt). A group spreads over
at most ``n_shards * SALTS`` cells whatever its size, so one text that holds a
third of all rows is neither a hot key nor an indivisible block, and a cell is
a small fraction of a shard. What the driver sees in a round is a demand table
of at most ``n_shards * CLASSES`` counts.

Defined cases: a null text has size 8, a null checksum and no links; empty
texts are equal texts; repeated rows are separate rows of one group; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from sparkloom.scratch import cut, drop

SALTS = 64
CLASSES = 64
ROWS_PER_BUCKET = 20_000


def assign_shards(docs: DataFrame, n_shards: int = 24, rounds: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard, and gapless slot in the shard, of every row; row counts of shards differ by one at most."""
    text = F.col(text_col)
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha1(text)).alias("key"),
    )
    h = F.xxhash64("doc_id", "size", "text_crc32")
    base = cut(base.withColumns({"init": F.pmod(h, F.lit(n_shards)).cast("int"), "salt": F.pmod(F.shiftright(h, 20), F.lit(SALTS)).cast("int"), "h": F.shiftright(h, 32)}), "base")
    total = base.count()
    caps = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    cells = propagate(base, caps, rounds)
    placed = (
        base.join(cells.select("key", "init", "salt", "label"), ["key", "init", "salt"], "left")
        .select("doc_id", "size", "text_crc32", "h", F.coalesce("label", "init").alias("label"), F.col("label").isNull().cast("int").alias("loose"))
    )
    return settle(placed, caps, total)


def propagate(base: DataFrame, caps: list[int], rounds: int) -> DataFrame:
    """Rounds of label propagation over the cells of linked documents; the last state.

    A round is one job that deals the cells out by text, once for its two
    aggregations and the join, and writes every cell with its wish, and one
    small job that counts the wishes. What a round admits is an expression over
    the written table that the next round reads, and the shards' loads are
    observed while it is written.
    """
    n = len(caps)
    cells = base.where(F.col("key").isNotNull()).groupBy("key", "init", "salt").agg(F.count(F.lit(1)).alias("c"))
    cells = cells.withColumn("n", F.sum("c").over(Window.partitionBy("key"))).where("n > 1").withColumn("label", F.col("init"))
    written, is_open = cut(cells, "cells"), [cap > 0 for cap in caps]
    state = written
    for _ in range(rounds):
        seen = Observation()
        loads = [F.sum(F.when(F.col("label") == s, F.col("c"))).alias(str(s)) for s in range(n)]
        asked = cut(_requests(state, is_open).observe(seen, *loads), "asked")
        drop(written)
        written = asked
        room = [cap - (seen.get[str(s)] or 0) for s, cap in enumerate(caps)]
        demand = {(r["target"], r["class"]): r["c"] for r in asked.where("target is not null").groupBy("target", "class").agg(F.sum("c").alias("c")).collect()}
        grant = _grants(demand, room)
        state = asked.select("key", "init", "salt", "c", "n", F.when(_admitted(grant), F.col("target")).otherwise(F.col("label")).alias("label"))
        given = [sum(c * (k < first) + c * part // 1000 * (k == first) for (t, k), c in demand.items() if t == s) for s, (first, part) in enumerate(grant)]
        if not any(given):
            break
        is_open = [r > g for r, g in zip(room, given)]
    return state


def _admitted(grant: list[tuple[int, int]]) -> Column:
    """Whether a cell's wish is granted: its class is below its target's first number, or of it and drawn."""
    at = lambda k: F.element_at(F.array(*[F.lit(g[k]) for g in grant]), F.col("target") + 1)
    dice = F.pmod(F.xxhash64("key", "init", "salt"), F.lit(1000))
    return F.col("target").isNotNull() & ((F.col("class") < at(0)) | ((F.col("class") == at(0)) & (dice < at(1))))


def _requests(state: DataFrame, is_open: list[bool]) -> DataFrame:
    """Each cell's wish to join the open shard with most of its group; null target: it stays."""
    state = state.repartition("key")  # both aggregations and the join below keep this partitioning; a text has a bounded number of cells
    held = state.groupBy("key", "label").agg(F.sum("c").alias("held"))
    free = F.element_at(F.array(*[F.lit(x) for x in is_open]), F.col("label") + 1)
    best = F.max(F.when(free, F.struct("held", F.xxhash64("key", "label").alias("tie"), "label"))).alias("best")
    groups = held.groupBy("key").agg(best, F.map_from_entries(F.collect_list(F.struct("label", "held"))).alias("shares"))
    wish = state.join(groups, "key").withColumn("held", F.element_at("shares", F.col("label")))
    better = (F.col("best.label") != F.col("label")) & (F.col("held") <= F.col("best.held"))
    size_class = 15 - F.least(F.floor(F.log2(F.col("n").cast("double"))), F.lit(15)).cast("int")
    return wish.select("key", "init", "salt", "c", "n", "label", F.when(better, F.col("best.label")).alias("target"), (size_class * 4 + F.pmod(F.hash("key"), F.lit(4))).alias("class"))


def _grants(demand: dict[tuple[int, int], int], room: list[int]) -> list[tuple[int, int]]:
    """Per shard: classes below the first number are admitted whole, of that class so many thousandths."""
    grants = []
    for s, left in enumerate(room):
        first, part, left = CLASSES, 0, max(0, left)
        for k in range(CLASSES):
            want = demand.get((s, k), 0)
            if want > left:
                first, part = k, left * 980 // want
                break
            left -= want
        grants.append((first, part))
    return grants


def settle(placed: DataFrame, caps: list[int], total: int) -> DataFrame:
    """Exact quotas and slots: each shard's rows are numbered, linked ones first, and rows numbered beyond the quota fill the places other shards have left."""
    n = len(caps)
    buckets = max(64, -(-total // (n * ROWS_PER_BUCKET)))
    placed = cut(placed.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int")).drop("h"), "placed")
    key = ["label", "loose", "bucket"]
    counts = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("label").orderBy("loose", "bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cut(counts.withColumn("before", before), "offsets")
    loads = {r["label"]: r["rows"] for r in offsets.groupBy("label").agg(F.sum("rows").alias("rows")).collect()}
    load = [loads.get(s, 0) for s in range(n)]
    over, gap, over_at, gap_at = 0, 0, [], []
    for s in range(n):
        over_at.append(over)
        gap_at.append(gap)
        over += max(0, load[s] - caps[s])
        gap += max(0, caps[s] - load[s])
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), at + 1)
    within = F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", "text_crc32", "size")) - 1
    numbered = placed.withColumn("within", within).join(offsets.drop("rows"), key).withColumn("pos", F.col("before") + F.col("within"))
    spill = F.when(F.col("pos") >= pick(caps, F.col("label")), pick(over_at, F.col("label")) + F.col("pos") - pick(caps, F.col("label")))
    to: Column = F.lit(None).cast("int")
    for s in range(n):
        if caps[s] > load[s]:
            to = F.when(F.col("spill") >= gap_at[s], F.lit(s)).otherwise(to)
    out = numbered.withColumn("spill", spill).withColumn("to", to)
    moved = F.col("spill").isNotNull()
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.when(moved, F.col("to")).otherwise(F.col("label")).alias("shard"),
        F.when(moved, pick(load, F.col("to")) + F.col("spill") - pick(gap_at, F.col("to"))).otherwise(F.col("pos")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
