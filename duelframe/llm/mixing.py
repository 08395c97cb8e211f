"""Mixing of sources to target weights by Pfair scheduling.

Each source's documents are laid end to end in an order without pattern and cut into blocks of equal size.
The k-th block of a source with weight w may be sent from slot floor((k - 1) / w) on and must be sent before
slot ceil(k / w); among the blocks that may be sent, the one with the earliest deadline goes first. At every
slot each source then has had its share to within less than one block. Weights are whole numbers of slots
in a period, so after each period all shares are exact, the schedule repeats, and only one period has to be
worked out, whatever the size of the input.

Nothing is dropped: the schedule ends with the last block of the source that takes longest, and sources that
end before begin again with their first block.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.common import spread

#: Characters in a block; a longer document is in the block in which it begins.
BLOCK = 16_384
#: Target weights are the sources' sizes to this power, so that large ones weigh less than their size.
POWER = 0.8
#: Slots of a period at least; with many sources there are MIN_SLOTS of them for each.
PERIOD = 2048
MIN_SLOTS = 8
#: Sources at most, whose names, sizes and slots the driver holds. More are an error, not a loss.
MOST_SOURCES = 20_000
#: Documents whose places one task works out.
ROWS_PER_BUCKET = 20_000


def shares(weights: dict, slots: int) -> dict:
    """Whole slots per period in proportion to the weights, one at least, by largest remainder."""
    names = sorted(weights, key=lambda s: (s is None, s))
    total = sum(weights[s] for s in names)
    if min(weights.values()) < 0 or total <= 0:
        raise ValueError("weights must not be negative, and one of them must be positive")
    exact = {s: slots * weights[s] / total for s in names}
    found = {s: max(1, int(exact[s])) for s in names}
    order = sorted(names, key=lambda s: (found[s] - exact[s], names.index(s)))
    i = 0
    while (rest := slots - sum(found.values())) != 0:
        s = order[i % len(order)] if rest > 0 else order[-1 - i % len(order)]
        i += 1
        if rest > 0 or found[s] > 1:
            found[s] += 1 if rest > 0 else -1
    return found


def schedule(slots: dict, period: int) -> dict:
    """The slots of one period that each source gets, earliest deadline first among released blocks."""
    names = sorted(slots, key=lambda s: (s is None, s))
    release = lambda k, a: (k - 1) * period // a
    deadline = lambda k, a: -(-k * period // a)
    waiting = [(0, i, 1) for i in range(len(names))]
    ready: list[tuple[int, int, int]] = []
    found: dict = {s: [] for s in names}
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline(k, slots[names[i]]), i, k))
        due, i, k = heapq.heappop(ready)
        if due <= t:
            raise ValueError("a deadline passed; the slots don't add up to the period")
        found[names[i]].append(t)
        if k < slots[names[i]]:
            heapq.heappush(waiting, (release(k + 1, slots[names[i]]), i, k + 1))
    return found


def mix(documents: DataFrame, weights: dict | None = None, block: int = BLOCK, power: float = POWER, size: str | None = None) -> DataFrame:
    """Documents with their places in the mixed order: one row per document and epoch.

    Adds source_block (the block of the source, from 0), epoch, slot, release and deadline (the slots between
    which the block had to be sent, the deadline itself excluded), place (characters of the block before the
    document) to all columns of `documents`. The order is slot, place, doc_id. Every row of `documents` comes in
    epoch 0 once, and a source comes to `weights` (any positive scale; sources not named weigh nothing more
    than one slot a period) of every stretch of blocks to within less than one block.

    `size` names a column with the documents' sizes, if not the characters of `text` are to count.
    A null source is a source of its own. Null texts take no place but are sent. Repeated rows are sent
    each. An empty table gives no row. Columns of `documents` with the names of the added ones are replaced.
    """
    spark = documents.sparkSession
    added = ["source_block", "epoch", "slot", "release", "deadline", "place"]
    documents = documents.drop(*added)
    length = F.coalesce(F.col(size) if size else F.length("text"), F.lit(0)).cast("long")
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))  # joins take equal keys only
    rows = documents.select(F.struct(*documents.columns).alias("d"), F.col("source").cast("string").alias("s"), key.alias("key"), F.col("doc_id").cast("string").alias("i"), spread("doc_id").alias("h"), length.alias("n"))
    by_source = rows.groupBy("s").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("size"))
    sizes = {r["s"]: (r["rows"], r["size"]) for r in by_source.limit(MOST_SOURCES + 1).collect()}
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"this operator takes {MOST_SOURCES} sources, and there are more")
    if not sizes:
        empty = documents.limit(0)
        return empty.withColumns({c: F.lit(None).cast("long") for c in added})

    # Where each document begins in its source: sums by bucket of the hash, then within the bucket.
    buckets = max(16, -(-sum(n for n, _ in sizes.values()) // ROWS_PER_BUCKET))
    bucket = F.floor(F.col("h") / F.lit(float(1 << 63)) * buckets).cast("int").alias("b")
    sums = rows.select("key", "n", bucket).groupBy("key", "b").agg(F.sum("n").alias("sum"))
    before = Window.partitionBy("key").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("key", "b", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("key", "b").orderBy("h", "i", "n").rowsBetween(Window.unboundedPreceding, -1)
    # Rows of one id stand side by side; those of equal size may change places.
    placed = rows.withColumn("b", bucket).withColumn("at", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    placed = placed.join(sums, ["key", "b"]).withColumn("at", F.col("at") + F.col("offset"))
    own_block = F.floor(F.col("at") / block)

    # One period, and how long it takes until each source has been sent whole once.
    blocks = {s: max(0, size - 1) // block + 1 for s, (_, size) in sizes.items()}  # documents begin in these
    period = max(PERIOD, MIN_SLOTS * len(sizes))
    wanted = {s: float((weights or {}).get(s, 0.0)) if weights else float(max(1, size)) ** power for s, (_, size) in sizes.items()}
    slots = shares(wanted, period)
    sent = schedule(slots, period)
    slot_of = lambda s, k: k // slots[s] * period + sent[s][k % slots[s]]
    end = max(slot_of(s, n - 1) for s, n in blocks.items()) + 1
    total = {s: end // period * slots[s] + sum(t < end % period for t in sent[s]) for s in blocks}
    # Bounded by MOST_SOURCES and the period, so small enough for every task.
    plan = spark.createDataFrame([(s, blocks[s], total[s], slots[s], sent[s]) for s in blocks], "s1 string, blocks long, total long, share long, sent array<long>")
    placed = placed.join(F.broadcast(plan), placed["s"].eqNullSafe(plan["s1"]))
    # The last document of a source may begin where its last block ends, with no characters left.
    placed = placed.withColumn("source_block", F.least(own_block, F.col("blocks") - 1))
    placed = placed.withColumn("k", F.explode(F.sequence(F.col("source_block"), F.col("total") - 1, F.col("blocks"))))
    turn = F.col("k") % F.col("share")
    slot = F.floor(F.col("k") / F.col("share")) * period + F.element_at("sent", (turn + 1).cast("int"))
    return placed.select(
        "d.*", "source_block", F.floor(F.col("k") / F.col("blocks")).alias("epoch"), slot.alias("slot"), F.floor(F.col("k") * period / F.col("share")).alias("release"),
        F.ceil((F.col("k") + 1) * period / F.col("share")).alias("deadline"), (F.col("at") - F.col("source_block") * block).alias("place"),
    )
