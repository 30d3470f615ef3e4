"""Mixing sources to target weights by Pfair scheduling.

A source's documents are dealt into blocks. With weight w, its block i (from 0) is released at slot floor(i / w) and
due by slot ceil((i + 1) / w); at each slot the released block with the earliest deadline goes next. One unit of work
a slot and weights that sum to 1 make that schedule feasible, so after every slot each source is within one block of
its share, however many slots there are: weights are taken as exact fractions. When a source has no blocks left, a
new phase begins with the weights of those that have.

The schedule is one sequence, so one task makes it from the counts of sources and writes it block by block; the task
holds a few numbers for each source, and its time grows with the number of blocks (rows / block). Nothing comes to the
driver. Rows then find their blocks' slots by a join, a broadcast one where the written slots are few.

Defined results: every row is kept, at one place; a null source is a source of its own; null ids are ordered first;
repeated rows share an order key and take neighbouring places; other columns are ignored; an empty table gives an
empty mix. The last block of a source may be short, so places can have gaps. Weights of 0 or less, or that aren't
finite, raise ValueError.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import inf, lcm

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lantern.llm.common import n_partitions, small, written

BLOCK = 16
#: Least number of shards of a source, and shards for each partition of a shuffle; powers of 2.
SHARDS, SHARES = 256, 4
#: Slots that the scheduling task writes at a time.
BATCH = 1 << 16


def schedule(shares: list[int], blocks: list[int]) -> Iterator[int]:
    """The source of each slot until one has no blocks left, earliest deadline first among the released. Weights are
    shares[s] / sum(shares), in whole numbers, so releases and deadlines are exact."""
    n, done = sum(shares), [0] * len(shares)
    later = [(0, s) for s in range(len(shares))]  # (release, source)
    ready: list[tuple[int, int]] = []  # (deadline, source)
    slot = 0
    while True:
        while later and later[0][0] <= slot:
            _, s = heapq.heappop(later)
            heapq.heappush(ready, (-(-(done[s] + 1) * n // shares[s]), s))
        due, s = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a deadline is missed")
        yield s
        slot += 1
        done[s] += 1
        if done[s] == blocks[s]:
            return
        heapq.heappush(later, (done[s] * n // shares[s], s))


def shares_of(weights: list[float]) -> list[int]:
    """Whole numbers in the very proportions of the weights: floats are rational."""
    exact = [Fraction(w) for w in weights]
    common = lcm(*(e.denominator for e in exact))
    return [int(e * common) for e in exact]


def slots(blocks: list[int], weights: list[float]) -> Iterator[tuple[int, int, int]]:
    """(source, block, phase) of slot after slot."""
    done, phase, shares = [0] * len(blocks), 0, shares_of(weights)
    while active := [s for s in range(len(blocks)) if done[s] < blocks[s]]:
        for k in schedule([shares[s] for s in active], [blocks[s] - done[s] for s in active]):
            yield active[k], done[active[k]], phase
            done[active[k]] += 1
        phase += 1


SLOTS = pa.schema([("p_source", pa.string()), ("p_block", pa.int64()), ("slot", pa.int64()), ("phase", pa.int32())])


def planned(totals: DataFrame, weights: dict | None, block: int, temperature: float) -> DataFrame:
    """(p_source, p_block, slot, phase) of every block, written; totals: source and count of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(s, n) for b in batches for s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or ""))
        names = [s for s, _ in rows]
        wanted = [float((weights or {}).get(s, n**temperature)) for s, n in rows]
        held: list[tuple] = []
        for slot, (s, k, phase) in enumerate(slots([-(-n // block) for _, n in rows], wanted)):
            held.append((names[s], k, slot, phase))
            if len(held) == BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), SLOTS, strict=True)], schema=SLOTS)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), SLOTS, strict=True)], schema=SLOTS)

    if any(not 0 < float(w) < inf for w in (weights or {}).values()):
        raise ValueError("weights must be over 0")
    return written(totals.repartition(1).mapInArrow(run, "p_source string, p_block long, slot long, phase int"), "slots")


def shard_bits(partitions: int) -> int:
    """Leading bits of the hash that tell the shard: a shard is a range of hashes, so places don't depend on their number."""
    return (max(SHARDS, SHARES * partitions) - 1).bit_length()


def mix(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source", block: int = BLOCK, temperature: float = 0.5, whole: bool = False) -> DataFrame:
    """doc_id, source, block, slot (the block's place), position (the row's place in the mix), phase.

    weights: target weight by source, over 0; those left out, or all if None, get their share of rows to the power
    `temperature`. Rows are ordered within a source by a hash of the id. Sources are cut in shards by that hash, some for
    each partition of a shuffle, so that a hot one is numbered by all tasks, whatever the size; counts of shards, not rows,
    meet where offsets are made. Rows that share an id are numbered by one task. whole: with a last column `row`, the row
    itself as a struct.
    """
    spark = docs.sparkSession
    own = [F.struct(*docs.columns).alias("row")] if whole else []
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(F.col(id_col)).alias("_h"), *own)
    d = d.withColumn("_shard", F.shiftrightunsigned(F.col("_h"), 64 - shard_bits(n_partitions(spark))).cast("int"))
    own = ["row"] if whole else []
    shards = written(d.groupBy("source", "_shard").count(), "shards")
    before = F.sum("count").over(Window.partitionBy("source").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = shards.select(F.col("source").alias("o_source"), F.col("_shard").alias("o_shard"), F.coalesce(before, F.lit(0).cast("long")).alias("before"))
    plan = planned(shards.groupBy("source").agg(F.sum("count").alias("count")), weights, block, temperature)
    order = Window.partitionBy("source", "_shard").orderBy("_h", "doc_id")
    d = d.withColumn("_rn", F.row_number().over(order).cast("long"))
    d = d.join(small(written(offsets, "offsets")), F.col("source").eqNullSafe(F.col("o_source")) & (F.col("_shard") == F.col("o_shard")))
    k = F.col("before") + F.col("_rn") - 1
    d = d.select("doc_id", "source", k.alias("_k"), F.floor(k / block).cast("long").alias("block"), *own)
    d = d.join(small(plan), F.col("source").eqNullSafe(F.col("p_source")) & (F.col("block") == F.col("p_block")))
    return d.select("doc_id", "source", "block", "slot", (F.col("slot") * block + F.col("_k") % block).alias("position"), "phase", *own)


def ordered(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """docs, whole rows, in the order of their positions in the mix."""
    return mix(docs, weights, id_col, source_col, block, whole=True).orderBy("position").select("row.*")
