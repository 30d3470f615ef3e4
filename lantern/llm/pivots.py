"""Embedding near-duplicates through a pivot-permutation index.

Pivots come from a bounded sample of the vectors (SAMPLE at most), no two of them closer than APART, so that a large
group of near copies doesn't hold them all; random directions fill up what is missing. A vector is described by its NEAREST nearest pivots, in order; two vectors
are candidates if they share SHARED = 2 or more of them. The inverted lists are kept by pivot pair, so that a list
holds just the vectors whose shared-pivot count reaches 2. Every candidate's cosine is computed in double precision; a
pair counts in the list of its two least shared pivots alone, so lists need no later deduplication. Equal vectors
become one with a weight first. What goes on from a list is a count and a component for each vector, not pairs.

Lists travel in packs, so that a vector goes once to all its lists in a pack, in the precision it came in. Long lists are
cut into blocks and each pair of blocks is a piece of work, so no list is gathered whole.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, as do
vectors of different lengths; ids may be null (a row of its own, without links of its own) or repeated (one row for each
input row); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lantern.llm import textvec
from lantern.llm.common import forget, n_partitions, release, written
from lantern.llm.components import components, forest

PIVOTS, NEAREST, COSINE = 256, 6, 0.9
SAMPLE, APART = 4096, 0.6
#: Vectors of a list that one task compares with as many others.
BLOCK = 4096
#: Tasks that the copies of one vector are dealt to.
SALTS = 32
#: Numbers that the vectors of a pack of short lists hold, about.
PACK = 1 << 21
FOUND = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def usable(col: str) -> Column:
    c = F.col(col).cast("array<double>")
    good = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(c) > 0) & good & F.exists(c, lambda x: x != 0), F.lit(False))


def normal(x: np.ndarray) -> np.ndarray:
    """Rows of unit length, in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def cells_of(perm: np.ndarray, d: int) -> np.ndarray:
    """The names of the lists of each row: a length of vectors and two pivots of ascending number."""
    a, b = np.triu_indices(perm.shape[1], 1)
    return (d << 40) + (perm[:, a].astype(np.int64) << 20) + perm[:, b]


def packed(sizes: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """cell (ascending), pack and cuts of each list. Lists that follow each other share a pack as long as it holds about
    PACK numbers, so that a vector goes once to all lists of a pack; a list over BLOCK is a pack of its own, cut in blocks."""
    cell = np.array(sorted(sizes), np.int64)
    count = np.array([sizes[c] for c in cell.tolist()], np.int64)
    d, long = cell >> 40, count > BLOCK
    before = np.cumsum(np.where(long, 0, count * d)) - count * d * ~long
    names = np.stack([d, np.where(long, -1 - np.arange(len(cell)), before // PACK)])
    pack = np.unique(names, axis=1, return_inverse=True)[1].ravel() if len(cell) else cell
    return cell, pack.astype(np.int64), np.maximum(1, -(-count * long // BLOCK))


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    """Binary values of one length as the rows of a matrix."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).reshape(len(column), -1)


def nearest(x: np.ndarray, pivots: np.ndarray, m: int) -> np.ndarray:
    """The m nearest pivots of each row, nearest first; ties go to the lower number."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :m].astype(np.int16)


def choose(sample: np.ndarray, n: int, apart: float = APART) -> np.ndarray:
    """n unit vectors of which no two are closer than `apart`, in order of the sample, then of random directions."""
    rng = np.random.default_rng(len(sample[0]))
    extra = rng.normal(size=(4 * n, sample.shape[1]))
    rows = np.concatenate([sample, extra])
    rows /= np.sqrt((rows**2).sum(axis=1, keepdims=True))
    kept = np.empty((0, rows.shape[1]))
    for x in rows:
        if len(kept) < n and (not len(kept) or (kept @ x).max() < apart):
            kept = np.concatenate([kept, x[None]])
    return kept


def compare(x, perm, weight, rows, others, key: int, cosine: float, links: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Adds the links of one block's rows with another's that belong to this list; returns links that connect them.

    A pair belongs to the list of its two least shared pivots, that is if it shares none of the pivots under the
    list's second but the first. Rows are taken by the pattern of those lesser pivots, so that one look at two
    patterns settles all pairs of their rows, and rows of patterns that share a pivot aren't multiplied at all.
    """
    low, high = key >> 20, key & ((1 << 20) - 1)
    patterns, of = np.unique(np.where((perm < high) & (perm != low), perm, -1), axis=0, return_inverse=True)
    of = of.ravel()
    holds = np.zeros((len(patterns), int(perm.max()) + 2), np.float32)
    np.put_along_axis(holds, patterns.astype(np.int64) + 1, 1, axis=1)
    holds[:, 0] = 0
    rows, others = rows[np.argsort(of[rows], kind="stable")], others[np.argsort(of[others], kind="stable")]
    label, edges = np.arange(len(perm)), []
    for lo in range(0, len(rows), 512):
        part = rows[lo : lo + 512]
        kinds, kind = np.unique(of[part], return_inverse=True)
        apart = holds[kinds] @ holds.T == 0
        with_some = others[apart.any(axis=0)[of[others]]]
        if not len(with_some):
            continue
        hit = (x[part] @ x[with_some].T >= cosine) & apart[:, of[with_some]][kind.ravel()]
        if same:  # each pair is met from both sides
            hit &= part[:, None] != with_some
        if not hit.any():
            continue
        counted = hit.astype(np.float64)
        links[part] += (counted @ weight[with_some]).astype(np.int64)
        if not same:
            links[with_some] += (weight[part] @ counted).astype(np.int64)
        edges += forest(hit, part, with_some, label)
    return edges


def neighbours(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE, pivots: int = PIVOTS, m: int = NEAREST) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    parts = n_partitions(spark)
    single = vectors.schema[vec_col].dataType.elementType == T.FloatType()
    kind = np.float32 if single else np.float64  # vectors travel as they came
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{'float' if single else 'double'}>").alias("v"), usable(vec_col).alias("ok"))
    # equal vectors are one; a signed zero is a zero
    good = v.filter("ok and vec_id is not null").withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast("float" if single else "double")))
    one = written(good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("w")), "vectors")
    # copies of one vector meet it in many tasks; a vector without copies is its own
    every = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
    copied = one.filter("w > 1").withColumn("salt", F.explode(every))
    members = good.withColumn("salt", salt).join(copied, ["v", "salt"], "left").select("vec_id", F.coalesce("id", "vec_id").alias("id"), F.coalesce("w", F.lit(1).cast("long")).alias("w"))
    chosen: dict[int, list] = {}
    for r in one.select("v", "id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect():
        chosen.setdefault(len(r["v"]), []).append(r["v"])
    points = {d: choose(np.array(rows), pivots) for d, rows in chosen.items()}
    shared = spark.sparkContext.broadcast(points)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(0).offsets.to_numpy())
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                for lo in range(0, len(at), 2000):
                    part = batch.take(pa.array(at[lo : lo + 2000]))
                    raw = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    base = shared.value.get(int(d))
                    n = 0 if base is None else min(m, len(base))
                    perm = np.sort(nearest(normal(raw), base, n), axis=1) if n >= 2 else np.tile(np.array([0, 1], np.int16), (len(raw), 1))
                    cells = cells_of(perm, int(d))
                    columns = [pa.array(list(cells), pa.list_(pa.int64())), part.column(1), part.column(2), pa.array([r.tobytes() for r in perm], pa.binary()), pa.array([r.tobytes() for r in raw.astype(kind)], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["cells", "id", "w", "perm", "x"])

    described = written(one.select("v", "id", "w").mapInArrow(describe, "cells array<long>, id long, w long, perm binary, x binary"), "described")
    # a row for each pair of pivots that two vectors share: at most pivots * (pivots - 1) / 2 for a length of vectors
    sizes = described.select(F.explode("cells").alias("cell")).groupBy("cell").count().filter("count > 1").collect()
    plan = spark.sparkContext.broadcast(packed({r["cell"]: r["count"] for r in sizes}))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row of a vector for each pack that holds lists of it; where a list is cut, for each pair with its block."""
        cell, pack, cuts = plan.value
        for batch in batches:
            lists = batch.column(0)
            flat, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(cell, flat), max(len(cell) - 1, 0))
            listed = cell[at] == flat if len(cell) else np.zeros(len(flat), bool)
            at, row = at[listed], row[listed]
            first = np.unique(row * (len(cell) + 1) + pack[at], return_index=True)[1]
            at, row = at[first], row[first]
            own = (textvec.mix(batch.column(1).to_numpy()[row].view(np.uint64)) % cuts[at].astype(np.uint64)).astype(np.int64)
            again = np.repeat(np.arange(len(row)), cuts[at])
            other = np.arange(len(again)) - np.repeat(np.cumsum(cuts[at]) - cuts[at], cuts[at])
            own, of = own[again], pa.array(row[again])
            keys = [pack[at][again], np.minimum(own, other), np.maximum(own, other), own]
            for lo in range(0, len(again), 4096):
                part = batch.select(["id", "w", "perm", "x"]).take(of[lo : lo + 4096])
                yield pa.RecordBatch.from_arrays([*(pa.array(c[lo : lo + 4096]) for c in keys), *part.columns], ["pack", "p", "q", "own", "id", "w", "perm", "x"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by piece of work, so one piece is held at a time."""
        held: list[pa.RecordBatch] = []
        held_key = None
        for batch in filter(len, batches):
            key = np.stack([batch.column(c).to_numpy() for c in ("pack", "p", "q")], axis=1)
            ends = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            out = []
            for lo, hi in zip(ends.tolist(), [*ends[1:].tolist(), len(key)], strict=True):
                own = tuple(key[lo].tolist())
                if held and own != held_key:
                    out.append(settled(held, held_key))
                    held = []
                held.append(batch.slice(lo, hi - lo))
                held_key = own
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=FOUND)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in settled(held, held_key)], schema=FOUND)
        release()

    def settled(piece: list[pa.RecordBatch], key: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """id, links and root of the rows of FOUND that a piece of work gives."""
        ids, w, own = (np.concatenate([b.column(c).to_numpy() for b in piece]) for c in ("id", "w", "own"))
        x = normal(np.concatenate([_rows(b.column("x"), kind) for b in piece]))
        perm = np.concatenate([_rows(b.column("perm"), np.int16) for b in piece])
        cells = cells_of(perm, x.shape[1])
        wanted = plan.value[0][plan.value[1] == key[0]]
        row, column = np.nonzero(np.isin(cells, wanted))
        cell = cells[row, column]
        order = np.argsort(cell, kind="stable")
        row, cell = row[order], cell[order]
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])).tolist()
        links, edges = np.zeros(len(ids), np.int64), []
        for lo, hi in zip(starts, [*starts[1:], len(cell)], strict=True):
            if hi - lo < 2:
                continue
            at, mine = row[lo:hi], np.zeros(hi - lo, np.int64)
            a, b = np.flatnonzero(own[at] == key[1]), np.flatnonzero(own[at] == key[2])
            found = compare(x[at], perm[at], w[at].astype(np.float64), a, b, int(cell[lo]) & ((1 << 40) - 1), cosine, mine, key[1] == key[2])
            links[at] += mine
            edges += [at[e] for e in np.array(found, np.int64).reshape(-1, 2)]
        e = np.unique(np.array(edges, np.int64).reshape(-1, 2), axis=0)
        some = np.flatnonzero(links)
        return np.concatenate([ids[some], ids[e[:, 0]]]), np.concatenate([links[some], np.zeros(len(e), np.int64)]), np.concatenate([ids[some], ids[e[:, 1]]])

    work = described.mapInArrow(deal, "pack long, p long, q long, own long, id long, w long, perm binary, x binary")
    dealt = work.repartition(parts, "pack", "p", "q").sortWithinPartitions("pack", "p", "q")
    found = written(dealt.mapInArrow(search, "id long, links long, root long"), "found")
    forget(described)
    n_links = found.groupBy("id").agg(F.sum("links").alias("n"))
    labels = components(found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    by_one = one.select("id", "w").join(n_links, "id", "left").join(labels, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "id").alias("component"), F.explode(F.when(F.col("w") > 1, every).otherwise(F.array(F.lit(0).cast("long")))).alias("salt"))
    linked = members.withColumn("salt", F.when(F.col("w") > 1, salt).otherwise(F.lit(0).cast("long"))).join(by_one, ["id", "salt"]).select("vec_id", (F.col("n") + F.col("w") - 1).alias("n_links"), F.col("component").alias("component_id"))
    alone = v.filter("not ok or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
